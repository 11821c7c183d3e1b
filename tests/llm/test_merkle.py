import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.llm import merkle
from footfall.llm.queries import LEAF_FIELDS, op13_merkle_manifest
from tests.llm.rows import SCHEMA, empty_table, odd_table


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(values):
    shown = [None if v is None else str(v) for v in values]
    return _sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def _levels(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_sha("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def _steps(levels, place, fanout):
    for nodes in levels[:-1]:
        start = place // fanout * fanout
        yield "".join(nodes[start:place]), "".join(nodes[place + 1 : start + fanout])
        place //= fanout


def plain(rows, fanout=3):
    """``(group, order, digest)`` rows: order, digest, subroot, root and path of each."""
    groups = {}
    for group, order, digest in rows:
        groups.setdefault(group, []).append(((order is not None, order or 0), digest, order))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([d for _, d, _ in sorted(groups[g], key=lambda x: x[:2])], fanout) for g in names}
    upper = _levels([trees[g][-1][0] for g in names], fanout)
    found = []
    for k, g in enumerate(names):
        for place, (_, digest, order) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            path = [*_steps(trees[g], place, fanout), *_steps(upper, k, fanout)]
            found.append((order, digest, trees[g][-1][0], upper[-1][0], path))
    return sorted(found, key=str)


def _built(table, **params):
    rows = merkle.build_manifest(table, "g", "o", "d", params=merkle.MerkleParams(**params)).collect()
    found = [
        (r.node.row.o, r.node.digest, r.subroot, r.root, [(s.before, s.after) for s in r.path])
        for r in rows
    ]
    return sorted(found, key=str)


@pytest.mark.parametrize("fanout, levels", [(3, 2), (2, 3)])
def test_like_a_plain_tree(spark, fanout, levels):
    """Groups of every size up to two pivots and beyond, NULLs and ties among them."""
    rng = random.Random(5)
    rows = []
    for group, size in [(None, 5), ("a", 1), ("b", 2), ("B", 3), ("é", 4), ("c", 28), ("d", 90), ("e", 9)]:
        rows += [(group, rng.choice([None, i, i // 3]), _sha(f"{group}{i // 2}")) for i in range(size)]
    table = spark.createDataFrame(rows, "g string, o long, d string").repartition(5)
    assert _built(table, fanout=fanout, levels=levels) == plain(rows, fanout)


@pytest.mark.parametrize("n", [1, 3, 10, 28])
def test_one_group(spark, n):
    rows = [("g", i, _sha(str(i))) for i in range(n)]
    assert _built(spark.createDataFrame(rows, "g string, o long, d string")) == plain(rows)


def test_every_proof_leads_to_the_root_and_no_other_leaf_does(spark):
    rows = [(f"g{i % 4}", i, _sha(str(i))) for i in range(40)]
    table = spark.createDataFrame(rows, "g string, o long, d string")
    built = merkle.build_manifest(table, "g", "o", "d")
    own, other = merkle.folded(F.col("node.digest"), F.col("path")), F.sha2(F.col("node.digest"), 256)
    for r in built.select("root", own.alias("own"), merkle.folded(other, F.col("path")).alias("other")).collect():
        assert r.own == r.root != r.other


def test_query_on_odd_documents(spark, tmp_path):
    more = spark.createDataFrame([(i, "a\n\nb", "en", "t", 4) for i in range(30, 36)], SCHEMA)
    odd = odd_table(spark).unionByName(more, allowMissingColumns=True)
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    docs = [r[:1] + (r[3], r[2], r[4], r[1]) for r in odd.collect()]
    expected = {}
    tree = plain([(s, i, _leaf((i, s, lang, n, t))) for i, s, lang, n, t in docs])
    short = {
        (i, _leaf((i, s, lang, n, t))): _leaf((i, s, lang, n, t and t.replace("\n", "")))
        for i, s, lang, n, t in docs
    }
    for i, leaf, subroot, root, path in tree:
        changed = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        at = short[i, leaf] if changed else leaf
        for before, after in path:
            at = _sha(before + at + after)
        proof = _sha("".join(b + a for b, a in path))
        expected.setdefault((i, leaf, subroot, root, proof, at, at == root), []).append(1)
    found = {}
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    for r in op13_merkle_manifest(spark, str(tmp_path)).collect():
        found.setdefault(tuple(r[c] for c in names), []).append(1)
    assert found == expected
    assert {k[-1] for k in found} == {True, False}
    assert LEAF_FIELDS[0] == "doc_id"


def test_empty_table(spark):
    table = empty_table(spark).selectExpr("source AS g", "doc_id AS o", "text AS d")
    assert merkle.build_manifest(table, "g", "o", "d").collect() == []
