import random
import re
from collections import defaultdict

import pytest

from footfall.llm.decontamination import DecontaminationParams, decontaminate
from footfall.sources import workspace
from tests.llm.rows import LOWER, empty_table, odd_documents, odd_table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def plain(docs, items, span=13):
    windows = defaultdict(set)
    for i, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(span, len(words))
        for j in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[j : j + n])].add(str(i))
    out = {}
    for i, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if ids := windows.get(tuple(words[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= ids
        out[i] = (len(words), len(hit), sorted(found), 0 < len(hit) and 20 * len(hit) >= len(words))
    return out


def _found(docs, items, params=DecontaminationParams()):
    rows = decontaminate(docs, items, params).collect()
    return {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_against_all_windows(spark, seed):
    """Few different words, so spans recur, overlap and cross; items of any length."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice([3, 12, 400]))]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(100, items[3][1]), (101, None)]
    docs = []
    for i in range(80):
        text = [rng.choice(words) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            source = (rng.choice(items)[1] or "").split()
            first = rng.randrange(len(source) + 1)
            at = rng.randrange(len(text) + 1)
            text[at:at] = source[first : first + rng.choice([5, 12, 13, 20])]
        docs.append((i, rng.choice([" ", ", ", "-\n"]).join(text).upper() if i % 2 else " ".join(text)))
    found = _found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert found == plain(docs, items)


def test_every_shared_span_is_seen(spark):
    """One span of thirteen words, at every place of a document."""
    item = " ".join(f"i{i}" for i in range(13))
    docs = [(n, " ".join([f"a{n}x{j}" for j in range(n)] + [item] + ["z"] * 7)) for n in range(30)]
    found = _found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], ITEMS))
    assert {v[1] for v in found.values()} == {13}


def test_texts_of_one_id_are_judged_one_by_one(spark):
    copied, clean = " ".join(f"i{i}" for i in range(20)), " ".join(f"w{i}" for i in range(2000))
    docs = [(1, copied), (1, clean), (2, clean), (None, copied), (None, clean), (3, copied), (3, copied)]
    rows = decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, copied)], ITEMS)
    ).collect()
    hit, unhit = (20, 20, ["7"], True), (2000, 0, [], False)
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in rows)
    expected = [("1", *hit), ("2", *unhit), ("3", *hit), ("None", *hit), ("None", *unhit)]
    assert found == sorted(expected)


def test_odd_documents(spark):
    items = [(1, odd_documents()[6][1]), (2, "one"), (3, None), (3, ""), (4, "a a a")]
    found = _found(odd_table(spark), spark.createDataFrame(items, ITEMS))
    assert found == plain([r[:2] for r in odd_documents()], items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert _found(empty_table(spark), none) == {}
    assert _found(empty_table(spark), spark.createDataFrame([(1, "a b")], ITEMS)) == {}
    clean = _found(odd_table(spark), none)
    assert len(clean) == len({r[0] for r in odd_documents()})
    assert not any(v[3] for v in clean.values())


def test_few_hit_documents_are_found_without_shuffling_the_others(spark, monkeypatch):
    """Whatever the planner thinks of sizes; beyond the bound the plain join gives the same."""
    rows = [(i, f"text {i}") for i in range(50)] + [(None, "x"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = spark.createDataFrame([(3,), (7,), (7,), (99,)], "doc_id long")
    few = workspace.with_few(docs, keys, "doc_id")
    assert sorted(r.doc_id for r in few.collect()) == [3, 3, 7]
    monkeypatch.setattr(workspace, "FEW_KEYS", 3)
    assert workspace.with_few(docs, keys, "doc_id").count() == len(rows)
