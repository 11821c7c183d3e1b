import random
import re
from pathlib import Path

import pytest

from footfall.llm import ngram_jaccard
from footfall.llm.components import connected_components
from footfall.llm.ngram_jaccard import JaccardParams, near_duplicates
from footfall.sources.workspace import shared_folder
from tests.llm.rows import LOWER, empty_table, odd_documents, odd_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, k=4, percent=85):
    """Every pair compared."""
    sets = {}
    for i, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        grams = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))}
        sets[i] = grams if words else set()
    root = {i: i for i in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def _copies(seed, n=160):
    """Groups of near copies, and a passage that many documents share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([30, 3000]))]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([30, 60, 120]))] for _ in range(3)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    docs = []
    for i in range(n):
        words, kind = list(rng.choice(bases)), rng.random()
        if kind < 0.7:
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
                at = rng.randrange(len(words))
                words[at] = rng.choice(vocabulary) if rng.random() < 0.5 else words[at] + rng.choice("abc")
            words = words[rng.randrange(5) :] if rng.random() < 0.3 else words
        elif kind < 0.9:
            words = passage + [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 8, 12, 30]))]
        else:
            words = words[: rng.randrange(6)]
        docs.append((i, " ".join(words) if words else rng.choice(["", None, " "])))
    return docs


@pytest.mark.parametrize("seed, small_group", [(0, 1), (1, 2), (2, 12), (3, 1), (4, 4)])
@pytest.mark.parametrize("shingle, percent", [(4, 85), (5, 80)])
def test_against_all_pairs(spark, seed, small_group, shingle, percent):
    docs = _copies(seed)
    params = JaccardParams(shingle=shingle, percent=percent, small_group=small_group)
    found = near_duplicates(spark.createDataFrame(docs, "id long, text string"), params)
    rows = {r.id: (r.n_shingles, r.component) for r in found.collect()}
    assert rows == plain(docs, shingle, percent)


def test_odd_documents(spark):
    docs = odd_table(spark).drop("id").withColumnRenamed("doc_id", "id")
    found = {r.id: (r.n_shingles, r.component) for r in near_duplicates(docs).collect()}
    assert found == plain([r[:2] for r in odd_documents()])


def test_empty_table(spark):
    assert near_duplicates(empty_table(spark).withColumnRenamed("doc_id", "id")).collect() == []


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:])) + [(100, 101), (101, 100), (7, 7)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in found} == {**{i: 0 for i in range(1, 60)}, 101: 100}


def test_starts_are_shuffled_once_at_a_time_and_gone_before_the_texts(spark, monkeypatch):
    """No query explodes them twice or shuffles them whole; none is on disk when texts are cut up."""
    plans, left, write, cut = {}, [], ngram_jaccard.materialize, ngram_jaccard._segments

    def starts():
        return {p for name in ("starts", "shared", "found") for p in Path(shared_folder(spark)).rglob(f"{name}-*")}

    def written(df, name="rows", *args, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name, *args, **options)

    def segments(*args):
        left.append(starts() - before)
        return cut(*args)

    monkeypatch.setattr(ngram_jaccard, "materialize", written)
    monkeypatch.setattr(ngram_jaccard, "_segments", segments)
    docs, before = spark.createDataFrame(_copies(2), "id long, text string"), starts()
    found = {r.id: (r.n_shingles, r.component) for r in near_duplicates(docs).collect()}
    assert found == plain(_copies(2))
    exploding = [plan.split("Generate explode(start")[1:] for plan in plans.values()]
    assert max(map(len, exploding)) == 1
    assert not any("Join" in below.partition("Relation")[0] for parts in exploding for below in parts)
    assert left == [set()]


def test_rows_that_outgrow_their_files_are_not_broadcast(spark, monkeypatch):
    """Exploded and compressed rows look small to the planner; broadcasts of them pass through the driver."""
    plans, write = [], ngram_jaccard.materialize

    def written(df, name="rows", *args, **options):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name, *args, **options)

    monkeypatch.setattr(ngram_jaccard, "materialize", written)
    docs = _copies(3)
    params = JaccardParams(small_group=1)
    found = near_duplicates(spark.createDataFrame(docs, "id long, text string"), params)
    assert {r.id: (r.n_shingles, r.component) for r in found.collect()} == plain(docs)
    names = [name for name, _ in plans]
    assert names.count("pairs") == names.count("links") == 2
    _, across = [plan for name, plan in plans if name == "pairs"]
    large = [plan for name, plan in plans if name in ("found", "links", "elements")]
    assert len(large) == 4
    for plan in [*large, across]:
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    # Of those that can link, only the postings' own join is left to the planner.
    (able,) = [plan for name, plan in plans if name == "able"]
    assert not any("LeftAnti" in x and "Broadcast" in x for x in able.splitlines())
