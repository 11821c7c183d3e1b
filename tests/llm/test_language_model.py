import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from footfall.llm import language_model, recurrent
from footfall.llm.language_model import LanguageModelParams, score_documents
from tests.llm.rows import LOWER, empty_table, odd_documents, odd_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = LanguageModelParams(listed=40, class_size=4, classes=7, hidden=8, epochs=8)


def _weights(seed=0, hidden=5):
    counts = np.array([50, 30, 20, 10, 9, 8, 7, 6])
    return recurrent.new_weights(counts, 40.0, 4, hidden, seed)


def test_gradients():
    """Against finite differences, in double precision."""
    weights = {k: w.astype(float) for k, w in _weights().items()}
    rng = np.random.default_rng(1)
    targets = rng.integers(0, 9, (3, 6))
    targets[1, 4:] = -1
    inputs = np.where(targets >= 0, rng.integers(0, 9, (3, 6)), -1)
    h0 = np.zeros((3, 5))

    def loss(w):
        h, total = h0, 0.0
        for t in range(6):
            h = recurrent._step(w, w["x"][np.maximum(inputs[:, t], 0)], h)[0]
            on = targets[:, t] >= 0
            total -= recurrent._log_chances(w, h[on], targets[on, t]).sum()
        return total / (targets >= 0).sum()

    grads, _ = recurrent._gradients(weights, inputs, targets, h0)
    for name, w in weights.items():
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(12)]:
            up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            numeric = (loss(up) - loss(down)) / 2e-5
            assert grads[name][at] == pytest.approx(numeric, abs=2e-4), (name, at)


def test_chances_add_up_to_one():
    weights = _weights()
    state = np.random.default_rng(2).normal(size=(1, 5)).astype(np.float32)
    logs = [recurrent._log_chances(weights, state, np.array([i]))[0] for i in range(9)]
    assert sum(map(math.exp, logs)) == pytest.approx(1, abs=1e-5)


def test_state_goes_on_over_windows_and_neighbours_do_not_matter():
    rng = np.random.default_rng(3)
    documents = [rng.integers(0, 9, n) for n in (1, 300, 7, 64, 65, 128)] + [np.array([], int)]
    whole = recurrent.score(_weights(), documents, 0, window=1000)
    assert recurrent.score(_weights(), documents, 0, side=2, window=9) == pytest.approx(whole, abs=1e-3)
    assert whole[-1] == 0


def _texts(n, seed=1):
    """Two languages, so what came before tells what comes next."""
    rng = random.Random(seed)
    words = [[f"{c}{i}" for i in range(12)] for c in "ab"]
    return [(i, " ".join(rng.choice(rng.choice([words[i % 2]])) for _ in range(rng.randrange(5, 60)))) for i in range(n)]


def _base(docs):
    docs = [(i, WORD.findall((t or "").translate(LOWER)) + ["\0end"]) for i, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    counts = Counter(w for (_, words), h in zip(docs, held) if not h for w in words)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, h, len(words), sum(counts[w] > 0 for w in words), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 5))
        for (i, words), h in zip(docs, held)
    ]


def _same_base(rows, docs):
    found = [(*tuple(r)[:5], round(r.base_score, 5)) for r in rows]
    assert sorted(map(str, found)) == sorted(map(str, _base(docs)))


def test_learns_and_beats_the_base_on_held_out_documents(spark):
    docs = _texts(400)
    rows = score_documents(spark.createDataFrame(docs, "doc_id long, text string"), SMALL).collect()
    _same_base(rows, docs)
    held = [r for r in rows if r.held_out]
    assert len(held) > 30
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.2  # two languages of equal size: log10(2) = 0.30 a word at most


def test_odd_documents(spark):
    docs = [r[:2] for r in odd_documents()] + [(None, "one of"), (2**60, "one")]
    table = odd_table(spark).select("doc_id", "text")
    table = table.unionAll(spark.createDataFrame(docs[-2:], table.schema))
    rows = score_documents(table, SMALL).collect()
    _same_base(rows, docs)
    assert all(math.isfinite(r.score) for r in rows)
    same = {(r.doc_id, r.n_tokens): r.score for r in rows}
    assert all(same[r.doc_id, r.n_tokens] == pytest.approx(r.score, abs=1e-2) for r in rows)


def test_no_training_document(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = [(held, "a b")]
    _same_base(score_documents(spark.createDataFrame(docs, "doc_id long, text string"), SMALL).collect(), docs)


def test_empty_table(spark):
    assert score_documents(empty_table(spark), SMALL).collect() == []


def test_texts_are_lowered_and_cut_up_once(spark):
    docs = spark.createDataFrame([(1, " A\tb "), (2, None), (3, " \n")], "doc_id long, text string")
    tokens = language_model._tokens(docs, SMALL)
    plan = tokens._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(f"{name}(") for name in ("lower", "split")] == [1, 1]
    assert sorted(len(r.hashes) for r in tokens.collect()) == [0, 0, 2]


def test_a_long_text_does_not_go_on_by_itself():
    texts = [np.ones(20, int)] * 160 + [np.ones(400, int)]
    ordered = language_model._long_ones_first(texts, 16)
    assert sorted(map(len, ordered)) == sorted(map(len, texts))
    steps = len(list(recurrent._windows(ordered, 0, 16, 20)))
    assert steps == 20 < len(list(recurrent._windows(texts, 0, 16, 20)))


def test_lookup_finds_listed_words_only():
    rng = random.Random(4)
    ends = [-(2**63), -(2**63) + 1, -1, 0, 1, 2**63 - 2, 2**63 - 1]
    words = ends[::2] + [rng.randrange(-(2**63), 2**63) for _ in range(300)] + list(range(50, 70))
    hashes = np.array(sorted(words), np.int64)
    ranks = np.random.default_rng(5).permutation(len(words))
    for n in (len(words), 1, 0):
        model = language_model.LanguageModel({}, hashes[:n], ranks[:n], ranks[:n] + 1, 3, 0, 0, 0, 0.0)
        lookup = language_model._Lookup(model)
        listed = dict(zip(hashes[:n].tolist(), ranks.tolist()))
        asked = np.array(words + ends + [71, -5], np.int64)
        assert lookup.ranks[lookup.places(asked)].tolist() == [listed.get(w, -1) for w in asked.tolist()]


def test_equal_rows_with_unlisted_words(spark):
    """Each of them gets the counts of its own words, whatever its id."""
    few = LanguageModelParams(listed=2, class_size=2, classes=1, hidden=4)
    docs = [(1, "a b c d e d"), (1, "a b c d e d"), (1, "e f"), (None, "c c c"), (None, "c c c"), (4, None)]
    rows = score_documents(spark.createDataFrame(docs, "doc_id long, text string"), few).collect()
    _same_base(rows, docs)
