import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import packing
from footfall.llm.queries import loaded_packing_params, op10_best_fit_packing, packing_params
from tests.llm.rows import empty_table, odd_documents, odd_table, prose


def _ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")


@pytest.mark.parametrize(
    "text", [prose(500), "a" * 5000, " " * 5000, "é漢字🙂​﻿ " * 50, "\r\n\t  x  y", "<|endoftext|>a", "'ll 'LL 1234567 ½²"]
)
def test_ids_are_those_of_the_json_vocabulary(text):
    ids = packing._encoder(packing_params()).encode_ordinary(text)
    assert ids == list(_ids(text)[:-1])


ADDED = "a <|endoftext|> b"


@pytest.mark.parametrize(
    "text", [ADDED, "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a\n<|endoftext|>\n b <|endoftext|", prose(100)]
)
def test_ids_are_those_of_the_tokenizer_as_loaded(text):
    params = loaded_packing_params()
    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = loaded.encode(text, add_special_tokens=False).ids
    assert packing._encode(packing._encoder(params), text, params) == expected


def test_the_query_gives_ids_as_loaded(spark, tmp_path):
    spark.createDataFrame([(1, ADDED)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = op10_best_fit_packing(spark, str(tmp_path)).first()
    ids = np.array([64, 220, 50256, 275, 2], dtype="<u4")
    assert (row.length, row.ids_crc32) == (5, zlib.crc32(ids.tobytes()))


def check_sequences(rows, capacity):
    """Gapless from 0 and never too long."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_odd_documents(spark):
    rows = packing.pack_documents(odd_table(spark), packing_params()).collect()
    check_sequences(rows, 1024)
    found, expected = Counter(), Counter()
    for r in rows:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    for doc in odd_documents():
        ids = _ids(doc[1])
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 1024)):
            own = zlib.crc32(ids[start : start + length].tobytes())
            expected[doc[0], piece, start, length, own] += 1
    assert found == expected


def test_null_id_and_large_ids(spark):
    docs = [(None, "a b"), (2**60 + 1, "c d")]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), packing_params()).collect()
    assert {r.doc_id for r in rows} == {None, 2**60 + 1}


def test_empty_table(spark):
    assert packing.pack_documents(empty_table(spark), packing_params()).collect() == []


def test_cuts():
    assert packing.cuts(5, 4) == [(0, 1), (1, 4)]
    assert packing.cuts(8, 4) == [(0, 4), (4, 4)]
    assert packing.cuts(1, 4) == [(0, 1)]


@pytest.mark.parametrize("rank_rows", [5, 200_000])
def test_hot_length_is_ranked_in_buckets(spark, rank_rows):
    params = packing.PackingParams("", "", capacity=10, rank_rows=rank_rows)
    rng = random.Random(3)
    sizes = [3] * 100 + [rng.randrange(1, 11) for _ in range(200)]
    pieces = spark.createDataFrame(
        [(i, 0, 0, n, i) for i, n in enumerate(sizes)],
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )
    rows = packing.pack(pieces, params).collect()
    assert sorted(r.length for r in rows) == sorted(sizes)
    planned = sum(times for times, _ in packing.plan(Counter(sizes), 10))
    assert check_sequences(rows, 10) == planned <= math.ceil(sum(sizes) / 10) * 1.03


def _fewest(sizes, capacity):
    """By trying everything, largest first."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_never_costs_a_sequence(seed):
    """What is fixed, with the best packing of the remainder, is a best packing."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    sizes = [rng.randrange(rng.choice([1, capacity // 3]), capacity + 1) for _ in range(rng.randrange(1, 10))]
    fixed, rest = packing.reduced(Counter(sizes), capacity)
    for _, pattern in fixed:
        assert sum(s * n for s, n in pattern.items()) <= capacity
    used = sum(times for times, _ in fixed)
    placed = Counter(rest)
    for times, pattern in fixed:
        placed.update({s: n * times for s, n in pattern.items()})
    assert placed == Counter(sizes)
    assert used + _fewest(list(Counter(rest).elements()), capacity) == _fewest(sizes, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_the_plain_one(seed):
    """Groups of equal sequences give as many as placing piece by piece."""
    rng = random.Random(seed)
    counts = Counter(rng.randrange(1, 100) for _ in range(400))
    rooms = []
    for size in sorted(counts.elements(), reverse=True):
        fitting = [k for k, r in enumerate(rooms) if r >= size]
        k = min(fitting, key=lambda k: rooms[k], default=None)
        if k is None:
            rooms.append(100 - size)
        else:
            rooms[k] -= size
    found = packing.best_fit(dict(counts), 100)
    assert sum(times for times, _ in found) == len(rooms)
