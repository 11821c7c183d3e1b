"""Best-fit packing of documents into sequences, after Martello and Toth's reduction.

Documents become token ids, one end mark each; those longer than a sequence are cut,
the shorter piece first. Only the length of a piece matters for its place, and there
are no more lengths than a sequence has tokens. So Spark counts pieces by length, the
plan is made on that one histogram, and Spark deals the pieces to the planned
places by their rank within their length. Nothing else passes through the driver.

The plan first fixes sets that provably dominate every alternative: for the longest
piece not placed yet, alone if nothing fits beside it; with the longest that fits,
if that fills the sequence, if no two others fit, or if it is at least as long as the
longest two that fit when no three do. Each fixed set shrinks the instance, so this is
repeated until nothing changes. What is left goes by best fit, longest first. Equal
sets are planned once, with a multiplicity.

Texts are cut at the tokenizer's added tokens, whose own ids stand for them; what lies
between is encoded with the ranks.

Defined cases: a NULL or empty text is its end mark alone. Repeated rows are packed
one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize


@dataclass(frozen=True)
class PackingParams:
    #: Ranks of the tokenizer's vocabulary and its splitting pattern.
    ranks_path: str
    pattern: str
    capacity: int = 1024
    end_id: int = 2
    keep_ids: bool = False
    #: Pieces of one length that one task ranks.
    rank_rows: int = 200_000
    #: Added tokens with their ids, as in the vocabulary's file.
    added_tokens: tuple[tuple[str, int], ...] = ()


def _encoder(params: PackingParams):
    import tiktoken

    with open(params.ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "of_file", pat_str=params.pattern, mergeable_ranks=ranks, special_tokens={}
    )


def _encode(encoder, text: str, params: PackingParams) -> list[int]:
    """Ids of a text: those of its added tokens, of the runs between them by the ranks.

    Where two added tokens start at one place the longer one counts.
    """
    added = dict(params.added_tokens)
    if not any(token in text for token in added):
        return encoder.encode_ordinary(text)
    longest_first = sorted(added, key=len, reverse=True)
    parts = re.split(f"({'|'.join(map(re.escape, longest_first))})", text)
    ids: list[int] = []
    for k, part in enumerate(parts):
        ids += [added[part]] if k % 2 else encoder.encode_ordinary(part)
    return ids


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens; only the first may be short."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(docs: DataFrame, params: PackingParams) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if kept, ``ids``."""
    # Ids travel as text: pandas would turn those of a batch with a NULL into doubles.
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long"
    if params.keep_ids:
        schema += ", ids array<int>"

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(params)
        columns = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = _encode(encoder, text or "", params)
                ids = np.array([*ids, params.end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), params.capacity)):
                    own = ids[start : start + length]
                    row = [doc_id, piece, start, length, zlib.crc32(own.tobytes())]
                    rows.append([*row, own.astype("int32")] if params.keep_ids else row)
            yield pd.DataFrame(rows, columns=columns)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(tokenize, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


Pattern = tuple[int, dict[int, int]]  # how many sequences, pieces by length in each


def _best_pair(counts: dict[int, int], room: int) -> int:
    """The largest total of two pieces that fit into ``room``; 0 if none do."""
    sizes = sorted(s for s, n in counts.items() if n)
    low, high, best = 0, len(sizes) - 1, 0
    while low <= high:
        total = sizes[low] + sizes[high]
        if total > room:
            high -= 1
        else:
            if low != high or counts[sizes[low]] > 1:
                best = max(best, total)
            low += 1
    return best


def _smallest(counts: dict[int, int], k: int) -> list[int]:
    """The ``k`` shortest pieces, or all if there are fewer."""
    out: list[int] = []
    for size in sorted(s for s, n in counts.items() if n):
        out += [size] * min(counts[size], k - len(out))
        if len(out) == k:
            break
    return out


def _dominating(counts: dict[int, int], size: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of ``size`` that no other such set can beat, if one is known."""
    others = dict(counts)
    others[size] -= 1
    room = capacity - size
    least = _smallest(others, 3)
    if not least or least[0] > room:
        return (size,)
    partner = max(s for s, n in others.items() if n and s <= room)
    if partner == room or sum(least[:2]) > room or len(least) == 1:
        return (size, partner)
    if (len(least) == 2 or sum(least) > room) and partner >= _best_pair(others, room):
        return (size, partner)
    return None


def reduced(histogram: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """The dominating sets that are fixed for good, and what remains."""
    counts = {s: n for s, n in histogram.items() if n}
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for size in sorted(counts, reverse=True):
            while counts[size]:
                chosen = _dominating(counts, size, capacity)
                if chosen is None:
                    break
                pattern = Counter(chosen)
                # What made the set dominate stays true while its pieces last.
                times = min(counts[s] // n for s, n in pattern.items())
                for s, n in pattern.items():
                    counts[s] -= n * times
                fixed.append((times, dict(pattern)))
                changed = True
    return fixed, {s: n for s, n in counts.items() if n}


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, over groups of sequences with equal contents."""
    open_by_room: dict[int, list[Pattern]] = {}

    def put(times: int, pattern: dict[int, int], room: int) -> None:
        if times:
            open_by_room.setdefault(room, []).append((times, pattern))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r, x in open_by_room.items() if x and r >= size), default=None)
            if room is None:
                room, times, pattern = capacity, left, {}
            else:
                times, pattern = open_by_room[room].pop()
            each = room // size
            filled = min(times, left // each)
            if filled:
                put(filled, {**pattern, size: each}, room - each * size)
            else:  # one sequence takes the rest
                filled, each = 1, left
                put(1, {**pattern, size: each}, room - each * size)
            if room != capacity:
                put(times - filled, pattern, room)
            left -= filled * each
    return [p for patterns in open_by_room.values() for p in patterns]


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = reduced(histogram, capacity)
    return fixed + best_fit(rest, capacity)


def _places(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """For runs of ranks of one length: length, first rank, first sequence, how many in each, offset."""
    rows, rank, sequence = [], Counter(), 0
    for times, pattern in patterns:
        offset = 0
        for size, each in sorted(pattern.items(), reverse=True):
            rows.append((size, rank[size], sequence, each, offset))
            rank[size] += times * each
            offset += size * each
        sequence += times
    return rows


def _ranked(pieces: DataFrame, n_pieces: int, params: PackingParams) -> DataFrame:
    """``rank``: numbers from 0 without gaps among pieces of a length.

    A length many pieces share is split into buckets; a running sum of the buckets'
    counts tells where each one's numbers begin.
    """
    buckets = n_pieces // params.rank_rows + 1
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    begin = counts.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")
    )
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        keyed.withColumn("place", F.row_number().over(own) - 1)
        .join(begin, ["length", "bucket"])
        .withColumn("rank", F.col("begin") + F.col("place"))
        .drop("bucket", "place", "begin")
    )


def pack(pieces: DataFrame, params: PackingParams) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; gapless from 0 in every sequence."""
    spark = pieces.sparkSession
    rows = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # one per length
    histogram = {r.length: r.n for r in rows}
    places = spark.createDataFrame(
        _places(plan(histogram, params.capacity)),
        "length long, rank_0 long, sequence_0 long, each long, offset_0 long",
    )
    # At most one row per length.
    by_length = places.groupBy("length").agg(
        F.array_sort(
            F.collect_list(F.struct("rank_0", "sequence_0", "each", "offset_0"))
        ).alias("runs")
    )
    ranked = _ranked(pieces, sum(histogram.values()), params)
    run = F.element_at("runs", F.size(F.filter("runs", lambda r: r.rank_0 <= F.col("rank"))))
    beyond = F.col("rank") - F.col("run.rank_0")
    return (
        ranked.join(F.broadcast(by_length), "length")
        .withColumn("run", run)
        .withColumn(
            "sequence_id",
            (F.col("run.sequence_0") + F.floor(beyond / F.col("run.each"))).cast("long"),
        )
        .withColumn("offset", F.col("run.offset_0") + beyond % F.col("run.each") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, params: PackingParams) -> DataFrame:
    """Every piece of every document (``doc_id``, ``text``) with its place."""
    return pack(materialize(token_pieces(docs, params), "pieces"), params)
