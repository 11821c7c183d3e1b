"""LM scoring: a gated recurrent model and a smoothed unigram base, side by side.

Spark counts the words of all training documents. The most frequent ones, a fixed
number, are listed with their counts; the first of these are words of the recurrent
network (``recurrent.py``). All other words share the network's last class and are told
apart by their counts: those listed by a lookup, those not listed by a join, since
their number grows with the corpus. The chance of such a word is the chance
of the class times its add-one share in it, so the chances of all words and one
unknown word add up to one.

Counts and weights are learned from all training documents. In an epoch every Spark partition
runs truncated backpropagation over its own documents, from the same weights, and the
results are averaged, each by the tokens it learned from; partial sums of weights meet in a second, smaller
stage before they reach the driver. A partition takes its documents batch by batch, of each batch the
long ones first. Every document is scored whole, state carried from its first
word to its end mark.

Words are compared by 64-bit hashes.

Defined cases: NULL and empty texts consist of the end mark. A NULL id is in the
training part. Repeated rows each count and are scored alike. Without training documents
all counts are 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import recurrent
from footfall.llm.words import SPACES, ascii_lower
from footfall.sources.workspace import materialize


@dataclass(frozen=True)
class LanguageModelParams:
    folds: int = 7
    held_out_fold: int = 2
    #: Words with listed counts, and those of them in the network (classes times size, less the end).
    listed: int = 16384
    class_size: int = 32
    classes: int = 32
    hidden: int = 16
    epochs: int = 1
    #: Documents side by side in training, at most; fewer where a partition is so small
    #: that it would make less than ``updates`` steps.
    side: int = 256
    window: int = 32
    updates: int = 400


@dataclass(frozen=True)
class LanguageModel:
    weights: recurrent.Weights
    #: Hashes of the listed words in ascending order, their ranks by count and their counts.
    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    n_network: int
    train_tokens: int
    train_types: int
    n_ends: int
    #: Add-one total of the words outside the network.
    others: float


def _tokens(docs: DataFrame, params: LanguageModelParams) -> DataFrame:
    """``doc_id``, ``held_out`` and the hashes of the words."""
    # Each text is cut up just once: around a lambda, Spark evaluates what occurs twice twice.
    text = F.coalesce(ascii_lower(F.col("text")), F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    words = F.transform(words, lambda w: F.xxhash64(w))
    fold = F.crc32(F.col("doc_id").cast("string")) % params.folds
    held_out = F.coalesce(fold == params.held_out_fold, F.lit(False))
    return docs.select(
        "doc_id",
        held_out.alias("held_out"),
        words.alias("hashes"),
    )


def word_counts(tokens: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` over all training documents."""
    rows = tokens.where("not held_out").select(F.explode("hashes").alias("word"))
    return materialize(rows.groupBy("word").agg(F.count("*").alias("n")), "counts")


class _Lookup:
    """Finds listed words by their hashes, from the first place that their leading bits allow."""

    def __init__(self, model: LanguageModel, bits: int = 16) -> None:
        self.shift, self.half = 64 - bits, 1 << (bits - 1)
        self.n = len(model.hashes)
        leading = (model.hashes >> self.shift) + self.half
        sizes = np.bincount(leading, minlength=2 * self.half)
        self.first = np.cumsum(sizes) - sizes
        self.most = int(sizes.max())
        # One more place, for words behind the last.
        self.hashes = np.append(model.hashes, np.iinfo(np.int64).max)
        self.ranks = np.append(model.ranks, -1)
        self.logs = np.append(np.log10(model.counts + 1.0), 0)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Of each word among the listed ones; the last place where it isn't listed."""
        at = self.first.take((hashes >> self.shift) + self.half)
        for _ in range(self.most):
            at += self.hashes.take(at) < hashes
        at[self.hashes.take(at) != hashes] = self.n
        return at


def _parts(lists: pa.ListArray, words: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of some rows at a time, and where each row ends; about so many words, or one row."""
    ends = np.asarray(lists.offsets, np.int64)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), ends - ends[0]
    row = 0
    while row < len(lists):
        begin = ends[row]
        after = max(row + 1, int(np.searchsorted(ends, begin + words, side="right")) - 1)
        yield flat[begin : ends[after]], ends[row + 1 : after + 1] - begin
        row = after


def _for_network(ranks: np.ndarray, ends: np.ndarray, n_network: int) -> list[np.ndarray]:
    """Network indices of each row with the end mark last; 0 is the end mark itself."""
    inside = (ranks >= 0) & (ranks < n_network)
    words = np.insert(np.where(inside, ranks + 1, n_network + 1).astype(np.int32), ends, 0)
    edges = np.append(0, ends + np.arange(1, len(ends) + 1)).tolist()
    return [words[begin:end] for begin, end in zip(edges, edges[1:])]


def _texts(lists: pa.ListArray, lookup: _Lookup, n_network: int) -> list[np.ndarray]:
    return [
        text
        for hashes, ends in _parts(lists)
        for text in _for_network(lookup.ranks[lookup.places(hashes)], ends, n_network)
    ]


def _long_ones_first(texts: list[np.ndarray], side: int) -> list[np.ndarray]:
    """Texts in their order, but first those that alone are an eighth of what a place gets.

    Taken last, a long one would go on by itself when all others have ended: as many steps
    as it has windows, each taught by one document.
    """
    long = sum(map(len, texts)) / (8 * side)
    return sorted(texts, key=lambda text: len(text) <= long)


def fit(tokens: DataFrame, counts: DataFrame, params: LanguageModelParams) -> LanguageModel:
    totals = counts.agg(F.count("*").alias("types"), F.sum("n").alias("tokens")).first()
    training = tokens.where("not held_out").select("hashes")
    n_ends = training.count()
    # A fixed number of words: each task sends no more of its own than the result has.
    top = counts.orderBy(F.desc("n"), "word").limit(params.listed)
    top = materialize(top, "listed").orderBy(F.desc("n"), "word").collect()
    words = np.array([r.word for r in top], dtype=np.int64)
    n = np.array([r.n for r in top], dtype=np.int64)
    n_network = params.class_size * params.classes - 1
    in_network = np.zeros(n_network, dtype=np.int64)
    in_network[: len(n[:n_network])] = n[:n_network]
    order = np.argsort(words)
    types, all_tokens = totals.types, totals.tokens or 0
    others = (all_tokens - in_network.sum()) + max(0, types - n_network) + 1
    model = LanguageModel(
        weights={},
        hashes=words[order],
        ranks=order,
        counts=n[order],
        n_network=n_network,
        train_tokens=int(all_tokens + n_ends),
        train_types=int(types + (n_ends > 0)),
        n_ends=n_ends,
        others=float(others),
    )
    start = recurrent.new_weights(
        np.append(n_ends, in_network), others, params.class_size, params.hidden, seed=1
    )

    weights = start
    for _ in range(params.epochs if n_ends else 0):
        weights = _epoch(training, model, weights, params)
    return LanguageModel(**{**vars(model), "weights": weights})


def _epoch(
    training: DataFrame, model: LanguageModel, start: recurrent.Weights, params: LanguageModelParams
) -> recurrent.Weights:
    """Weights after every partition has learned from its documents, averaged by tokens."""
    partitions = training.rdd.getNumPartitions()
    share = model.train_tokens // (partitions * params.window * params.updates)
    side = max(8, min(params.side, share))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model)
        texts = (
            text
            for batch in batches
            for text in _long_ones_first(_texts(batch.column(0), lookup, model.n_network), side)
        )
        learned, n = recurrent.train(start, texts, 0, side, params.window)
        total = np.append(recurrent.packed(learned) * n, n)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for value in batch.column(0):
                total = total + np.frombuffer(value.as_buffer())
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = training.mapInArrow(learn, "sums binary").repartition(max(1, math.isqrt(partitions)))
    total = sum(np.frombuffer(r.sums) for r in sums.mapInArrow(add, "sums binary").collect())
    return recurrent.unpacked(total[:-1] / max(total[-1], 1), start)


def _scored(tokens: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row: the network's part, sums over listed words, and the unlisted words."""
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, n_listed long, network double,"
        " listed_log double, listed_other_log double, n_other long, unlisted array<long>"
    )
    columns = [part.split()[0] for part in schema.split(",")]
    n_network = model.n_network
    end_log = float(np.log10(model.n_ends + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(model)
        for batch in batches:
            texts, parts, unlisted = [], [np.empty((5, 0))], [np.empty(0, np.int64)]
            for hashes, ends in _parts(batch.column("hashes")):
                places = lookup.places(hashes)
                ranks, logs = lookup.ranks[places], lookup.logs[places]
                texts += _for_network(ranks, ends, n_network)
                lengths = np.diff(ends, prepend=0)
                row = np.repeat(np.arange(len(ends)), lengths)
                listed, other = ranks >= 0, (ranks < 0) | (ranks >= n_network)
                sums = (np.bincount(row, w, len(ends)) for w in (listed, logs, logs * other, other))
                parts.append(np.vstack([lengths, *sums]))
                unlisted.append(hashes[~listed])
            lengths, n_listed, logs, other_logs, n_other = np.concatenate(parts, axis=1)
            ends = np.append(0, np.cumsum(lengths - n_listed))
            values = [
                *(batch.column(c) for c in columns[:3]),
                pa.array(lengths.astype(int) + 1),
                pa.array(n_listed.astype(int)),
                pa.array(recurrent.score(model.weights, texts, 0)),
                pa.array(logs + end_log),
                pa.array(other_logs),
                pa.array(n_other.astype(int)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), np.concatenate(unlisted)),
            ]
            yield pa.RecordBatch.from_arrays(values, columns)

    doc_id = F.col("doc_id").cast("long")
    # Written down with the rest, so each row keeps its number.
    rows = tokens.select(F.monotonically_increasing_id().alias("row"), doc_id, "held_out", "hashes")
    return materialize(rows.mapInArrow(run, schema), "scored")


def score_documents(
    docs: DataFrame, params: LanguageModelParams = LanguageModelParams()
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): base and model scores, in powers of ten."""
    tokens = materialize(_tokens(docs.select("doc_id", "text"), params), "tokens")
    counts = word_counts(tokens)
    model = fit(tokens, counts, params)
    scored = _scored(tokens, model)
    # Counts of a share of the words fit a task, and rows needn't be sorted to meet them.
    found = (
        scored.select("row", F.explode("unlisted").alias("word"))
        .join(counts.hint("shuffle_hash"), "word")
        .groupBy("row")
        .agg(F.count("*").alias("n_found"), F.sum(F.log10(F.col("n") + 1.0)).alias("found_log"))
    )
    n, v = model.train_tokens, model.train_types
    unlisted = F.coalesce("found_log", F.lit(0.0))
    base = F.col("listed_log") + unlisted - F.col("n_tokens") * float(np.log10(n + v + 1))
    score = (
        F.col("network") / float(np.log(10))
        + F.col("listed_other_log")
        + unlisted
        - F.col("n_other") * float(np.log10(model.others))
    )
    n_known = F.col("n_listed") + F.coalesce("n_found", F.lit(0)) + int(model.n_ends > 0)
    return scored.drop("unlisted").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        n_known.cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        F.round(score, 6).alias("score"),
    )
