"""Benchmark decontamination by winnowing.

The hashes of all k-grams of a text are reduced to the smallest of every ``w`` in a
row. Two texts that share ``k + w - 1`` consecutive words share such a window and
so its smallest hash: with ``k + w - 1`` equal to the length of a span, no shared
span of that length goes unseen. Fingerprints of documents and benchmark items
meet in an equi-join, and every pair that shares one is compared word by word
along the diagonals on which the shared k-grams lie: what is equal there for as
long as a span, or longer, is a hit.

An item with fewer words than a span is one span itself. For each such length that
occurs in the benchmark (at most ``span - 1``) there is a set of fingerprints with
its own ``k`` and ``w``.

Defined cases: NULL and texts without words have no fingerprints and are hit by
nothing. Items with the same text all count. Texts that share a document id are judged one by
one; the id has the row of the worst: a contaminated one before others, then that with most words hit.
Repeated item ids count as one item. Documents without an id are told apart by their texts: one
row with a NULL id for each text. Empty tables give an empty result, or one without hits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.words import alnum_words, ascii_lower
from footfall.sources.workspace import materialize, with_few


@dataclass(frozen=True)
class DecontaminationParams:
    span: int = 13
    #: A document is contaminated when this share of its words is hit.
    min_hit_percent: int = 5


def _k_and_w(length: int) -> tuple[int, int]:
    k = (length + 1) // 2
    return k, length - k + 1


def _words(df: DataFrame, id_column: str) -> DataFrame:
    words = alnum_words(ascii_lower(F.coalesce("text", F.lit(""))))
    return df.select(F.col(id_column).alias("id"), words.alias("words"))


def _k_grams(words: Column, length: int) -> Column:
    """Hashes of the k-grams for spans of ``length`` words, by position."""
    k, _ = _k_and_w(length)
    return F.when(
        F.size(words) >= k,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - k),
            lambda i: F.xxhash64(F.lit(length), *[F.get(words, i + j) for j in range(k)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: Column, length: int) -> Column:
    """The smallest hash of every ``w`` in a row, each value once."""
    _, w = _k_and_w(length)
    smallest = F.transform(
        F.sequence(F.lit(0), F.size(grams) - w),
        lambda i: F.least(*[F.get(grams, i + j) for j in range(w)])
        if w > 1
        else F.get(grams, i),
    )
    return F.when(F.size(grams) >= w, F.array_distinct(smallest)).otherwise(
        F.array().cast("array<bigint>")
    )


def _with_fingerprints(words: DataFrame, lengths: list[int]) -> DataFrame:
    """One more column: the fingerprints for spans of all ``lengths``."""
    for n in lengths:
        words = words.withColumn(f"grams_{n}", _k_grams(F.col("words"), n))
    prints = [_winnowed(F.col(f"grams_{n}"), n) for n in lengths]
    return words.withColumn("prints", F.concat(*prints)).drop(*[f"grams_{n}" for n in lengths])


def _item_prints(items: DataFrame, lengths: list[int], span: int) -> DataFrame:
    """``print``, ``item``, ``length``: an item's fingerprints for its own span."""
    parts = []
    for n in lengths:
        own = items.where(F.least(F.size("words"), F.lit(span)) == n)
        prints = _winnowed(F.col("grams"), n)
        own = own.withColumn("grams", _k_grams(F.col("words"), n))
        parts.append(own.select(F.explode(prints).alias("print"), F.col("id").alias("item")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.distinct()


def _hit_spans(pairs: DataFrame, length: int) -> DataFrame:
    """``doc``, ``item``, ``first``, ``last``: the equal runs of ``length`` words or more.

    ``pairs`` holds the words of a document and of one item, and the hashes they
    share. A diagonal is a difference of positions; on each, the places where the
    words differ cut the overlap into runs.
    """
    doc_grams, item_grams = F.col("doc_grams"), F.col("item_grams")
    places = F.filter(
        F.transform(
            doc_grams, lambda h, i: F.when(F.array_contains("shared", h), F.struct(h.alias("h"), i.alias("i")))
        ),
        lambda x: x.isNotNull(),
    )
    diagonals = F.array_distinct(
        F.flatten(
            F.transform(
                "places",
                lambda p: F.filter(
                    F.transform(item_grams, lambda h, j: F.when(h == p.h, p.i - j)),
                    lambda d: d.isNotNull(),
                ),
            )
        )
    )
    low = F.greatest(F.lit(0), -F.col("d"))
    high = F.least(F.size("item_words"), F.size("doc_words") - F.col("d")) - 1
    differing = F.filter(
        F.sequence("low", "high"),
        lambda j: F.get("doc_words", j + F.col("d")) != F.get("item_words", j),
    )
    cuts = F.concat(F.array(F.col("low") - 1), differing, F.array(F.col("high") + 1))
    runs = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("cuts") - 2),
            lambda k: F.struct(
                (F.get("cuts", k) + 1 + F.col("d")).alias("first"),
                (F.get("cuts", k + 1) - 1 + F.col("d")).alias("last"),
            ),
        ),
        lambda r: r.last - r.first + 1 >= length,
    )
    return (
        pairs.withColumn("doc_grams", _k_grams(F.col("doc_words"), length))
        .withColumn("item_grams", _k_grams(F.col("item_words"), length))
        .withColumn("places", places)
        .withColumn("d", F.explode(diagonals))
        .withColumns({"low": low, "high": high})
        .withColumn("cuts", cuts)
        .withColumn("run", F.explode(runs))
        .select("doc", "item", "run.first", "run.last")
    )


def hit_spans(
    docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams()
) -> tuple[DataFrame, DataFrame]:
    """Hits (``doc``, ``item``, ``first``, ``last``, in words) and word counts of all documents.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    items = materialize(_words(items, "item_id").where(F.size("words") > 0), "items")
    found = items.select(F.least(F.size("words"), F.lit(params.span)).alias("n")).distinct()
    # At most ``span`` values.
    lengths = sorted(r.n for r in found.collect()) or [params.span]

    prints = _with_fingerprints(_words(docs, "doc_id"), lengths)
    prints = materialize(
        prints.select("id", F.size("words").cast("long").alias("n_words"), "prints"), "prints"
    )
    item_prints = materialize(_item_prints(items, lengths, params.span), "item_prints")
    shared = (
        prints.select(F.col("id").alias("doc"), F.explode("prints").alias("print"))
        .join(item_prints, "print")
        .groupBy("doc", "item")
        .agg(F.collect_set("print").alias("shared"))
    )
    shared = materialize(shared, "shared")
    wanted = shared.select(F.col("doc").alias("doc_id"))
    doc_words = _words(with_few(docs, wanted, "doc_id").join(wanted, "doc_id", "left_semi"), "doc_id")
    pairs = (
        shared.join(doc_words.select(F.col("id").alias("doc"), F.col("words").alias("doc_words")), "doc")
        .join(items.select(F.col("id").alias("item"), F.col("words").alias("item_words")), "item")
    )
    spans = None
    for n in lengths:
        own = pairs.where(F.least(F.size("item_words"), F.lit(params.span)) == n)
        part = _hit_spans(own, n)
        spans = part if spans is None else spans.unionAll(part)
    return materialize(spans.distinct(), "spans"), prints.select("id", "n_words")


def decontaminate(
    docs: DataFrame, items: DataFrame, params: DecontaminationParams = DecontaminationParams()
) -> DataFrame:
    """Per document: ``doc_id``, words, words hit, items found and the verdict.

    ``item_ids`` lists the items as strings, in order.
    """
    # A document is an id and a text: texts of one id, or of none, aren't one document.
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    own = F.struct(F.col("doc_id").alias("id"), digest.alias("digest"))
    docs = docs.select(own.alias("doc_id"), "text")
    spans, counts = hit_spans(docs, items, params)
    in_order = Window.partitionBy("doc").orderBy("first", "last", "item")
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.greatest(F.col("first"), F.coalesce(F.col("reached") + 1, F.col("first")))
    hits = (
        spans.withColumn("reached", reached)
        .withColumn("fresh", F.greatest(F.col("last") - start + 1, F.lit(0)))
        .groupBy("doc")
        .agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("item_ids"),
        )
    )
    counts = counts.groupBy("id").agg(F.max("n_words").alias("n_words"))
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    enough = n_hit * 100 >= F.col("n_words") * params.min_hit_percent
    verdict = F.struct(
        ((n_hit > 0) & enough).alias("contaminated"),
        n_hit.alias("n_hit"),
        "n_words",
        F.coalesce("item_ids", none).alias("item_ids"),
    )
    worst = (
        counts.join(hits, F.col("id") == F.col("doc"), "left")
        .select("id.id", F.when(F.col("id.id").isNull(), F.col("id.digest")).alias("own"), verdict.alias("v"))
        .groupBy("id", "own")
        .agg(F.max("v").alias("v"))
    )
    return worst.select(
        F.col("id").alias("doc_id"), "v.n_words", "v.n_hit", "v.item_ids", "v.contaminated"
    )
