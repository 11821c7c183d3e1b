"""The corpus pipeline: stages on documents, each calling one operator.

``run`` applies them in order; what a stage returns is written as Parquet in the
shared folder and read again as the documents of the next one. Documents are told
apart by ``doc_id``, those without one by their texts (a digest): they pass all stages like
others, equal ones like repeated rows. Of near duplicates one with an id is kept before one
without.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontamination, ngram_jaccard, packing, pii, quality_rules
from footfall.llm.queries import DEMO_KEY, loaded_packing_params
from footfall.llm.words import fresh_name
from footfall.sources.workspace import is_few, materialize, scope, table_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates here: shingles of five words, a similarity of 0.8 or more.
NEAR = ngram_jaccard.JaccardParams(shingle=5, percent=80)


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged, name = quality_rules.quality_rules(docs)
    return judged.where(F.col(name).kept).select(*_columns(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that with the smallest id.

    Of equal rows (same id, or none, and same text) any one stays, with or without an id.
    """
    # Ids made of texts lie above 2^62, so that given ids come first.
    made = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1))
    own = F.coalesce(F.col("doc_id"), made.bitwiseOR(F.lit(1 << 62)))
    key, digest, row = (fresh_name(docs, c) for c in ("key_", "digest_", "row_"))
    text_digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    path = table_path(spark, "kept")
    # What the search wrote down goes before the texts are shuffled, which takes the most disk.
    with scope(spark):
        found = ngram_jaccard.near_duplicates(docs.select(own.alias("id"), "text"), NEAR)
        first = found.where("id = component").select("id").distinct()
        # Nearly as many ids as documents: not to be broadcast at any size.
        kept = (
            docs.select(own.alias("id"), F.unhex(text_digest).alias(digest))
            .distinct()
            .join(first.hint("shuffle_hash"), "id")
            .withColumnRenamed("id", key)
        )
        kept.write.parquet(path)
    kept = spark.read.schema(kept.schema).parquet(path).hint("shuffle_hash")
    # Equal rows meet as one per task already; the join finds them dealt out by its own keys.
    whole = F.any_value(F.struct(*_columns(docs))).alias(row)
    once = docs.groupBy(own.alias(key), F.unhex(text_digest).alias(digest)).agg(whole)
    return once.join(kept, [key, digest], "left_semi").select(f"{row}.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too much of the benchmark in them; those of one id are judged by their texts."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text_digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    name, key = fresh_name(docs, "key_"), F.concat_ws("|", F.col("doc_id").cast("string"), text_digest)
    found = decontamination.decontaminate(
        docs.select(key.alias("doc_id"), "text"), items.select("item_id", "text")
    )
    bad = materialize(found.where("contaminated").select(F.col("doc_id").alias(name)), "contaminated")
    # Few keys, so that the texts of all documents needn't be shuffled.
    bad = F.broadcast(bad) if is_few(bad) else bad
    return docs.withColumn(name, key).join(bad, name, "left_anti").select(*_columns(docs))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    count = fresh_name(docs, "n_entities")
    return pii.replace_pii(docs, DEMO_KEY).drop(count)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack_documents(docs, loaded_packing_params())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("pii_surrogates", replace_personal_data),
    ("best_fit_packing", pack),
]

#: Keyed surrogates and the tokenizer have no SQL; ``tests/llm`` has a plain twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        # Texts are most of what the stages leave behind.
        docs = materialize(stage(spark, docs, sf_dir), name, compression="zstd")
    return docs
