"""Registered queries of the subpackage: each operator on its whole table."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    chat,
    decontamination,
    language_model,
    licenses,
    merkle,
    ngram_jaccard,
    packing,
    pii,
    quality_rules,
    secret_scan,
    url_filter,
    warc,
    whitening,
)
from footfall.sources.workspace import materialize

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rules_table(spark, url_filter.CONTRACT_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured, name = quality_rules.quality_rules(docs, keep_text=False)
    m = F.col(name)
    return measured.select(
        "doc_id",
        m.n_words.alias("n_words"),
        m.word_chars.alias("word_chars"),
        m.n_symbols.alias("n_symbols"),
        m.n_dup_lines.alias("n_dup_lines"),
        m.n_repeat_words.alias("n_repeat_words"),
        m.base_failed.alias("base_failed"),
        m.kept.alias("kept"),
        F.round(m.char_distance, 6).alias("char_distance"),
        F.round(m.word_distance, 6).alias("word_distance"),
    )


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    found = ngram_jaccard.near_duplicates(docs)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.decontaminate(
        docs.select("doc_id", "text"), items.select("item_id", "text")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        "contaminated",
    )


# A real run takes its key from the operator's caller; this one makes results repeatable.
DEMO_KEY = "a key for repeatable results"


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.replace_pii(docs, DEMO_KEY).select("doc_id", "text", "n_entities")


def packing_params() -> packing.PackingParams:
    """The installed public vocabulary: the ranks are those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    return packing.PackingParams(
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
    )


def loaded_packing_params() -> packing.PackingParams:
    """The same with the added tokens of ``byte_bpe_50k.json``: its ids as loaded."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    # Options that change what stands around a token would need more than a cut.
    if any(t[x] for t in added for x in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("an added token with options")
    tokens = tuple((t["content"], t["id"]) for t in added)
    return replace(packing_params(), added_tokens=tokens)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, loaded_packing_params())


# A conversation made of control strings of a common chat template.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    extra = spark.createDataFrame(added, "conv_id long, turn long, role string, text string")
    written = materialize(chat.format_examples(own.unionAll(extra)), "examples")
    replies = F.array_sort(
        F.collect_list(
            F.when(
                F.col("loss_start").isNotNull(),
                F.struct("example", chat.trainable_text(written).alias("text")),
            )
        )
    )
    by_conversation = written.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(F.transform(replies, lambda r: r.text), "").alias("loss"),
        F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
    )
    turns = by_conversation.withColumn("turns", chat.read_turns(F.col("longest")))
    text = F.array_join(
        F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""
    )
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder, index = warc.write_archives(pages)
    read = warc.read_records(folder, index)
    facts = materialize(
        read.select(
            "page_id",
            "record_type",
            "refers_to",
            "digest",
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha2("payload", 256).alias("sha"),
        ),
        "records",
    )
    full = facts.where("record_type = 'response'").select(
        F.col("page_id").alias("full_id"), F.col("bytes").alias("n"), F.col("sha").alias("s")
    ).distinct()
    # Pages without an id, and several payloads of one id, meet their own by the digest.
    own_id = F.coalesce("refers_to", "page_id").eqNullSafe(F.col("full_id"))
    return facts.join(full, own_id & (F.col("digest") == F.col("s"))).select(
        "page_id",
        F.col("n").alias("payload_bytes"),
        F.col("s").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan_documents(docs)
    return found.select(
        "doc_id", F.concat_ws(",", "families").alias("families"), "n_paragraphs"
    )


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


# The fields of a document that its leaf covers.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and what it says on a copy that lost line breaks."""
    docs = table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    cut = F.when(
        (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n")),
        F.replace("text", F.lit("\n"), F.lit("")),
    )
    others = [F.col(c) for c in LEAF_FIELDS[:-1]]
    rows = docs.select(
        "doc_id",
        "source",
        merkle.row_digest(*others, F.col("text")).alias("leaf"),
        F.when(cut.isNotNull(), merkle.row_digest(*others, cut)).alias("changed"),
    )
    proven = merkle.build_manifest(rows, "source", "doc_id", "leaf", carry=["changed"])
    leaf = F.col("node.digest")
    root = merkle.folded(F.coalesce("node.row.changed", leaf), F.col("path"))
    return proven.select(
        F.col("node.row.doc_id").alias("doc_id"),
        leaf.alias("leaf"),
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = whitening.whiten(rows, "embedding")
    return white.select(
        F.col("row.vec_id").alias("vec_id"),
        "component",
        "n",
        "deviation",
        "whitened",
        "explained",
        "identity_error",
    )


@query
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = secret_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    return scanned.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in (secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX)],
        F.sha2(secret_scan.shown(F.col("base")), 256).alias("base_sha256"),
        secret_scan.shown(F.col("spans")).alias("spans"),
    )
