"""URL filters: rules on a host and the start of a path.

A rule is a host and a path, like ``example.net/en/``. It fits its host and every
subdomain of it where the URL's path starts with the rule's path. Of the rules
that fit, the longest wins; of equally long ones, the one with the longer host;
of the same rule listed twice with different verdicts, the block. A URL without
any fitting rule takes the default verdict.

Every URL is expanded into its host suffixes times its path prefixes that end in
a slash, no deeper than the rules go. Rules and expressions meet in an equi-join
on the first bytes of a hash, which also fits rule lists far too long to be sent
to every task; the full SHA-256 digests and the rule's whole path then confirm.
Rules of the empty host or NULL host fit nothing.

Defined cases: NULL and URLs without ``://`` have the empty host and path, so no
rule fits. A host with empty labels (``a..b``) keeps them. Repeated rows are
judged one by one, so the URLs are numbered by nothing but themselves: rules are
looked up once per distinct URL. Columns of the input may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.words import ascii_lower, fresh_name
from footfall.sources.workspace import materialize

# The rules of the registered query.
CONTRACT_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

HASH_CHARS = 8


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(
        F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")
    ).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _slash_prefix(path: Column) -> Column:
    """The path up to its last slash, or nothing."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _digest(host: Column, prefix: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), prefix), 256)


def _prepared(rules: DataFrame) -> DataFrame:
    """One row per rule, with the digest of its host and slash-ended path."""
    host, path = ascii_lower(F.col("rule_host")), F.coalesce("rule_path", F.lit(""))
    prepared = rules.where(host != "").select(
        host.alias("rule_host"), path.alias("rule_path"), "rule_verdict"
    )
    # "block" sorts after "allow".
    prepared = prepared.groupBy("rule_host", "rule_path").agg(
        F.max("rule_verdict").alias("rule_verdict")
    )
    digest = _digest(F.col("rule_host"), _slash_prefix(F.col("rule_path")))
    return prepared.withColumns(
        {
            "rule_digest": digest,
            "rule_short": F.substring(digest, 1, HASH_CHARS),
            "labels": F.size(F.split("rule_host", r"\.")),
            "depth": F.size(F.split(_slash_prefix(F.col("rule_path")), "/")) - 1,
        }
    )


def expressions(urls: DataFrame, max_labels: int, max_depth: int) -> DataFrame:
    """``host``, ``path`` and one row per host suffix and path prefix of each URL."""
    labels = F.split("host", r"\.")
    parts = F.split(_slash_prefix(F.col("path")), "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(max_labels, 1)))),
        lambda n: F.concat_ws(".", F.slice("labels", F.size("labels") - n + 1, n)),
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size("parts") - 1, F.lit(max_depth))),
        lambda n: F.when(n == 0, "").otherwise(
            F.concat(F.concat_ws("/", F.slice("parts", 1, n)), F.lit("/"))
        ),
    )
    expanded = (
        urls.withColumns({"labels": labels, "parts": parts})
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
    )
    digest = _digest(F.col("suffix"), F.col("prefix"))
    return expanded.select("host", "path", digest.alias("digest"))


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each distinct ``host`` and ``path`` that has one."""
    rules = materialize(_prepared(rules), "rules")
    most = rules.agg(F.max("labels"), F.max("depth")).first()
    found = (
        expressions(urls.where("host != ''").distinct(), most[0] or 0, most[1] or 0)
        .withColumn("short", F.substring("digest", 1, HASH_CHARS))
        .join(rules, F.col("short") == F.col("rule_short"))
        .where("digest = rule_digest")
        .where(F.startswith("path", "rule_path"))
    )
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.char_length(rule), F.char_length("rule_host"), rule, "rule_verdict")
    best = found.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", F.col("best.col3").alias("rule"), "best.rule_verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (``url`` and more) with ``host``, ``path``, ``rule`` and ``verdict``.

    Columns of the input called so are replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col("url"))
    split = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"))
    best = matched_rules(split.select("host", "path"), rules)
    own_host, own_path = fresh_name(split, "host_"), fresh_name(split, "path_")
    mine = best.select(
        F.col("host").alias(own_host), F.col("path").alias(own_path), "rule", "rule_verdict"
    )
    same = (split["host"] == mine[own_host]) & (split["path"] == mine[own_path])
    joined = split.join(mine, same, "left")
    return joined.select(
        *[split[f"`{c}`"] for c in kept],
        split["host"],
        split["path"],
        mine["rule"],
        F.coalesce(mine["rule_verdict"], F.lit(default)).alias("verdict"),
    )
