"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose tables and cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times; the median counts. The staged
feature build and the single-partition window n-tile are timed next to the
plans that replace them.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.plans.queries import QUERIES, TRAINING
from footfall.operators.scoring import score_deciles
from footfall.plans.feature_table import feature_table
from footfall.plans.staged import feature_table_staged
from footfall.sources.event_log import sessions_from_events
from footfall.sources.sessions import read_sessions, write_sessions
from footfall.vocabulary import VISITOR

HEADLINE = [
    "feature_table",
    "holdout_features",
    "feature_table_lookback",
    "feature_table_write",
    "sessions_scan",
    "users_labeled",
    "summary_metrics",
    "metro_flags",
    "page_flags",
    "visitor_day",
    "visitor_daypart",
    "train_eval_split",
    "feature_correlation",
    "score_deciles",
    "segment_summary",
    "confusion_matrix",
    "roc_curve",
    "evaluate",
    "train_logistic",
    "l1_sweep",
    "predicted_deciles",
]


def session(cpus: str) -> SparkSession:
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{shared}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build: Callable[[], DataFrame], runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(runs)), 3)


def window_deciles(scores: DataFrame) -> DataFrame:
    order = Window.orderBy(F.desc_nulls_last("probability"), F.md5(VISITOR), F.col(VISITOR))
    return scores.withColumn("decile", F.ntile(10).over(order))


def comparisons(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Pairs of plans for the same rows, over stored inputs."""
    folder = spark.conf.get("spark.checkpoint.dir")
    write_sessions(sessions_from_events(spark, sf_dir), f"{folder}/sessions")
    stored = read_sessions(spark, f"{folder}/sessions")
    # One score per line item, a third of them equal.
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    score = F.when(F.col("l_linenumber") % 3 == 0, 0.25).otherwise(F.col("l_extendedprice") / 1e6)
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    lines.select(line_id.alias(VISITOR), score.alias("probability")).write.parquet(f"{folder}/scores")
    scores = spark.read.parquet(f"{folder}/scores")
    return {
        "stored_features_one_pass": seconds(lambda: feature_table(stored, TRAINING), runs),
        "stored_features_staged": seconds(lambda: feature_table_staged(stored, TRAINING), runs),
        "line_deciles_exact": seconds(lambda: score_deciles(scores), runs),
        "line_deciles_window": seconds(lambda: window_deciles(scores), runs),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    times = {
        name: seconds(lambda query=QUERIES[name]: query(spark, sf_dir), runs) for name in HEADLINE
    }
    pairs = comparisons(spark, sf_dir, runs)
    report = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {**times, **pairs},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
