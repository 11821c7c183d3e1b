"""The nested session table, partitioned by day."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.params import FeatureParams
from footfall.sources.workspace import folder_names, scope, table_path
from footfall.vocabulary import VISITOR

# Declared, never inferred: partition discovery would turn the day into an
# integer, and the day range is a comparison of strings.
SESSION_SCHEMA = """
    fullVisitorId string,
    visitStartTime bigint,
    date string,
    channelGrouping string,
    totals struct<visits: bigint, pageviews: bigint, timeOnSite: bigint,
                  bounces: bigint, transactions: bigint>,
    device struct<deviceCategory: string, browser: string>,
    geoNetwork struct<country: string, region: string, metro: string>,
    hits array<struct<page: struct<pagePathLevel2: string, pagePathLevel3: string>,
                      occurrences: bigint>>,
    table_suffix string
"""


def read_sessions(spark: SparkSession, path: str, params: FeatureParams | None = None) -> DataFrame:
    """Sessions below ``path``; with ``params`` only the days and country asked for."""
    sessions = spark.read.schema(SESSION_SCHEMA).parquet(path)
    return sessions if params is None else select_sessions(sessions, params)


def write_sessions(sessions: DataFrame, path: str) -> None:
    """Write sessions as one folder per day; only the days they hold are replaced."""
    write_by_day(sessions, path)


def write_by_day(rows: DataFrame, path: str) -> None:
    """Write rows as one folder per ``table_suffix``, in place of the folders of these days.

    The rebalance hint gathers a day in few files and still splits a day that
    holds much more than the others.
    """
    (
        rows.hint("rebalance", "table_suffix")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_suffix")
        .parquet(path)
    )


def write_daily_tables(sessions: DataFrame, root: str, prefix: str = "sessions_") -> None:
    """One table per day below ``root``, the day at the end of its name; days there are replaced.

    The sessions are computed once, into a folder by day. Each table is then a copy of its day's
    files, so what a day costs doesn't depend on how the sessions are found.
    """
    spark = sessions.sparkSession
    with scope(spark):
        folder = table_path(spark, "by_day")
        write_by_day(sessions, folder)
        by_day = spark.read.schema(sessions.schema).parquet(folder)
        days = [r[0] for r in by_day.select("table_suffix").distinct().orderBy("table_suffix").collect()]
        for day in days:
            rows = by_day.where(F.col("table_suffix") == day).drop("table_suffix")
            rows.write.mode("overwrite").parquet(f"{root}/{prefix}{day}")


def read_daily_tables(
    spark: SparkSession, root: str, params: FeatureParams, prefix: str = "sessions_"
) -> tuple[DataFrame, list[str]]:
    """Sessions of the days asked for, from one table per day; and days without a table.

    Tables are chosen by name: those outside the range are never opened. Columns are taken
    by name, what a table lacks is NULL and what it has besides is left out. Days without a table hold
    no sessions.
    """
    found = {
        name.removeprefix(prefix): name
        for name in folder_names(spark, root)
        if re.fullmatch(re.escape(prefix) + r"\d{8}", name)
    }
    first, last = (datetime.strptime(d, "%Y%m%d") for d in (params.session_start, params.session_end))
    wanted = [f"{first + timedelta(days=i):%Y%m%d}" for i in range((last - first).days + 1)]
    present = [d for d in wanted if d in found]
    schema = StructType.fromDDL(SESSION_SCHEMA)
    if not present:
        return spark.createDataFrame([], schema), wanted
    stored = StructType([f for f in schema if f.name != "table_suffix"])
    tables = spark.read.schema(stored).parquet(*[f"{root}/{found[d]}" for d in present])
    day = F.regexp_extract(F.col("_metadata.file_path"), rf"/{re.escape(prefix)}(\d{{8}})/[^/]*$", 1)
    sessions = tables.withColumn("table_suffix", day).select(*schema.names)
    return select_sessions(sessions, params), [d for d in wanted if d not in found]


def select_sessions(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Day range (partition filter), country (pushed filter), known visitor."""
    return sessions.where(
        F.col("table_suffix").between(params.session_start, params.session_end)
        & (F.col("geoNetwork.country") == params.country)
        & F.col(VISITOR).isNotNull()
    )
