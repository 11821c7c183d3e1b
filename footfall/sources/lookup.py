"""The inline lookup relation: region name to UTC offset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from footfall.functions.literals import sql_string
from footfall.vocabulary import STATES


def state_lookup(
    spark: SparkSession, states: Iterable[tuple[str, int, int]] = tuple(STATES)
) -> DataFrame:
    """One row per region: ``state_name``, ``timezone`` (hours), ``dst`` (0/1)."""
    structs = ", ".join(f"struct({sql_string(n)}, {zone}, {dst})" for n, zone, dst in states)
    return spark.sql(f"SELECT inline(array({structs})) AS (state_name, timezone, dst)")


def zone_lookup(spark: SparkSession, zones: Iterable[tuple[str, str]]) -> DataFrame:
    """One row per region: ``state_name`` and ``zone``, its name in the zone database."""
    structs = ", ".join(f"struct({sql_string(n)}, {sql_string(zone)})" for n, zone in zones)
    return spark.sql(f"SELECT inline(array({structs})) AS (state_name, zone)")
