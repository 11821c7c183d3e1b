"""Named tables: replace one with a query result, read one back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources.workspace import delete_folder

# Table properties: the folder written here for a table, and that of its former version.
OWN_FOLDER, FORMER_FOLDER = "footfall.folder", "footfall.former"


def _location(spark: SparkSession, name: str) -> str | None:
    """Where the table's files lie, if there is such a table."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    row = described.select(F.col("data_type")).first()
    return row[0] if row else None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _same_folder(one: str, other: str) -> bool:
    return one.removeprefix("file:").rstrip("/") == other.removeprefix("file:").rstrip("/")


def _finish_switch(spark: SparkSession, name: str) -> None:
    """Go on where a program ended while the name was passing."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__next"):
        spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace table ``name`` with the rows of ``df``, which may read that table.

    The rows go to a fresh folder below ``path`` (the warehouse, if none is given);
    only when all are there does the name point to it. A write that fails leaves the former
    table as it was. With other columns the name passes from the former table to one that is
    ready; should the program end in between, the next call of this module goes on from there.

    The former version's folder stays for those who are still reading it and goes with the
    next replacement. Folders of tables that something else wrote are never deleted.
    """
    spark = df.sparkSession
    _finish_switch(spark, name)
    parent = (path or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    folder = f"{parent}/{name.replace('.', '-')}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    former, known = _location(spark, name), _properties(spark, name)
    ours = former is not None and _same_folder(former, known.get(OWN_FOLDER, ""))
    marks = {OWN_FOLDER: folder, FORMER_FOLDER: former if ours else ""}
    marked = ", ".join(f"'{key}' = '{value}'" for key, value in marks.items())
    if former is not None and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({marked})")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}__next")
        spark.catalog.createTable(f"{name}__next", path=folder, source="parquet", schema=df.schema)
        spark.sql(f"ALTER TABLE {name}__next SET TBLPROPERTIES ({marked})")
        if former is not None:
            _retire(spark, name, ours)
        _finish_switch(spark, name)
    spark.catalog.refreshTable(name)
    if ours and known.get(FORMER_FOLDER):
        delete_folder(spark, known[FORMER_FOLDER])
    return read_table(spark, name)


def _retire(spark: SparkSession, name: str, ours: bool) -> None:
    """Free the name. Tables made here are dropped, their files stay; others live on
    under a name of their own, with all their rows."""
    if ours:
        spark.sql(f"DROP TABLE {name}")
        return
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__former_{uuid.uuid4().hex}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    _finish_switch(spark, name)
    return spark.table(name)
