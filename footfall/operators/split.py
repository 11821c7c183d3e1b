"""Random but repeatable split into training and evaluation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.vocabulary import VISITOR


def train_eval_split(
    df: DataFrame, eval_fraction: float = 0.20, seed: int = 0, id_col: str = VISITOR
) -> DataFrame:
    """Add ``is_eval``, decided by a hash of id and seed alone.

    A retried task or a second scan puts every row on the same side, whatever
    the partitioning.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000
    return df.withColumn("is_eval", share < round(eval_fraction * 10000))
