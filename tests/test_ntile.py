import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators.ntile import exact_ntile, placed_in_cells
from footfall.operators.scoring import score_deciles


def _order():
    return Window.orderBy(
        F.desc_nulls_last("probability"), F.md5("fullVisitorId"), F.col("fullVisitorId")
    )


def _scores(spark, values):
    rows = [(str(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "fullVisitorId string, probability double").repartition(7)


def _random_values(n, seed=0):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), -float("inf"), -3.5, -0.0, 1e300, 5e-324]
    return [
        rng.choice([0.1, 0.1, 0.1, 0.5, rng.random(), rng.random() * 1e-6, rng.choice(odd)])
        for _ in range(n)
    ]


def _same(df, tiles, target_rows):
    found = exact_ntile(df, tiles, target_rows=target_rows)
    expected = df.withColumn("tile", F.ntile(tiles).over(_order()))
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("n", [0, 1, 3, 10, 25, 97, 1234, 20003])
def test_equals_window_function(spark, n):
    _same(_scores(spark, _random_values(n)), 10, 1000)


@pytest.mark.parametrize("target_rows", [1, 3, 50])
@pytest.mark.parametrize("tiles", [1, 2, 7, 400])
def test_small_groups_and_any_number_of_tiles(spark, tiles, target_rows):
    _same(_scores(spark, _random_values(333, seed=target_rows)), tiles, target_rows)


@pytest.mark.parametrize("value", [0.0, 0.7, None, float("nan"), float("inf")])
def test_one_value_only(spark, value):
    _same(_scores(spark, [value] * 101), 10, 16)


def test_deciles_are_even_and_ordered(spark):
    deciles = score_deciles(_scores(spark, [i / 1000 for i in range(1000)]))
    rows = deciles.groupBy("decile").agg(F.count("*"), F.min("probability")).orderBy("decile").collect()
    assert [r[1] for r in rows] == [100] * 10
    assert rows[0].decile == 1
    assert rows[0][2] == 0.9


def _largest_cut_cell(df, target_rows):
    placed, cells = placed_in_cells(df, 10, "probability", "fullVisitorId", target_rows)
    counts = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    assert counts == {c.number: c.rows for c in cells}
    ranks, rank = [], 0
    for cell in sorted(cells, key=lambda c: c.place):
        ranks.append((rank, rank + cell.rows - 1, cell.rows))
        rank += cell.rows
    size = rank // 10
    return max((n for a, b, n in ranks if a // size != b // size), default=0)


@pytest.mark.parametrize("hot", [0.25, None])
@pytest.mark.parametrize("times", [1, 10])
def test_cut_cells_stay_small_as_rows_grow(spark, hot, times):
    """A value a third of the rows share, and ten times the rows: no larger groups."""
    values = [hot] * 1000 * times + [i / (2000 * times) for i in range(2000 * times)]
    assert _largest_cut_cell(_scores(spark, values), 64) <= 64
