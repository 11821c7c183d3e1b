"""Exact NTILE over all rows, without bringing them into one partition.

Rows are put into cells that follow the sort order, by a fixed rule, and counted; the
counts give every cell the rank of its first row. Most cells lie inside one tile, and
their rows get it by a lookup. Of the few that a tile border cuts, those with more
rows than one task should sort are divided again, and counted again; rows that tie are
divided by the hash of their id. What is left of the cut cells is sorted, each in its
own group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.vocabulary import VISITOR

# Rows of a cut cell that one task may sort.
TARGET_ROWS = 1_000_000
# Parts of a divided cell: three hex digits of the hash.
PARTS = 4096
HASH_LEVELS = 10

NULLS, NAN, INFINITE = -2_000_000, 2_000_000, 1_000_000


@dataclass(frozen=True)
class Cell:
    """A leaf: its number, its place in the sort order, its rows."""

    number: int
    place: tuple[int, ...]
    rows: int
    low: float | None
    high: float | None
    #: How often its rows have been divided by hash already.
    hashed: int = 0


def _first_cell(value: Column) -> Column:
    """A number that rises with the value, at most some 70,000 different ones.

    About logarithmic: small probabilities are as well resolved as large ones.
    """
    step = F.floor(F.signum(value) * (F.log2(F.abs(value) + 2.0**-30) + 30) * 32)
    finite = ~F.isnan(value) & (F.abs(value) < math.inf)
    return (
        F.when(value.isNull(), NULLS)
        .when(F.isnan(value), NAN)
        .when(finite, F.when(finite, step).cast("int"))
        .otherwise(F.when(value > 0, INFINITE).otherwise(-INFINITE))
        .cast("long")
    )


def _digest(id_col: str) -> Column:
    return F.md5(F.col(id_col).cast("string"))


def _divided(df: DataFrame, cells: list[Cell], start: int, order_by: str, id_col: str) -> DataFrame:
    """``df`` with the rows of ``cells`` moved to new ones, ``PARTS`` for each.

    A cell of several values is cut evenly between its least and its largest, one of a
    single value by the next digits of the hash.
    """
    rows = [
        (c.number, start + i * PARTS, c.low, c.high, c.low is None or c.low == c.high, c.hashed)
        for i, c in enumerate(cells)
    ]
    table = df.sparkSession.createDataFrame(
        rows, "cell long, base long, low double, high double, tied boolean, hashed int"
    )
    share = (F.col(order_by) - F.col("low")) / (F.col("high") - F.col("low"))
    by_value = PARTS - 1 - F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
    digits = F.substring(_digest(id_col), F.col("hashed") * 3 + 1, F.lit(3))
    part = F.when(F.col("tied"), F.conv(digits, 16, 10).cast("long")).otherwise(by_value)
    # At most one row for each tile border.
    return (
        df.join(F.broadcast(table), "cell", "left")
        .withColumn("cell", F.coalesce(F.col("base") + part, F.col("cell")))
        .drop("base", "low", "high", "tied", "hashed")
    )


def _counted(placed: DataFrame, order_by: str) -> list:
    value = F.when(F.col(order_by).isNotNull() & ~F.isnan(order_by), F.col(order_by))
    return (
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        .collect()
    )


def tile_of(rank: int, total: int, tiles: int) -> int:
    """Tile of a zero-based rank: the first ``total % tiles`` tiles get one row more."""
    size, extra = divmod(total, tiles)
    if rank < extra * (size + 1):
        return rank // (size + 1) + 1
    return extra + (rank - extra * (size + 1)) // max(size, 1) + 1


def _spans(cells: list[Cell], tiles: int) -> list[tuple[Cell, int, int, int]]:
    """Cells in order with their first rank, first tile and last tile."""
    total, rank, spans = sum(c.rows for c in cells), 0, []
    for cell in sorted(cells, key=lambda c: c.place):
        last = rank + cell.rows - 1
        spans.append((cell, rank, tile_of(rank, total, tiles), tile_of(last, total, tiles)))
        rank += cell.rows
    return spans


def placed_in_cells(
    df: DataFrame, tiles: int, order_by: str, id_col: str, target_rows: int = TARGET_ROWS
) -> tuple[DataFrame, list[Cell]]:
    """``df`` with its final ``cell``, and all cells.

    Only counts per cell reach the driver: those of the fixed cells, and ``PARTS`` for
    each cell that a border cuts.
    """
    placed = df.withColumn("cell", _first_cell(F.col(order_by)))
    cells = [Cell(r.cell, (-r.cell,), r.n, r.low, r.high) for r in _counted(placed, order_by)]
    start = 10 * NAN
    while True:
        dividing = [
            cell
            for cell, _, first, last in _spans(cells, tiles)
            if first < last and cell.rows > target_rows and cell.hashed < HASH_LEVELS
        ]
        if not dividing:
            return placed, cells
        placed = _divided(placed, dividing, start, order_by, id_col)
        new = _counted(placed.where(F.col("cell") >= start), order_by)
        for r in new:
            parent = dividing[(r.cell - start) // PARTS]
            tied = parent.low is None or parent.low == parent.high
            place = (*parent.place, (r.cell - start) % PARTS)
            cells.append(Cell(r.cell, place, r.n, r.low, r.high, parent.hashed + tied))
        gone = {c.number for c in dividing}
        cells = [c for c in cells if c.number not in gone]
        start += PARTS * len(dividing)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _tile(rank: Column, total: int, tiles: int) -> Column:
    """``tile_of`` for a column."""
    size, extra = divmod(total, tiles)
    larger = _div(rank, F.lit(size + 1))
    smaller = extra + _div(rank - extra * (size + 1), F.lit(max(size, 1)))
    return (F.when(rank < extra * (size + 1), larger).otherwise(smaller) + 1).cast("int")


def exact_ntile(
    df: DataFrame,
    tiles: int,
    order_by: str = "probability",
    id_col: str = VISITOR,
    output: str = "tile",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY order_by DESC NULLS LAST, md5(id_col), id_col)``.

    Cells that a border cuts hold at most ``target_rows`` rows each, whatever the
    size of ``df``, unless that many share one id. ``df`` is read once for the first
    count, once for each further division, and twice for the result; pass a
    materialised one if it is dear.
    """
    df = df.withColumn(order_by, F.col(order_by).cast("double"))
    placed, cells = placed_in_cells(df, tiles, order_by, id_col, target_rows)
    spans = _spans(cells, tiles)
    total = sum(c.rows for c in cells)
    rows = [(c.number, rank, first, last) for c, rank, first, last in spans]
    table = df.sparkSession.createDataFrame(
        rows, "cell long, first_rank long, first_tile int, last_tile int"
    )
    located = placed.join(F.broadcast(table), "cell")
    inside = located.where("first_tile = last_tile").withColumn(output, F.col("first_tile"))
    in_cell = Window.partitionBy("cell").orderBy(
        F.desc_nulls_last(order_by), _digest(id_col), F.col(id_col)
    )
    rank = F.col("first_rank") + F.row_number().over(in_cell) - 1
    cut = located.where("first_tile < last_tile").withColumn(output, _tile(rank, total, tiles))
    return inside.select(*df.columns, output).unionByName(cut.select(*df.columns, output))
