"""Merkle manifest of a dataset, with a proof for every row.

Rows are leaves, groups of rows (a source) are subtrees, their roots are the leaves of one
more tree. While a tree has several nodes, every ``fanout`` consecutive ones become their
parent; a last run may be shorter, even a single node.

Levels are built by a slot pivot: one aggregate per parent spreads its children over
``fanout`` columns (the grandchildren over their square: a pivot covers two levels). The
concatenated columns hash to the parent; the columns left and right
of a slot are that child's siblings, so a pivot row gives all its children their step of
the proof without any lookup of neighbours. Going down, each pivot row meets the path of
its own node and hands it on to the children.

Places come from a range partitioning over (group, order, digest): a row's place is what
came before its partition plus its position inside. So no group is ever sorted or counted in one task,
one of a third of all rows is spread like any other, and all joins are on (group, place).

Defined results: a NULL group is a group of its own, the first one. Rows without an order
value come first in their group. Equal order values go by digest, fully equal rows are
several leaves with one digest, in any order. A field that is NULL is hashed as ``-``, an empty text as
``0:``. An empty table has no rows and no root. Carried columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize

# Rows of one partition are numbered below the partition's number.
POSITION_BITS = 33


@dataclass(frozen=True)
class MerkleParams:
    fanout: int = 3
    #: Levels that one pivot covers, in ``fanout ** levels`` slots; changes no result.
    levels: int = 2


def row_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each as its length in bytes, ``:`` and value, or ``-``."""
    parts = []
    for field in fields:
        value = field.cast("string")
        shown = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(shown, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _group_key(group: Column) -> Column:
    """Never NULL; orders like the group with NULL first, by bytes."""
    return F.coalesce(F.concat(F.lit("g"), group.cast("string")), F.lit(""))


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (``key``, …) with ``place`` from 0 within the key, and ``n``, the key's size."""
    keys = ["key", *order]
    numbered = (
        nodes.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "tie")
        .sortWithinPartitions(*keys, "tie")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", POSITION_BITS))
        .drop("tie")
    )
    numbered = materialize(numbered, "numbered")
    runs = numbered.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key",
        "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(of_key).alias("n"),
    )
    return (
        numbered.join(runs, ["key", "part"])
        .withColumn("place", F.col("at") + F.col("shift"))
        .drop("at", "part", "shift")
    )


def _slots(params: MerkleParams) -> list[str]:
    return [f"slot{i}" for i in range(params.fanout**params.levels)]


def _size(level: int, fanout: int) -> Column:
    """Nodes of the key ``level`` levels above those that a pivot's ``n`` counts."""
    return F.floor((F.col("n") + (fanout**level - 1)) / fanout**level)


def _names(level: int, params: MerkleParams, nested: bool) -> list[str]:
    """The columns of a pivot that hold the digests of its nodes of a level."""
    if level == 0:
        return [f"{s}.digest" if nested else s for s in _slots(params)]
    return [f"level{level}_{i}" for i in range(params.fanout ** (params.levels - level))]


def _joined(names: list[str]) -> Column:
    """The digests one after the other; an empty slot is an empty text."""
    return F.concat(*[F.coalesce(F.col(c), F.lit("")) for c in names]) if names else F.lit("")


def _pivot(children: DataFrame, params: MerkleParams, nested: bool) -> DataFrame:
    """One row per node ``levels`` levels up: the nodes below by slot, ``n`` children of the key.

    The digests of the levels between stand beside the slots. Where a key has one node left,
    the levels above that are empty, and the node itself moves up.
    """
    fanout, slots = params.fanout, _slots(params)
    child, place = "node" if nested else "digest", F.col("place")
    spread = [F.max(F.when(place % len(slots) == i, F.col(child))).alias(c) for i, c in enumerate(slots)]
    parent = F.floor(place / len(slots)).alias("place")
    table = children.where("n > 1").groupBy("key", parent).agg(F.max("n").alias("n"), *spread)
    for level in range(params.levels):
        below, above = _names(level, params, nested), _names(level + 1, params, nested)
        digests = {}
        for i, name in enumerate(above):
            run = below[i * fanout : (i + 1) * fanout]
            hashed = F.when(_size(level, fanout) > 1, F.sha2(_joined(run), 256)).otherwise(F.col(run[0]))
            digests[name] = F.when(F.col(run[0]).isNotNull(), hashed)
        table = table.withColumns(digests)
    return table


def _parents(pivot: DataFrame, params: MerkleParams) -> DataFrame:
    (top,) = _names(params.levels, params, False)
    return pivot.select(
        "key", "place", _size(params.levels, params.fanout).alias("n"), F.col(top).alias("digest")
    )


def _children(pivot: DataFrame, paths: DataFrame, params: MerkleParams, nested: bool) -> DataFrame:
    """Every child of every pivot row, with its path: its own steps, then its parent's path."""
    fanout, slots = params.fanout, _slots(params)
    none = F.array().cast("array<struct<before: string, after: string>>")
    options = []
    for i, name in enumerate(slots):
        steps = []
        for level in range(params.levels):
            names, at = _names(level, params, nested), i // fanout**level
            run = at // fanout * fanout
            step = F.struct(
                _joined(names[run:at]).alias("before"),
                _joined(names[at + 1 : run + fanout]).alias("after"),
            )
            steps.append(F.when(_size(level, fanout) > 1, F.array(step)).otherwise(none))
        here = F.struct(
            F.lit(i).alias("slot"), F.col(name).alias("child"), F.concat(*steps, F.col("path")).alias("path")
        )
        options.append(F.when(F.col(name).isNotNull(), here))
    exploded = pivot.join(paths, ["key", "place"]).select(
        "key",
        (F.col("place") * len(slots)).alias("start"),
        "subroot",
        "root",
        F.explode(F.filter(F.array(*options), lambda x: x.isNotNull())).alias("x"),
    )
    return exploded.select(
        "key",
        (F.col("start") + F.col("x.slot")).alias("place"),
        F.col("x.child").alias("child"),
        "subroot",
        "root",
        F.col("x.path").alias("path"),
    )


@dataclass
class _Tree:
    leaves: DataFrame
    pivots: list[DataFrame]
    #: ``key``, ``digest`` and ``height`` of the top node of every key.
    tops: DataFrame


def _build(leaves: DataFrame, params: MerkleParams) -> _Tree:
    """All levels above ``leaves`` (``key``, ``place``, ``n``, ``node`` with its ``digest``)."""
    nodes = leaves.select("key", "place", "n", F.col("node.digest").alias("digest"))
    tops = nodes.where("n = 1").withColumn("height", F.lit(0))
    pivots, size = [], leaves.agg(F.max("n")).first()[0] or 0
    while size > 1:
        nested = not pivots
        pivot = _pivot(leaves if nested else nodes, params, nested)
        pivots.append(materialize(pivot, "pivot"))
        nodes = _parents(pivots[-1], params)
        tops = tops.unionAll(nodes.where("n = 1").withColumn("height", F.lit(len(pivots))))
        size = -(-size // params.fanout**params.levels)
    return _Tree(leaves, pivots, materialize(tops.select("key", "digest", "height"), "tops"))


def _paths(tree: _Tree, starts: DataFrame, params: MerkleParams) -> DataFrame:
    """``node``, ``subroot``, ``root`` and ``path`` of every leaf.

    ``starts`` holds these for the top node of every key, with its height in pivots.
    """
    columns = ["key", "subroot", "root", "path"]
    paths = None
    for height in range(len(tree.pivots), 0, -1):
        tops = starts.where(F.col("height") == height)
        here = tops.select("key", F.lit(0).cast("long").alias("place"), *columns[1:])
        if paths is not None:
            here = here.unionByName(paths.drop("child"))
        found = _children(tree.pivots[height - 1], here, params, nested=height == 1)
        paths = found if height == 1 else materialize(found, "paths")
    single = starts.where("height = 0").join(tree.leaves.where("n = 1"), "key")
    single = single.select("key", F.col("node"), *columns[1:])
    if paths is None:
        return single
    return paths.select("key", F.col("child").alias("node"), *columns[1:]).unionAll(single)


def build_manifest(
    rows: DataFrame,
    group: str,
    order: str,
    digest: str,
    carry: Sequence[str] = (),
    params: MerkleParams = MerkleParams(),
) -> DataFrame:
    """Every row's ``node`` with ``subroot``, ``root`` and ``path``.

    ``rows`` has a column of digests (hex), see ``row_digest``. ``node`` has ``digest``, and
    under ``row`` the columns to ``carry``, the order column first. ``path`` lists, from the leaf to the root, the
    concatenated digests of the siblings ``before`` and ``after`` the node.
    """
    if params.fanout < 2 or params.levels < 1:
        raise ValueError("a node needs two slots at least, a pivot one level")
    own = F.struct(*[F.col(f"`{c}`") for c in (order, *carry)])
    leaves = rows.select(
        _group_key(F.col(f"`{group}`")).alias("key"),
        F.col(f"`{order}`").alias("order"),
        F.struct(F.col(f"`{digest}`").alias("digest"), own.alias("row")).alias("node"),
    )
    leaves = materialize(_placed(leaves, ["order", "node.digest"]).drop("order"), "leaves")
    groups = _build(leaves, params)
    # The subroots are the leaves of a tree of one key.
    subroots = groups.tops.select(
        F.lit("").alias("key"),
        F.col("key").alias("group"),
        F.struct("digest", "key", "height").alias("node"),
    )
    upper = _build(materialize(_placed(subroots, ["group"]).drop("group"), "subroots"), params)
    no_path = F.array().cast("array<struct<before: string, after: string>>")
    start = upper.tops.select(
        "key", "height", F.lit("").alias("subroot"), F.col("digest").alias("root"), no_path.alias("path")
    )
    starts = _paths(upper, start, params).select(
        F.col("node.key").alias("key"),
        F.col("node.height").alias("height"),
        F.col("node.digest").alias("subroot"),
        "root",
        "path",
    )
    return _paths(groups, materialize(starts, "starts"), params).drop("key")


def proof(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, from the leaf up, left to right."""
    shown = F.transform(path, lambda s: F.concat(s.before, s.after))
    return F.sha2(F.array_join(shown, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(
        path, leaf, lambda digest, s: F.sha2(F.concat(s.before, digest, s.after), 256)
    )
