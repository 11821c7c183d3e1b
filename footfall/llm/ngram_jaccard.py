"""N-gram Jaccard join: texts whose sets of word shingles overlap enough.

Shingles are ordered globally by their hash, and the order is cut into fragments.
A text's set falls into one segment per fragment; the overlap of two texts is
counted per fragment and summed per pair, so no task holds the whole of a long
text and a text with many partners is spread over all fragments.

Only pairs that can link are counted. Linking takes an overlap of 85 % of the
larger set, so the two texts share at least ``k`` of the first ``n - o + k``
shingles in the global order (``n``: size, ``o``: least overlap, ``k``: 8 % of
``n``). That start of every set is the only part that is shuffled for all texts:

1. Shingles of the starts are counted; those in one text only are dropped. Texts
   with too few left can't link with anything and are dropped as well.
2. What a text has left is put in order of frequency. As two linked texts share
   ``t`` of these, the ``t - 1`` most frequent can be left out: frequent passages
   mostly fall away here.
3. Texts that share a shingle now are pairs to be counted. Where many texts share
   one, all are compared with the most typical of them. Groups that this leaves in
   several components are joined once more on the shingles in which their
   texts differ from a reference: texts that link, but not both with the
   reference, must have differences in common (``_links_across``). So a group of
   copies costs a few pairs per copy, and no link between components is lost.

Copies of one text are one text throughout. Hashes have 64 bits; a collision could
change a decision only at the very threshold.

Defined cases: a text without words (NULL, empty, blank) has an empty set and links
with nothing. Texts with fewer words than a shingle have one shingle, the whole
sequence. Repeated ids count as one document. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.components import connected_components
from footfall.llm.words import ascii_lower, space_words
from footfall.sources.workspace import materialize, scope, table_path


@dataclass(frozen=True)
class JaccardParams:
    shingle: int = 4
    percent: int = 85
    slack_percent: int = 8
    small_group: int = 12
    fragment_bits: int = 4


def _shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` as a side of a join in which neither side is broadcast, whatever the planner thinks of its size.

    It goes by the bytes of the files. Rows cut out of arrays or made per fragment take 20 to 70 times
    as much, those of ids and hashes that repeat 10 times; a broadcast has to pass through the driver.
    """
    return rows.hint("merge")


def _ceil_percent(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100.0) - 1e-9).cast("int")


def shingle_sets(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """``id`` and ``hashes``: the set in ascending order, empty without words."""
    w, k = F.col("words"), params.shingle
    grams = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]),
    )
    empty = F.array().cast("array<bigint>")
    return (
        docs.withColumn("words", space_words(ascii_lower(F.col("text"))))
        .withColumn("grams", F.when(F.size(w) > 0, grams).otherwise(empty))
        .withColumn("hashes", F.sort_array(F.array_distinct("grams")))
        .drop("words", "grams")
    )


def _starts(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """Per document: a digest of its words, the size of its set, the set's start."""
    n = F.size("hashes")
    length = F.least(
        n, n - _ceil_percent(n, params.percent) + _ceil_percent(n, params.slack_percent)
    )
    sets = shingle_sets(docs, params)
    return sets.select(
        "id",
        F.md5(ascii_lower(F.coalesce("text", F.lit("")))).alias("digest"),
        n.alias("n"),
        F.slice("hashes", F.lit(1), length).alias("start"),
    )


def _postings(starts: DataFrame, texts: DataFrame, params: JaccardParams) -> DataFrame:
    """``h``, ``id``, ``n`` and how typical: what can link texts, rare shingles only."""
    rows = starts.select("id", "n", F.explode("start").alias("h"))
    # The starts are most of what is shuffled: once to count them, then to find what is shared, then
    # (written down, else whole starts are shuffled for the last join) only that.
    shared = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = materialize(shared.withColumnRenamed("h", "h_"), "shared")
    found = rows.join(_shuffled(shared), F.col("h") == F.col("h_")).select("id", "n", "h", "df")
    found = materialize(found, "found")
    # One text per group of copies; ids are unique there, so windows hold one text each.
    found = found.join(texts.select(F.col("text_id").alias("id")), "id", "left_semi")
    own = Window.partitionBy("id")
    least = F.ceil(F.col("n") * (params.percent * params.slack_percent) / F.lit(10000.0) - 1e-9)
    kept = (
        found.withColumn("shared", F.count("*").over(own))
        .withColumn("rank", F.row_number().over(own.orderBy("df", "h")))
        .where(F.col("rank") <= F.col("shared") - least + 1)
    )
    typical = F.floor(F.col("shared") * 1000 / F.col("n")).cast("int")
    return kept.select("h", "id", "n", typical.alias("typical"))


def _written(docs: DataFrame, params: JaccardParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All documents (``id``, ``digest``, ``n``), their texts and the postings.

    The starts go before anything else is shuffled.
    """
    spark = docs.sparkSession
    paths = [table_path(spark, name) for name in ("heads", "texts", "postings")]
    with scope(spark):
        starts = materialize(_starts(docs, params), "starts")
        heads = materialize(starts.drop("start"), path=paths[0])
        copies = heads.groupBy("digest").agg(F.min("id").alias("text_id"))
        texts = materialize(copies, path=paths[1])
        return heads, texts, materialize(_postings(starts, texts, params), path=paths[2])


def _near_in_size(a: str, b: str, params: JaccardParams) -> Column:
    return (F.col(a) * 100 >= F.col(b) * params.percent) & (
        F.col(b) * 100 >= F.col(a) * params.percent
    )


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _pairs_of_small_groups(postings: DataFrame, params: JaccardParams) -> DataFrame:
    small = postings.where((F.col("size") > 1) & (F.col("size") <= params.small_group))
    left = small.select("h", F.col("id").alias("x"), F.col("n").alias("nx"))
    right = small.select("h", F.col("id").alias("y"), F.col("n").alias("ny"))
    pairs = left.join(right, "h").where("x < y").where(_near_in_size("nx", "ny", params))
    return pairs.select("x", "y").distinct()


def _segments(docs: DataFrame, ids: DataFrame, params: JaccardParams) -> DataFrame:
    """``id``, ``n``, ``fragment`` and the shingles of the set in it."""
    # The ids grow with the corpus, so they aren't to be broadcast at any size.
    sets = shingle_sets(docs.join(ids.hint("shuffle_hash"), "id", "left_semi"), params)
    n_fragments = 1 << params.fragment_bits
    fragment = lambda h: F.shiftrightunsigned(h, 64 - params.fragment_bits)
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(n_fragments - 1)),
        lambda f: F.filter("hashes", lambda h: fragment(h) == f),
    )
    return sets.select(
        "id", F.size("hashes").alias("n"), F.posexplode(cut).alias("fragment", "segment")
    )


def _links(pairs: DataFrame, segments: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs (``x``, ``y``) that link: overlaps by fragment, summed."""
    one = segments.select(F.col("id").alias("x"), F.col("n").alias("nx"), "fragment", "segment")
    two = segments.select(
        F.col("id").alias("y"), F.col("n").alias("ny"), "fragment", F.col("segment").alias("other")
    )
    fragments = F.explode(F.sequence(F.lit(0), F.lit((1 << params.fragment_bits) - 1)))
    partial = (
        pairs.withColumn("fragment", fragments)
        .join(_shuffled(one), ["x", "fragment"])
        .join(_shuffled(two), ["y", "fragment"])
        .select("x", "y", "nx", "ny", F.size(F.array_intersect("segment", "other")).alias("part"))
    )
    union = F.col("nx") + F.col("ny") - F.col("overlap")
    return (
        partial.groupBy("x", "y", "nx", "ny")
        .agg(F.sum("part").alias("overlap"))
        .where(F.col("overlap") * 100 >= union * params.percent)
        .select("x", "y")
    )


def _with_component(rows: DataFrame, links: DataFrame) -> DataFrame:
    components = connected_components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))
    found = components.withColumnRenamed("node", "id")
    return rows.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _open_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Postings of the groups whose texts lie in several components."""
    placed = materialize(_with_component(groups, links), "placed")
    several = (
        placed.groupBy("h")
        .agg(F.min("component").alias("a"), F.max("component").alias("b"))
        .where("a < b")
        .select("h")
    )
    return materialize(placed.join(several, "h", "left_semi"), "open")


def _pairs_with_leaders(groups: DataFrame, params: JaccardParams) -> DataFrame:
    """Each text with the most typical one of each group."""
    leader = F.max_by(F.struct("id", "n"), F.struct("typical", -F.col("id")))
    leaders = groups.groupBy("h").agg(leader.alias("leader"))
    led = groups.join(leaders, "h").select(
        F.col("id").alias("x"),
        F.col("n").alias("nx"),
        F.col("leader.id").alias("y"),
        F.col("leader.n").alias("ny"),
    )
    return _ordered_pairs(led.where("x != y").where(_near_in_size("nx", "ny", params)))


def _segments_of(groups: DataFrame, segments: DataFrame) -> DataFrame:
    ids = groups.select("id").distinct()
    return materialize(segments.join(ids, "id", "left_semi"), "open_segments")


def _able(groups: DataFrame, segments: DataFrame, params: JaccardParams) -> DataFrame:
    """Postings of the texts that can still link with something in an open group.

    A shingle in no other text of an open group can't be part of any overlap that
    matters here, so the rest of the set (``most``) bounds every overlap. Half of the
    fragments tell already of most texts that they have too many such shingles.
    """
    half = 1 << (params.fragment_bits - 1)
    rows = segments.where(F.col("fragment") < half)
    rows = rows.select("id", F.explode("segment").alias("s"))
    several = rows.groupBy("s").agg(F.count("*").alias("c")).where("c > 1").select("s")
    alone = rows.join(_shuffled(several), "s", "left_anti").groupBy("id").agg(F.count("*").alias("alone"))
    most = F.col("n") - F.coalesce("alone", F.lit(0))
    able = groups.join(alone, "id", "left").withColumn("most", most).drop("alone")
    return materialize(able.where(F.col("most") * 100 >= F.col("n") * params.percent), "able")


def _differences(groups: DataFrame, segments: DataFrame) -> DataFrame:
    """What each text of a group has that the group's reference lacks, and the reverse.

    The reference is the text with the largest share of common shingles, so
    groups of the same texts mostly have the same one. One row per
    ``reference``, ``id`` and fragment with the differing shingles.
    """
    share = F.floor(F.col("most") * 1000 / F.col("n"))
    chosen = F.max_by(F.struct("id", "n"), F.struct(share, -F.col("id"))).alias("ref")
    references = groups.groupBy("h").agg(chosen)
    members = (
        groups.join(references, "h")
        .select("id", F.col("ref.id").alias("reference"))
        .distinct()
    )
    own = segments.select("id", "n", "fragment", "segment")
    theirs = segments.select(
        F.col("id").alias("reference"),
        F.col("n").alias("ref_n"),
        "fragment",
        F.col("segment").alias("other"),
    )
    differing = F.concat(F.array_except("segment", "other"), F.array_except("other", "segment"))
    rows = (
        members.join(own, "id")
        .join(theirs, ["reference", "fragment"])
        .select("reference", "ref_n", "id", "n", "fragment", differing.alias("differing"))
    )
    return materialize(rows, "differences")


def _links_across(
    groups: DataFrame, segments: DataFrame, params: JaccardParams
) -> DataFrame:
    """The links of the groups: with the references, and among the other texts.

    ``d`` is the number of shingles in which a text and the reference differ. Two texts
    link if they differ in at most ``t = r * (nx + ny)`` shingles, ``r`` being
    ``(100 - p) / (100 + p)``; and they differ in ``dx + dy`` less twice the number of
    differing shingles they share. Two texts that both link with the reference are
    in one component already, so one of a pair doesn't, and its ``d`` is large. From
    that follows how many differing shingles any pair has to share: more than about half
    of those of each text whose partner doesn't link with the reference (``half``), and
    of a text that doesn't, whatever its partner, those beyond the most it may differ in
    (``beyond``). All but the rarest, in the order of their frequency, can be left out. So
    copies with changes of their own don't meet, though they share nearly all of their text.
    """
    differences = _differences(groups, segments)
    sizes = differences.groupBy("reference", "ref_n", "id", "n").agg(
        F.sum(F.size("differing")).alias("d")
    )
    p = params.percent
    # In whole numbers: they link if (100 + p) * d <= (100 - p) * (n + ref_n).
    linked = (100 + p) * F.col("d") <= (100 - p) * (F.col("n") + F.col("ref_n"))
    sizes = materialize(sizes.withColumn("linked", linked), "sizes")

    elements = differences.select("reference", "id", F.explode("differing").alias("e"))
    common = elements.groupBy("reference", "e").agg(F.count("*").alias("df")).where("df > 1")
    shared = elements.join(_shuffled(common), ["reference", "e"])
    shared = shared.join(_shuffled(sizes), ["reference", "id"])
    own = Window.partitionBy("reference", "id")
    r = (100 - p) / (100 + p)
    half = F.floor((F.col("d") + r * (F.col("ref_n") - F.col("n"))) / 2 - 1e-9) + 1
    beyond = F.col("d") - F.floor(F.col("n") * (100 - p) / F.lit(float(p)) + 1e-9)

    def up_to(least: Column) -> Column:
        return F.col("rank") <= F.col("shared") - F.greatest(least, F.lit(1)) + 1

    kept = (
        shared.withColumn("shared", F.count("*").over(own))
        .withColumn("rank", F.row_number().over(own.orderBy("df", "e")))
        .withColumns({"few": up_to(half), "many": ~F.col("linked") & up_to(beyond)})
        .where("few OR many")
        .select("reference", "e", "id", "n", "d", "shared", "linked", "few", "many")
    )
    kept = materialize(kept, "elements")

    def side(rows: DataFrame, i: str) -> DataFrame:
        facts = [F.col(c).alias(f"{c}{i}") for c in ("id", "n", "d", "shared")]
        return rows.select("reference", "e", *facts)

    apart = F.col("dx") + F.col("dy") - 2 * F.least("sharedx", "sharedy")
    can_link = _near_in_size("nx", "ny", params) & (
        (100 + p) * apart <= (100 - p) * (F.col("nx") + F.col("ny"))
    )
    unlinked = kept.where("NOT linked")
    both = side(unlinked.where("few"), "x").join(
        _shuffled(side(unlinked.where("few"), "y")), ["reference", "e"]
    )
    one = side(unlinked.where("many"), "x").join(
        _shuffled(side(kept.where("linked AND few"), "y")), ["reference", "e"]
    )
    pairs = both.where("idx < idy").unionByName(one).where(can_link)
    pairs = pairs.groupBy(F.col("idx").alias("x"), F.col("idy").alias("y")).agg(
        F.min("reference").alias("reference")
    )
    links = sizes.where("linked AND id != reference").select(
        F.col("id").alias("x"), F.col("reference").alias("y")
    )
    found = _links_by_differences(materialize(pairs, "pairs"), differences, params)
    return _ordered_pairs(links.unionAll(found))


def _links_by_differences(
    pairs: DataFrame, differences: DataFrame, params: JaccardParams
) -> DataFrame:
    """The pairs that link, from what each differs in from their reference.

    That is far less than the texts' sets, so the parts of all fragments travel as one.
    """
    whole = differences.groupBy("reference", "id", "n").agg(
        F.flatten(F.collect_list("differing")).alias("differing")
    )
    whole = materialize(whole, "whole")
    one, two = (
        whole.select("reference", *[F.col(a).alias(b) for a, b in (("id", i), ("n", f"n{i}"), ("differing", f"d{i}"))])
        for i in ("x", "y")
    )
    apart = F.size("dx") + F.size("dy") - 2 * F.size(F.array_intersect("dx", "dy"))
    p = params.percent
    return (
        pairs.join(_shuffled(one), ["reference", "x"])
        .join(_shuffled(two), ["reference", "y"])
        .where((100 + p) * apart <= (100 - p) * (F.col("nx") + F.col("ny")))
        .select("x", "y")
    )


def near_duplicates(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """``id``, ``n_shingles`` and ``component`` of every document (``id``, ``text``).

    ``component`` is the smallest id that a chain of links reaches.
    """
    docs = docs.select("id", "text")
    heads, texts, postings = _written(docs, params)
    sizes = postings.groupBy("h").agg(F.count("*").alias("size")).where("size > 1")
    postings = materialize(postings.join(sizes, "h"), "groups")

    large = postings.where(F.col("size") > params.small_group)
    pairs = _ordered_pairs(
        _pairs_of_small_groups(postings, params).unionAll(_pairs_with_leaders(large, params))
    )
    pairs = materialize(pairs, "pairs")
    ids = pairs.select(F.col("x").alias("id")).unionAll(pairs.select("y"))
    ids = ids.unionAll(large.select("id")).distinct()
    segments = materialize(_segments(docs, ids, params), "segments")
    links = materialize(_links(pairs, segments, params), "links")

    still_open = _open_groups(large, links)
    open_segments = _segments_of(still_open, segments)
    still_open = _able(still_open, open_segments, params)
    if not still_open.isEmpty():
        across = _links_across(still_open, open_segments, params)
        links = links.unionAll(materialize(across, "links"))

    texts = _with_component(texts.withColumnRenamed("text_id", "id"), links)
    texts = texts.select("digest", "component")
    return (
        heads.select("id", "digest", F.col("n").cast("long").alias("n_shingles"))
        .join(texts, "digest")
        .select(
            "id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component"))
            .otherwise(F.col("id"))
            .alias("component"),
        )
    )
