"""Quality rules: how far a document's histograms lie from its language's.

Two histograms describe a document: its characters by class, and how often each
of its language's most common words occurs. The reference of a language is the
mean of both over all its documents that pass the base rules and are long
enough. A document too far from the reference by Jensen-Shannon distance is rejected; a histogram over
too few characters or words says nothing and is not held against it.

What is too far follows from the language's own distances. Counting n words moves a document
away from its reference by about noise / sqrt(n), and the language's noise is the median of
distance * sqrt(n) over its documents: a document may be ``word_spread`` times as far as that of its
length. Character classes hardly vary by chance, but short texts hold headings, numbers
or addresses, so the median distance is widened by 1 + ``char_widening`` / sqrt(characters). Below the
two least limits nothing is far. References and medians count documents with equal measures once, so that
a group of copies has no more say than one of them, however large it is.

Counts are computed row by row without a shuffle. The documents' measures are shuffled
once to find the equal ones; references and medians are one small row per language.

Defined cases: a NULL, empty or blank text has no words, fails the base rules and has no distances. A
document of no or an unlisted language has no common-word test; one whose
language has no reference (nothing of it is long enough) has no test at all.
Repeated rows are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.words import SPACE_CHARS, SPACES, fresh_name, space_words
from footfall.sources.workspace import materialize

# Common words by language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "in", "den", "von", "zu", "mit", "ist", "auf", "nicht"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "pour"],
}
N_COMMON = 12

# Character classes, as regular expressions; what is in none of them is the last class.
CHAR_CLASSES = {
    "lower": r"[a-z]+",
    "upper": r"[A-Z]+",
    "digit": r"[0-9]+",
    "space": SPACES,
    "mark": r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+",
}
SYMBOLS = r"[#*$%&|<>]+"

# Shares are rounded down to this fraction, so that their sums are whole numbers
# and don't depend on the order of the rows.
UNIT = 1_000_000

# Distances become whole numbers of these fractions to take their medians by counting.
NOISE_UNIT, DISTANCE_UNIT = 1_000, 10_000
MOST_NOISE = 20 * NOISE_UNIT

REFERENCE_COLUMNS = ("ref_lang", "ref_chars", "ref_words", "ref_noise", "ref_middle")


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    min_chars_compared: int = 200
    min_words_compared: int = 50
    word_spread: float = 1.8
    char_widening: float = 110.0
    least_word_limit: float = 0.15
    least_char_limit: float = 0.1


def _numbered(keys: Column) -> Column:
    """The windows' hashes with their positions, equal ones side by side."""
    return F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _places(numbered: Column) -> Column:
    """Positions, in order, of the windows whose hash a neighbour shares."""

    def if_shared(x: Column, k: Column) -> Column:
        before, after = F.get(numbered, k - 1).h, F.get(numbered, k + 1).h
        return F.when((x.h == before) | (x.h == after), x.i)

    return F.array_sort(F.array_compact(F.transform(numbered, if_shared)))


def _n_covered(places: Column, window: int) -> Column:
    """Words covered: ``window`` from each place, or as many as lie before the next."""
    steps = F.transform(
        places,
        lambda i, k: F.least(F.coalesce(F.get(places, k + 1) - i, F.lit(window)), F.lit(window)),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def with_measures(df: DataFrame, params: QualityParams = QualityParams()) -> tuple[DataFrame, str]:
    """``df`` with a struct of counts and histograms; also the struct's name."""
    text, lang = F.coalesce("text", F.lit("")), F.col("lang")
    name = fresh_name(df, "quality")
    words, common, keys = (fresh_name(df, x) for x in ("w_", "c_", "k_"))
    numbered, places = fresh_name(df, "n_"), fresh_name(df, "p_")
    rest, lines = fresh_name(df, "t_"), fresh_name(df, "l_")
    steps: list[str] = []
    every = {w for its_words in COMMON_WORDS.values() for w in its_words}
    listed = sorted({form for w in every for form in (w, w.capitalize(), w.upper())})
    w, c, k, shown = F.col(words), F.col(common), F.col(keys), F.col(lines)

    listed_of_lang = F.lit(None).cast("array<string>")
    for code, its_words in COMMON_WORDS.items():
        listed_of_lang = F.when(lang == code, F.array(*map(F.lit, its_words))).otherwise(
            listed_of_lang
        )

    last = F.size(w) - params.window + 1
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda i: F.xxhash64(*[F.get(k, i + j) for j in range(-1, params.window - 1)]),
    )
    # Columns of earlier steps are used several times below, so each is computed once.
    df = df.withColumn(words, space_words(F.col("text")))
    df = df.withColumns(
        {
            common: F.transform(F.filter(w, lambda x: x.isin(listed)), lambda x: F.lower(x)),
            keys: F.transform(w, lambda x: F.xxhash64(x)),
            rest: F.regexp_replace(text, CHAR_CLASSES["lower"], ""),
            lines: F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACE_CHARS)) != ""),
        }
    )
    # Each class is counted on what is left of the text by the ones before it.
    r = F.col(rest)
    counts = [F.char_length(text) - F.char_length(r)]
    df = df.withColumn(keys, F.when(last >= 2, windows))
    for pattern in list(CHAR_CLASSES.values())[1:]:
        after = F.regexp_replace(r, pattern, "")
        if pattern == CHAR_CLASSES["mark"]:
            n_symbols = F.char_length(r) - F.char_length(F.regexp_replace(r, SYMBOLS, ""))
        else:
            n_symbols = F.lit(0)
        step = F.struct(
            after.alias("text"),
            (F.char_length(r) - F.char_length(after)).alias("n"),
            n_symbols.alias("n_symbols"),
        )
        name_of_step = fresh_name(df, "r_")
        df = df.withColumn(name_of_step, step)
        counts.append(F.col(name_of_step).n)
        steps.append(name_of_step)
        r = F.col(name_of_step).text
    # Most documents repeat nothing and skip the sorting.
    repeated = F.size(F.array_distinct(k)) < F.size(k)
    df = df.withColumn(numbered, F.when(repeated, _numbered(k)))
    df = df.withColumn(places, _places(F.col(numbered)))
    n_chars = F.char_length(text).cast("long")
    per_word = [
        F.size(c) - F.size(F.array_remove(c, F.get(listed_of_lang, F.lit(i))))
        for i in range(N_COMMON)
    ]
    n_space = counts[list(CHAR_CLASSES).index("space")]
    measures = F.struct(
        F.size(w).cast("long").alias("n_words"),
        (n_chars - n_space).alias("word_chars"),
        F.col(steps[-1]).n_symbols.cast("long").alias("n_symbols"),
        (F.size(shown) - F.size(F.array_distinct(shown))).cast("long").alias("n_dup_lines"),
        F.coalesce(_n_covered(F.col(places), params.window), F.lit(0))
        .cast("long")
        .alias("n_repeat_words"),
        n_chars.alias("n_chars"),
        F.array(*counts, F.char_length(r)).cast("array<long>").alias("chars"),
        F.when(listed_of_lang.isNotNull(), F.array(*per_word).cast("array<long>")).alias("common"),
    )
    helpers = [words, common, keys, numbered, places, rest, lines, *steps]
    return df.withColumn(name, measures).drop(*helpers), name


def base_failed(measures: Column, params: QualityParams = QualityParams()) -> Column:
    return (measures.n_words < params.min_words) | (
        100 * measures.n_repeat_words > params.max_repeat_percent * measures.n_words
    )


def _histograms(measures: Column) -> tuple[Column, Column]:
    """Shares of the character classes; of the common words and of all others."""

    def shares(counts: Column, total: Column) -> Column:
        total = F.greatest(total, F.lit(1).cast("long"))
        return F.transform(counts, lambda n: F.floor(n * UNIT / total).cast("long"))

    of_words = shares(measures.common, measures.n_words)
    rest = F.aggregate(of_words, F.lit(UNIT).cast("long"), lambda left, x: left - x)
    return shares(measures.chars, measures.n_chars), F.concat(of_words, F.array(rest))


def _kinds(df: DataFrame, measures: str, params: QualityParams) -> DataFrame:
    """The acceptable documents' languages, lengths and histograms, equal ones once."""
    m = F.col(measures)
    long_enough = (m.n_chars >= params.min_chars_compared) & (
        m.n_words >= params.min_words_compared
    )
    good = df.where(F.col("lang").isNotNull() & ~base_failed(m, params) & long_enough)
    fields = ("n_words", "n_chars", "chars", "common")
    kinds = good.select("lang", *[m[f].alias(f) for f in fields]).distinct()
    chars, words = _histograms(F.struct(*fields))
    return kinds.select("lang", "n_words", "n_chars", chars.alias("chars"), words.alias("words"))


def language_references(kinds: DataFrame) -> DataFrame:
    """One row per language: sums of the shares over its acceptable documents."""

    def sums(column: str, n: int) -> Column:
        return F.array(*[F.sum(F.get(F.col(column), F.lit(i))) for i in range(n)])

    return kinds.groupBy(F.col("lang").alias("ref_lang")).agg(
        sums("chars", len(CHAR_CLASSES) + 1).alias("ref_chars"),
        sums("words", N_COMMON + 1).alias("ref_words"),
    )


def with_medians(kinds: DataFrame, references: DataFrame) -> DataFrame:
    """``references`` with ``ref_noise`` and ``ref_middle``, the medians over the language's documents.

    Exact over the whole numbers that are counted; of two in the middle the lower one.
    """
    joined = kinds.join(references, F.col("lang") == F.col("ref_lang"))
    by_chars = _distance(_normalised(F.col("chars")), _normalised(F.col("ref_chars")))
    by_words = _distance(_normalised(F.col("words")), _normalised(F.col("ref_words")))
    noise = F.floor(by_words * F.sqrt("n_words") * NOISE_UNIT).cast("long")
    noise = F.when(noise > MOST_NOISE, MOST_NOISE).otherwise(noise)
    middle = F.floor(by_chars * DISTANCE_UNIT).cast("long")
    numbers = F.explode(
        F.array(
            F.struct(F.lit("ref_noise").alias("which"), noise.alias("value")),
            F.struct(F.lit("ref_middle").alias("which"), middle.alias("value")),
        )
    )
    counts = (
        joined.select("ref_lang", numbers.alias("x"))
        .where("x.value IS NOT NULL")
        .groupBy("ref_lang", "x.which", "x.value")
        .count()
    )
    # At most MOST_NOISE + DISTANCE_UNIT rows of a language, whatever the number of documents.
    all_of = Window.partitionBy("ref_lang", "which")
    so_far = F.sum("count").over(all_of.orderBy("value"))
    placed = counts.withColumns({"so_far": so_far, "total": F.sum("count").over(all_of)})

    def median(which: str) -> Column:
        return F.min(F.when(F.col("which") == which, F.col("value"))).alias(which)

    medians = (
        placed.where("2 * so_far >= total")
        .groupBy("ref_lang")
        .agg(median("ref_noise"), median("ref_middle"))
    )
    return references.join(medians, "ref_lang", "left").select(*REFERENCE_COLUMNS)


def _normalised(shares: Column) -> Column:
    """Shares of 1; NULLs where there is nothing to share out, as in a text without characters."""
    total = F.aggregate(shares, F.lit(0).cast("long"), lambda a, x: a + x).cast("double")
    return F.transform(shares, lambda x: F.try_divide(x.cast("double"), total))


def _distance(mine: Column, theirs: Column) -> Column:
    """Jensen-Shannon distance (base 2, so from 0 to 1) of two distributions."""

    def against_middle(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    parts = F.zip_with(mine, theirs, lambda p, q: against_middle(p, q) + against_middle(q, p))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    # NULL if there is nothing to compare; rounding may leave equal ones just below 0.
    return F.sqrt(F.when(total > 0, total / 2).when(total <= 0, 0.0))


def _root(n: Column) -> Column:
    """Square root to divide by: texts of nothing have the limits of texts of one."""
    return F.sqrt(F.greatest(n, F.lit(1).cast("long")).cast("double"))


def _word_limit(m: Column, params: QualityParams) -> Column:
    noise = F.col("ref_noise") / NOISE_UNIT
    return F.greatest(F.lit(params.least_word_limit), noise * params.word_spread / _root(m.n_words))


def _char_limit(m: Column, params: QualityParams) -> Column:
    middle = F.col("ref_middle") / DISTANCE_UNIT
    return F.greatest(
        F.lit(params.least_char_limit),
        middle * (1 + params.char_widening / _root(m.n_chars)),
    )


def judge(
    df: DataFrame, measures: str, references: DataFrame, params: QualityParams = QualityParams()
) -> DataFrame:
    """``df`` with ``base_failed``, both distances, their limits and ``kept`` inside the struct."""
    m = F.col(measures)
    chars, words = _histograms(m)
    cols = [c for c in df.columns if c != measures]
    far, mine = fresh_name(df, "far_"), fresh_name(df, "mine_")
    references = references.select(
        "ref_lang",
        _normalised(F.col("ref_chars")).alias("ref_chars"),
        _normalised(F.col("ref_words")).alias("ref_words"),
        "ref_noise",
        "ref_middle",
    )
    joined = df.join(references, F.col("lang") == F.col("ref_lang"), "left").withColumn(
        mine, F.struct(chars.alias("chars"), words.alias("words"))
    )
    joined = joined.withColumn(
        mine,
        F.struct(
            _normalised(F.col(mine).chars).alias("chars"),
            _normalised(F.col(mine).words).alias("words"),
        ),
    )
    by_chars = _distance(F.col(mine).chars, F.col("ref_chars"))
    by_words = _distance(F.col(mine).words, F.col("ref_words"))
    judged = joined.withColumn(
        far,
        F.struct(
            F.when(m.n_chars >= params.min_chars_compared, by_chars).alias("chars"),
            F.when(m.n_words >= params.min_words_compared, by_words).alias("words"),
            _char_limit(m, params).alias("char_limit"),
            _word_limit(m, params).alias("word_limit"),
        ),
    )
    d = F.col(far)
    # A distance that is not compared is NULL and above no limit.
    too_far = F.coalesce(d.chars > d.char_limit, F.lit(False)) | F.coalesce(
        d.words > d.word_limit, F.lit(False)
    )
    verdict = m.withField("base_failed", base_failed(m, params))
    verdict = verdict.withField("char_distance", d.chars).withField("word_distance", d.words)
    verdict = verdict.withField("char_limit", d.char_limit).withField("word_limit", d.word_limit)
    verdict = verdict.withField("kept", ~base_failed(m, params) & ~too_far)
    return judged.select(*[F.col(f"`{c}`") for c in cols], verdict.alias(measures))


def quality_rules(
    df: DataFrame, params: QualityParams = QualityParams(), keep_text: bool = True
) -> tuple[DataFrame, str]:
    """All rows of ``df`` (``text``, ``lang`` and any other columns), each judged.

    Also gives the name of the struct that holds counts, distances and ``kept``.
    The measured rows are written to the shared folder, since the references and
    the verdicts both read them; ``keep_text`` says whether with their texts.
    """
    own = [c for c in df.columns if keep_text or c != "text"]
    clash = {c: fresh_name(df, f"own_{c}_") for c in own if c.lower() in REFERENCE_COLUMNS}
    measured, name = with_measures(df.withColumnsRenamed(clash), params)
    if keep_text:
        # The texts stay on disk until the caller's scope ends.
        measured = materialize(measured, "quality", compression="zstd")
    else:
        measured = materialize(measured.drop("text"), "quality")
    kinds = materialize(_kinds(measured, name, params), "kinds")
    # Written down, so that the planner knows how small they are and joins without a shuffle by language.
    sums = materialize(language_references(kinds), "sums")
    references = materialize(with_medians(kinds, sums), "references")
    judged = judge(measured, name, references, params)
    return judged.withColumnsRenamed({new: old for old, new in clash.items()}), name
