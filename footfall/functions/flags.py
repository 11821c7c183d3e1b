"""0/1 indicators packed into bit masks.

A row's indicators on one field become the bits of a long word; ``bit_or``
folds the words of a visitor's rows, and the result columns are read off the
folded words. The aggregate state is one long per field instead of one slot
per indicator, so the aggregation stays a compiled hash aggregate and its
shuffle rows stay small.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import batched, groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.literals import sql_string
from footfall.vocabulary import Indicator

WORD_BITS = 60

# Hit fields are read through these columns, see ``with_page_levels``.
PAGE_LEVELS = {
    "hits.page.pagePathLevel2": "page_levels_2",
    "hits.page.pagePathLevel3": "page_levels_3",
}


def with_page_levels(sessions: DataFrame) -> DataFrame:
    """Add the page paths of a session's hits as arrays.

    Taken out of the hits once per row, not once per test on them.
    """
    return sessions.withColumns({column: F.col(f) for f, column in PAGE_LEVELS.items()})


def has_hits() -> Column:
    """True for sessions with at least one hit. Needs ``with_page_levels``."""
    return F.expr("coalesce(size(page_levels_2) > 0, false)")


def _words(indicators: Sequence[Indicator]) -> Iterator[tuple[str, str, tuple[Indicator, ...]]]:
    """Name, field and indicators of each word.

    One field per word keeps the compiled update of each word below the 8000
    bytes of code beyond which the JVM only interprets a method.
    """
    for field, group in groupby(indicators, key=lambda ind: ind.field):
        for i, batch in enumerate(batched(group, WORD_BITS)):
            yield f"mask_{field.replace('.', '_')}_{i}", field, batch


def _bits(field: str, indicators: Sequence[Indicator]) -> str:
    """SQL for the bits of the literals that ``field`` (a string, or strings) holds."""
    literals = [(sql_string(ind.literal), f"{1 << bit}L") for bit, ind in enumerate(indicators)]
    if field in PAGE_LEVELS:
        levels = PAGE_LEVELS[field]
        return " | ".join(f"if(array_contains({levels}, {lit}), {bit}, 0L)" for lit, bit in literals)
    entries = ", ".join(f"{lit}, {bit}" for lit, bit in literals)
    return f"coalesce(map({entries})[{field}], 0L)"


def fold_words(indicators: Sequence[Indicator]) -> list[Column]:
    """Aggregates: the words of all sessions with hits; NULL if there are none."""
    words = zip(_words(indicators), session_words(indicators), strict=True)
    return [F.bit_or(bits).alias(name) for (name, _, _), bits in words]


def session_words(indicators: Sequence[Indicator]) -> list[Column]:
    """The words of each session; NULL for one without hits."""
    return [
        F.when(has_hits(), F.expr(_bits(field, group))).alias(name)
        for name, field, group in _words(indicators)
    ]


def fold_session_words(indicators: Sequence[Indicator]) -> list[Column]:
    """Aggregates over the columns of ``session_words``."""
    return [F.bit_or(name).alias(name) for name, _, _ in _words(indicators)]


def unpack_words(indicators: Sequence[Indicator]) -> list[Column]:
    """One int column per indicator, read off the folded words; NULL words give NULL."""
    return [
        F.expr(f"cast(getbit({name}, {bit}) AS int) AS {ind.column}")
        for name, _, group in _words(indicators)
        for bit, ind in enumerate(group)
    ]
