"""Rows every operator on documents has to cope with."""

from __future__ import annotations

import random
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and to in river stone lamp Über Ça größe über naïve data model train web".split()


def prose(n: int, seed: int = 0) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def odd_documents() -> list[tuple]:
    """NULLs in any column, empty and blank texts, a very long one, ties and repeated rows."""
    texts = [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "É x",
        "a a a a a a a a a a a a a a a a a a a a",
        prose(60, 1),
        prose(60, 1),
        prose(20_000, 2),
        "\n\n" + prose(12, 3) + "\n" + prose(12, 3) + "\n",
        "<|endoftext|> </s> \\ $1 {}",
    ]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(20, prose(40, 4), None, None, None), (21, prose(40, 5), "xx", "s", 1)]
    rows += [rows[6], rows[6], (22, None, None, None, None)]
    return rows


def odd_table(spark):
    """The odd documents with further columns called like the operators' own."""
    table = spark.createDataFrame(odd_documents(), SCHEMA)
    names = ["id", "words", "quality", "n_words", "n_entities", "length", "h", "ref_lang", "w_"]
    for name in names:
        table = table.selectExpr("*", f"concat('own ', source) AS {name}")
    return table


def empty_table(spark):
    return spark.createDataFrame([], SCHEMA)
