import time

import pytest

from footfall.llm import licenses
from tests.llm.rows import empty_table, odd_table, prose

NOTICES = {
    "apache-2.0": "licensed under the APACHE License, version 2.0!",
    "mit": "This code is released under the MIT license",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "lgpl": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(40, i) + "\n" + prose(20, 500 + i)) for i in range(100)]
    rows += [(200 + i, prose(30, 900 + i) + "\n" + text + "\n" + prose(5, i)) for i, text in enumerate(NOTICES.values())]
    rows += [(300, "\n".join([NOTICES["mit"], NOTICES["gpl"], NOTICES["mit"]]))]
    rows += [(400 + i, t) for i, t in enumerate([
        "He lost his driving licence on the way to the river",
        "The licence fee pays for the train and the web",
        "with permission of the lamp",
    ])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_notices_are_named_and_other_texts_left_alone(spark, corpus):
    found = {r.doc_id: (list(r.families), r.n_paragraphs) for r in licenses.scan_documents(corpus).collect()}
    assert len(found) == corpus.count()
    expected = {200 + i: ([family], 1) for i, family in enumerate(NOTICES)} | {300: (["gpl", "mit"], 3)}
    assert {i: v for i, v in found.items() if v[1]} == expected


def test_held_out_variants(spark, corpus):
    """Families of templates with other words left out than in training."""
    params = licenses.LicenseParams()
    model = licenses.train(corpus, params)
    rows = []
    for family, texts in licenses.TEMPLATES.items():
        for n, text in enumerate(texts):
            words = text.split()
            rows.append((family, "seen before " + " ".join(w for i, w in enumerate(words) if len(words) < 8 or i % 11 != 3 + n)))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.family for r in licenses.scan(docs, model, params).collect()}
    right = sum(found.get(i) == family for i, (family, _) in enumerate(rows))
    assert right >= 0.9 * len(rows), [(r, found.get(i)) for i, r in enumerate(rows) if found.get(i) != r[0]]


def test_notices_without_a_mark_and_wrapped_ones(spark, corpus):
    wrapped = (
        "Permission is hereby granted, free of charge, to any\n# person obtaining a copy of this software and\n"
        "# associated documentation files, to deal in the\n# Software without restriction"
    )
    texts = {
        0: ("All rights reserved.", ["proprietary"], 1),
        1: ("All rights reserved. No part of this work may be reproduced", ["proprietary"], 1),
        2: ("SPDX identifier: MIT", ["mit"], 1),
        3: (wrapped, ["mit"], 1),
        4: ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.", ["cc-by-nc"], 1),
        6: ("All rights reserved.\nReleased under the MIT License.", ["mit", "proprietary"], 2),
    }
    docs = [(1000 + i, prose(30, i) + "\n\n" + text + "\n\n" + prose(30, 50 + i)) for i, (text, _, _) in texts.items()]
    docs = corpus.unionAll(spark.createDataFrame(docs, corpus.schema))
    found = {r.doc_id: (list(r.families), r.n_paragraphs) for r in licenses.scan_documents(docs).collect()}
    for i, (text, families, n) in texts.items():
        assert found[1000 + i] == (families, n), text


def test_every_template_fits_a_piece():
    assert licenses._most_words() <= licenses.PIECES[-1]


def test_key_words_lose_nothing():
    """Every template without any of the words that may lack still has a key word."""
    for share in (0.5, 0.6, 0.8):
        keys = set(licenses.key_words(share))
        for words in licenses._template_words():
            needed = next(n for n in range(1, len(words) + 1) if n / len(words) >= share)
            assert len(set(words) - keys) < needed


def test_odd_documents(spark):
    rows = licenses.scan_documents(odd_table(spark)).collect()
    assert {r.n_paragraphs for r in rows} == {0}
    assert len({r.doc_id for r in rows}) == len(rows)
    assert licenses.scan_documents(empty_table(spark)).collect() == []


def test_families_next_to_the_listed_ones(spark, corpus):
    """Licences of other names are themselves or none, never their neighbour."""
    texts = {
        "Released under the ISC License.": ["isc"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["agpl"],
        "Licensed under CC BY-ND 4.0.": ["cc-by-nd"],
        "Licensed under CC BY-NC-SA 4.0.": ["cc-by-nc-sa"],
        "Released under the Zlib License.": [],
        "Released under the Unicode License.": [],
        "This code is released under the MIT license": ["mit"],
    }
    docs = [(1000 + i, prose(30, i) + "\n" + text + "\n" + prose(9, i)) for i, text in enumerate(texts)]
    docs = corpus.unionAll(spark.createDataFrame(docs, corpus.schema))
    found = {r.doc_id: list(r.families) for r in licenses.scan_documents(docs).collect()}
    assert {t: found[1000 + i] for i, t in enumerate(texts)} == texts


def test_notices_inside_long_lines(spark, corpus):
    """Thirty words before and after, and texts of one line."""
    around = [(30, 30), (200, 200), (1000, 3), (3, 1000), (29, 31), (59, 61)]
    docs = [
        (1000 + i, f"{prose(before, i)} {notice} {prose(after, 70 + i)}")
        for i, (before, after) in enumerate(around)
        for notice in [NOTICES["mit"] if i % 2 else NOTICES["gpl"]]
    ]
    docs = corpus.unionAll(spark.createDataFrame(docs, corpus.schema))
    found = {r.doc_id: (list(r.families), r.n_paragraphs) for r in licenses.scan_documents(docs).collect()}
    for i in range(len(around)):
        assert found[1000 + i] == (["mit" if i % 2 else "gpl"], 1), around[i]


def test_very_long_lists_of_notices(spark, corpus):
    model = licenses.train(corpus)
    lines = [NOTICES["mit"], NOTICES["gpl"]] * 10_000
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[:7])), (2, "\n".join(lines[:7]))], corpus.schema)
    started = time.monotonic()
    found = licenses.scan(docs, model).groupBy("doc_id", "family").count().collect()
    assert {tuple(r) for r in found} == {(1, "mit", 10_000), (1, "gpl", 10_000), (2, "mit", 4), (2, "gpl", 3)}
    assert time.monotonic() - started < 60


def test_every_unknown_line_counts(spark, monkeypatch):
    """More lines with a key word than any bounded sample, many of them equal."""
    tables, write = {}, licenses.materialize

    def recorded(df, name="rows"):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(licenses, "materialize", recorded)
    words = ["river", "lamp", "the", "of", "and", "free", "person", "form"]
    rows = [(i, "\n".join(f"the source {words[(i + k) % 8]} {words[k % 8]} of stone {i}" for k in range(30))) for i in range(300)]
    licenses.train(spark.createDataFrame(rows, "doc_id long, text string"))
    unknown = tables["unknown"]
    assert unknown.selectExpr("sum(n)" if "n" in unknown.columns else "count(*)").first()[0] == 9000


def test_corpus_of_notices_alone(spark):
    docs = spark.createDataFrame([(i, NOTICES["mit"]) for i in range(5)], "doc_id long, text string")
    assert [list(r.families) for r in licenses.scan_documents(docs).collect()] == [["mit"]] * 5


def test_threshold_is_the_least_that_few_lines_exceed(spark):
    rows = [(i / 100, 1) for i in range(100)] + [(0.25, 900)]
    edge = licenses._edge(spark.createDataFrame(rows, "chance double, n long"), licenses.LicenseParams())
    assert sum(n for c, n in rows if c > edge) <= 10 < sum(n for c, n in rows if c > edge - 0.011)
    assert licenses._edge(spark.createDataFrame([], "chance double, n long"), licenses.LicenseParams()) == 0.5
