import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm.quality_rules import QualityParams, quality_rules
from footfall.llm.queries import QUERIES
from tests.llm.rows import empty_table, odd_documents, odd_table, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, window=5):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - window + 1):
        places[tuple(words[i : i + window])].append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(window)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def _base(df, name):
    m = F.col(name)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return df.select("doc_id", "text", *[m[f].alias(f) for f in fields])


def test_counts_of_odd_documents(spark):
    table = odd_table(spark)
    judged, name = quality_rules(table)
    assert [c for c in judged.columns if c != name] == table.columns
    rows = _base(judged, name).collect()
    assert len(rows) == len(odd_documents())
    for r in rows:
        assert tuple(r)[2:] == plain(r.text), r.doc_id
    assert judged.select("quality", "ref_lang").distinct().count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_repeated_windows(spark, seed):
    texts = [(i, prose(30 + i, seed * 100 + i % 5) + " " + prose(i, seed * 100 + i % 5), "en") for i in range(40)]
    judged, name = quality_rules(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    for r in _base(judged, name).collect():
        assert tuple(r)[2:] == plain(r.text)


def test_empty_table(spark):
    judged, _ = quality_rules(empty_table(spark))
    assert judged.collect() == []


def _corpus(spark, extra):
    clean = [(i, prose(300, i), "en") for i in range(60)]
    return spark.createDataFrame(clean + extra, "doc_id long, text string, lang string")


def test_far_documents_go_and_clean_ones_stay(spark):
    words = prose(300, 77).split()
    symbols = " ".join(w + "###" for w in words)
    shouted = " ".join(w.upper() + "!!" for w in words)
    foreign = " ".join(f"zq{i}x" for i in range(300))
    judged, name = quality_rules(_corpus(spark, [(100, symbols, "en"), (101, shouted, "en"), (102, foreign, "en")]))
    kept = {r.doc_id for r in judged.where(F.col(name).kept).select("doc_id").collect()}
    assert kept == set(range(60))


def test_short_or_unknown_is_not_compared(spark):
    shouted = " ".join(w.upper() for w in prose(30, 5).split())
    rows = [(100, shouted[:190], "en"), (101, shouted * 4, "tlh"), (102, shouted * 4, None)]
    judged, name = quality_rules(_corpus(spark, rows), QualityParams(max_repeat_percent=100))
    far = {r.doc_id: r for r in judged.select("doc_id", f"{name}.*").collect()}
    assert far[100].kept and far[100].char_distance is None
    # A language's only documents are their own reference.
    assert far[101].char_distance == 0 and far[101].word_distance is None
    assert far[102].kept and far[102].char_distance is None


def test_texts_without_words_or_characters_are_judged_like_others(spark):
    """All that is judged is read here, beside a language whose limits follow from its documents."""
    table = _corpus(spark, [(100, None, "en"), (101, "", "en"), (102, " \n", "en"), (103, "###", "en"), (104, "", None)])
    judged, name = quality_rules(table, QualityParams(least_char_limit=0))
    found = {r.doc_id: r for r in judged.select("doc_id", f"{name}.*").collect()}
    assert len(found) == 65 and found[0].kept
    for i in range(100, 105):
        assert (found[i].base_failed, found[i].kept) == (True, False)
        assert found[i].char_distance is None and found[i].word_distance is None
    assert found[100].word_limit == found[101].word_limit == found[103].word_limit > found[0].word_limit
    assert found[100].char_limit == found[101].char_limit > found[103].char_limit > found[0].char_limit


def test_query_on_texts_without_characters(spark, tmp_path):
    table = _corpus(spark, [(100, None, "en"), (101, "", "en"), (102, "\n", "de")])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, str(tmp_path)).collect()}
    assert len(found) == 63 and not any(found[i].kept for i in (100, 101, 102))
    assert (found[101].n_words, found[101].char_distance, found[101].word_distance) == (0, None, None)


def test_references_do_not_depend_on_partitions(spark):
    docs = _corpus(spark, [])
    results = []
    for n in (1, 7):
        judged, name = quality_rules(docs.repartition(n), keep_text=False)
        results.append(sorted(judged.select("doc_id", f"{name}.char_distance", f"{name}.word_distance").collect()))
    assert results[0] == results[1]


def _kept(judged, name):
    return {r.doc_id for r in judged.where(F.col(name).kept).select("doc_id").collect()}


def test_copies_do_not_move_references_and_limits(spark):
    """A text that a third of all rows hold has one say; other verdicts stay as they were."""
    extra = [(100, " ".join(f"zq{i}x" for i in range(300)), "en"), (101, prose(2000, 5), "en")]
    copies = [(200 + i, extra[1][1], "en") for i in range(30)]
    fields = ("char_distance", "word_distance", "char_limit", "word_limit", "kept")
    found = []
    for more in ([], copies):
        judged, name = quality_rules(_corpus(spark, extra + more))
        rows = judged.where("doc_id < 200").select("doc_id", *[f"{name}.{f}" for f in fields])
        found.append(sorted(rows.collect()))
    assert found[0] == found[1]


def test_limits_widen_as_texts_get_shorter(spark):
    lengths = [(100 + n, prose(n, n), "en") for n in (60, 120, 1000)]
    judged, name = quality_rules(_corpus(spark, lengths), QualityParams(least_char_limit=0))
    limits = {r.doc_id: r for r in judged.select("doc_id", f"{name}.*").where("doc_id > 99").collect()}
    assert limits[160].word_limit > limits[220].word_limit >= limits[1100].word_limit
    assert limits[160].char_limit > limits[220].char_limit > limits[1100].char_limit


def test_one_document_of_a_language_and_two(spark):
    rows = [(1, prose(200, 1), "fr"), (2, prose(200, 2), "de"), (3, prose(200, 3), "de")]
    judged, name = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert _kept(judged, name) == {1, 2, 3}


def test_texts_are_written_down_small(spark):
    """They stay on disk as long as the verdicts are read, in the pipeline through all later stages."""
    docs = _corpus(spark, [(500, prose(20_000, 1), "en")])
    judged, _ = quality_rules(docs)
    assert any("/quality-" in f for f in judged.inputFiles())
    assert all(f.endswith(".zstd.parquet") for f in judged.inputFiles() if "/quality-" in f)
