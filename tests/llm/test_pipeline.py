"""The pipeline's stages against plain versions, each on its own input."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import decontamination, pii
from footfall.llm.quality_rules import (
    CHAR_CLASSES,
    COMMON_WORDS,
    DISTANCE_UNIT,
    MOST_NOISE,
    NOISE_UNIT,
    UNIT,
    QualityParams,
)
from tests.llm import test_decontamination, test_ngram_jaccard, test_packing, test_quality_rules
from tests.llm.rows import SCHEMA, empty_table, odd_table, prose

TABLES = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    """Rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    frames = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], TABLES).cache())
    return frames


def _rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def _shares(counts, total):
    return [n * UNIT // total for n in counts]


def _histograms(text, lang):
    classes = [sum(map(len, re.findall(p, text))) for p in CHAR_CLASSES.values()]
    chars = _shares([*classes, len(text) - sum(classes)], max(len(text), 1))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(w.lower() for w in words if w in {w.lower(), w.capitalize(), w.upper()})
    common = _shares([seen[w] for w in COMMON_WORDS[lang]], max(len(words), 1))
    return chars, [*common, UNIT - sum(common)]


def _distance(mine, theirs):
    p, q = ([x / sum(xs) for x in xs] for xs in (mine, theirs))
    parts = [x * math.log2(2 * x / (x + y)) for a, b in ((p, q), (q, p)) for x, y in zip(a, b) if x]
    return math.sqrt(max(sum(parts) / 2, 0))


def test_quality(outputs):
    params, docs = QualityParams(), _rows(outputs[0])
    base = {i: test_quality_rules.plain(r.text) for i, r in docs.items()}
    histograms = {i: _histograms(r.text, r.lang) for i, r in docs.items()}
    long_chars = {i for i, r in docs.items() if len(r.text) >= params.min_chars_compared}
    long_words = {i for i in docs if base[i][0] >= params.min_words_compared}
    kinds = defaultdict(dict)
    for i in long_chars & long_words:
        if not base[i][-1]:
            key = (len(docs[i].text), base[i][0], repr(histograms[i]))
            kinds[docs[i].lang][key] = (len(docs[i].text), base[i][0], histograms[i])
    references, medians = {}, {}
    for lang, of_lang in kinds.items():
        sums = [[sum(x) for x in zip(*(h[k] for *_, h in of_lang.values()))] for k in (0, 1)]
        noise = sorted(
            min(math.floor(_distance(h[1], sums[1]) * math.sqrt(n) * NOISE_UNIT), MOST_NOISE)
            for _, n, h in of_lang.values()
        )
        middle = sorted(math.floor(_distance(h[0], sums[0]) * DISTANCE_UNIT) for *_, h in of_lang.values())
        references[lang] = sums
        low = (len(of_lang) - 1) // 2
        medians[lang] = noise[low] / NOISE_UNIT, middle[low] / DISTANCE_UNIT
    expected = set()
    for i, r in docs.items():
        chars, words = references[r.lang]
        noise, middle = medians[r.lang]
        of_words = max(params.least_word_limit, noise * params.word_spread / math.sqrt(max(base[i][0], 1)))
        widened = middle * (1 + params.char_widening / math.sqrt(max(len(r.text), 1)))
        of_chars = max(params.least_char_limit, widened)
        far = i in long_chars and _distance(histograms[i][0], chars) > of_chars
        far |= i in long_words and _distance(histograms[i][1], words) > of_words
        if not base[i][-1] and not far:
            expected.add(i)
    assert set(_rows(outputs[1])) == expected
    assert 100 < len(expected) < len(docs)


def test_one_of_each_group(outputs):
    docs = _rows(outputs[1])
    classes = test_ngram_jaccard.plain([(i, r.text) for i, r in docs.items()], 5, 80)
    kept = _rows(outputs[2])
    assert set(kept) == {i for i in docs if classes[i][1] == i}
    assert len(kept) < len(docs)


def test_contaminated_documents_go(spark, outputs):
    docs = _rows(outputs[2])
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()
    verdicts = test_decontamination.plain([(i, r.text) for i, r in docs.items()], [tuple(r) for r in items])
    assert set(_rows(outputs[3])) == {i for i in docs if not verdicts[i][3]}
    assert any(v[3] for v in verdicts.values())


def test_personal_data_is_replaced(outputs):
    before, after = _rows(outputs[3]), _rows(outputs[4])
    assert set(after) == set(before)
    changed = 0
    for i, r in before.items():
        entities = [m[0] for m in re.finditer("|".join(f"(?:{p})" for k, p in pii.PATTERNS.items() if k != "name"), r.text)]
        changed += bool(entities)
        assert not any(e in after[i].text for e in entities)
        assert (after[i].text == r.text) == (not entities)
        assert tuple(r)[2:] == tuple(after[i])[2:]
    assert changed > 3


def test_packed(outputs):
    docs, rows = _rows(outputs[4]), outputs[5].collect()
    test_packing.check_sequences(rows, 1024)
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths == {i: len(test_packing._ids(r.text)) for i, r in docs.items()}


def test_stages_keep_the_columns(outputs):
    for frame in outputs[:-1]:
        assert frame.columns == COLUMNS


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_documents(spark, name, stage):
    for docs in (odd_table(spark), empty_table(spark)):
        done = stage(spark, docs, TABLES)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert done.columns == docs.columns
        ids = {r.doc_id for r in done.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_documents_without_id_pass_like_others(spark):
    """Row counts with ids left out, against the same documents with ids."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").cache()
    judged = corpus_pipeline.drop_contaminated(spark, docs, TABLES)
    bad = docs.join(judged.select("doc_id"), "doc_id", "left_anti").limit(1)
    clean = judged.orderBy("doc_id").limit(20)
    some = clean.unionAll(bad).cache()
    nameless = some.withColumn("doc_id", F.lit(None).cast("long"))
    assert some.count() == 21
    for stage in (corpus_pipeline.drop_contaminated, corpus_pipeline.keep_one_of_each_group):
        expected, found = (sorted(r.text for r in stage(spark, d, TABLES).collect()) for d in (some, nameless))
        assert set(found) == set(expected) and len(expected) > 1
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text")
    hits = decontamination.decontaminate(nameless.select("doc_id", "text"), items).collect()
    assert len(hits) == some.select("text").distinct().count()
    assert {r.doc_id for r in hits} == {None} and sum(r.contaminated for r in hits) == 1
    mixed = decontamination.decontaminate(clean.unionAll(nameless).select("doc_id", "text"), items)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in clean.collect()} | {None}


def test_one_row_stays_of_equal_ones(spark):
    """Equal rows with and without id, many times over; different texts of one id are no copies."""
    texts = [prose(40, i) for i in range(4)]
    rows = [(1, texts[0])] * 5 + [(None, texts[1])] * 4 + [(2, texts[2]), (None, texts[2]), (3, None), (3, None)]
    rows += [(None, None)] * 2 + [(4, texts[3]), (5, texts[3])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).repartition(3)
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, TABLES).collect()
    found = sorted(((r.doc_id, r.text) for r in kept), key=str)
    assert found == sorted([(1, texts[0]), (None, texts[1]), (2, texts[2]), (3, None), (None, None), (4, texts[3])], key=str)


def test_run_is_the_stages_in_turn(spark, outputs):
    found = corpus_pipeline.run(spark, TABLES)
    order = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    assert sorted(found.select(*order).collect()) == sorted(outputs[5].select(*order).collect())
