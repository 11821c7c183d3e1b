"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from footfall.llm.quality_rules import (
    COMMON_WORDS,
    DISTANCE_UNIT,
    MOST_NOISE,
    NOISE_UNIT,
    UNIT,
    QualityParams,
)

OP4 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS s FROM p
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY s) ELSE page_id END AS first
  FROM d
)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP7 = r"""
WITH a AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), b AS (
  SELECT page_id, coalesce(rest, '') AS rest FROM a
), c AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM b
), r(rh, rp, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT c.*, r.rh || r.rp AS rule, r.v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.rh || r.rp) DESC NULLS LAST) AS k
  FROM c LEFT JOIN r
    ON (c.host = r.rh OR ends_with(c.host, '.' || r.rh)) AND starts_with(c.path, r.rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""

OP3 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n AS (
  SELECT *,
         row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS last,
         sum(length(role) + length(regexp_replace(role, '[^<|\[\\]', '', 'g'))
             + length(text) + length(regexp_replace(text, '[^<|\[\\]', '', 'g')) + 11) OVER w AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                      ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR k = last))::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

OP1 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(
    range(1, len(w) - least(13, len(w)) + 2), lambda i: list_slice(w, i, i + least(13, len(w)) - 1))) AS g
  FROM iw WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM win), dg AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM dw, lens WHERE len(w) >= n
), hit AS (
  SELECT doc_id, i, dg.n, item_id FROM dg JOIN win ON dg.n = win.n AND list_slice(w, i, i + dg.n - 1) = g
), pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY 1
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP5 = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)),
    lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) AS s
  FROM dw WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * o >= 85 * (p.n + q.n - o)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM dw UNION SELECT a, y FROM reach JOIN edges ON b = x
), low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM low LEFT JOIN n USING (doc_id)
"""



def _op9(params: QualityParams = QualityParams()) -> str:
    """The rules once more; histograms are lists here, references are sums of lists."""
    by_lang = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]"
        for lang, words in COMMON_WORDS.items()
    )

    def sums(column: str, n: int) -> str:
        return "[" + ", ".join(f"sum({column}[{i + 1}])" for i in range(n)) + "]"

    def distance(mine: str, theirs: str) -> str:
        one = f"list_transform({mine}, lambda x: x / list_sum({mine})::DOUBLE)"
        two = f"list_transform({theirs}, lambda x: x / list_sum({theirs})::DOUBLE)"
        part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
        terms = f"{part.format('z[1]', 'z[2]')} + {part.format('z[2]', 'z[1]')}"
        pairs = f"list_transform(list_zip({one}, {two}), lambda z: [z[1], z[2]])"
        return f"sqrt(greatest(list_sum(list_transform({pairs}, lambda z: {terms})) / 2, 0))"

    return rf"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS x,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    CASE lang {by_lang} END AS listed
  FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(w, i, i + {params.window - 1}) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {params.window - 2})) AS i FROM t) AS s
), places AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), steps AS (
  SELECT doc_id, least({params.window}, coalesce(
    lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {params.window})) AS step
  FROM places
), repeats AS (SELECT doc_id, sum(step)::BIGINT AS n FROM steps GROUP BY 1
), counted AS (
  SELECT doc_id, lang, listed, len(w)::BIGINT AS n_words, length(x)::BIGINT AS n_chars,
    length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    list_transform(['a-z', 'A-Z', '0-9', '\x20\x09-\x0D', '\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E'],
      lambda c: length(regexp_replace(x, '[^' || c || ']', '', 'g'))) AS classes,
    list_transform(listed, lambda v: len(list_filter(w,
      lambda y: y IN (v, upper(v), upper(v[1]) || v[2:])))) AS common
  FROM t LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < {params.min_words}
      OR 100 * n_repeat_words > {params.max_repeat_percent} * n_words AS base_failed,
    list_transform(list_append(classes, n_chars - list_sum(classes)),
      lambda n: (n * {UNIT} // greatest(n_chars, 1))::BIGINT) AS chars,
    list_transform(common, lambda n: (n * {UNIT} // greatest(n_words, 1))::BIGINT) AS words
  FROM counted
), full_words AS (
  SELECT * REPLACE (list_append(words, ({UNIT} - list_sum(words))::BIGINT) AS words) FROM judged
), kinds AS (
  SELECT DISTINCT lang, n_words, n_chars, classes, common, chars, words
  FROM full_words
  WHERE lang IS NOT NULL AND NOT base_failed AND n_chars >= {params.min_chars_compared}
    AND n_words >= {params.min_words_compared}
), refs AS (
  SELECT lang, {sums('chars', 6)} AS ref_chars, {sums('words', 13)} AS ref_words
  FROM kinds GROUP BY 1
), medians AS (
  SELECT lang,
    quantile_disc(least(floor({distance('words', 'ref_words')} * sqrt(n_words) * {NOISE_UNIT}),
      {MOST_NOISE}), 0.5) / {NOISE_UNIT} AS noise,
    quantile_disc(floor({distance('chars', 'ref_chars')} * {DISTANCE_UNIT}), 0.5)
      / {DISTANCE_UNIT} AS middle
  FROM kinds JOIN refs USING (lang) GROUP BY 1
), far AS (
  SELECT f.*,
    greatest({params.least_word_limit}, noise * {params.word_spread} / sqrt(n_words)) AS word_limit,
    greatest({params.least_char_limit},
      middle * (1 + {params.char_widening} / sqrt(n_chars))) AS char_limit,
    CASE WHEN n_chars >= {params.min_chars_compared}
      THEN {distance('chars', 'ref_chars')} END AS cd,
    CASE WHEN n_words >= {params.min_words_compared}
      THEN {distance('words', 'ref_words')} END AS wd
  FROM full_words AS f LEFT JOIN refs USING (lang) LEFT JOIN medians USING (lang)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(cd <= char_limit, true)
    AND coalesce(wd <= word_limit, true) AS kept,
  round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
FROM far
"""


#: CRC-32 of the decimal ``doc_id``, bit by bit: a digit to mix in, then eight shifts (-1).
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: list_concat(
      [ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

OP13 = rf"""
WITH RECURSIVE shown AS (
  SELECT *, row_number() OVER () AS k,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    replace(text, chr(10), '') AS short
  FROM documents
), leaves AS (
  SELECT doc_id, source, k, head,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(short) || ':' || short, '-')) AS short_leaf
  FROM shown
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves
), levels(source, h, hs) AS (
  SELECT source, 0, list(leaf ORDER BY place) FROM placed GROUP BY source
  UNION ALL
  SELECT source, h + 1, list_transform(range(0, (len(hs) + 2) // 3),
    lambda i: sha256(array_to_string(list_slice(hs, 3 * i + 1, 3 * i + 3), '')))
  FROM levels WHERE len(hs) > 1
), subroots AS (
  SELECT source, hs[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS nth
  FROM levels WHERE len(hs) = 1
), upper_levels(h, hs) AS (
  SELECT 0, list(subroot ORDER BY nth) FROM subroots
  UNION ALL
  SELECT h + 1, list_transform(range(0, (len(hs) + 2) // 3),
    lambda i: sha256(array_to_string(list_slice(hs, 3 * i + 1, 3 * i + 3), '')))
  FROM upper_levels WHERE len(hs) > 1
), steps AS (
  SELECT k, h AS step, array_to_string(list_slice(hs, p // 3 * 3 + 1, p), '') AS before,
    array_to_string(list_slice(hs, p + 2, p // 3 * 3 + 3), '') AS after
  FROM (SELECT k, h, hs, place // CAST(pow(3, h) AS BIGINT) AS p
        FROM placed JOIN levels ON placed.source IS NOT DISTINCT FROM levels.source
        WHERE len(hs) > 1) AS own
  UNION ALL
  SELECT k, 1000 + h, array_to_string(list_slice(hs, p // 3 * 3 + 1, p), ''),
    array_to_string(list_slice(hs, p + 2, p // 3 * 3 + 3), '')
  FROM (SELECT k, h, hs, nth // CAST(pow(3, h) AS BIGINT) AS p
        FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source,
          upper_levels
        WHERE len(hs) > 1) AS own
), paths AS (
  SELECT k, list(before ORDER BY step) AS befores, list(after ORDER BY step) AS afters
  FROM steps GROUP BY k
), folds(k, i, acc) AS (
  SELECT k, 0, CASE WHEN {_CRC32} % 2 = 0 THEN short_leaf ELSE leaf END FROM placed
  UNION ALL
  SELECT k, i + 1, sha256(befores[i + 1] || acc || afters[i + 1])
  FROM folds JOIN paths USING (k) WHERE i < len(befores)
), ends AS (
  SELECT k, max_by(acc, i) AS folded_root FROM folds GROUP BY k
), r AS (SELECT hs[1] AS root FROM upper_levels WHERE len(hs) = 1)
SELECT doc_id, leaf, subroot, root, folded_root,
  sha256(coalesce(array_to_string(list_transform(range(1, len(befores) + 1),
    lambda i: befores[i] || afters[i]), ''), '')) AS proof_sha256,
  folded_root = root AS verified
FROM placed JOIN ends USING (k) LEFT JOIN paths USING (k)
  JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source, r
"""


ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": OP1,
    "op3_chat_format": OP3,
    "op4_warc": OP4,
    "op5_ngram_jaccard": OP5,
    "op7_url_filter": OP7,
    "op9_quality_rules": _op9(),
    "op13_merkle_manifest": OP13,
}
