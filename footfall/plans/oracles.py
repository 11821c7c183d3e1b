"""The registered queries once more as SQL over the given tables.

Written stage by stage, with unnested hits and ranked groups: on purpose not
the way the Spark plans compute the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from footfall.columns import FLAGS, RATIOS
from footfall.operators.correlation import SINGULAR
from footfall.operators.training import L1_STRENGTHS
from footfall.params import FeatureParams
from footfall.plans.queries import (
    HOLDOUT,
    LONG_DOCUMENT,
    SWEPT_STRENGTHS,
    TRAINING,
    WINDOWS,
    linear_logit,
)
from footfall.sources import event_log as log
from footfall.vocabulary import DAYPARTS, DST_RANGES, INDICATORS, STATES, WEEKDAYS


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _path(level: int) -> str:
    cases = " ".join(f"WHEN '{t}' THEN {_text(p[level])}" for t, p in log.PAGES.items())
    return f"CASE event_type {cases} END"


_HIT_TYPES = ", ".join(_text(t) for t in log.PAGES)

_VISITS = f"""
visits AS (
  SELECT user_id, day, min(event_id) AS e, count(*) AS n,
    CAST(floor(epoch(min(t))) AS BIGINT) AS started,
    CAST(floor(epoch(max(t))) AS BIGINT) AS ended,
    nullif(count(*) FILTER (event_type IN ('view', 'click')), 0) AS views,
    nullif(count(*) FILTER (event_type = 'purchase' AND value >= {log.PURCHASE_FLOOR}), 0) AS sales,
    list({{l2: {_path(0)}, l3: {_path(1)}}}) FILTER (event_type IN ({_HIT_TYPES})) AS pages
  FROM (SELECT *, strftime(t, '%Y%m%d') AS day
        FROM (SELECT *, ts - INTERVAL {log.SHIFT_DAYS} DAY AS t FROM events) AS shifted) AS dated
  GROUP BY user_id, day
),
sessions AS (
  SELECT CAST(user_id AS VARCHAR) AS "fullVisitorId", started AS "visitStartTime", day AS date,
    CAST(1 AS BIGINT) AS visits,
    views AS pageviews,
    CASE WHEN n > 1 THEN ended - started END AS "timeOnSite",
    CASE WHEN n = 1 THEN CAST(1 AS BIGINT) END AS bounces,
    sales AS transactions,
    {_list(log.DEVICES)}[e % 3 + 1] AS "deviceCategory",
    {_list(log.BROWSER_NAMES)}[e % 5 + 1] AS browser,
    {_list(log.CHANNEL_NAMES)}[e % 9 + 1] AS "channelGrouping",
    CASE WHEN r_name = 'MIDDLE EAST' THEN r_name ELSE 'United States' END AS country,
    {_list(log.REGIONS)}[n_nationkey + 1] AS region,
    {_list(log.METRO_NAMES)}[n_nationkey + 1] AS metro,
    pages
  FROM visits
  JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_STATES = "states(state_name, timezone, dst) AS (VALUES {})".format(
    ", ".join(f"({_text(n)}, {zone}, {dst})" for n, zone, dst in STATES)
)


def _base(params: FeatureParams, source: str = "sessions", name: str = "base") -> str:
    return f"""
{name} AS (
  SELECT * FROM {source}
  WHERE date BETWEEN '{params.session_start}' AND '{params.session_end}'
    AND country = '{params.country}'
)"""


_LABELED = """
labeled AS (
  SELECT "fullVisitorId",
    CAST(coalesce(bool_or(transactions >= 1), FALSE) AS INT) AS labels,
    min("visitStartTime") AS first_visit,
    min("visitStartTime") FILTER (transactions >= 1) AS first_conversion_session,
    max("visitStartTime") FILTER (transactions >= 1) AS last_conversion_timestamp,
    max("visitStartTime") AS last_visit_timestamp
  FROM base WHERE bounces IS NULL GROUP BY 1
),
anchored AS (
  SELECT *, CASE labels WHEN 1 THEN last_conversion_timestamp
            ELSE last_visit_timestamp END AS last_timestamp
  FROM labeled
)"""


def _users(params: FeatureParams) -> str:
    return f"""
users AS (
  SELECT "fullVisitorId", labels, first_conversion_session, last_visit_timestamp,
    last_conversion_timestamp,
    last_timestamp - {params.lookback_days} * 86400 AS front_lookback_window,
    last_timestamp AS end_lookback_window
  FROM anchored
  WHERE NOT (labels = 1 AND first_visit = first_conversion_session)
)"""


_SUMMARY = """
summary AS (
  SELECT "fullVisitorId",
    CAST(sum("timeOnSite") AS DOUBLE) / nullif(sum(visits), 0) AS "timeOnSite_per_visit",
    CAST(sum("timeOnSite") AS DOUBLE) / nullif(sum(pageviews), 0) AS "timeOnSite_per_page"
  FROM seen GROUP BY 1
)"""

_HITS = """
hit_rows AS (
  SELECT *, page.l2 AS "pagePathLevel2", page.l3 AS "pagePathLevel3"
  FROM (SELECT *, unnest(pages) AS page FROM seen) AS unnested
)"""


def _flag_columns(groups: tuple[str, ...]) -> str:
    return ",\n    ".join(
        f'CAST(coalesce(bool_or("{ind.field.split(".")[-1]}" = {_text(ind.literal)}), FALSE) AS INT)'
        f' AS "{ind.column}"'
        for ind in INDICATORS
        if ind.group in groups
    )


_ALL_GROUPS = ("device", "browser", "channel", "page", "metro")


def _flags(*groups: str) -> str:
    columns = _flag_columns(groups)
    return f'\nflags AS (SELECT "fullVisitorId",\n    {columns}\n  FROM hit_rows GROUP BY 1)'


_SUMMER = " OR ".join(f"date BETWEEN '{lo}' AND '{hi}'" for lo, hi in DST_RANGES)
_PARTS = " ".join(
    f"WHEN h >= {lo} AND h < {hi} THEN '{name}'" for name, (lo, hi) in DAYPARTS.items()
)

_HABITS = f"""
by_day AS (
  SELECT "fullVisitorId", CAST(dayofweek(strptime(date, '%Y%m%d')) + 1 AS INT) AS day,
    CAST(sum(pageviews) AS BIGINT) AS pages_viewed
  FROM seen GROUP BY ALL
),
favourite_day AS (
  SELECT "fullVisitorId", {_list(WEEKDAYS)}[day] AS day FROM by_day
  QUALIFY row_number() OVER (
    PARTITION BY "fullVisitorId" ORDER BY pages_viewed DESC NULLS LAST, by_day.day) = 1
),
{_STATES},
local AS (
  SELECT seen.*, CAST(hour(make_timestamp("visitStartTime" * 1000000) + to_hours(
      timezone + CASE WHEN dst = 1 AND ({_SUMMER}) THEN 1 ELSE 0 END)) AS INT) AS h
  FROM seen LEFT JOIN states ON region = state_name
),
by_part AS (
  SELECT "fullVisitorId", CASE {_PARTS} WHEN h = 0 THEN 'latenight_23_1' END AS daypart,
    CAST(sum(pageviews) AS BIGINT) AS pageviews
  FROM local GROUP BY ALL
),
favourite_part AS (
  SELECT "fullVisitorId", daypart FROM by_part
  QUALIFY row_number() OVER (
    PARTITION BY "fullVisitorId" ORDER BY pageviews DESC NULLS LAST, daypart NULLS LAST) = 1
)"""

_FEATURES = """
features AS (
  SELECT * FROM users
  LEFT JOIN summary USING ("fullVisitorId")
  LEFT JOIN flags USING ("fullVisitorId")
  LEFT JOIN favourite_day USING ("fullVisitorId")
  LEFT JOIN favourite_part USING ("fullVisitorId")
)"""

# The sessions that count for behaviour: all of the window, or those looked back on.
_SEEN = "seen AS (SELECT * FROM base)"
_SEEN_LOOKBACK = """seen AS (
  SELECT base.* FROM base JOIN users USING ("fullVisitorId")
  WHERE "visitStartTime" BETWEEN front_lookback_window AND end_lookback_window
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _feature_ctes(params: FeatureParams, seen: str = _SEEN) -> str:
    return _with(
        _VISITS,
        _base(params),
        _LABELED,
        _users(params),
        seen,
        _SUMMARY,
        _HITS,
        _flags(*_ALL_GROUPS),
        _HABITS,
        _FEATURES,
    )


def _scored() -> str:
    return _feature_ctes(TRAINING) + f""",
scored AS (
  SELECT "fullVisitorId", labels, round(1 / (1 + exp(-({linear_logit()}))), 6) AS probability
  FROM features
)"""


def _input_columns(which: str = "", source: str = "") -> tuple[list[str], list[str]]:
    """Names of the model inputs, and an expression for each.

    NULL becomes the mean: that of ``which`` rows, or of the columns called like them in ``source``.
    """
    numbers = [*RATIOS, *FLAGS]
    filled = []
    for c in numbers:
        mean = f'{source}."{c}"' if source else f'avg("{c}") {which} OVER ()'
        own = f'features."{c}"' if source else f'"{c}"'
        filled.append(f'coalesce(CAST({own} AS DOUBLE), {mean}, 0) AS "{c}"')
    for column, names in (("day", WEEKDAYS), ("daypart", sorted(DAYPARTS))):
        for name in names:
            numbers.append(f"{column}={name}")
            filled.append(f"CAST(coalesce({column} = '{name}', FALSE) AS DOUBLE) AS \"{numbers[-1]}\"")
        numbers.append(f"{column}=__unknown")
        filled.append(f'CAST({column} IS NULL AS DOUBLE) AS "{numbers[-1]}"')
    return numbers, filled


def _correlation_sql() -> str:
    numbers, filled = _input_columns()
    filled = ", ".join(filled)
    places = ", ".join(f"('{c}', {i})" for i, c in enumerate(numbers))
    return _feature_ctes(TRAINING) + f""",
filled AS (SELECT "fullVisitorId", {filled} FROM features),
places(feature, place) AS (VALUES {places}),
long AS (
  SELECT * FROM (UNPIVOT filled ON * EXCLUDE ("fullVisitorId") INTO NAME feature VALUE v)
  JOIN places USING (feature)
),
pairs AS (
  SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.v, b.v) AS r,
    min(a.v) < max(a.v) AND min(b.v) < max(b.v) AS varies
  FROM long AS a JOIN long AS b USING ("fullVisitorId") WHERE a.place < b.place
  GROUP BY 1, 2
)
SELECT feature_a, feature_b, CASE WHEN varies THEN round(r, 6) + 0.0 END AS correlation
FROM pairs"""


_IS_EVAL = """CAST('0x' || substr(md5('0:' || "fullVisitorId"), 1, 8) AS BIGINT) % 10000 < 2000"""


def _fitted_path(strengths: Sequence[float], iterations: int = 2500) -> str:
    """Models of all inputs by accelerated proximal gradient steps, restarted when they overshoot.

    A matrix is a list of lists in one row, once by rows and once by columns; a step is
    one expression. ``ends`` has the weights of scaled inputs, the intercept first.
    """
    names, filled = _input_columns(f"FILTER (NOT {_IS_EVAL})")
    quoted = [f'"{c}"' for c in names]
    listed, width = ", ".join(quoted), len(names) + 1
    means = ", ".join(f"avg({c})" for c in quoted)
    spreads = ", ".join(f"stddev_samp({c})" for c in quoted)
    values = ", ".join(f"(CAST({l1} AS DOUBLE))" for l1 in strengths)
    return _feature_ctes(TRAINING).replace("WITH ", "WITH RECURSIVE ", 1) + f""",
filled AS (
  SELECT "fullVisitorId" AS id, CAST(labels AS DOUBLE) AS y, {_IS_EVAL} AS is_eval, {", ".join(filled)}
  FROM features
),
scale AS (SELECT [{means}] AS m, [{spreads}] AS s FROM filled WHERE NOT is_eval),
scaled AS (
  SELECT id, y, is_eval, list_concat([CAST(1 AS DOUBLE)], list_transform(list_zip([{listed}], m, s),
    lambda z: CASE WHEN z[3] > 1e-9 THEN (z[1] - z[2]) / z[3] ELSE 0 END)) AS x
  FROM filled, scale
),
by_row AS (
  SELECT list(x ORDER BY id) AS xs, list(y ORDER BY id) AS ys, CAST(count(*) AS DOUBLE) AS n,
    avg(y) AS rate
  FROM scaled WHERE NOT is_eval
),
matrix AS (
  SELECT xs, ys, n, rate, list_transform(range(1, {width} + 1),
      lambda j: list_transform(xs, lambda x: x[j])) AS cs,
    list_sum(list_transform(xs, lambda x: list_dot_product(x, x))) / 4 AS curve
  FROM by_row
),
strengths(l1) AS (VALUES {values}),
steps(l1, i, w, v, t) AS (
  SELECT l1, 0, start, start, CAST(1 AS DOUBLE)
  FROM strengths, (SELECT list_concat([ln(rate / (1 - rate))],
    list_transform(range({width} - 1), lambda j: CAST(0 AS DOUBLE))) AS start FROM matrix) AS s
  UNION ALL
  SELECT l1, i + 1, now, list_transform(list_zip(now, w),
      lambda z: z[1] + (t - 1) / ((1 + sqrt(1 + 4 * t * t)) / 2) * (z[1] - z[2])),
    (1 + sqrt(1 + 4 * t * t)) / 2
  FROM (
    SELECT l1, i, w, now, CASE WHEN list_sum(list_transform(list_zip(v, now, w),
      lambda z: (z[1] - z[2]) * (z[2] - z[3]))) > 0 THEN 1 ELSE t END AS t
    FROM (
      SELECT l1, i, w, v, t, list_transform(moved, lambda u, j: CASE WHEN j = 1 THEN u
        ELSE sign(u) * greatest(abs(u) - l1 / curve, 0) END) AS now
      FROM (
        SELECT l1, i, w, v, t, curve, list_transform(list_zip(v, cs),
          lambda z: z[1] - list_dot_product(z[2], away) / curve) AS moved
        FROM (
          SELECT steps.*, cs, curve, list_transform(list_zip(xs, ys),
            lambda z: 1 / (1 + exp(-list_dot_product(z[1], v))) - z[2]) AS away
          FROM steps, matrix WHERE i < {iterations}
        ) AS residuals
      ) AS gradients
    ) AS shrunk
  ) AS restarted
),
ends AS (SELECT l1, w FROM steps WHERE i = {iterations}),
chances AS (
  SELECT l1, id, y, is_eval, list_dot_product(x, w) AS margin,
    1 / (1 + exp(-list_dot_product(x, w))) AS p
  FROM scaled, ends
),
losses AS (
  SELECT l1, avg(-ln(CASE y WHEN 1 THEN p ELSE 1 - p END)) FILTER (NOT is_eval) AS loss,
    avg(-ln(CASE y WHEN 1 THEN p ELSE 1 - p END)) FILTER (is_eval) AS eval_loss
  FROM chances GROUP BY l1
),
base_losses AS (
  SELECT avg(-ln(CASE y WHEN 1 THEN rate ELSE 1 - rate END)) FILTER (NOT is_eval) AS loss,
    avg(-ln(CASE y WHEN 1 THEN rate ELSE 1 - rate END)) FILTER (is_eval) AS eval_loss
  FROM scaled, matrix
),
objectives AS (
  SELECT l1, w, n, loss, eval_loss,
    loss + l1 * list_sum(list_transform(w[2:], lambda x: abs(x))) / n AS objective
  FROM ends JOIN losses USING (l1), matrix
)"""


def _named_inputs() -> str:
    """``names``: the model inputs by place, the intercept at 1."""
    rows = ["(1, '__INTERCEPT__', NULL)"]
    for i, name in enumerate(_input_columns()[0]):
        column, _, category = name.partition("=")
        rows.append(f"({i + 2}, {_text(column)}, {_text(category or None)})")
    return f"names(place, processed_input, category) AS (VALUES {', '.join(rows)})"


def _holdout_scored() -> str:
    """``scored``: visitors of the later days by the model; the later features come as a derived table."""
    names, filled = _input_columns(source="means")
    listed = ", ".join(f'"{c}"' for c in names)
    averages = ", ".join(f'avg("{c}") FILTER (NOT {_IS_EVAL}) AS "{c}"' for c in [*RATIOS, *FLAGS])
    return f""",
means AS (SELECT {averages} FROM features),
later AS ({_feature_ctes(HOLDOUT)} SELECT * FROM features),
later_filled AS (SELECT features."fullVisitorId", {", ".join(filled)} FROM later AS features, means),
scored AS (
  SELECT "fullVisitorId", round(1 / (1 + exp(-list_dot_product(w, list_concat([CAST(1 AS DOUBLE)],
    list_transform(list_zip([{listed}], m, s),
      lambda z: CASE WHEN z[3] > 1e-9 THEN (z[1] - z[2]) / z[3] ELSE 0 END))))), 4) AS probability
  FROM later_filled, scale, ends
)"""


def _collinearity_sql() -> str:
    """Regressions by sweeping the correlation matrix: for every input, all pivots but itself."""
    return _fitted_path([1], iterations=0) + "," + _named_inputs() + f""",
varying AS (SELECT list_filter(range(2, len(cs) + 1), lambda j: s[j - 1] > 1e-9) AS js FROM matrix, scale),
correlations AS (
  SELECT js, list_transform(js, lambda a: list_transform(js,
    lambda b: list_dot_product(cs[a], cs[b]) / (n - 1))) AS r
  FROM matrix, varying
),
swept(target, k, r) AS (
  SELECT target, 1, r FROM (SELECT r, unnest(range(1, len(js) + 1)) AS target FROM correlations) AS t
  UNION ALL
  SELECT target, k + 1, CASE WHEN k = target OR r[k][k] < {SINGULAR} THEN r
    ELSE list_transform(r, lambda x, i: CASE WHEN i = k THEN x
      ELSE list_transform(x, lambda y, j: y - x[k] * r[k][j] / r[k][k]) END) END
  FROM swept WHERE k <= len(r)
),
rest AS (
  SELECT js[target] AS place, swept.r[target][target] AS left_over
  FROM swept, correlations WHERE k = len(swept.r) + 1
)
SELECT processed_input, category,
  CASE WHEN left_over < {SINGULAR} THEN 0 ELSE round(left_over, 6) END AS tolerance,
  coalesce(left_over < {SINGULAR}, FALSE) AS singular
FROM names LEFT JOIN rest USING (place) WHERE place > 1"""


def _path_sql() -> dict[str, str]:
    model, positive = [1], [l1 for l1 in L1_STRENGTHS if l1]
    n_inputs = len(_input_columns()[0])
    return {
        "train_logistic": _fitted_path(model) + f"""
SELECT l1, 'logistic_reg' AS model_type, CAST(n AS BIGINT) AS n_rows, {n_inputs} AS n_inputs,
  round(objective, 6) AS objective, TRUE AS optimal, TRUE AS converged
FROM objectives""",
        "training_info": _fitted_path(model) + """
SELECT l1, round(base_losses.loss, 6) AS first_loss, round(objectives.loss, 6) AS final_loss,
  round(base_losses.eval_loss, 6) AS first_eval_loss,
  round(objectives.eval_loss, 6) AS final_eval_loss, TRUE AS falls, TRUE AS converged
FROM objectives, base_losses""",
        "model_weights": _fitted_path(model) + "," + _named_inputs() + """
SELECT processed_input, category, round(CASE place WHEN 1 THEN w[1] - list_sum(list_transform(
    list_zip(w[2:], m, s), lambda z: CASE WHEN z[3] > 1e-9 THEN z[1] * z[2] / z[3] ELSE 0 END))
  ELSE w[place] END, 4) + 0.0 AS weight
FROM names, ends, scale""",
        "optimality": _fitted_path(positive) + "," + _named_inputs() + """,
away AS (SELECT l1, list(p - y ORDER BY id) AS r FROM chances WHERE NOT is_eval GROUP BY l1)
SELECT l1, processed_input, category, round(list_dot_product(cs[place], r), 4) + 0.0 AS gradient,
  TRUE AS optimal
FROM away, names, matrix""",
        "predict": _fitted_path(model) + _holdout_scored() + """
SELECT "fullVisitorId", CAST(probability >= 0.5 AS INT) AS predicted_labels, probability
FROM scored""",
        "predicted_deciles": _fitted_path(model) + _holdout_scored() + """
SELECT "fullVisitorId", probability, CAST(ntile(10) OVER (
  ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS INT) AS decile
FROM scored""",
        "l1_sweep": _fitted_path(positive) + """,
ranked AS (
  SELECT *, rank() OVER (PARTITION BY l1 ORDER BY margin)
    + (count(*) OVER (PARTITION BY l1, margin) - 1) / 2 AS mid_rank
  FROM chances WHERE is_eval
),
held AS (
  SELECT l1, round(avg(CAST((p >= 0.5) = (y = 1) AS INT)), 4) AS accuracy,
    round((sum(mid_rank) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2)
      / nullif(sum(y) * (count(*) - sum(y)), 0), 4) AS roc_auc
  FROM ranked GROUP BY l1
)
SELECT l1, TRUE AS converged, TRUE AS optimal, round(objective, 4) AS objective, accuracy,
  round(eval_loss, 4) AS log_loss, roc_auc
FROM objectives LEFT JOIN held USING (l1)
UNION ALL SELECT 0, TRUE, TRUE, NULL, NULL, NULL, NULL""",
    }


_LABELED_DOCUMENTS = f"""
document_rows AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, quality AS y, ln(1 + n_chars) AS x,
    CAST(n_chars >= {LONG_DOCUMENT} AS INT) AS is_long,
    CAST(coalesce(lang = 'en', FALSE) AS INT) AS is_english,
    CAST('0x' || substr(md5('0:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 2000
      AS is_eval
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL
),
tr AS (SELECT * FROM document_rows WHERE NOT is_eval),
held AS (SELECT * FROM document_rows WHERE is_eval),
facts AS (
  SELECT count(*) AS n, avg(y) AS rate, stddev_samp(x) AS deviation,
    sum(x * (y - rate0)) AS pull
  FROM tr, (SELECT avg(y) AS rate0 FROM tr) AS base
)"""


def _newton(l1: float) -> str:
    """A one-input logistic model by Newton's method, its weight's sign held.

    A penalty as strong as the pull of the data at weight 0 leaves the base rate.
    """
    return f"""
start AS (
  SELECT ln(rate / (1 - rate)) AS b0, abs(pull) > {l1} * deviation AS active,
    CASE WHEN abs(pull) > {l1} * deviation THEN {l1} * deviation * sign(pull) ELSE 0 END AS slope
  FROM facts
),
steps(i, b, w) AS (
  SELECT 0, b0, CAST(0 AS DOUBLE) FROM start
  UNION ALL
  SELECT i + 1, b - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12),
    w - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (
    SELECT i, b, w, sum(p - y) AS g1, sum((p - y) * x) + max(slope) AS g2,
      sum(p * (1 - p)) AS h11, sum(p * (1 - p) * x) AS h12, sum(p * (1 - p) * x * x) AS h22
    FROM (SELECT i, b, w, x, y, slope, 1 / (1 + exp(-(b + w * x))) AS p
          FROM steps, tr, start WHERE i < 25) AS chances
    GROUP BY i, b, w
  ) AS sums
),
model AS (
  SELECT CASE WHEN active THEN b ELSE b0 END AS b, CASE WHEN active THEN w ELSE 0 END AS w
  FROM steps, start WHERE i = 25
)"""


def _fitted(l1: float = 1) -> str:
    return "WITH RECURSIVE " + _LABELED_DOCUMENTS + "," + _newton(l1)


_HELD_OUT = """,
scored AS (SELECT id, y, 1 / (1 + exp(-(b + w * x))) AS p FROM held, model)"""


def _swept(l1: float) -> str:
    return f"""
SELECT * FROM ({_fitted(l1)}{_HELD_OUT},
ranked AS (
  SELECT *, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS mid_rank
  FROM scored
)
SELECT '{l1:g}' AS "L1", TRUE AS converged, round(max(w), 4) + 0.0 AS weight,
  round(avg(CAST((p >= 0.5) = (y = 1) AS INT)), 4) AS accuracy,
  round(avg(-ln(CASE y WHEN 1 THEN p ELSE 1 - p END)), 4) AS log_loss,
  round((sum(mid_rank) FILTER (y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2)
    / nullif(CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)), 0), 4) AS roc_auc
FROM ranked, model) AS strength"""


def _fitted_sql() -> dict[str, str]:
    return {
        "train_logistic_one_input": _fitted() + """
SELECT 'logistic_reg' AS model_type, CAST(1 AS DOUBLE) AS l1, round(w, 4) AS weight,
  round(b, 4) AS intercept, TRUE AS converged
FROM model""",
        "training_info_one_input": _fitted() + """
SELECT round(max(-rate * ln(rate) - (1 - rate) * ln(1 - rate)), 6) AS first_loss,
  round(avg(-ln(CASE y WHEN 1 THEN p ELSE 1 - p END)) + max(abs(w) * deviation / n), 6)
    AS final_loss,
  TRUE AS converged
FROM (SELECT *, 1 / (1 + exp(-(b + w * x))) AS p FROM tr, model, facts) AS at_the_end""",
        "model_weights_one_input": _fitted() + """
SELECT 'log_length' AS processed_input, CAST(NULL AS VARCHAR) AS category,
  round(w * deviation, 4) AS weight FROM model, facts
UNION ALL SELECT '__INTERCEPT__', NULL, round(b, 4) FROM model""",
        "predict_one_input": _fitted() + _HELD_OUT + """
SELECT id AS "fullVisitorId", CAST(p >= 0.5 AS INT) AS predicted_labels, round(p, 4) AS probability
FROM scored""",
        "predicted_deciles_one_input": _fitted() + _HELD_OUT + """
SELECT id AS "fullVisitorId", round(p, 4) AS probability,
  CAST(ntile(10) OVER (ORDER BY round(p, 4) DESC, md5(id), id) AS INT) AS decile
FROM scored""",
        "l1_sweep_one_input": "\nUNION ALL".join(_swept(l1) for l1 in SWEPT_STRENGTHS),
        "train_tree_models": "WITH " + _LABELED_DOCUMENTS + """,
sides AS (SELECT is_long, avg(y) AS r FROM tr GROUP BY 1),
-- A tree gives up a split if both sides predict the same label.
leaves AS (
  SELECT is_long, r, CASE WHEN (min(r) OVER () > 0.5) = (max(r) OVER () > 0.5)
    THEN (SELECT avg(y) FROM tr) ELSE r END AS kept
  FROM sides
)
SELECT 'boosted_tree_classifier' AS model_type, is_long,
  round(1 / (1 + exp(-2 * (2 * r - 1))), 6) AS probability FROM leaves
UNION ALL SELECT 'random_forest_classifier', is_long, round(kept, 6) FROM leaves""",
        "train_deep_models": "WITH " + _LABELED_DOCUMENTS + """
SELECT model_type, is_long, is_english, count(*) AS n, CAST(sum(y) AS BIGINT) AS expected_positives
FROM tr, (VALUES ('wide_and_deep_classifier'), ('deep_classifier')) AS families(model_type)
GROUP BY ALL""",
        "strong_penalty": _feature_ctes(TRAINING) + f""",
base_rate AS (
  SELECT round(avg(labels), 4) AS probability FROM features
  WHERE CAST('0x' || substr(md5('0:' || "fullVisitorId"), 1, 8) AS BIGINT) % 10000 >= 2000
)
SELECT "fullVisitorId", probability
FROM ({_feature_ctes(HOLDOUT)} SELECT "fullVisitorId" FROM features) AS held_out, base_rate""",
    }


def oracle_sql() -> dict[str, str]:
    base = _with(_VISITS, _base(TRAINING))
    labeled = _with(_VISITS, _base(TRAINING), _LABELED)
    users = _with(_VISITS, _base(TRAINING), _LABELED, _users(TRAINING))
    seen = _with(_VISITS, _base(TRAINING), _SEEN)
    habits = seen + "," + _HABITS
    scored = _scored()
    lookback = FeatureParams(TRAINING.session_start, TRAINING.session_end, lookback_days=7)
    features = _feature_ctes(TRAINING) + "\nSELECT * FROM features"

    def flags(group: str) -> str:
        return seen + "," + _HITS + "," + _flags(group) + "\nSELECT * FROM flags"

    return _fitted_sql() | _path_sql() | {
        "sessions_scan": base + """
SELECT "fullVisitorId", date AS table_suffix, "visitStartTime", "channelGrouping",
  visits, pageviews, "timeOnSite", bounces, transactions, "deviceCategory", browser, region, metro
FROM base""",
        "state_lookup": base + "," + _STATES + """
SELECT state_name, timezone, dst, count(date) AS sessions
FROM states LEFT JOIN base ON state_name = region GROUP BY ALL""",
        "users_labeled": labeled + "\nSELECT * FROM labeled",
        "anchor_timestamp": labeled
        + '\nSELECT "fullVisitorId", labels, last_timestamp FROM anchored',
        "lookback_window": labeled + f"""
SELECT "fullVisitorId", last_timestamp - {TRAINING.lookback_days} * 86400 AS front_lookback_window,
  last_timestamp AS end_lookback_window
FROM anchored""",
        "filtered_users": users + "\nSELECT * FROM users",
        "summary_metrics": seen + "," + _SUMMARY + "\nSELECT * FROM summary",
        "hits_unnest": seen + "," + _HITS + """
SELECT "pagePathLevel2", "pagePathLevel3", count(*) AS hits,
  count(DISTINCT ("fullVisitorId", date)) AS sessions
FROM hit_rows GROUP BY 1, 2""",
        "device_flags": flags("device"),
        "browser_flags": flags("browser"),
        "channel_flags": flags("channel"),
        "page_flags": flags("page"),
        "metro_flags": flags("metro"),
        "pageviews_by_day": habits + "\nSELECT * FROM by_day",
        "visitor_day": habits + "\nSELECT * FROM favourite_day",
        "daypart_local_hour": habits + """
SELECT "fullVisitorId", date, "visitStartTime", region, h AS hour_of_day_localized FROM local""",
        "pageviews_by_daypart": habits + "\nSELECT * FROM by_part",
        "visitor_daypart": habits + "\nSELECT * FROM favourite_part",
        "feature_table": features,
        "feature_table_staged": features,
        "feature_table_write": features,
        "feature_table_from_days": features,
        "features_of_windows": " UNION ALL ".join(
            f"SELECT '{label}' AS window_name, * FROM ({_feature_ctes(window)} SELECT * FROM features)"
            for label, window in WINDOWS.items()
        ),
        "feature_table_lookback": _feature_ctes(lookback, _SEEN_LOOKBACK)
        + "\nSELECT * FROM features",
        "holdout_features": _feature_ctes(HOLDOUT) + "\nSELECT * FROM features",
        "training_projection": _feature_ctes(TRAINING) + """
SELECT * EXCLUDE ("fullVisitorId", first_conversion_session, last_visit_timestamp,
  last_conversion_timestamp, front_lookback_window, end_lookback_window)
FROM features""",
        "train_eval_split": _feature_ctes(TRAINING) + """
SELECT "fullVisitorId", labels,
  CAST(CAST('0x' || substr(md5('0:' || "fullVisitorId"), 1, 8) AS BIGINT) % 10000 < 2000 AS INT)
    AS is_eval
FROM features""",
        "feature_correlation": _correlation_sql(),
        "linear_score": scored + """
SELECT "fullVisitorId", CAST(probability >= 0.5 AS INT) AS predicted_labels, probability
FROM scored""",
        "positive_class_probability": scored
        + '\nSELECT "fullVisitorId", probability FROM scored',
        "score_deciles": scored + """
SELECT "fullVisitorId", probability, CAST(ntile(10) OVER (
  ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS INT) AS decile
FROM scored""",
        "segment_summary": scored + """,
banded AS (
  SELECT *, CAST(ntile(10) OVER (
    ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS INT) AS decile
  FROM scored
)
SELECT decile, count(*) AS visitors, min(probability) AS min_probability,
  round(avg(probability), 6) AS avg_probability, max(probability) AS max_probability,
  CAST(sum(labels) AS BIGINT) AS buyers, round(avg(labels), 6) AS conversion_rate,
  round(avg(labels) / nullif((SELECT avg(labels) FROM scored), 0), 6) AS lift
FROM banded GROUP BY decile""",
        "collinearity": _collinearity_sql(),
        "daily_tables_scan": base + """
SELECT date AS table_suffix, count(*) AS sessions, CAST(sum(pageviews) AS BIGINT) AS pageviews,
  CAST(22 - (SELECT count(DISTINCT day) FROM visits
    WHERE day BETWEEN '20170301' AND '20170322') AS BIGINT) AS missing_days
FROM base GROUP BY 1""",
        "roc_at_quantiles": scored + """,
counted AS (
  SELECT probability AS p, sum(labels) AS own,
    sum(sum(labels)) OVER w AS tp, sum(count(*) - sum(labels)) OVER w AS fp,
    sum(sum(labels)) OVER () AS positives, sum(count(*) - sum(labels)) OVER () AS negatives
  FROM scored GROUP BY 1 WINDOW w AS (ORDER BY probability DESC)
)
SELECT p AS threshold, tp / positives AS recall, fp / nullif(negatives, 0) AS false_positive_rate,
  CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST(negatives - fp AS BIGINT) AS true_negatives, CAST(positives - tp AS BIGINT) AS false_negatives
FROM counted WHERE own > 0 AND floor(tp * 100 / positives) > floor((tp - own) * 100 / positives)""",
        "rated_by_borders": scored + f""",
banded AS (
  SELECT *, CAST(ntile(10) OVER (
    ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS INT) AS decile
  FROM scored
),
borders AS (
  SELECT decile, arg_max(probability, o) AS p, max(o) AS o FROM (
    SELECT *, row_number() OVER (ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS o
    FROM banded) AS ordered
  WHERE decile < 10 GROUP BY decile
),
border_ids AS (
  SELECT b.decile, b.p, md5("fullVisitorId") AS digest FROM borders AS b JOIN (
    SELECT *, row_number() OVER (ORDER BY probability DESC, md5("fullVisitorId"), "fullVisitorId") AS o
    FROM banded) AS ordered USING (o)
),
later AS ({_feature_ctes(HOLDOUT)} SELECT * FROM features),
later_scored AS (
  SELECT "fullVisitorId", round(1 / (1 + exp(-({linear_logit()}))), 6) AS probability FROM later
)
SELECT "fullVisitorId", probability, CAST(1 + count(*) FILTER (probability < p
  OR (probability = p AND md5("fullVisitorId") > digest)) AS INT) AS decile
FROM later_scored LEFT JOIN border_ids ON TRUE GROUP BY 1, 2""",
        "confusion_matrix": scored + """
SELECT labels AS expected_label, count(*) FILTER (probability < 0.5) AS predicted_0,
  count(*) FILTER (probability >= 0.5) AS predicted_1
FROM scored GROUP BY 1""",
        "roc_curve": scored + """,
grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(101) AS steps(i)),
counted AS (
  SELECT threshold,
    count(*) FILTER (labels = 1 AND probability >= threshold) AS tp,
    count(*) FILTER (labels = 0 AND probability >= threshold) AS fp,
    count(*) FILTER (labels = 0 AND probability < threshold) AS tn,
    count(*) FILTER (labels = 1 AND probability < threshold) AS fn
  FROM grid, scored GROUP BY 1
)
SELECT threshold, tp / nullif(tp + fn, 0) AS recall, fp / nullif(fp + tn, 0) AS false_positive_rate,
  tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives
FROM counted""",
        "evaluate": scored + """,
ranked AS (
  SELECT *, rank() OVER (ORDER BY probability)
    + (count(*) OVER (PARTITION BY probability) - 1) / 2 AS mid_rank
  FROM scored
),
counted AS (
  SELECT count(*) AS n, sum(labels) AS pos, count(*) - sum(labels) AS neg,
    count(*) FILTER (labels = 1 AND probability >= 0.5) AS tp,
    count(*) FILTER (probability >= 0.5) AS called,
    count(*) FILTER (labels = (CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END)) AS agreed,
    sum(mid_rank) FILTER (labels = 1) AS rank_sum,
    avg(-ln(CASE labels WHEN 1 THEN probability ELSE 1 - probability END)) AS loss
  FROM ranked
)
SELECT round(tp / nullif(called, 0), 6) AS precision, round(tp / nullif(pos, 0), 6) AS recall,
  round(agreed / n, 6) AS accuracy, round(2 * tp / nullif(called + pos, 0), 6) AS f1_score,
  round(loss, 6) AS log_loss,
  round((rank_sum - CAST(pos AS DOUBLE) * (pos + 1) / 2) / (CAST(pos AS DOUBLE) * neg), 6) AS roc_auc
FROM counted""",
    }
