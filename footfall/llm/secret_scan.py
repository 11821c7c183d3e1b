"""Secret scan: patterns find the plain cases, a character network judges the rest.

Every text is read whole, once: the three base patterns give spans that always stay, and every run
of key characters (``CANDIDATE``) becomes a candidate with its surroundings. Candidates that a base span
touches are known findings; the network decides on all others.

The network (``char_network``) learns from labelled findings: all candidates of the corpus, known ones as
secrets and the others as none, and findings made by rule (random keys of many
alphabets and lengths, identifiers, paths, versions, dates), which teach it shapes the corpus's own findings lack.
A first network, taught by rule alone, strikes out candidates that are
labelled as none but are very likely secrets. Numbers without a letter teach nothing, as a long one matches a base pattern whatever it is.
A quarter of the findings is held back: Platt scaling on it turns scores to probabilities, and each
shape of candidate gets the highest threshold that still finds ``recall`` of the held-back secrets of
that shape. A candidate longer than a window is read in overlapping pieces and has the score of the best.

The fit reads every different finding of the corpus. They are dealt by a hash into lessons of about ``lesson``
findings. In an epoch each lesson is learned from the same weights, with the made findings beside it,
and weights and moments are averaged by the findings of each; sums meet in a smaller stage before they reach
the driver. Calibration counts all held-back findings by score, in steps of ``STEP``; there those of
the corpus weigh together as much as the made ones, however many they are.

Defined results: NULL and empty texts have no spans. Repeated rows come back once each, with the same
spans; equal findings teach once. A corpus without findings is judged by the made ones. Very long
texts and candidates are read whole. The input's columns come back inside a struct, so no
name can clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from footfall.llm.char_network import (
    CharNetwork,
    Moments,
    NetworkParams,
    WindowParams,
    encode,
    pieces,
)
from footfall.sources.workspace import materialize

# Kinds in the order in which spans of one start are listed.
ASSIGN, ACCESS, HEX, LEARNED = "assign", "access", "hex", "learned"
KINDS = (ASSIGN, ACCESS, HEX, LEARNED)

# The base patterns, and how long a match (or its group) has to be.
BASE = (
    (ASSIGN, re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    ), 2, 12),
    (ACCESS, re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    (HEX, re.compile(r"[0-9a-f]{16,}"), 0, 16),
)

_KEY = r"[A-Za-z0-9+/_.=-]"
# A whole run of key characters: 12 and more with a digit, or 16 and more.
CANDIDATE = re.compile(rf"(?<!{_KEY})(?:(?={_KEY}*[0-9]){_KEY}{{12,}}|{_KEY}{{16,}})")
SHAPES = ("hex", "mixed", "other")


@dataclass(frozen=True)
class SecretParams:
    window: WindowParams = WindowParams()
    network: NetworkParams = NetworkParams()
    #: Findings of the corpus that are learned in a row, about.
    lesson: int = 4096
    made_findings: int = 3000
    held_back: float = 0.25
    recall: float = 0.97
    #: Candidates without a base span don't teach if a network taught by rule alone gives them this.
    doubtful: float = 0.9
    #: Held-back secrets a shape needs for a threshold of its own.
    min_secrets: int = 30
    seed: int = 11


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points) of all base matches, by start, then kind."""
    found = [
        (kind, m.start(), m.end())
        for kind, pattern, group, least in BASE
        for m in pattern.finditer(text)
        if m.end(group) - m.start(group) >= least
    ]
    return sorted(found, key=_place)


def _place(span: tuple) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def candidates(text: str, base: list[tuple[str, int, int]], window: WindowParams) -> list[tuple]:
    """Start, end, text before, itself, text after, and whether a base span touches it."""
    found, spans, i, reach = [], sorted((s, e) for _, s, e in base), 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while i < len(spans) and spans[i][0] < end:
            reach = max(reach, spans[i][1])
            i += 1
        before, after = text[max(0, start - window.before) : start], text[end : end + window.after]
        found.append((start, end, before, m.group(), after, reach > start))
    return found


def shape(value: str) -> str:
    """``hex``, ``mixed`` (a digit and letters of both cases) or ``other``."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return "hex"
    classes = (r"[0-9]", r"[a-z]", r"[A-Z]")
    return "mixed" if all(re.search(c, value) for c in classes) else "other"


SPAN = "struct<kind: string, start: int, end: int>"
FOUND = (
    f"base array<{SPAN}>, candidates array<struct<start: int, end: int, before: string, "
    "value: string, after: string, known: boolean>>"
)


def _arrow(schema: str, spark) -> pa.Schema:
    """The Arrow types of a schema's columns."""
    fields = spark.createDataFrame([], schema).schema.fields
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in fields])


def _structs(rows: list[list[tuple]], kind: pa.DataType) -> pa.Array:
    names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
    return pa.array([[dict(zip(names, r, strict=True)) for r in row] for row in rows], kind)


def find(docs: DataFrame, text: str, keep: Sequence[str], params: SecretParams) -> DataFrame:
    """``row`` (the columns to ``keep``), ``base`` spans and ``candidates`` of every row."""
    own = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(own.alias("row"), F.col(f"`{text}`").alias("text"))
    types, window = _arrow(FOUND, docs.sparkSession), params.window

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for value in batch.column(1).to_pylist():
                base.append(base_spans(value or ""))
                more.append(candidates(value or "", base[-1], window))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _structs(base, types.field(0).type), _structs(more, types.field(1).type)],
                ["row", "base", "candidates"],
            )

    return rows.mapInArrow(read, f"row {rows.schema['row'].dataType.simpleString()}, {FOUND}")


def _words(rng: random.Random, n: int) -> list[str]:
    """Word-like strings: syllables of a consonant and a vowel, some with an end."""
    return [
        "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
        + rng.choice(["", "", "n", "r", "s"])
        for _ in range(n)
    ]


def _made_secret(rng: random.Random) -> tuple[str, str, str]:
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphabet = rng.choice(
        ["0123456789abcdef", "0123456789ABCDEF", upper + "234567", lower + digits, upper + digits]
        + 3 * [lower + upper + digits]
        + 2 * [lower + upper + digits + "+/", lower + upper + digits + "-_"]
    )
    value = "".join(rng.choice(alphabet) for _ in range(rng.randint(20, 64)))
    if rng.random() < 0.3:
        prefix = "".join(rng.choice(lower) for _ in range(rng.randint(2, 4)))
        value = prefix + rng.choice(["_", "-", "_live_", "_test_"]) + value
    if rng.random() < 0.1:
        value += "=" * rng.randint(1, 2)
    lead = rng.choice(["key: ", "auth ", "Bearer ", "credential=", 'private_key = "', "pwd:", "", "", "", ""])
    return " ".join(_words(rng, 3)) + " " + lead, value, rng.choice(["", " ", '"', ".", ", "]) + _words(rng, 1)[0]


def _made_other(rng: random.Random) -> tuple[str, str, str]:
    words = _words(rng, rng.randint(3, 6))
    number = str(rng.randint(0, 10 ** rng.randint(1, 6)))
    value = rng.choice(
        [
            "".join(w.capitalize() for w in words) + rng.choice(["", number]),
            words[0] + "".join(w.capitalize() for w in words[1:]),
            "_".join([*words, number]),
            "-".join(words) + rng.choice(["", "-" + number]),
            "/" + "/".join(words) + rng.choice([".html", ".py", ".txt", "/", "/" + number]),
            ".".join(words),
            "".join(words),
            "".join(words).upper(),
            f"{rng.randint(1990, 2040)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}",
            ".".join(str(rng.randint(0, 999)) for _ in range(rng.randint(4, 6))) + rng.choice(["", "-beta.1"]),
            rng.choice("-=_.+xX0aA*/") * rng.randint(16, 70),
            "+" + "-".join(str(rng.randint(100, 9999)) for _ in range(4)),
        ]
    )
    lead = rng.choice(["", "", "", "see ", "file ", "www.", "version ", "name: ", 'id = "'])
    value = value if CANDIDATE.fullmatch(value) else value + "".join(_words(rng, 8))
    return " ".join(_words(rng, 3)) + " " + lead, value, rng.choice(["", " ", '"', ".", ", "]) + _words(rng, 1)[0]


def made_findings(n: int, seed: int) -> list[tuple[str, str, str, int]]:
    """``n`` findings by rule, half of them secrets: text before, candidate, text after, label."""
    rng = random.Random(seed)
    return [(*(_made_secret(rng) if i % 2 else _made_other(rng)), i % 2) for i in range(n)]


FINDING = "before string, value string, after string, label int"


def corpus_findings(found: DataFrame, params: SecretParams) -> DataFrame:
    """All of the corpus's own findings, distinct, labelled by the base patterns."""
    return (
        found.select(F.explode("candidates").alias("c"))
        .where("NOT c.value RLIKE '^[^A-Za-z]*$'")
        .select(
            "c.before",
            # As much of a long one as a window shows; scoring reads all of it.
            F.left("c.value", F.lit(params.window.body)).alias("value"),
            "c.after",
            F.col("c.known").cast("int").alias("label"),
        )
        .distinct()
    )


def _likely(findings: DataFrame, first: SecretModel, params: SecretParams) -> DataFrame:
    """Findings without those that are labelled as no secret but very likely are one.

    The patterns know few forms, so the corpus's other candidates hold secrets too.
    """

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = first.probabilities(_texts(batch))
            labels = batch.column(3).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array((labels == 1) | (chances < params.doubtful)))

    return findings.mapInArrow(strike, FINDING)


def _texts(batch: pa.RecordBatch) -> list[tuple[str, str, str]]:
    """The first three columns of every row."""
    return list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))


@dataclass
class SecretModel:
    """The fitted network, its calibration, and a threshold per shape."""

    network: CharNetwork
    slope: float
    intercept: float
    thresholds: dict[str, float]
    losses: list[float] = field(default_factory=list)

    def scores(self, findings: list[tuple[str, str, str]]) -> np.ndarray:
        """What the network says; a finding read in pieces has the score of its best piece."""
        window, owners, windows = self.network.window, [], []
        for i, (before, value, after) in enumerate(findings):
            for piece in pieces(value, window):
                owners.append(i)
                windows.append((before, piece, after))
        best = np.full(len(findings), -np.inf)
        np.maximum.at(best, owners, self.network.logits(encode(windows, window)))
        return best

    def chances(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.intercept, -50, 50)))

    def probabilities(self, findings: list[tuple[str, str, str]]) -> np.ndarray:
        """Of being a secret."""
        return self.chances(self.scores(findings))

    def flagged(self, findings: list[tuple[str, str, str]]) -> np.ndarray:
        limits = np.array([self.thresholds[shape(v)] for _, v, _ in findings])
        return self.probabilities(findings) >= limits if findings else np.zeros(0, bool)


def _platt(
    logits: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, steps: int = 50
) -> tuple[float, float]:
    """Slope and intercept of a logistic model of the score, by Newton's method.

    Targets are pulled in as Platt does, so that parted labels leave both finite.
    """
    weights = np.ones(len(logits)) if weights is None else weights
    positives, total = (weights * labels).sum(), weights.sum()
    target = np.where(labels == 1, (positives + 1) / (positives + 2), 1 / (total - positives + 2))
    x = np.stack([logits, np.ones_like(logits)], axis=1).astype(float)
    at = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weights * (p - target)))
        at = at - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


# Scores are counted in steps of this size, and as no more than so many steps.
STEP, MOST_STEPS = 1 / 64, 6400


def _calibrate(model: SecretModel, counted: list[tuple], params: SecretParams) -> None:
    """Platt scaling and thresholds from ``own``, ``label``, shape, step and number of held-back findings."""
    own, labels, shapes, steps, n = (np.array(c) for c in zip(*counted, strict=True))
    n_own, n_made = n[own == 1].sum(), n[own == 0].sum()
    weights = np.where(own == 1, n_made / n_own if n_own and n_made else 1.0, 1.0) * n
    # At the lower edge of a step no finding in it is lost.
    scores, secret = steps * STEP, labels == 1
    model.slope, model.intercept = _platt(scores, labels.astype(float), weights)
    chances = model.chances(scores)

    def highest(mask: np.ndarray) -> float:
        """The highest threshold with the wanted recall of the secrets in ``mask``."""
        order = np.argsort(chances[mask])
        passed = np.cumsum(weights[mask][order])
        # The first that is not among those that may be missed.
        return float(chances[mask][order][np.searchsorted(passed, (1 - params.recall) * passed[-1], side="right")])

    overall = highest(secret) if secret.any() else 1.0
    for name in SHAPES:
        mine = secret & (shapes == name)
        model.thresholds[name] = highest(mine) if n[mine].sum() >= params.min_secrets else overall


def _steps(scores: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(scores / STEP), -MOST_STEPS, MOST_STEPS).astype(int)


def _counted(model: SecretModel, findings: list[tuple[str, str, str, int]]) -> list[tuple]:
    """Made findings as ``_calibrate`` takes them, one by one."""
    steps = _steps(model.scores([f[:3] for f in findings]))
    return [(0, f[3], shape(f[1]), int(k), 1) for f, k in zip(findings, steps, strict=True)]


def _apart(findings: list[tuple], params: SecretParams) -> tuple[list[tuple], list[tuple]]:
    """Findings to learn from, and those held back."""
    order = np.random.default_rng(params.seed).permutation(len(findings))
    n_held = round(params.held_back * len(findings))
    return [findings[i] for i in order[n_held:]], [findings[i] for i in order[:n_held]]


def _encoded(findings: list[tuple], window: WindowParams) -> tuple[np.ndarray, np.ndarray]:
    codes = encode([(b, v[: window.body], a) for b, v, a, _ in findings], window)
    return codes, np.array([f[3] for f in findings], dtype=float)


def fit(findings: list[tuple[str, str, str, int]], params: SecretParams = SecretParams()) -> SecretModel:
    """Train on three quarters, calibrate on the rest; ``findings`` as ``made_findings`` gives them."""
    taught, held = _apart(findings, params)
    network = CharNetwork(params.window, params.network)
    model = SecretModel(network, 1.0, 0.0, {}, network.train(*_encoded(taught, params.window)))
    _calibrate(model, _counted(model, held), params)
    return model


def fit_corpus(found: DataFrame, params: SecretParams = SecretParams()) -> SecretModel:
    """Train and calibrate on all findings of the corpus (``found`` as ``find`` gives it) and the made ones."""
    made = made_findings(params.made_findings, params.seed)
    first = fit(made, params)
    place = F.pmod(F.xxhash64("before", "value", "after"), F.lit(1_000_000_007))
    own = _likely(corpus_findings(found, params), first, params)
    own = own.withColumn("place", place).withColumn("held", F.col("place") % 1000 < round(params.held_back * 1000))
    own = materialize(own, "findings")
    taught, held_made = _apart(made, params)
    model = _learned(own.where("NOT held"), taught, first, params)
    counted = own.where("held").select("before", "value", "after", "label")
    kinds = counted.mapInArrow(_scored_by(model), "label int, shape string, step int").groupBy("label", "shape", "step")
    # A bounded number of rows: two labels, three shapes, and the steps.
    rows = [(1, r.label, r["shape"], r.step, r.n) for r in kinds.agg(F.count("*").alias("n")).collect()]
    _calibrate(model, rows + _counted(model, held_made), params)
    return model


def _scored_by(model: SecretModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch)
            shapes = [shape(v) for _, v, _ in texts]
            steps = pa.array(_steps(model.scores(texts)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(shapes, pa.string()), steps], ["label", "shape", "step"])

    return score


def _learned(own: DataFrame, made: list[tuple], first: SecretModel, params: SecretParams) -> SecretModel:
    """The first network taught on by all lessons, epoch by epoch."""
    n_lessons = max(1, -(-own.count() // params.lesson))
    lessons = own.withColumn("lesson", (F.col("place") % n_lessons).cast("int"))
    # A lesson of no finding still has the made ones.
    blank = own.sparkSession.createDataFrame([(None, None, None, None, -1, False, 0)], lessons.schema)
    lessons = lessons.unionAll(blank).repartition(n_lessons, "lesson")
    network = CharNetwork(params.window, params.network)
    names = sorted(network.weights)
    network.weights, moments, losses = dict(first.network.weights), network.new_moments(), []
    shapes = [network.weights[k].shape for k in names]

    def packed(net: CharNetwork, state: Moments) -> np.ndarray:
        return np.concatenate([part[k].ravel() for part in (net.weights, state.first, state.second) for k in names])

    def unpacked(vector: np.ndarray) -> list[dict[str, np.ndarray]]:
        sizes = [int(np.prod(s)) for s in shapes] * 3
        parts = np.split(vector.astype(np.float32), np.cumsum(sizes)[:-1])
        parts = [p.reshape(s) for p, s in zip(parts, shapes * 3, strict=True)]
        return [dict(zip(names, parts[i : i + len(names)], strict=True)) for i in range(0, len(parts), len(names))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(v.as_buffer()) for batch in batches for v in batch.column(0))
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    for epoch in range(params.network.epochs):
        weights, state = dict(network.weights), moments

        def learn(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows[rows.place >= 0].sort_values(["place", "before", "value", "after", "label"])
            findings = [(r.before, r.value, r.after, int(r.label)) for r in rows.itertuples()] + made
            net = CharNetwork(params.window, params.network)
            net.weights = dict(weights)
            own_state = Moments(dict(state.first), dict(state.second), state.steps)
            loss = net.epoch(*_encoded(findings, params.window), own_state, np.random.default_rng(epoch))
            steps = own_state.steps - state.steps
            total = np.append(packed(net, own_state), [loss, steps, 1.0]).astype(float) * len(findings)
            return pd.DataFrame({"sums": [total.tobytes()]})

        sums = lessons.groupBy("lesson").applyInPandas(learn, "sums binary")
        sums = sums.repartition(max(1, math.isqrt(n_lessons))).mapInArrow(add, "sums binary")
        total = sum(np.frombuffer(r.sums) for r in sums.collect())
        *mean, loss, steps, _ = total / total[-1]
        network.weights, *both = unpacked(np.array(mean))
        moments = Moments(*both, state.steps + round(steps))
        losses.append(float(loss))
    return SecretModel(network, 1.0, 0.0, {}, losses)


def scan(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    params: SecretParams = SecretParams(),
) -> DataFrame:
    """``row`` (the columns to ``keep``, all by default), ``base`` spans and all ``spans`` of every row.

    Spans are by start, then kind; those of the network have kind ``learned``.
    """
    found = materialize(find(docs, text, docs.columns if keep is None else keep, params), "found")
    model = fit_corpus(found, params)
    schema = f"row {found.schema['row'].dataType.simpleString()}, base array<{SPAN}>, spans array<{SPAN}>"
    types = _arrow(f"spans array<{SPAN}>", docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            spans = [[(s["kind"], s["start"], s["end"]) for s in row] for row in base]
            open_ones = [(i, c) for i, row in enumerate(more) for c in row if not c["known"]]
            flags = model.flagged([(c["before"], c["value"], c["after"]) for _, c in open_ones])
            for (i, c), flag in zip(open_ones, flags, strict=True):
                if flag:
                    spans[i].append((LEARNED, c["start"], c["end"]))
            ordered = [sorted(row, key=_place) for row in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _structs(ordered, types.field(0).type)],
                ["row", "base", "spans"],
            )

    return found.mapInArrow(judge, schema)


def shown(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(parts, ",")
