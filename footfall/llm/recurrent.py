"""A gated recurrent unit over words, in numpy.

The vocabulary is a fixed number of frequent words in classes of equal size, sorted by
frequency, and one class for all other words. The chance of a word is that of
its class times that of the word within it, both softmaxes of the state; words of the
last class share a chance that isn't the network's business.

Documents run side by side, longest first; a window is a bounded number of steps. In
training, gradients stop at the edge of a window, while the state goes on from window to
window, so it spans whole documents in training and scoring alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np

Weights = dict[str, np.ndarray]


def new_weights(counts: np.ndarray, other: float, n_class: int, hidden: int, seed: int) -> Weights:
    """Weights that start as the unigram model.

    ``counts`` holds the listed words' counts, classes of ``n_class`` in a row, and ``other``
    that of all further words. Index ``len(counts)`` stands for any of those.
    """
    rng = np.random.default_rng(seed)
    words = np.maximum(counts.reshape(-1, n_class).astype(float), 1e-6)
    of_class = np.append(words.sum(axis=1), max(other, 1e-6))
    n_classes, scale = len(of_class), 1 / np.sqrt(hidden)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return {
        "x": normal(len(counts) + 1, 3 * hidden),
        "u": normal(hidden, 3 * hidden),
        "c": normal(hidden, n_classes) * np.float32(0.1),
        "c0": np.log(of_class / of_class.sum()).astype(np.float32),
        "w": normal(n_classes - 1, hidden, n_class) * np.float32(0.1),
        "w0": np.log(words / words.sum(axis=1, keepdims=True)).astype(np.float32),
    }


def _by_gate(w: np.ndarray) -> np.ndarray:
    """``x`` or ``u`` with one matrix per gate (update, reset, candidate).

    Both sigmoids are taken as ``tanh(a / 2) / 2 + 1 / 2``, so theirs are halved.
    """
    half = np.array([0.5, 0.5, 1], w.dtype)[:, None, None]
    return np.multiply(w.reshape(len(w), 3, -1).swapaxes(0, 1), half, order="C")


def _advance(x: np.ndarray, u: np.ndarray, states: np.ndarray, from_h: np.ndarray) -> None:
    """Fills ``states`` after the first, one per step.

    ``x`` (gate, step, place, unit) holds the inputs and becomes the gates; ``from_h`` (the same, or
    with a single step that is used again) receives the products with the states. Steps and
    places lie side by side in memory, so that each operation is one over all places.
    """
    last = from_h.shape[1] - 1
    for t in range(len(states) - 1):
        h, after, gates, candidate = states[t], states[t + 1], x[:2, t], x[2, t]
        product = from_h[:, min(t, last)]
        np.matmul(h, u, out=product)
        gates += product[:2]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(gates[1], product[2], out=after)
        candidate += after
        np.tanh(candidate, out=candidate)
        np.subtract(h, candidate, out=after)
        after *= gates[0]
        after += candidate


def _step(weights: Weights, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state and its gates, of one step."""
    x = _by_gate(x)[:, None]
    states = np.stack([h, h]).astype(np.result_type(x, h))
    _advance(x, _by_gate(weights["u"]), states, np.empty_like(x))
    return states[1], *x[:, 0]


def _by_class(targets: np.ndarray, n_class: int, n_classes: int) -> tuple[np.ndarray, list[int]]:
    """The positions of the targets, less those of -1, in order of their classes, and where each class begins."""
    classes = targets // n_class
    if n_classes < 2**15:
        classes = classes.astype(np.int16)  # sorted by radix
    order = np.argsort(classes, kind="stable")
    edges = np.searchsorted(classes[order], np.arange(n_classes + 1))
    return order[edges[0] :], (edges - edges[0]).tolist()


def _with_ones(states: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Some of the states, with one more unit, always 1, to multiply the biases by."""
    out = np.empty((len(order), states.shape[1] + 1), states.dtype)
    out[:, :-1] = states.take(order, axis=0)
    out[:, -1] = 1
    return out


def _logits(
    weights: Weights, states: np.ndarray, edges: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Of the classes, and of the words inside each state's own class; the last class has none.

    ``states`` are in order of their classes, with ones. The exponents of the logits can be
    added up: where any is too large or too small for that, the largest of each row is 0.
    """
    outer = states @ np.vstack([weights["c"], weights["c0"]])
    words = np.concatenate([weights["w"], weights["w0"][:, None]], axis=1)
    inner = np.empty((edges[-2], words.shape[2]), outer.dtype)
    for of_class, begin, end in zip(words, edges, edges[1:]):
        if begin < end:
            np.dot(states[begin:end], of_class, out=inner[begin:end])
    for logits in (outer, inner):
        if logits.size and max(logits.max(), -logits.min()) > 60:
            logits -= logits.max(axis=1, keepdims=True)
    return outer, inner


def _totals(chances: np.ndarray) -> np.ndarray:
    """Sums of the rows; a product takes less time than a sum of short rows."""
    return chances @ np.ones(chances.shape[1], chances.dtype)


def _log_chances(weights: Weights, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithm of each target's chance given its state; 0 for targets of -1."""
    n_class, n_classes = weights["w0"].shape[1], len(weights["c0"])
    order, edges = _by_class(targets, n_class, n_classes)
    outer, inner = _logits(weights, _with_ones(states, order), edges)
    y = targets[order]
    logs = []
    for logits, at in ((outer, y // n_class), (inner, y[: len(inner)] % n_class)):
        hit = logits[np.arange(len(at)), at]
        logs.append(hit - np.log(_totals(np.exp(logits, out=logits))))
    logs[0][: len(inner)] += logs[1]
    out = np.zeros(len(targets), outer.dtype)
    out[order] = logs[0]
    return out


def _keep_freed_memory() -> None:
    """So that the arrays of each window aren't new pages of the system.

    The C library's allocator keeps what is freed, by the size of the largest block freed so far;
    this one isn't written to and takes no memory.
    """
    np.empty(31 << 20, np.uint8)


def _windows(
    documents: Iterable[np.ndarray], start: int, side: int, window: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the documents side by side: places, documents' numbers, whether they begin, inputs and targets.

    A place whose document has ended takes the next one. Documents are taken as they come, so no
    more than ``side`` of them are held. Behind the end of a document, targets are -1.
    """
    waiting = ((i, d) for i, d in enumerate(documents) if len(d))
    nothing = (-1, np.empty(0, int))
    own, at, before = [nothing] * side, [0] * side, np.full(side, start)
    while True:
        ended = [k for k, (_, d) in enumerate(own) if at[k] >= len(d)]
        for k in ended:
            own[k], at[k] = next(waiting, nothing), 0
        before[ended] = start
        busy = np.array([k for k, (i, _) in enumerate(own) if i >= 0], int)
        if not len(busy):
            return
        numbers, docs = zip(*(own[k] for k in busy))
        begins = [at[k] for k in busy]
        parts = [d[i : i + window] for d, i in zip(docs, begins)]
        lengths = np.array([len(p) for p in parts])
        targets = np.full((len(parts), lengths.max()), -1)
        targets[np.arange(targets.shape[1]) < lengths[:, None]] = np.concatenate(parts)
        yield busy, np.array(numbers), np.array(begins) == 0, np.column_stack([before[busy], targets[:, :-1]]), targets
        before[busy] = targets[:, -1]
        at = [i + window for i in at]


def score(
    weights: Weights, documents: list[np.ndarray], start: int, side: int = 256, window: int = 64
) -> np.ndarray:
    """Log-likelihood of each whole document (word indices); ``start`` is fed in first."""
    _keep_freed_memory()
    order = np.argsort([-len(d) for d in documents], kind="stable")
    out = np.zeros(len(documents))
    table, u = _by_gate(weights["x"]), _by_gate(weights["u"])
    h = np.zeros((side, u.shape[1]), u.dtype)
    longest_first = (documents[i] for i in order)
    for places, numbers, begins, inputs, targets in _windows(longest_first, start, side, window):
        h[places[begins]] = 0
        inputs, targets = np.maximum(inputs.T, 0), targets.T
        x = table.take(inputs, axis=1)
        states = np.empty((len(targets) + 1, len(places), h.shape[1]), u.dtype)
        states[0] = h[places]
        _advance(x, u, states, np.empty_like(x[:, :1]))
        h[places] = states[-1]
        logs = _log_chances(weights, states[1:].reshape(-1, h.shape[1]), targets.ravel())
        out[order[numbers]] += logs.reshape(targets.shape).sum(axis=0, dtype=float)
    return out


def _added(rows: np.ndarray, words: np.ndarray, like: np.ndarray, n_class: int) -> np.ndarray:
    """Shaped ``like`` the table of inputs: for each word the sum of its rows.

    Class by class, as a product with a table that has a 1 where a row is of a word; the
    last class has one word.
    """
    n_classes = len(like) // n_class + 1
    order, edges = _by_class(words, n_class, n_classes)
    last = (words == len(like) - 1).astype(rows.dtype)
    order = order[: edges[-2]]
    is_word = np.zeros((len(order), n_class), rows.dtype)
    is_word[np.arange(len(order)), words[order] % n_class] = 1
    own = rows.take(order, axis=0)
    out = np.zeros(like.shape, rows.dtype)
    for c, (begin, end) in enumerate(zip(edges[:-2], edges[1:])):
        if begin < end:
            of_class = out[c * n_class : (c + 1) * n_class]
            np.dot(is_word[begin:end].T, own[begin:end], out=of_class)
    out[-1] = last @ rows
    return out


def _gradients(
    weights: Weights, inputs: np.ndarray, targets: np.ndarray, h0: np.ndarray
) -> tuple[Weights, np.ndarray]:
    """Gradients of one window's mean loss, and the state at its end."""
    side, steps = targets.shape
    n = h0.shape[1]
    inputs, targets = np.maximum(inputs.T, 0), targets.T.ravel()
    x = _by_gate(weights["x"]).take(inputs, axis=1)
    states = np.empty((steps + 1, side, n), x.dtype)
    states[0] = h0
    from_h = np.empty_like(x)
    _advance(x, _by_gate(weights["u"]), states, from_h)
    grads = {}
    n_class, n_classes = weights["w0"].shape[1], len(weights["c0"])
    order, edges = _by_class(targets, n_class, n_classes)
    s, y = _with_ones(states[1:].reshape(-1, n), order), targets[order]
    share = 1 / max(len(y), 1)

    outer, inner = _logits(weights, s, edges)
    for d, at in ((outer, y // n_class), (inner, y[: len(inner)] % n_class)):
        np.exp(d, out=d)
        d *= (share / _totals(d))[:, None]
        d[np.arange(len(at)), at] -= share
    of_c = np.dot(s.T, outer)
    grads["c"], grads["c0"] = of_c[:-1], of_c[-1]
    d_s = np.dot(outer, weights["c"].T)
    of_w = np.zeros((n_classes - 1, n + 1, n_class), s.dtype)
    d_inner = np.empty((len(inner), n), s.dtype)
    for c, (begin, end) in enumerate(zip(edges[:-2], edges[1:])):
        if begin < end:
            d = inner[begin:end]
            np.dot(s[begin:end].T, d, out=of_w[c])
            np.dot(d, weights["w"][c].T, out=d_inner[begin:end])
    grads["w"], grads["w0"] = of_w[:, :-1], of_w[:, -1]
    d_s[: len(inner)] += d_inner
    d_states = np.zeros_like(states[1:])
    d_states.reshape(-1, n)[order] = d_s

    # What the gradient of a state is multiplied by on its way to the gates, for all steps at once.
    before, (z, r, candidate) = states[:-1], x
    to_candidate = (1 - z) * (1 - candidate * candidate)
    d_u = np.empty((steps, side, 3, n), x.dtype)
    np.multiply((before - candidate) * z, 1 - z, out=d_u[:, :, 0])
    reset = np.multiply(to_candidate, r, out=d_u[:, :, 2])
    np.multiply(from_h[2] * reset, 1 - r, out=d_u[:, :, 1])
    back = weights["u"].T.copy()
    d_h = np.zeros_like(states[0])
    for t in reversed(range(steps)):
        total, to_gates = d_states[t], d_u[t]
        total += d_h
        to_gates *= total[:, None]
        np.dot(to_gates.reshape(side, -1), back, out=d_h)
        d_h += total * z[t]
    flat = d_u.reshape(-1, 3 * n)
    grads["u"] = np.dot(before.reshape(-1, n).T, flat)
    np.multiply(d_states, to_candidate, out=d_u[:, :, 2])
    grads["x"] = _added(flat, inputs.ravel(), weights["x"], n_class)
    return grads, states[-1]


def train(
    weights: Weights,
    documents: Iterable[np.ndarray],
    start: int,
    side: int = 48,
    window: int = 32,
    rate: float = 0.01,
) -> tuple[Weights, int]:
    """Adam over truncated windows of whole documents, side by side; the tokens learned from.

    Documents are taken as they come.
    """
    vector = packed(weights, np.float32)
    weights = unpacked(vector, weights)  # parts of the vector
    first, second, scratch = (np.zeros_like(vector) for _ in range(3))
    _keep_freed_memory()
    h = np.zeros((side, weights["u"].shape[0]), np.float32)
    updates, learned = 0, 0
    for places, _, begins, inputs, targets in _windows(documents, start, side, window):
        h[places[begins]] = 0
        learned += int((targets >= 0).sum())
        grads, h[places] = _gradients(weights, inputs, targets, h[places])
        updates += 1
        g = packed(grads, np.float32)
        norm = math.sqrt(g @ g)
        g *= min(1.0, 1.0 / (norm + 1e-9))
        pace = rate / math.sqrt(1 + updates / 100)
        for moment, value, share in ((first, g, 0.1), (second, np.multiply(g, g, out=scratch), 0.01)):
            moment *= 1 - share
            value *= share
            moment += value
        # Both moments' corrections for their start at 0, taken out of the division.
        spread = math.sqrt(1 - 0.99**updates)
        np.sqrt(second, out=scratch)
        scratch += 1e-8 * spread
        np.divide(first, scratch, out=scratch)
        scratch *= pace * spread / (1 - 0.9**updates)
        vector -= scratch
    return weights, learned


def packed(weights: Weights, kind: type = float) -> np.ndarray:
    """All weights as one vector, in order of their names."""
    return np.concatenate([weights[name].ravel() for name in sorted(weights)], dtype=kind)


def unpacked(vector: np.ndarray, like: Weights) -> Weights:
    """The weights in ``vector``, shaped like those given; parts of it where the type is the same."""
    weights, at = {}, 0
    for name in sorted(like):
        part = vector[at : at + like[name].size]
        weights[name] = part.reshape(like[name].shape).astype(like[name].dtype, copy=False)
        at += like[name].size
    return weights
