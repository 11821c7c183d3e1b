"""A small convolutional network over characters, in numpy.

An input is a window of characters, some of which are the candidate and the rest its
surroundings. Embedded characters, and a mark on those of the candidate, go through one
convolution; its responses are pooled over the candidate (largest and mean) and over the
surroundings (largest), and a hidden layer turns the pooled values to one score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PAD, BREAK, OTHER, SYMBOLS = 0, 96, 97, 98


@dataclass(frozen=True)
class WindowParams:
    before: int = 24
    body: int = 48
    after: int = 8
    #: A longer candidate is read in pieces that start so many characters apart.
    stride: int = 32

    @property
    def length(self) -> int:
        return self.before + self.body + self.after


@dataclass(frozen=True)
class NetworkParams:
    embedding: int = 8
    width: int = 5
    filters: int = 32
    hidden: int = 16
    epochs: int = 8
    batch: int = 64
    rate: float = 0.003
    decay: float = 1e-4
    seed: int = 11


def _codes(text: str) -> list[int]:
    """Printable ASCII from 1, breaks and tabs as one symbol, all others as another."""
    codes = []
    for char in text:
        point = ord(char)
        if 32 <= point < 127:
            codes.append(point - 31)
        else:
            codes.append(BREAK if char in "\t\n\r" else OTHER)
    return codes


def pieces(value: str, window: WindowParams) -> list[str]:
    """Overlapping parts of a candidate that cover all of it."""
    if len(value) <= window.body:
        return [value]
    starts = range(0, len(value) - window.body + window.stride, window.stride)
    last = len(value) - window.body
    return [value[min(s, last) : min(s, last) + window.body] for s in starts]


def encode(windows: list[tuple[str, str, str]], window: WindowParams) -> np.ndarray:
    """Symbols by position: text before (right-aligned), candidate, text after."""
    codes = np.zeros((len(windows), window.length), dtype=np.int16)
    for row, (before, body, after) in zip(codes, windows, strict=True):
        left = _codes(before[-window.before :]) if window.before else []
        row[window.before - len(left) : window.before] = left
        row[window.before : window.before + len(body)] = _codes(body)
        right = _codes(after[: window.after])
        start = window.before + window.body
        row[start : start + len(right)] = right
    return codes


@dataclass
class Moments:
    """What Adam carries from step to step."""

    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    steps: int


class CharNetwork:
    """Weights, forward pass and gradients."""

    def __init__(self, window: WindowParams, params: NetworkParams):
        self.window, self.params = window, params
        rng = np.random.default_rng(params.seed)
        inputs = params.width * (params.embedding + 1)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)

        self.weights = {
            "embedding": rng.standard_normal((SYMBOLS, params.embedding)).astype(np.float32) / 2,
            "filters": normal(inputs, params.filters),
            "filters_bias": np.zeros(params.filters, np.float32),
            "hidden": normal(3 * params.filters, params.hidden),
            "hidden_bias": np.zeros(params.hidden, np.float32),
            "out": normal(params.hidden, 1),
            "out_bias": np.zeros(1, np.float32),
        }

    def _forward(self, codes: np.ndarray) -> dict[str, np.ndarray]:
        w, p = self.weights, self.params
        dtype = w["filters"].dtype
        known = (codes != PAD).astype(dtype)
        inside = np.zeros_like(known)
        inside[:, self.window.before : self.window.before + self.window.body] = 1
        inside *= known
        embedded = w["embedding"][codes] * known[..., None]
        half = p.width // 2
        padded = np.pad(
            np.concatenate([embedded, inside[..., None]], axis=2), ((0, 0), (half, half), (0, 0))
        )
        views = np.lib.stride_tricks.sliding_window_view(padded, p.width, axis=1)
        columns = views.transpose(0, 1, 3, 2).reshape(*codes.shape, -1)
        response = np.maximum(columns @ w["filters"] + w["filters_bias"], 0)
        body, around = response * inside[..., None], response * (known - inside)[..., None]
        size = np.maximum(inside.sum(axis=1), 1)[:, None]
        pooled = np.concatenate([body.max(axis=1), body.sum(axis=1) / size, around.max(axis=1)], axis=1)
        hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
        logit = (hidden @ w["out"] + w["out_bias"])[:, 0]
        return {
            "known": known, "inside": inside, "columns": columns, "response": response, "body": body,
            "around": around, "size": size, "pooled": pooled, "hidden": hidden, "logit": logit,
        }

    def logits(self, codes: np.ndarray, batch: int = 512) -> np.ndarray:
        parts = [self._forward(codes[i : i + batch])["logit"] for i in range(0, len(codes), batch)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the batch and its derivatives by every weight."""
        w, p, f = self.weights, self.params, self._forward(codes)
        n, filters = len(codes), p.filters
        logit = f["logit"].astype(np.float64)
        loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
        delta = ((1 / (1 + np.exp(-logit)) - labels) / n).astype(w["out"].dtype)[:, None]
        grads = {"out": f["hidden"].T @ delta, "out_bias": delta.sum(axis=0)}
        hidden = (delta @ w["out"].T) * (f["hidden"] > 0)
        grads |= {"hidden": f["pooled"].T @ hidden, "hidden_bias": hidden.sum(axis=0)}
        pooled = hidden @ w["hidden"].T
        response = np.zeros_like(f["response"])
        rows, channels = np.arange(n)[:, None], np.arange(filters)[None, :]
        for part, seen, start in (("body", f["inside"], 0), ("around", f["known"] - f["inside"], 2)):
            at = f[part].argmax(axis=1)
            share = pooled[:, start * filters : (start + 1) * filters]
            response[rows, at, channels] += share * seen[rows, at]
        mean = pooled[:, filters : 2 * filters] / f["size"]
        response += mean[:, None, :] * f["inside"][..., None]
        response *= f["response"] > 0
        flat = response.reshape(-1, filters)
        grads["filters"] = f["columns"].reshape(len(flat), -1).T @ flat
        grads["filters_bias"] = flat.sum(axis=0)
        columns = (flat @ w["filters"].T).reshape(*codes.shape, p.width, p.embedding + 1)
        half, length = p.width // 2, codes.shape[1]
        embedded = np.zeros((n, length + 2 * half, p.embedding), columns.dtype)
        for k in range(p.width):
            embedded[:, k : k + length] += columns[:, :, k, :-1]
        embedded = embedded[:, half : half + length] * f["known"][..., None]
        grads["embedding"] = np.zeros_like(w["embedding"])
        np.add.at(grads["embedding"], codes.reshape(-1), embedded.reshape(-1, p.embedding))
        return loss, grads

    def new_moments(self) -> Moments:
        zeros = {k: np.zeros_like(v) for k, v in self.weights.items()}
        return Moments(zeros, dict(zeros), 0)

    def train(self, codes: np.ndarray, labels: np.ndarray) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng, moments = np.random.default_rng(self.params.seed + 1), self.new_moments()
        return [self.epoch(codes, labels, moments, rng) for _ in range(self.params.epochs)]

    def epoch(self, codes: np.ndarray, labels: np.ndarray, moments: Moments, rng: np.random.Generator) -> float:
        """One pass; weights and moments go on from where they are."""
        p, first, second, of_epoch = self.params, moments.first, moments.second, []
        for batch in _batches(rng.permutation(len(codes)), p.batch):
            loss, grads = self.gradients(codes[batch], labels[batch])
            of_epoch.append(loss)
            moments.steps += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step = (first[k] / (1 - 0.9**moments.steps)) / (
                    np.sqrt(second[k] / (1 - 0.999**moments.steps)) + 1e-8
                )
                self.weights[k] = self.weights[k] - p.rate * (step + p.decay * self.weights[k])
        return float(np.mean(of_epoch)) if of_epoch else 0.0


def _batches(order: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for start in range(0, len(order), size):
        yield order[start : start + size]
