"""A bidirectional gated recurrent network over bytes, in NumPy: training and labelling.

Every position of a text gets a probability for each label from the states of both
directions there; a document's probabilities are the mean over its positions.  Texts are
cut in segments, and every segment starts with empty states, so all segments of many texts
run side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GATES = 3  # update, reset, candidate


@dataclass
class Model:
    labels: list[str]
    weights: dict[str, np.ndarray]


def _sigmoid(x):
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def new_weights(hidden: int, labels: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    return {"input": 4 * normal(2, GATES, 256, hidden), "state": normal(2, GATES, hidden, hidden),
            "out": normal(2, hidden, labels), "bias": np.zeros(labels, np.float32)}


def _states(x, weights, direction, mask=None, trace=None):
    """The states ``[step, sequence, hidden]`` of one direction; ``x`` is ``[step, sequence]``."""
    e, u = weights["input"][direction], weights["state"][direction]
    steps, n = x.shape
    h = np.zeros((n, e.shape[2]), np.float32)
    states = np.empty((steps, n, e.shape[2]), np.float32)
    for t in range(steps) if direction == 0 else range(steps - 1, -1, -1):
        z = e[0].take(x[t], axis=0)
        z += h @ u[0]
        z = _sigmoid(z)
        r = e[1].take(x[t], axis=0)
        r += h @ u[1]
        r = _sigmoid(r)
        s = h @ u[2]
        c = r * s
        c += e[2].take(x[t], axis=0)
        np.tanh(c, out=c)
        if trace is not None:
            trace.append((t, h, z, r, s, c))
        h = c + z * (h - c)
        if mask is not None:
            h *= mask[t]
        states[t] = h
    return states


def position_probabilities(x, weights, mask=None):
    """``[step, sequence, label]``."""
    logits = weights["bias"] + np.zeros(1, np.float32)
    for direction in (0, 1):
        logits = logits + _states(x, weights, direction, mask) @ weights["out"][direction]
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits


def gradients(x, y, weights):
    """Loss (mean cross entropy over positions) and its gradients, through time."""
    steps, n = x.shape
    traces, states = ([], []), []
    for direction in (0, 1):
        states.append(_states(x, weights, direction, trace=traces[direction]))
    logits = weights["bias"] + states[0] @ weights["out"][0] + states[1] @ weights["out"][1]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    own = np.arange(n)
    loss = -np.log(p[:, own, y] + 1e-9).mean()
    p[:, own, y] -= 1
    p /= steps * n
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    grads["bias"] = p.sum(axis=(0, 1))
    for direction in (0, 1):
        e, u = grads["input"][direction], grads["state"][direction]
        w = weights["state"][direction]
        grads["out"][direction] = np.einsum("tnh,tnc->hc", states[direction], p, optimize=True)
        below = p @ weights["out"][direction].T
        dh = np.zeros_like(states[direction][0])
        for t, h, z, r, s, c in reversed(traces[direction]):
            dh = dh + below[t]
            dz = dh * (h - c) * z * (1 - z)
            dc = dh * (1 - z) * (1 - c * c)
            dr = dc * s * r * (1 - r)
            ds = dc * r
            one_hot = np.zeros((256, n), np.float32)
            one_hot[x[t], own] = 1
            for gate, d, into in ((0, dz, dz), (1, dr, dr), (2, dc, ds)):
                e[gate] += one_hot @ d
                u[gate] += h.T @ into
            dh = dh * z + dz @ w[0].T + dr @ w[1].T + ds @ w[2].T
    return loss, grads


def train(segments: np.ndarray, y: np.ndarray, labels: list[str], hidden: int = 12, steps: int = 400,
          batch: int = 256, rate: float = 0.02, seed: int = 0) -> Model:
    """Adam on random batches of segments ``[sequence, step]`` with label numbers ``y``."""
    rng = np.random.default_rng(seed)
    weights = new_weights(hidden, len(labels), seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(y), batch)
        _, grads = gradients(segments[chosen].T, y[chosen], weights)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        now = rate * min(1.0, 4 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            weights[k] -= now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
    return Model(labels, weights)


def label_texts(data: np.ndarray, offsets: np.ndarray, model: Model, length: int = 128, side_by_side: int = 4096):
    """Mean label probabilities of each text ``data[offsets[i]:offsets[i + 1]]``; zeros if empty."""
    size = np.diff(offsets)
    pieces = -(-size // length)
    row = np.repeat(np.arange(len(size)), pieces)
    start = np.repeat(offsets[:-1], pieces) + length * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    n = np.minimum(length, offsets[1:][row] - start)
    order = np.argsort(-n, kind="stable")
    total = np.zeros((len(size), len(model.labels)))
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    step = np.arange(length)[:, None]
    for a in range(0, len(order), side_by_side):
        chosen = order[a:a + side_by_side]
        longest = int(n[chosen].max())
        x = padded[start[chosen] + step[:longest]]
        inside = step[:longest] < n[chosen]
        mask = None if inside.all() else inside.astype(np.float32)[:, :, None]
        p = position_probabilities(x, model.weights, mask)
        if mask is not None:
            p *= mask
        np.add.at(total, row[chosen], p.sum(axis=0))
    return total / np.maximum(size, 1)[:, None]
