"""A linear-chain conditional random field over token features, trained and decoded in numpy.

A token's score for a label is the sum of its own features' weights and those of its neighbours up to two tokens away.
Features belong to token types, so scores are computed once for each different token and gathered by position.
"""

from __future__ import annotations

import numpy as np

OFFSETS = (-2, -1, 0, 1, 2)


class Chain:
    """Weights of the model: w[k] for the features of the token at OFFSETS[k], gap weights, and label transitions."""

    def __init__(self, features: int, labels: int, gaps: int, allowed: np.ndarray) -> None:
        self.w = np.zeros((len(OFFSETS), features, labels))
        self.gap = np.zeros((gaps, labels))
        self.move = np.zeros((labels, labels))
        self.allowed = allowed

    def parameters(self) -> list[np.ndarray]:
        return [self.w, self.gap, self.move]


def token_scores(model: Chain, features: np.ndarray) -> np.ndarray:
    """(offsets x tokens x labels) scores of token types given the numbers of their features; 0 is no feature."""
    return model.w[:, features].sum(axis=2)


def _sums(group: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Column sums of ``values`` by group."""
    return np.stack([np.bincount(group, weights=values[:, c], minlength=size) for c in range(values.shape[1])], axis=1)


def train(sentences: list[tuple[np.ndarray, np.ndarray, np.ndarray]], features: np.ndarray, size: int, labels: int, gaps: int, allowed: np.ndarray, rounds: int = 150, rate: float = 0.12, decay: float = 3e-4) -> Chain:
    """Maximise the conditional likelihood by Adam over the whole table, at a pace that falls to 0.

    A sentence is (token types, gap kinds, labels), type 0 being the padding; ``features`` has the feature numbers of
    each type, below ``size``, feature 0 being none; ``allowed`` is the mask of label transitions.
    """
    sentences = sorted(sentences, key=lambda s: -len(s[0]))
    n, length = len(sentences), max(len(s[0]) for s in sentences)
    tokens, gap_kind, gold = (np.zeros((n, length), np.int64) for _ in range(3))
    mask = np.zeros((n, length), bool)
    for i, (t, g, y) in enumerate(sentences):
        tokens[i, : len(t)], gap_kind[i, : len(t)], gold[i, : len(t)], mask[i, : len(t)] = t, g, y, True
    model = Chain(size, labels, gaps, allowed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]
    reach = max(OFFSETS)
    wide = np.pad(tokens, ((0, 0), (reach, reach)))
    near = [wide[:, reach + o : reach + o + length][mask] for o in OFFSETS]
    gaps_at, truth = gap_kind[mask], gold[mask]
    inner = mask[:, 1:]
    moved = np.zeros((labels, labels))
    np.add.at(moved, (gold[:, :-1][inner], gold[:, 1:][inner]), 1)
    live = mask.sum(axis=0)  # the longest come first, so those that reach a position are a head of the list
    barrier = np.where(allowed, 0.0, -np.inf)
    for step in range(1, rounds + 1):
        u = token_scores(model, features)
        flat = model.gap[gaps_at] + sum(u[k][near[k]] for k in range(len(OFFSETS)))
        score = np.zeros((n, length, labels))
        score[mask] = flat
        e = np.exp(score - score.max(axis=2, keepdims=True))
        m = np.exp(model.move + barrier)
        ahead, back = np.ones_like(e), np.ones_like(e)
        ahead[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, length):
            k = live[t]
            step_t = (ahead[:k, t - 1] @ m) * e[:k, t]
            ahead[:k, t] = step_t / step_t.sum(axis=1, keepdims=True)
        edge = np.zeros_like(m)
        for t in range(length - 2, -1, -1):
            k = live[t + 1]
            joint = e[:k, t + 1] * back[:k, t + 1]
            b = joint @ m.T
            total = (ahead[:k, t] * b).sum(axis=1, keepdims=True)
            edge += m * ((ahead[:k, t] / total).T @ joint)
            back[:k, t] = b / b.sum(axis=1, keepdims=True)
        p = ahead * back
        p /= p.sum(axis=2, keepdims=True)
        err = -p[mask]
        err[np.arange(len(truth)), truth] += 1
        du = np.stack([_sums(near[k], err, u.shape[1]) for k in range(len(OFFSETS))])
        dw = np.stack([sum(_sums(features[:, j], d, model.w.shape[1]) for j in range(features.shape[1])) for d in du])
        dw[:, 0] = 0
        dgap = _sums(gaps_at, err, gaps)
        pace = rate * min(1.0, 2 - 2 * step / rounds)  # to rest in the second half
        grads = [dw, dgap, np.where(allowed, moved - edge, 0)]
        for p_, g, (m1, m2) in zip(model.parameters(), grads, moments):
            g = g / n - decay * p_
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            p_ += pace * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return model


def viterbi(score: np.ndarray, begins: np.ndarray, lengths: np.ndarray, move: np.ndarray, allowed: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Best labels of many stretches at once: stretch i covers score[begins[i] : begins[i] + lengths[i]].

    ``start`` says which labels may come first. Stretches go side by side, the longest first, one position a step.
    """
    out = np.zeros(len(score), np.int64)
    if not len(begins):
        return out
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    step = np.where(allowed, move, -np.inf).astype(score.dtype)
    live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    best = np.where(start, score[begins], -np.inf)
    trace = []
    for t in range(1, int(lengths[0])):
        n = live[t]
        paths = best[:n, :, None] + step
        come = paths.argmax(axis=1)
        trace.append(come)
        best[:n] = np.take_along_axis(paths, come[:, None, :], axis=1)[:, 0] + score[begins[:n] + t]
    last = best.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        n = live[t]
        out[begins[:n] + t] = last[:n]
        if t:
            last[:n] = trace[t - 1][np.arange(n), last[:n]]
    return out
