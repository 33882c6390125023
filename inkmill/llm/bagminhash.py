"""BagMinHash signatures of weighted bags, for many bags at once.

The weight axis of an element is cut at 0, 1, 2, 4, 8, ...; each stretch carries its own Poisson process whose
rate is its width. A point has a time, a register and a place on the weight axis; a bag of weight w sees the
points placed below w, so two bags see the same points on their common weight and the share of equal registers
estimates sum(min) / sum(max) without bias. Points come in ascending time and a process stops at the largest
register of its bag.
"""

from __future__ import annotations

import math

import numpy as np

from inkmill.llm.wordstream import mix

_STEP = np.uint64(0xA0761D6478BD642F)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(element: np.ndarray, bag: np.ndarray, weight: np.ndarray, bags: int, registers: int) -> np.ndarray:
    """Register times, shape (bags, registers); inf where a bag is empty. Weights are positive numbers."""
    times = np.full(bags * registers, np.inf)
    if not len(element):
        return times.reshape(bags, registers)
    weight = weight.astype(np.float64)
    top = int(np.ceil(np.log2(max(1.0, weight.max())))) if len(weight) else 0
    parts = [np.flatnonzero(weight > (0.0 if k == 0 else 2.0 ** (k - 1))) for k in range(top + 1)]
    rows = np.concatenate(parts)
    stretch = np.repeat(np.arange(top + 1), [len(p) for p in parts])
    low = np.where(stretch == 0, 0.0, 2.0 ** (stretch - 1.0))
    width = np.where(stretch == 0, 1.0, low)
    seed = mix(element[rows] * np.uint64(0x9E3779B97F4A7C15) + stretch.astype(np.uint64))
    at, owner, limit = np.zeros(len(rows)), bag[rows], weight[rows]
    whole = limit >= low + width
    stop, turn = np.full(bags, np.inf), 0
    while len(at):
        seed = seed + _STEP
        draw = mix(seed)
        at = at - np.log(_uniform(draw)) / width
        alive = at < stop[owner]
        if not alive.all():
            seed, draw, at, owner, limit, low, width, whole = (x[alive] for x in (seed, draw, at, owner, limit, low, width, whole))
        second = mix(draw ^ _STEP)
        slot = owner * registers + ((second >> np.uint64(40)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        if whole.all():
            np.minimum.at(times, slot, at)
        else:
            seen = whole | (low + width * _uniform(mix(second)) < limit)
            np.minimum.at(times, slot[seen], at[seen])
        turn += 1
        # a stop that is out of date only lets points through that change nothing
        if turn < 4 or turn % 4 == 0:
            stop = times.reshape(bags, registers).max(axis=1)
    return times.reshape(bags, registers)


def code(times: np.ndarray) -> np.ndarray:
    """The fingerprint of each bag: eight bits a register, one after the other; shape (bags, registers), bytes.

    Equal registers give equal bytes, others differ in four of eight bits on average, so of two fingerprints about
    4 x registers x (1 - similarity) bits differ.
    """
    return (mix(times.view(np.uint64).reshape(times.shape)) >> np.uint64(56)).astype(np.uint8)


def longs(codes: np.ndarray) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers, shape (bags, registers / 8)."""
    return np.ascontiguousarray(codes).view(np.int64)


def segments(codes: np.ndarray, rows: int, turns: int) -> np.ndarray:
    """Code blocks: the fingerprint, and then ``turns`` - 1 permutations of it, cut into segments of ``rows`` registers.

    Shape (bags, turns x registers / rows). A block holds its segment's bits (8 a register) below its number.
    """
    n, registers = codes.shape
    out = []
    for turn in range(turns):
        # the registers in steps of a number without a common divisor
        step = 1 if not turn else next(k for k in range(registers * turn // turns + turn, 2 * registers) if math.gcd(k, registers) == 1)
        cut = codes[:, np.arange(registers) * step % registers].reshape(n, -1, rows).astype(np.int64)
        block = np.zeros(cut.shape[:2], np.int64)
        for j in range(rows):
            block = (block << 8) | cut[:, :, j]
        out.append(block + ((turn * (registers // rows) + np.arange(registers // rows, dtype=np.int64)) << (8 * rows)))
    return np.concatenate(out, axis=1)
