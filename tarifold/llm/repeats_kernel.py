"""Fingerprints of byte strings at content-chosen positions, many texts at a time. Runs inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .hashing import BASE, BASE_INVERSE, U, mix, powers

#: Each byte its own random value; case matters here.
VALUES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
#: Bits of a position within a run of texts; one text has less than 2**31 bytes.
PLACE_BITS = 31


class Prints:
    """Prefix sums of a run of bytes: the fingerprint of any part of it in constant time."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate([[U(0)], np.cumsum(VALUES[raw] * powers(BASE, len(raw)), dtype=np.uint64)])
        self.back = powers(BASE_INVERSE, len(raw) + 1)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start])


@dataclass
class Anchors:
    """Windows of ``span`` bytes by the position they choose: windows [first, last] of a text choose ``place``."""

    text: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for each i that fits."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(prints: Prints, borders: np.ndarray, span: int, gram: int) -> Anchors:
    """Each window of ``span`` bytes chooses the ``gram``-byte string in it with the smallest fingerprint, the first of
    equal ones. Equal windows choose the same place in them. ``borders``: where texts begin, and the end."""
    total = int(borders[-1])
    none = np.zeros(0, np.int64)
    if total < span:
        return Anchors(none, none, none, none)
    place = np.arange(total - gram + 1)
    keyed = (prints.of(place, gram) >> U(PLACE_BITS) << U(PLACE_BITS)) | place.astype(np.uint64)
    chosen = (sliding_minimum(keyed, span - gram + 1) & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))[:len(chosen)]
    inside = np.arange(len(chosen)) + span <= borders[text + 1]
    at = np.flatnonzero(inside)
    text, chosen = text[at], chosen[at]
    begins = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    ends = np.append(begins[1:], len(at)) - 1 if len(begins) else none
    return Anchors(text[begins], chosen[begins], at[begins], at[ends])
