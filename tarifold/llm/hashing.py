"""Words and shingles of many texts at once, as numpy arrays of hashes. Runs inside tasks, a batch at a time."""

from __future__ import annotations

import numpy as np

U = np.uint64
_RANDOM = np.random.default_rng(20240229)
#: A random value for each byte (A-Z has that of a-z) and odd multipliers: a polynomial hash modulo 2**64.
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
FACTORS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
#: Texts are hashed in pieces of about this many bytes, which bounds the arrays.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ...; those of usual chunks are kept."""
    kept = _POWERS.get(int(base))
    if kept is None or len(kept) < n:
        out = np.full(max(n, CHUNK + CHUNK // 8), base, dtype=np.uint64)
        out[0] = 1
        kept = np.cumprod(out, dtype=np.uint64)
        if len(kept) <= 2 * CHUNK:
            _POWERS[int(base)] = kept
    return kept[:n]


def chunks(texts: list[bytes], limit: int = CHUNK):
    """(first index, texts) of runs of about ``limit`` bytes; a longer text is a run by itself."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, texts[start:]


def pair_chunks(pairs: list[tuple[bytes, bytes]], limit: int = CHUNK):
    """(first index, pairs) of runs of about ``limit`` bytes of both texts; a longer pair is a run by itself."""
    start, held = 0, 0
    for i, (a, b) in enumerate(pairs):
        if held and held + len(a) + len(b) > limit:
            yield start, pairs[start:i]
            start, held = i, 0
        held += len(a) + len(b)
    if start < len(pairs):
        yield start, pairs[start:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more entry than texts)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    borders = np.concatenate([[0], np.cumsum(lengths)])
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = IS_BLANK[raw]
    edge = np.diff(blank.astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[U(0)], np.cumsum(BYTE_VALUES[raw] * powers(BASE, len(raw)), dtype=np.uint64)])
    words = mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, len(raw) + 1)[starts])
    return words, np.searchsorted(starts, borders)


def shingle_sets(texts: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 48-bit shingle hashes of each text, one after the other, and where each begins.

    A text of fewer than ``n`` words has one shingle of them all; one without words has none.
    """
    words, at = word_hashes(texts)
    counts = np.diff(at)
    runs = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    total = int(runs.sum())
    doc = np.repeat(np.arange(len(texts)), runs)
    first = at[:-1][doc] + (np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs))
    size = np.minimum(counts[doc], n)
    h = np.zeros(total, dtype=np.uint64)
    for j in range(n):
        inside = size > j
        h[inside] += words[first[inside] + j] * FACTORS[j] if not inside.all() else words[first + j] * FACTORS[j]
    h = mix(h + size.astype(np.uint64))
    return _sorted_by_text(h, doc, len(texts))


def _sorted_by_text(h: np.ndarray, doc: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes = [], []
    for lo in range(0, max(texts, 1), 1 << 15):  # 16 bits of a sort key say which text, 48 are the shingle
        inside = slice(*np.searchsorted(doc, [lo, min(lo + (1 << 15), texts)]))
        key = np.sort(((doc[inside] - lo).astype(np.uint64) << U(48)) | (h[inside] >> U(16)))
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        parts.append(key & U((1 << 48) - 1))
        sizes.append(np.bincount((key >> U(48)).astype(np.int64), minlength=min(1 << 15, texts - lo)) if texts > lo else np.zeros(0, np.int64))
    sizes = np.concatenate(sizes)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
