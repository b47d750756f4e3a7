"""Token-sort similarity of texts: ``2 * LCS / (len a + len b)`` over sorted tokens.

Sorting tokens is plain column work. The longest common subsequence has no built-in, so it is
computed on Arrow batches with bit-parallel arithmetic: one machine word holds 64 positions
of a text, and one numpy operation advances many pairs at once.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip, text_or_blank

WORD = 64
PAIRS_PER_STEP = 1 << 13

# Executors get the kernel with the task, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def comparison_text(maker: Column, title: Column) -> Column:
    """``maker title`` in lower case with its tokens sorted."""
    joined = F.lower(F.concat(text_or_blank(maker), F.lit(" "), text_or_blank(title)))
    return sorted_tokens(strip(joined))


def sorted_tokens(c: Column) -> Column:
    tokens = F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")
    return F.array_join(F.sort_array(tokens), " ")


class Encoded:
    """Texts as rows of alphabet positions, padded with the position after the last."""

    def __init__(self, texts, alphabet: np.ndarray):
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        width = int(self.lengths.max(initial=0))
        other = len(alphabet)
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        place = np.full(int(max(chars.max(initial=0), alphabet.max(initial=0))) + 1, other, dtype=np.int32)
        place[alphabet] = np.arange(other)
        chars = place[chars]
        small = np.int16 if other < 32_767 else np.int32
        self.codes = np.full((len(self.lengths), max(width, 1)), other, dtype=small)
        self.codes[np.arange(max(width, 1)) < self.lengths[:, None]] = chars

    def counts(self, size: int) -> np.ndarray:
        """Occurrences of each alphabet character per text."""
        rows = np.repeat(np.arange(len(self.codes)), self.codes.shape[1])
        table = np.bincount(rows * (size + 1) + self.codes.ravel(), minlength=len(self.codes) * (size + 1))
        longest = self.codes.shape[1]
        kind = np.uint8 if longest < 256 else np.uint16 if longest < 65_536 else np.uint32
        return table.reshape(len(self.codes), size + 1)[:, :size].astype(kind)


def alphabet_of(texts) -> np.ndarray:
    joined = "".join(texts).encode("utf-32-le")
    return np.unique(np.frombuffer(joined, dtype=np.uint32))


def position_masks(enc: Encoded, size: int, rows: slice = slice(None)) -> np.ndarray:
    """Bit ``i`` of word ``w`` of ``[text, char]``: the char stands at position ``64 w + i``; for the texts of ``rows``."""
    codes = enc.codes[rows, : max(1, enc.lengths[rows].max(initial=0))]
    words = max(1, -(-codes.shape[1] // WORD))
    # word by word in memory, as the kernel reads one word of many texts at a time
    masks = np.moveaxis(np.zeros((words, len(codes), size + 1), dtype=np.uint64), 0, 2)
    at = np.arange(len(codes))
    for position in range(codes.shape[1]):
        bit = np.uint64(1) << np.uint64(position % WORD)
        masks[at, codes[:, position], position // WORD] |= bit
    masks[:, size, :] = 0
    return masks


def common_subsequence(masks: np.ndarray, right: Encoded, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common subsequence of left text ``a[i]`` and right text ``b[i]`` for every i."""
    result = np.zeros(len(a), dtype=np.int64)
    order = np.argsort(-right.lengths[b], kind="stable")
    for start in range(0, len(order), PAIRS_PER_STEP):
        part = order[start : start + PAIRS_PER_STEP]
        result[part] = _common_subsequence(masks, right, a[part], b[part])
    return result


def _common_subsequence(masks, right, a, b):
    words, chars = masks.shape[2], masks.shape[1]
    planes = np.ascontiguousarray(np.moveaxis(masks, 2, 0)).reshape(words, -1)
    state = np.full((words, len(a)), np.iinfo(np.uint64).max, dtype=np.uint64)
    lengths = right.lengths[b]
    codes, base = np.ascontiguousarray(right.codes[b].T), a * chars
    for step in range(int(lengths[0]) if len(lengths) else 0):
        active = int(np.searchsorted(-lengths, -step, side="left"))
        place = base[:active] + codes[step, :active]
        carry = None
        for w in range(words):
            v = state[w, :active]
            met = planes[w].take(place)
            met &= v
            added = v + met
            if words > 1:
                over = added < v
                if carry is not None:
                    added += carry
                    over |= added < carry
                carry = over
            v -= met
            v |= added
    return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def pair_scores(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Similarity of two aligned series of sorted texts; 0 where either is blank or NULL."""
    a, b = left.fillna(""), right.fillna("")
    left_texts, left_at = np.unique(a.to_numpy(dtype=object), return_inverse=True)
    right_texts, right_at = np.unique(b.to_numpy(dtype=object), return_inverse=True)
    alphabet = alphabet_of(left_texts)
    le, re = Encoded(left_texts, alphabet), Encoded(right_texts, alphabet)
    lcs = common_subsequence(position_masks(le, len(alphabet)), re, left_at, right_at)
    la, lb = le.lengths[left_at], re.lengths[right_at]
    return np.where((la > 0) & (lb > 0), 2.0 * lcs / np.maximum(la + lb, 1), 0.0)


def sorted_similarity(a: Column, b: Column, pairs=None) -> Column:
    """Similarity in 0..1 of two texts whose tokens are sorted; ``pairs``, an accumulator, counts them."""

    @F.pandas_udf(T.DoubleType())
    def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
        size = 4096
        parts = [
            pair_scores(left.iloc[i : i + size], right.iloc[i : i + size]) for i in range(0, len(left), size)
        ]
        if pairs is not None:
            pairs.add(len(left))
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return similarity(a, b)


def token_sort_similarity(a: Column, b: Column) -> Column:
    """Similarity in 0..1 of two texts, whatever the order of their tokens."""
    return sorted_similarity(sorted_tokens(F.lower(a)), sorted_tokens(F.lower(b)))


# What a key's tag says below the length of its text.
LESS, UPPER, TAG_BITS = 1, 2, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit values (the last steps of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def near_keys(texts: list[str], near: float, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys under which texts with a score of ``near`` or more meet: position of the text, key, and tag of each.

    A text is the set of its numbered characters, each with its number among equal ones. Texts with such a score differ in
    at most ``D = (1 - near) * (length + length)`` of them. The characters are dealt into ``D / 2 + 1`` groups by their
    hash, so in some group at most one differs, and it is in one text only. A key is a group's combined hash, or that of the
    group without one character (``LESS``): one of the two is the whole group. ``D`` follows the length band, whose bounds
    are ``factor`` apart; a text has keys for its own band and, as the longer one (``UPPER``), for the band below.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), lengths)
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sorted_ = np.sort((text.astype(np.uint64) << np.uint64(21)) | chars)  # the positions in ``text`` stay as they are
    new = np.ones(len(sorted_), dtype=bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    at = np.arange(len(sorted_))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    golden = np.uint64(0x9E3779B97F4A7C15)
    hashes = _mixed(((sorted_ & np.uint64((1 << 21) - 1)) + np.uint64(1)) * golden + _mixed(number.astype(np.uint64)))
    own = np.floor(np.log(np.maximum(lengths, 1)) / np.log(factor)).astype(np.int64)
    found = []
    for band, upper in ((own, 0), (own - 1, UPPER)):
        most = np.floor(factor ** (band + 1.0) * (1.0 + factor) * (1.0 - near) + 1e-6)
        groups = (most // 2).astype(np.int64) + 1
        first = np.cumsum(groups) - groups
        of = np.repeat(np.arange(len(texts)), groups)
        salt = _mixed((band[of].astype(np.uint64) << np.uint64(32)) + (np.arange(len(of)) - first[of]).astype(np.uint64))
        group = first[text] + (hashes % groups[text].astype(np.uint64)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        begins = np.flatnonzero(np.diff(group[order], prepend=-1))
        whole = np.zeros(len(of), dtype=np.uint64)
        whole[group[order][begins]] = np.bitwise_xor.reduceat(hashes[order], begins) if len(begins) else 0
        tags = (lengths << TAG_BITS) | upper
        found.append((of, _mixed(whole ^ salt), tags[of]))
        found.append((text, _mixed(whole[group] ^ hashes ^ salt[group]), tags[text] | LESS))
    row, key, tag = (np.concatenate(x) for x in zip(*found))
    return row, key.view(np.int64), tag.astype(np.int32)


class Shared:
    """Upper bounds of common subsequences: the characters that texts share, whatever their order.

    Bit ``(c, k)`` of a text says that it has more than ``k`` times the character ``c``, so the bits two texts share are as
    many as the characters they share. Only the characters of the left texts count; the rarer ones beyond ``KINDS`` are
    taken for one, and where the bits are more than ``BITS`` the counts are compared instead. Both keep memory bounded and
    never give less than the characters shared.
    """

    KINDS, BITS, CELLS = 255, 1024, 1 << 22

    def __init__(self, left: Encoded, right: Encoded, size: int):
        often = np.bincount(left.codes.ravel(), minlength=size + 1)[:size]
        self.kind = np.full(size + 1, -1, dtype=np.int64)
        self.kind[np.argsort(-often, kind="stable")] = np.minimum(np.arange(size), self.KINDS)
        self.kinds = min(size, self.KINDS + 1)
        self.most = np.zeros(self.kinds, dtype=np.int64)
        for start, part in self._counts(left):
            np.maximum(self.most, part.max(axis=0), out=self.most)
        self.type = np.min_scalar_type(int(self.most.sum()))
        self.as_bits = self.most.sum() <= self.BITS
        self.left, self.right = self._packed(left), self._packed(right)

    def _counts(self, enc: Encoded):
        """Runs of rows with the occurrences of each kind of character."""
        rows = max(1, self.CELLS // max(enc.codes.shape[1], self.kinds + 1))
        for start in range(0, len(enc.codes), rows):
            kind = self.kind[enc.codes[start : start + rows]]
            n = len(kind)
            place = np.arange(n)[:, None] * (self.kinds + 1) + np.where(kind < 0, self.kinds, kind)
            table = np.bincount(place.ravel(), minlength=n * (self.kinds + 1))
            yield start, table.reshape(n, self.kinds + 1)[:, : self.kinds]

    def _packed(self, enc: Encoded) -> np.ndarray:
        """One row per word of bits, or per kind of character, one column per text."""
        words = max(1, -(-int(self.most.sum()) // WORD))
        out = np.zeros((words, len(enc.codes)), np.uint64) if self.as_bits else np.zeros((self.kinds, len(enc.codes)), self.type)
        before = np.cumsum(self.most) - self.most
        for start, counts in self._counts(enc):
            rows = slice(start, start + len(counts))
            if not self.as_bits:
                out[:, rows] = np.minimum(counts, self.most).T  # beyond it nothing is shared
                continue
            bits = np.zeros((len(counts), words * WORD), dtype=np.uint8)
            for c in range(self.kinds):
                bits[:, before[c] : before[c] + self.most[c]] = counts[:, c, None] > np.arange(self.most[c])
            out[:, rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).T
        return out

    def of(self, rows: slice, side: tuple[int, int] = (16, 4096)) -> np.ndarray:
        """Characters that each left text of ``rows`` shares with each right text, in pieces that fit a cache."""
        left = self.left[:, rows]
        out = np.zeros((left.shape[1], self.right.shape[1]), dtype=self.type)
        for i in range(0, out.shape[0], side[0]):
            for j in range(0, out.shape[1], side[1]):
                into = out[i : i + side[0], j : j + side[1]]
                met, n = np.empty(into.shape, left.dtype), np.empty(into.shape, np.uint8)
                for a, b in zip(left[:, i : i + side[0]], self.right[:, j : j + side[1]], strict=True):
                    if self.as_bits:
                        into += np.bitwise_count(np.bitwise_and(a[:, None], b, out=met), out=n)
                    else:
                        into += np.minimum(a[:, None], b, out=met)
        return out


def least_shared(score: float, total: np.ndarray) -> np.ndarray:
    """The least ``n`` with ``2.0 * n / total >= score``, in the arithmetic of the scores."""
    n, total = np.ceil(score * total / 2.0), np.maximum(total, 1)
    n -= (n > 0) & (2.0 * (n - 1) / total >= score)
    return n + (2.0 * n / total < score)


def _reaching(table: np.ndarray, need: np.ndarray, side: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the few values that reach what their column needs, eight looked at in one."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for j in range(0, table.shape[1], side):
        hits = (table[:, j : j + side] >= need[j : j + side]).ravel()
        whole = len(hits) // 8 * 8
        near = (np.flatnonzero(hits[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
        places = np.concatenate([near[hits[near]], whole + np.flatnonzero(hits[whole:])])
        a, b = np.divmod(places, min(side, table.shape[1] - j))
        found.append((a, b + j))
    return tuple(np.concatenate(x) for x in zip(*found))


LEVEL = 0.05


def best_in_tile(ours: list[str], theirs: list[str], stores: list[np.ndarray],
                 offers: list[np.ndarray], threshold: float, done: list[np.ndarray], pairs=None, block: int = 128):
    """Best offer per (our text, store) among the texts of one tile, for stores that aren't ``done`` for our text.

    ``stores[j]`` and ``offers[j]`` list the stores that carry text ``j`` and their earliest
    offer. The shared-character bound is never below the score, so pairs are scored level by level from the
    highest bounds down, and a pair whose bound is under what our text has already reached in
    every open store that carries the other text cannot win and is not scored; a text whose open stores have all reached a
    level goes no further down. Yields ``(our position, store, score, offer)`` arrays.
    """
    alphabet = alphabet_of(ours)
    size = len(alphabet)
    # texts of one length need the same number of characters at a level
    by_length = np.argsort([len(t) for t in ours], kind="stable")
    ours, done = [ours[i] for i in by_length], [done[i] for i in by_length]
    left, right = Encoded(ours, alphabet), Encoded(theirs, alphabet)
    bounds = Shared(left, right, size)
    carried = np.array([len(s) for s in stores], dtype=np.int64)
    first = np.cumsum(carried) - carried
    store_ids, all_stores = np.unique(np.concatenate(stores), return_inverse=True)
    all_offers = np.concatenate(offers)
    totals = np.arange(left.lengths.max(initial=0) + right.lengths.max(initial=0) + 1)
    most = np.iinfo(bounds.type).max  # one that needs more is looked at early

    def of_stores(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each (text of ``b``, store that carries it): the position in ``b``, and that among all offers."""
        times = carried[b]
        index = np.repeat(first[b] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        return np.repeat(np.arange(len(b)), times), index

    for start in range(0, len(ours), block):
        rows = slice(start, min(start + block, len(ours)))
        wanted = np.array([~np.isin(store_ids, d) for d in done[rows]])
        if not wanted.any():
            continue
        if pairs is not None:
            carries = np.zeros((len(store_ids), len(theirs)), dtype=np.float32)
            carries[all_stores, np.repeat(np.arange(len(theirs)), carried)] = 1
            pairs.add(int((wanted.astype(np.float32) @ carries > 0).sum()))
        shared, lengths = bounds.of(rows), left.lengths[rows]
        masks = position_masks(left, size, rows)
        reached = np.where(wanted, 0.0, np.inf)
        won = []

        def score(a: np.ndarray, b: np.ndarray, common: np.ndarray) -> None:
            """Score the pairs that can still win, best bounds first."""
            total = lengths[a] + right.lengths[b]  # noqa: B023
            bound = 2.0 * common / total
            order = np.argsort(-bound, kind="stable")
            a, b, bound, total = a[order], b[order], bound[order], total[order]
            done_, step = 0, 2048
            while done_ < len(a):
                part = slice(done_, done_ + step)
                done_, step = done_ + step, 2 * step
                may = np.flatnonzero(bound[part] >= reached.min(axis=1)[a[part]]) + part.start  # noqa: B023
                may = may[carried[b[may]] > 0]
                if not len(may):
                    continue
                at, index = of_stores(b[may])
                lowest = reached.ravel()[(a[may] * len(store_ids))[at] + all_stores[index]]  # noqa: B023
                may = may[bound[may] >= np.minimum.reduceat(lowest, np.cumsum(carried[b[may]]) - carried[b[may]])]
                if not len(may):
                    continue
                ours_, theirs_ = a[may], b[may]
                points = 2.0 * common_subsequence(masks, right, ours_, theirs_) / total[may]  # noqa: B023
                good = points >= threshold
                ours_, theirs_, points = ours_[good], theirs_[good], points[good]
                at, index = of_stores(theirs_)
                ours_, points, store, offer = ours_[at], points[at], all_stores[index], all_offers[index]
                better = points >= reached[ours_, store]  # noqa: B023
                ours_, points, store, offer = ours_[better], points[better], store[better], offer[better]
                np.maximum.at(reached, (ours_, store), points)  # noqa: B023
                won.append((ours_, store, points, offer))  # noqa: B023

        runs = [slice(x[0], x[-1] + 1) for x in np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(lengths)) + 1)]
        above = np.inf  # what is left has bounds under it
        for level in [*np.arange(1.0, threshold + 1e-9, -LEVEL), threshold]:
            lowest = reached.min(axis=1)
            shared[lowest >= above] = 0
            if (lowest >= above).all():
                break
            found = []
            for run in runs:
                if lowest[run].min() < above:
                    need = least_shared(max(level, lowest[run].min()), totals)
                    need = np.clip(need, 1, most).astype(shared.dtype)[lengths[run.start] + right.lengths]
                    a, b = _reaching(shared[run], need)
                    found.append((a + run.start, b))
            a, b = (np.concatenate(x) for x in zip(*found))
            common, shared[a, b] = shared[a, b], 0  # not again at a lower level
            score(a, b, common)
            above = level
        if not won:
            continue
        a, store, points, offer = (np.concatenate(x) for x in zip(*won))
        order = np.lexsort((offer, -points, store, a))
        a, store, points, offer = a[order], store[order], points[order], offer[order]
        lead = np.ones(len(a), dtype=bool)
        lead[1:] = (a[1:] != a[:-1]) | (store[1:] != store[:-1])
        yield by_length[a[lead] + start], store_ids[store[lead]], points[lead], offer[lead]
