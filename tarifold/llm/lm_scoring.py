"""Language-model scores from a hierarchical Pitman-Yor model of word pairs, seated by Gibbs sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hashing import FACTORS, U, chunks, mix, word_hashes

#: The end of a text, as a word; it also stands before the first word.
END = U(0x5EED0FE2D0F7E875)
LOW40 = U((1 << 40) - 1)
BLOCK_BITS = 11
BUCKET_TEXT_BYTES = 8 << 20
#: Dishes of up to this many customers are re-seated at once from the exact conditional; larger ones in batches.
EXACT = 64
BURN, SAMPLES = 1, 4
STRENGTH = 1.0
#: Texts (at most this long) whose words are counted to find contexts so common that their restaurant is split.
HOT_SAMPLE, HOT_CHARS, HOT_SHARE = 2000, 20_000, 1 / 256


def stirling(discount: float, n: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: ways to seat c customers at t tables, weighted by the discount."""
    table = np.full((n + 1, n + 2), -np.inf)
    table[1, 1] = 0.0
    t = np.arange(n + 2)
    for c in range(1, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(c - discount * t > 0, np.log(np.maximum(c - discount * t, 1e-300)) + table[c], -np.inf)
        table[c + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], table[c][:-1]]))
    return table


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, table: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """One Gibbs step: new numbers of tables for dishes, given what opening a table weighs for each."""
    tables = np.minimum(customers, 1)
    small = np.flatnonzero((customers > 1) & (customers <= EXACT))
    for c in np.unique(customers[small]):
        at = small[customers[small] == c]
        for part in np.array_split(at, max(1, len(at) * int(c) >> 20)):
            weight = table[c, 1:c + 1] + np.log(opening[part])[:, None] * np.arange(1, c + 1)
            tables[part] = 1 + (weight + random.gumbel(size=weight.shape)).argmax(axis=1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        c, seated, t = customers[large], np.ones(len(large), np.int64), np.ones(len(large), np.int64)
        while (seated < c).any():
            step = np.minimum(np.maximum(seated // 8, 1), c - seated)
            t += random.binomial(step, opening[large] / (opening[large] + seated - discount * t))
            seated += step
        tables[large] = t
    return tables


def discount_of(counts: np.ndarray) -> float:
    """From how many dishes have one and two customers."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5


COUNT_COLUMNS = ["bucket", "block", "keys", "runs", "others", "counts"]


class Tokens:
    """The words of a block of texts, its distinct words and its distinct pairs (context, word)."""

    def __init__(self, texts: list[bytes]):
        parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, part in chunks(texts):
            words, at = word_hashes(part)
            counts = np.diff(at)
            token = np.full(len(words) + len(part), END, dtype=np.uint64)
            token[np.arange(len(words)) + np.repeat(np.arange(len(part)), counts)] = words
            parts.append(token)
            sizes.append(counts + 1)
        self.sizes = np.concatenate(sizes)
        token = np.concatenate(parts)
        # distinct words come sorted by their low 40 bits, so those of one bucket are in a fixed order
        self.words, self.word = np.unique(token, return_inverse=True)
        before = np.empty_like(self.word)
        if len(token):
            before[1:] = self.word[:-1]
            before[np.concatenate([[0], np.cumsum(self.sizes)[:-1]])] = int(np.searchsorted(self.words, END))
        self.pairs, self.pair = np.unique(before * len(self.words) + self.word, return_inverse=True)
        self.left, self.right = self.pairs // max(len(self.words), 1), self.pairs % max(len(self.words), 1)

    def buckets(self, n: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word and of each pair: a pair is with its context, unless that is a hot one."""
        low = self.words & LOW40
        word = (low % U(n)).astype(np.int64)
        split = np.isin(low, hot)[self.left] if len(self.words) else np.zeros(0, bool)
        spread = (mix(low[self.left] * FACTORS[9] + low[self.right] * FACTORS[10]) % U(n)).astype(np.int64) if len(self.left) else word[:0]
        return word, np.where(split, spread, word[self.left]) if len(self.left) else word[:0]


def _five(x: np.ndarray) -> bytes:
    """40-bit numbers in five bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(b: bytes) -> np.ndarray:
    wide = np.zeros((len(b) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(np.uint64)


def _runs(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def _collect(n: int, hot: np.ndarray, of_words: bool):
    """Per block and bucket: words and their training counts, or contexts and their words and counts."""

    def block_rows(block: int, texts: list[bytes], train: np.ndarray) -> pd.DataFrame:
        t = Tokens(texts)
        learn = np.repeat(train, t.sizes)
        word_count = np.bincount(t.word[learn], minlength=len(t.words)).astype(np.uint32)
        pair_count = np.bincount(t.pair[learn], minlength=len(t.pairs)).astype(np.uint32)
        word_bucket, pair_bucket = t.buckets(n, hot)
        low = t.words & LOW40
        rows = []
        if of_words:
            order, ends = _runs(word_bucket, n)
            for b in np.flatnonzero(np.diff(ends)):
                at = order[ends[b]:ends[b + 1]]
                rows.append((int(b), block, t.words[at].tobytes(), b"", b"", word_count[at].tobytes()))
            return pd.DataFrame(rows, columns=COUNT_COLUMNS)
        order, ends = _runs(pair_bucket, n)
        for b in np.flatnonzero(np.diff(ends)):
            at = order[ends[b]:ends[b + 1]]  # sorted by context, then word
            left = t.left[at]
            own = np.flatnonzero(np.diff(left, prepend=-1))
            runs = np.diff(np.append(own, len(at))).astype(np.uint32)
            rows.append((int(b), block, _five(low[left[own]]), runs.tobytes(), _five(low[t.right[at]]), pair_count[at].tobytes()))
        return pd.DataFrame(rows, columns=COUNT_COLUMNS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush():
            whole = pd.concat(held)
            return block_rows(int(whole["block"].iloc[0]), [(t or "").encode("utf-8", "replace") for t in whole["text"]], whole["train"].to_numpy(bool))

        for batch in batches:  # rows of a block follow each other; a block may cross batches
            for block in batch["block"].unique():
                if held and int(held[0]["block"].iloc[0]) != block:
                    yield flush()
                    held = []
                held.append(batch[batch["block"] == block])
        if held:
            yield flush()

    return run


def _seat_pairs(n: int, seed: int, hot: np.ndarray):
    """Restaurants of one bucket: what each pair and each context is worth, back to the blocks, and tables for the parent."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        frame = frame.sort_values("block")
        sizes = frame["counts"].str.len().to_numpy() // 4
        left = np.repeat(_from_five(b"".join(frame["keys"])), np.frombuffer(b"".join(frame["runs"]), np.uint32))
        right = _from_five(b"".join(frame["others"]))
        count = np.frombuffer(b"".join(frame["counts"]), np.uint32).astype(np.int64)
        contexts, u = np.unique(left, return_inverse=True)
        dishes, w = np.unique(right, return_inverse=True)
        cells, back = np.unique(u * len(dishes) + w, return_inverse=True)
        c = np.bincount(back, weights=count, minlength=len(cells)).astype(np.int64)
        cu, cw = cells // len(dishes), cells % len(dishes)
        known = c > 0
        d = discount_of(c[known])
        table = stirling(d)
        scale = np.where(np.isin(contexts, hot), n, 1)  # a hot restaurant is here in part
        random = np.random.default_rng([seed, bucket])
        tables, mean = known.astype(np.int64), np.zeros(len(cells))
        for sweep in range(BURN + SAMPLES):
            total = np.bincount(cu, weights=tables, minlength=len(contexts)) * scale
            of_dish = np.bincount(cw, weights=tables, minlength=len(dishes))
            some = max(of_dish.sum(), 1.0)
            # this bucket's tables stand for the parent restaurant while it is sampled
            parent = (np.maximum(of_dish - d, 0) + d * (of_dish > 0).sum() / max(len(dishes), 1)) / some
            tables = seat(c, np.maximum((STRENGTH + d * total[cu]) * parent[cw], 1e-12), d, table, random)
            if sweep >= BURN:
                mean += tables / SAMPLES
        worth = (c - d * mean).astype(np.float32)
        back_off = np.bincount(cu, weights=d * mean, minlength=len(contexts)).astype(np.float32)
        to_parent = np.bincount(cw, weights=mean, minlength=len(dishes)).astype(np.float32)
        rows = []
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for i, block in enumerate(frame["block"]):
            at = slice(ends[i], ends[i + 1])
            own = np.flatnonzero(np.diff(u[at], prepend=-1))  # one value for each context of the block here
            rows.append((bucket, int(block), "pairs", worth[back[at]].tobytes(), back_off[u[at][own]].tobytes()))
        for kind, keys, values in (("tables", dishes, to_parent), ("hot", contexts[scale > 1], back_off[scale > 1])):
            goal = (keys % U(n)).astype(np.int64)
            order, ends = _runs(goal, n)
            for b in np.flatnonzero(np.diff(ends)):
                at = order[ends[b]:ends[b + 1]]
                at = at[values[at] > 0]
                rows.append((int(b), -1, kind, _five(keys[at]), values[at].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "block", "kind", "first", "second"])

    return run


def _seat_words(seed: int, hot_words: np.ndarray):
    """The parent restaurant's dishes of one bucket: counts, tables and back-off of its words, back to the blocks."""

    def run(key: tuple, asked: pd.DataFrame, tables: pd.DataFrame) -> pd.DataFrame:
        bucket = int(key[0])
        asked = asked.sort_values("block")
        sizes = asked["counts"].str.len().to_numpy() // 4
        words = np.frombuffer(b"".join(asked["keys"]), np.uint64)
        count = np.frombuffer(b"".join(asked["counts"]), np.uint32).astype(np.int64)
        distinct, back = np.unique(words, return_inverse=True)
        c = np.bincount(back, weights=count, minlength=len(distinct)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        low = distinct & LOW40
        order = np.argsort(low)

        def summed(kind: str) -> np.ndarray:
            some = tables[tables["kind"] == kind]
            keys = _from_five(b"".join(some["first"]))
            values = np.frombuffer(b"".join(some["second"]), np.float32).astype(np.float64)
            sums = np.zeros(len(distinct))
            if len(keys) and len(distinct):
                place = np.minimum(np.searchsorted(low[order], keys), len(low) - 1)
                same = low[order][place] == keys
                np.add.at(sums, order[place[same]], values[same])
            return sums

        customers, hot = summed("tables"), summed("hot")
        whole = np.where(c > 0, np.maximum(np.rint(customers), 1), 0).astype(np.int64)
        d = discount_of(whole[whole > 0])
        known = int((c > 0).sum())
        random = np.random.default_rng([seed, bucket, 1])
        mean, table, t = np.zeros(len(distinct)), stirling(d), np.minimum(whole, 1)
        for sweep in range(BURN + SAMPLES):  # opening a table: the whole vocabulary is about this many times this bucket's
            t = seat(whole, np.full(len(distinct), max((STRENGTH + d * t.sum()) / (known + 1), 1e-12)), d, table, random)
            if sweep >= BURN:
                mean += t / SAMPLES
        worth = (whole - d * mean).astype(np.float32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        width = np.uint32 if not len(c) or c.max() < 1 << 32 else np.int64
        rows = []
        for i, block in enumerate(asked["block"]):
            at = back[ends[i]:ends[i + 1]]
            common = np.isin(low[at], hot_words)  # the back-off of other contexts comes with their pairs
            values = np.concatenate([worth[at], hot[at][common].astype(np.float32)])
            rows.append((bucket, int(block), "words", c[at].astype(width).tobytes(), values.tobytes(), 0, 0, 0.0, 0.0))
        rows.append((bucket, -1, "sums", b"", b"", int(c.sum()), known, float(whole.sum()), float((d * mean).sum())))
        return pd.DataFrame(rows, columns=["bucket", "block", "kind", "first", "second", "n", "v", "customers", "back_off"])

    return run


def _score(n: int, hot: np.ndarray, sums: dict):
    total, vocabulary = sums["n"] or 0, sums["v"] or 0
    parent_all = STRENGTH + (sums["customers"] or 0.0)
    parent_base = (STRENGTH + (sums["back_off"] or 0.0)) / (vocabulary + 1)

    def run(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("uid")
        t = Tokens([(x or "").encode("utf-8", "replace") for x in docs["text"]])
        word_bucket, pair_bucket = t.buckets(n, hot)
        count, worth, back_off = np.zeros(len(t.words), np.int64), np.zeros(len(t.words)), np.zeros(len(t.words))
        pair_worth = np.zeros(len(t.pairs))
        word_order, word_ends = _runs(word_bucket, n)
        pair_order, pair_ends = _runs(pair_bucket, n)
        is_hot = np.isin(t.words & LOW40, hot)
        for b, kind, first, second in zip(answers["bucket"], answers["kind"], answers["first"], answers["second"], strict=True):
            if kind == "words":
                at = word_order[word_ends[b]:word_ends[b + 1]]
                both = np.frombuffer(second, np.float32)
                count[at] = np.frombuffer(first, np.uint32 if len(first) == 4 * len(at) else np.int64)
                worth[at], back_off[at[is_hot[at]]] = both[:len(at)], both[len(at):]
            else:
                at = pair_order[pair_ends[b]:pair_ends[b + 1]]
                pair_worth[at] = np.frombuffer(first, np.float32)
                # contexts go by the sorted low bits there and by their order here: both by first appearance in the run
                left = t.left[at]
                own = np.flatnonzero(np.diff(left, prepend=-1))
                values = np.frombuffer(second, np.float32)
                cold = ~is_hot[left[own]]
                back_off[left[own][cold]] = values[cold]
        parent = (worth + parent_base) / parent_all
        p = (pair_worth + (STRENGTH + back_off[t.left]) * parent[t.right]) / (STRENGTH + count[t.left])
        log_pair = np.log10(p)
        log_base = np.log10((count + 0.1) / (total + 0.1 * (vocabulary + 1)))
        begins = np.cumsum(t.sizes) - t.sizes
        return pd.DataFrame({
            "uid": docs["uid"], "n_tokens": t.sizes, "n_known": np.add.reduceat((count > 0)[t.word].astype(np.int64), begins),
            "base_score": np.add.reduceat(log_base[t.word], begins), "score": np.add.reduceat(log_pair[t.pair], begins),
        })

    return run


def _common_words(texts: list[str]) -> np.ndarray:
    counts: dict[int, int] = {}
    t = Tokens([x.encode("utf-8", "replace") for x in texts])
    n = np.bincount(t.word, minlength=len(t.words))
    counts = t.words[n >= max(HOT_SHARE * n.sum(), 1)] if len(n) else t.words
    return np.sort(np.unique(np.concatenate([counts, np.array([END], np.uint64)]) & LOW40))


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A hierarchical Pitman-Yor model of word pairs, learnt from all rows where ``train`` holds: each word is a restaurant whose
    dishes are the words that follow it, all of them share the unigram restaurant as parent, and that has a uniform base
    over the vocabulary and one unknown word. Seatings are sampled by Gibbs: for each dish of each restaurant a new number of
    tables from its conditional (exact up to 64 customers), ``SAMPLES`` sweeps after ``BURN``; predictive
    probabilities use the averages. Scores are log10 probabilities of the words and the end of a text.

    Blocks of texts send their distinct words and pairs, packed by bucket, and get values back in the order
    sent; each restaurant lives in one bucket, but those of the commonest words (found in a bounded sample, which only decides the
    layout) are spread. While sampling, a bucket's own tables stand for the parent; the final parent has
    the tables of all. Hashes: 64 bits for counts, 40 bits of them within pairs.

    NULL texts are empty: one token, the end. Rows with equal ids are texts like others. No training rows: nothing is known, and
    all scores are those of the uniform base. Empty table: empty result. Each text has the same score wherever it
    stands. ``docs`` is read several times and should be a stored table, whose rows keep their order.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"),
    ).withColumn("block", F.shiftright("uid", BLOCK_BITS))
    volume, n_rows = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)), F.count("*")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(2 * parts, -(-volume // BUCKET_TEXT_BYTES))
    some = docs.select(F.col(text_col).alias("t")).where(F.char_length("t") <= HOT_CHARS)
    some = some.where(F.pmod(F.xxhash64("t"), F.lit(-(-n_rows // HOT_SAMPLE) or 1)) == 0).limit(HOT_SAMPLE)
    hot = _common_words([r["t"] for r in some.collect()])

    def counts(of_words: bool) -> DataFrame:
        return rows.select("uid", "block", "train", "text").mapInPandas(
            _collect(n, hot, of_words), "bucket int, block long, keys binary, runs binary, others binary, counts binary").groupBy("bucket")

    seated = stored(counts(False).applyInPandas(
        _seat_pairs(n, seed, hot), "bucket int, block long, kind string, first binary, second binary"), "lm-pairs")
    answers = stored(counts(True).cogroup(seated.where("kind <> 'pairs'").groupBy("bucket")).applyInPandas(
        _seat_words(seed, hot), "bucket int, block long, kind string, first binary, second binary, n long, v long, customers double, back_off double"), "lm-words")
    sums = answers.where("kind = 'sums'").agg(*[F.sum(c).alias(c) for c in ("n", "v", "customers", "back_off")]).first().asDict()
    columns = ["bucket", "block", "kind", "first", "second"]
    back = answers.where("kind = 'words'").select(*columns).unionByName(seated.where("kind = 'pairs'").select(*columns))
    scored = rows.select("uid", "block", "text").groupBy("block").cogroup(back.groupBy("block")).applyInPandas(
        _score(n, hot, sums), "uid long, n_tokens long, n_known long, base_score double, score double")
    return scored.join(rows.select("uid", "id", "train"), "uid").withColumn("train_tokens", F.lit(sums["n"] or 0).cast("long"))
