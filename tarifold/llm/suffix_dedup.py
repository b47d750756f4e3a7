"""Repeated passages by prefix doubling: byte strings of 50, 100 and 200 bytes are ranked, and what is unique is left behind."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, key128, stored
from .hashing import FACTORS, U, chunks, mix
from .repeats_kernel import Anchors, Prints, anchors

#: Windows of one bucket of the last round, roughly; the number of buckets follows the input.
BUCKET_WINDOWS = 1 << 20
#: Rows of the input that make one block of the last round.
BLOCK_BITS = 9


def _prints(texts: list[bytes]) -> tuple[Prints, np.ndarray]:
    borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return Prints(np.frombuffer(b"".join(texts), dtype=np.uint8)), borders


def _bytes(column: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in column]


def _first_ranks(span: int, gram: int):
    """(rank of the shortest strings, row) at the places that the windows choose."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, uid = _bytes(batch["text"]), batch["uid"].to_numpy()
            seen: dict[bytes, int] = {}  # equal texts of a batch count twice at most
            for i, t in enumerate(texts):
                seen[t] = seen.get(t, 0) + 1
                if seen[t] > 2:
                    texts[i] = b""
            del seen
            for first, part in chunks(texts):
                prints, borders = _prints(part)
                found = anchors(prints, borders, span, gram)
                yield pd.DataFrame({"g": prints.of(found.place, gram).astype(np.int64), "uid": uid[first + found.text]})

    return run


def _second_ranks(span: int, gram: int):
    """For the places whose first rank isn't unique: ranks twice as long to either side, and of all that their windows cover."""
    half = span // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, uid = _bytes(batch["text"]), batch["uid"].to_numpy()
            for first, part in chunks(texts):
                prints, borders = _prints(part)
                a: Anchors = anchors(prints, borders, span, gram)
                g = prints.of(a.place, gram)
                allowed = [np.asarray(x, dtype=np.int64) for x in batch["grams"][first:first + len(part)]]
                owner = np.repeat(np.arange(len(allowed)), [len(x) for x in allowed]).astype(np.uint64)
                pairs = mix(np.concatenate(allowed).astype(np.uint64) + owner * FACTORS[3])
                keep = np.flatnonzero(np.isin(mix(g + a.text.astype(np.uint64) * FACTORS[3]), pairs))
                text, place, lo, hi = a.text[keep], a.place[keep], a.first[keep], a.last[keep]
                begin, end = borders[text], borders[text + 1]
                right, left = place + half <= end, place - half >= begin
                r = np.where(right, prints.of(np.where(right, place, 0), np.where(right, half, 0)), U(0))
                l = np.where(left, prints.of(np.where(left, place - half, 0), np.where(left, half, 0)), U(0))
                context = mix(prints.of(lo, hi - lo + span) ^ mix((place - lo).astype(np.uint64) * FACTORS[5] + (hi - lo).astype(np.uint64) * FACTORS[6]))
                yield pd.DataFrame({
                    "uid": uid[first + text], "g": g[keep].astype(np.int64), "c": context.astype(np.int64),
                    "r": r.astype(np.int64), "l": l.astype(np.int64), "place": place - begin, "lo": lo - begin, "hi": hi - begin,
                })

    return run


def _windows_of(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _last_ranks(span: int, buckets: int):
    """Of one block of texts: packed (rank of whole windows, number of the window in the block) by bucket.

    Ranks that occur twice within the block are known to repeat: their windows go along as such, and one of them stands for all."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        block = int(frame["block"].iloc[0])
        ranks = [np.zeros(0, np.uint64)]
        texts, spans = _bytes(frame["text"]), list(frame["spans"])
        for first, part in chunks(texts):
            prints, borders = _prints(part)
            for i, listed in enumerate(spans[first:first + len(part)]):
                lo, n = _sorted_spans(listed)
                ranks.append(prints.of(borders[i] + _windows_of(lo, n), span))
        rank = np.concatenate(ranks)
        value, where, back, times = np.unique(rank, return_index=True, return_inverse=True, return_counts=True)
        repeated = np.flatnonzero(times[back] > 1).astype(np.int32)
        bucket = (value % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(int(b), block, value[at].tobytes(), where[at].astype(np.int32).tobytes())
                for b in np.flatnonzero(np.diff(ends)) for at in [order[ends[b]:ends[b + 1]]]]
        rows.append((abs(block) % buckets, block, b"", repeated.tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "block", "ranks", "numbers"])

    return run


def _sorted_spans(listed) -> tuple[np.ndarray, np.ndarray]:
    pairs = sorted((int(s["lo"]), int(s["n"])) for s in listed)
    return np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.int64)


def _repeating(frame: pd.DataFrame) -> pd.DataFrame:
    """Which numbers of which block have a rank that another block has too."""
    known = frame["ranks"].str.len() == 0
    sent = frame[~known]
    counts = sent["ranks"].str.len().to_numpy() // 8
    rank = np.frombuffer(b"".join(sent["ranks"]), np.uint64)
    number = np.frombuffer(b"".join(sent["numbers"]), np.int32)
    source = np.repeat(np.arange(len(sent)), counts)
    _, back, times = np.unique(rank, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(times[back] > 1) if len(rank) else np.zeros(0, np.int64)
    ends = np.searchsorted(source[hit], np.arange(len(sent) + 1))
    found = [(int(b), number[hit[ends[i]:ends[i + 1]]].tobytes()) for i, b in enumerate(sent["block"]) if ends[i] < ends[i + 1]]
    found += list(zip(frame.loc[known, "block"], frame.loc[known, "numbers"], strict=True))
    return pd.DataFrame(found, columns=["block", "numbers"])


def _spans_back(key: tuple, numbers: pd.DataFrame, emitted: pd.DataFrame) -> pd.DataFrame:
    """Numbers of a block's windows back to (row, first window, last window)."""
    hit = np.unique(np.concatenate([np.frombuffer(x, np.int32) for x in numbers["numbers"]] or [np.zeros(0, np.int32)]))
    if not len(hit) or not len(emitted):
        return pd.DataFrame({"uid": [], "lo": [], "hi": []}, dtype=np.int64)
    emitted = emitted.sort_values(["uid", "lo", "n"])
    n = emitted["n"].to_numpy()
    owner = np.repeat(emitted["uid"].to_numpy(), n)[hit]
    start = _windows_of(emitted["lo"].to_numpy(), n)[hit]
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    begins = np.flatnonzero((np.diff(start, prepend=-5) > 1) | (np.diff(owner, prepend=-1) != 0) | (np.diff(start, prepend=-5) < 0))
    ends = np.append(begins[1:], len(start)) - 1
    return pd.DataFrame({"uid": owner[begins], "lo": start[begins], "hi": start[ends]})


def _removed(span: int, with_text: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uid, text, listed in zip(batch["uid"], _bytes(batch["text"]), batch["spans"], strict=True):
                kept, at, removed, n = [], 0, 0, 0
                reach = -1
                for lo, hi in sorted((int(s["lo"]), int(s["hi"]) + span) for s in listed):
                    if lo > reach:  # a new run
                        kept.append(text[max(at, 0):lo])
                        n += 1
                        removed += hi - lo
                        reach = hi
                    elif hi > reach:
                        removed += hi - reach
                        reach = hi
                    at = reach
                kept.append(text[at:])
                rows.append((uid, removed, n, b"".join(kept)))
            out = pd.DataFrame(rows, columns=["uid", "n_removed", "n_spans", "kept"])
            out["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in out["kept"]]
            yield out if with_text else out.drop(columns="kept")

    return run


def remove_repeats(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept``, the bytes left).

    A byte goes if a string of ``span`` bytes that covers it starts anywhere else, in this text or another.

    Prefix doubling over all texts, by rounds whose strings are a quarter, a half and the whole of ``span``. Ranks are 64-bit
    fingerprints, so a pair of neighbouring ranks is named without sorting; each round groups (rank, position) rows,
    and positions whose rank is unique go no further. The first two rounds need few positions: each window of ``span`` bytes is
    represented by the string in it with the smallest fingerprint, which equal windows choose alike. Two
    shortcuts settle runs at once: equal texts, and equal stretches around such a place. Only windows that
    are still undecided, near edits, take part in the last round one by one, packed by rank; a rank counts
    once per block of texts, so a passage that a third of all documents share is no hot key.

    NULL texts are empty; texts shorter than ``span`` lose nothing. Equal rows are copies of each other. NULL ids
    are kept. Empty table: empty result. ``docs`` is read three times and should be a stored table, whose rows keep their order.
    """
    gram = span // 4
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), text.alias("text"))
    h1, h2 = key128(F.col("text"))
    narrow = stored(rows.select("uid", "id", F.octet_length("text").cast("long").alias("n_bytes"), h1.alias("h1"), h2.alias("h2"),
                                F.sha2("text", 256).alias("whole_sha256")), "repeat-rows")
    classes = narrow.groupBy("h1", "h2").agg(F.min("uid").alias("rep"), F.count("*").alias("copies"))
    narrow = stored(narrow.join(classes, ["h1", "h2"]).drop("h1", "h2"), "repeat-classes")

    ranked = stored(rows.select("uid", "text").mapInPandas(_first_ranks(span, gram), "g long, uid long"), "repeat-first")
    shared = stored(ranked.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "repeat-shared")
    alive = ranked.join(shared, "g").select("uid", "g").distinct().groupBy("uid").agg(F.collect_list("g").alias("grams"))
    alive = alive.join(narrow.where("uid = rep").select("uid"), "uid")
    texts = stored(rows.select("uid", "text").join(alive, "uid"), "repeat-texts")

    second = stored(texts.mapInPandas(
        _second_ranks(span, gram), "uid long, g long, c long, r long, l long, place long, lo long, hi long"), "repeat-second")
    contexts = second.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct("uid", "place")).alias("rep"))
    second = stored(second.join(contexts, ["g", "c"]), "repeat-contexts")
    settled = second.where("n > 1").select("uid", "lo", "hi")
    # one of each context takes part in the rounds at half and whole length, where any undecided one could meet it
    entering = second.where((F.col("n") == 1) | ((F.col("rep.uid") == F.col("uid")) & (F.col("rep.place") == F.col("place"))))
    half = span // 2
    right = entering.select("uid", "g", F.col("r").alias("half"), F.lit("r").alias("side"), "n",
                            F.greatest("lo", F.col("place") - half).alias("lo"), "hi")
    left = entering.select("uid", "g", F.col("l").alias("half"), F.lit("l").alias("side"), "n", "lo",
                           F.least("hi", F.col("place") - half - 1).alias("hi"))
    halves = right.unionByName(left).where("lo <= hi")
    again = halves.groupBy("side", "g", "half").agg(F.count("*").alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1")
    block = F.shiftright("uid", BLOCK_BITS)
    emitted = stored(halves.join(again.select("side", "g", "half"), ["side", "g", "half"]).select(
        "uid", block.alias("block"), "lo", (F.col("hi") - F.col("lo") + 1).alias("n")), "repeat-emitted")
    windows = emitted.agg(F.sum("n")).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * parts, -(-windows // BUCKET_WINDOWS))
    listed = emitted.groupBy("uid").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    packed = texts.select("uid", "text").join(listed, "uid").withColumn("block", block)
    packed = packed.groupBy("block").applyInPandas(_last_ranks(span, buckets), "bucket int, block long, ranks binary, numbers binary")
    repeats = packed.groupBy("bucket").applyInPandas(_repeating, "block long, numbers binary")
    found = repeats.groupBy("block").cogroup(emitted.groupBy("block")).applyInPandas(_spans_back, "uid long, lo long, hi long")

    spans = settled.unionByName(found).groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    cut = texts.select("uid", "text").join(spans, "uid").mapInPandas(
        _removed(span, with_text), "uid long, n_removed long, n_spans long" + ", kept binary" * with_text + ", kept_sha256 string")
    extra = ["kept"] if with_text else []
    cut = cut.select(F.col("uid").alias("cut"), "n_removed", "n_spans", "kept_sha256", *extra)
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    whole = narrow.join(cut, narrow["uid"] == F.col("cut"), "left").select(
        "uid", "id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        *[F.when(gone, F.lit(b"")).otherwise(F.col(c)).alias(c) for c in extra],
    )
    if with_text:  # texts that lose nothing come from the input
        whole = whole.join(rows.select("uid", F.col("text").cast("binary").alias("all")), "uid").withColumn(
            "kept", F.coalesce("kept", "all")).drop("all")
    return whole
