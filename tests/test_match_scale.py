"""What keeps text matching small in the driver and few in pairs compared."""

import random

import numpy as np
from pyspark.sql import functions as F

from tarifold.functions import similarity
from tarifold.operators import match


def test_keys_of_near_texts_are_never_broadcast(spark, tmp_path):
    """Two small files of texts: their keys are many times as large, which no estimate tells."""
    for n in (1, 2):
        spark.range(500).select(F.concat(F.lit(f"text {n} "), "id").alias("text")).write.parquet(f"{tmp_path}/{n}")
    found = match.near_pairs(spark.read.parquet(f"{tmp_path}/1"), spark.read.parquet(f"{tmp_path}/2"), 0.96)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_store_without_a_match_does_not_open_the_others(monkeypatch):
    """Every text has an equal one in store 0, and store 1 carries one unlike text only."""
    rng = random.Random(3)
    ours = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(40)]
    theirs = [*ours, *("".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(400)), "z" * 60]
    stores = [np.array([0])] * (len(theirs) - 1) + [np.array([1])]
    offers = [np.array([n]) for n in range(len(theirs))]
    scored, lcs = [], similarity.common_subsequence
    monkeypatch.setattr(similarity, "common_subsequence", lambda m, r, a, b: scored.append(len(a)) or lcs(m, r, a, b))
    won = list(similarity.best_in_tile(ours, theirs, stores, offers, 0.75, [np.zeros(0, int)] * len(ours)))
    got = {(int(i), int(s), float(p), int(o)) for a, store, points, offer in won for i, s, p, o in zip(a, store, points, offer)}
    assert got == {(n, 0, 1.0, n) for n in range(len(ours))}
    assert sum(scored) < len(ours) * len(theirs) / 100


def test_shared_characters_are_counted_or_bounded(monkeypatch):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("aab c漢𝄞éxyz0123") for _ in range(rng.randrange(1, 150)))
    ours, theirs = [text() for _ in range(30)], [text() + "only here" for _ in range(50)]
    alphabet = similarity.alphabet_of(ours)
    left, right = similarity.Encoded(ours, alphabet), similarity.Encoded(theirs, alphabet)
    exact = np.array([[sum(min(a.count(c), b.count(c)) for c in set(a)) for b in theirs] for a in ours])
    for bits, kinds, cells in ((1024, 255, 1 << 22), (0, 255, 300), (1024, 3, 1 << 22), (0, 3, 7)):
        monkeypatch.setattr(similarity.Shared, "BITS", bits)
        monkeypatch.setattr(similarity.Shared, "KINDS", kinds)
        monkeypatch.setattr(similarity.Shared, "CELLS", cells)
        got = similarity.Shared(left, right, len(alphabet)).of(slice(5, 30), (4, 16))
        assert (got == exact[5:]).all() if kinds == 255 else (got >= exact[5:]).all()


def test_tiles_of_many_chunks(spark, monkeypatch):
    """Chunks cut by texts, characters and stores give the same winners as one tile."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(3, 60))) for _ in range(60)]
    less = lambda t: "".join(c for c in t if rng.random() < 0.9) + "x"
    ours = spark.createDataFrame([(t, []) for t in sorted(set(base))], "text string, done array<int>")
    theirs = spark.createDataFrame(
        [(t, [n % 3, 5], [n, 10 * n]) for n, t in enumerate(sorted({less(t) for t in base * 2}))],
        "text string, stores array<int>, offers array<long>")
    key = lambda df: sorted(map(tuple, df.select("text", "comp_ord", "score", "offer_ord").collect()))
    whole = key(match.best_in_tiles(ours, theirs, 0.75))
    for name, n in (("TILE_SIDE", 16), ("OTHER_SIDE", 16), ("OTHER_CELLS", 40), ("MOST_TASKS", 2)):
        monkeypatch.setattr(match, name, n)
    assert whole and key(match.best_in_tiles(ours, theirs, 0.75)) == whole
    assert key(match.best_in_tiles(ours.where(F.lit(False)), theirs, 0.75)) == []
