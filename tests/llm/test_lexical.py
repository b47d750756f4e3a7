"""Ranked lexical search against scores of all pairs in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tarifold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    bags = [(d, Counter(found(t))) for d, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(found(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, bag in bags:
            if not bag:
                continue
            m = 10 + 90 * bag.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in terms if t in bag)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    for name in ("item", "id", "score", "rank", "length", "terms"):
        d, i = d.withColumn(name, F.lit(1)), i.withColumn(name, F.lit(1))
    return sorted(map(tuple, lexical.ranked_search(d, i, **more).collect()), key=str)


def corpus(n, seed, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60))) for _ in range(n)]


def test_same_as_all_pairs(spark, monkeypatch):
    docs = list(enumerate(corpus(900, 1))) + [(1000 + n, "w5 w6 w7 w8") for n in range(40)]
    items = list(enumerate(corpus(25, 2))) + [(90, "w5 W6 w7"), (91, "unknown"), (92, "w0")]
    assert ranked(spark, docs, items) == expected(docs, items)
    assert ranked(spark, docs, items, k=3, pass_bytes=400) == expected(docs, items, 3)


def test_awkward_rows(spark):
    docs = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "a"), (2, None), (3, ""), (4, ",;- {}"), (5, "A-B_c é É x"),
            (6, "b " * 300_000 + "zz"), (-9, "a b c")]
    items = [(1, "a b c"), (1, "é"), (1, "a b c"), (None, "zz b"), (2, None), (3, ""), (4, "É x"), (5, "a " * 5000)]
    assert ranked(spark, docs, items) == expected(docs, items)
    assert ranked(spark, [], items) == [] and ranked(spark, docs, []) == [] and ranked(spark, [(1, ""), (2, None)], items) == []


def test_text_ids(spark):
    d = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "q")], "doc_id string, text string")
    i = spark.createDataFrame([("i", "x y")], "item_id string, text string")
    rows = lexical.ranked_search(d, i, k=2).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in rows] == [("i", 1, "a"), ("i", 2, "b")]


def test_blocks_skip_documents_that_cannot_win():
    rng = np.random.default_rng(3)
    docs, total = 20_000, 0
    top, want = lexical.Top(10), []
    for block in range(3):
        lists = []
        for share, high in ((0.0005, 5000), (0.002, 4000), (0.3, 60), (0.5, 40), (0.9, 10)):
            places = np.flatnonzero(rng.random(docs) < share)
            lists.append((places, rng.integers(1, high, len(places))))
        ids = list(range(block * docs, (block + 1) * docs))
        total += lexical.search_block(lists, ids, top, 1000)
        score = np.zeros(docs, dtype=np.int64)
        for places, impacts in lists:
            score[places] += impacts
        want += [(int(s), i) for s, i in zip(score, ids)]
    assert top.best == sorted(want, key=lambda x: (-x[0], x[1]))[:10]
    assert total < docs / 10


def test_bar_keeps_equal_scores():
    top = lexical.Top(2)
    for first in (4, 0):  # the smaller ids come in a later block
        lexical.search_block([(np.arange(4), np.full(4, 7))], list(range(first, first + 4)), top, 2)
    assert top.best == [(7, 0), (7, 1)]
