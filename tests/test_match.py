"""Matching and pricing against plain models."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarifold.functions.similarity import best_in_tile, pair_scores
from tarifold.operators import fx, match, pricing
from tarifold.plans.skew import drop_matching, heavy_keys, join_lookup


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for ch in a:
        prev = 0
        for j, other in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if ch == other else max(row[j + 1], row[j])
    return row[-1]


def score(a, b):
    a, b = (" ".join(sorted(x.lower().split())) for x in (a, b))
    return 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def test_kernel():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé 漢") for _ in range(rng.randrange(0, 200))) for _ in range(120)]
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(400)]
    got = pair_scores(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    want = [2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0 for a, b in pairs]
    assert got == pytest.approx(want)


def test_tile_against_model():
    rng = random.Random(4)
    for low, high in ((1, 12), (60, 70), (240, 300)):
        base = "".join(rng.choice("abcd") for _ in range(high))
        text = lambda: "".join(ch for ch in base if rng.random() < 0.95)[: rng.randrange(low, high)]  # noqa: E731, B023
        ours = list({text() for _ in range(25)} - {""})
        theirs = list({text() for _ in range(25)} - {""})
        stores = [np.array(sorted(rng.sample(range(5), rng.randrange(1, 4)))) for _ in theirs]
        offers = [np.array([rng.randrange(1000) for _ in s]) for s in stores]
        done = [np.array(sorted(rng.sample(range(5), rng.randrange(0, 3))), dtype=int) for _ in ours]
        got = {}
        for a, store, points, offer in best_in_tile(ours, theirs, stores, offers, 0.75, done, block=4):
            got.update({(ours[i], s): (p, o) for i, s, p, o in zip(a, store, points, offer)})
        want = {}
        for x, settled in zip(ours, done):
            for y, ss, oo in zip(theirs, stores, offers):
                points = 2 * lcs(x, y) / (len(x) + len(y))
                for s, o in zip(ss, oo):
                    if s not in settled and points >= 0.75 and (points, -o) > want.get((x, s), (0, 0)):
                        want[x, s] = (points, -o)
        assert got == {k: (p, -o) for k, (p, o) in want.items()}


def edited(rng, text, most):
    """A text a few insertions and deletions away."""
    chars = list(text)
    for _ in range(rng.randrange(most + 1)):
        if chars and rng.random() < 0.5:
            del chars[rng.randrange(len(chars))]
        else:
            chars.insert(rng.randrange(len(chars) + 1), rng.choice("abcdé漢𝄞 "))
    return "".join(chars)


def texts_frame(spark, texts, stores=lambda n: [n % 3]):
    rows = [(t, stores(n), [1000 * n + s for s in stores(n)]) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "text string, stores array<int>, offers array<long>")


@pytest.mark.parametrize("near", [0.8, 0.9, 0.94, 1.0])
def test_index_loses_no_near_pair(spark, near):
    rng = random.Random(int(near * 100))
    base = ["".join(rng.choice("abcdé漢𝄞 ") for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    ours = sorted({edited(rng, t, 5) for t in base} | {"a", "b", "x" * 400, "𝄞" * 30} - {""})
    theirs = sorted({edited(rng, t, 5) for t in base * 2} | {"a", "ab", "x" * 399, "x" * 30 + "y", "𝄞" * 29} - {""})
    want = {(a, b) for a in ours for b in theirs if 2 * lcs(a, b) / (len(a) + len(b)) >= near}
    found = match.near_pairs(texts_frame(spark, ours), texts_frame(spark, theirs), near).collect()
    got = {(r.text, r.other) for r in found}
    assert len(got) == len(found) and want and want <= got
    assert len(got) < len(ours) * len(theirs) / 4


def test_two_rungs_give_what_tiles_give(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(4, 40))) for _ in range(60)]
    ours, theirs = sorted(set(base)), sorted({edited(rng, t, 8) for t in base * 3} - {""})
    left, right = texts_frame(spark, ours), texts_frame(spark, theirs, lambda n: sorted({n % 3, n % 5}))
    whole = match.best_in_tiles(left.select("text", F.array().cast("array<int>").alias("done")), right, 0.75)
    key = lambda df: sorted(map(tuple, df.select("text", "comp_ord", "score", "offer_ord").collect()))
    assert key(match.best_by_text(left, right, 0.75, 0.9)) == key(whole) == key(match.best_by_text(left, right, 0.75, 0.99))
    assert key(match.best_by_text(left, right, 0.9, 0.9)) == [r for r in key(whole) if r[2] >= 0.9]


def test_pairs_grow_slower_than_the_product(spark):
    """Every store carries a near text of most of ours: the larger the catalogs, the fewer texts go on to the tiles."""
    looked = []
    for n in (150, 600):
        rng = random.Random(n)
        base = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789 ") for _ in range(40)) for _ in range(n)]
        pairs = spark.sparkContext.accumulator(0)
        left, right = texts_frame(spark, base), texts_frame(spark, [edited(rng, t, 2) for t in base], lambda n: [0])
        match.best_by_text(left, right, 0.75, 0.94, pairs).collect()
        looked.append(pairs.value)
    assert looked[0] < 150 * 150 / 10 and looked[1] < 8 * looked[0]


def offers_frame(spark, rows):
    return spark.createDataFrame(
        rows, "domain string, comp_ord int, offer_ord long, name string, currency string, sku string, title string, "
              "vendor string, price_eur double")


def model(products, offers, threshold=0.75):
    out = {}
    for ord_, sku, brand, title in products:
        for domain in sorted({o[1] for o in offers}):
            best, best_score = None, 0.0
            for o in sorted((o for o in offers if o[1] == domain), key=lambda o: o[2]):
                if sku.strip() and sku.strip().upper() == o[5].strip().upper():
                    best, best_score = o, 1.0
                    break
                s = score(f"{brand.strip()} {title.strip()}", f"{o[7] or ''} {o[6] or ''}")
                if s > best_score:
                    best, best_score = o, s
            if best is not None and best_score >= threshold:
                out[ord_, domain] = (best[6], round(best_score, 4))
    return out


def test_match_all_against_model(spark):
    rng = random.Random(7)
    words = ["slip-on", "carbon", "honda", "cb650r", "titanium", "full", "system", "mt-09", "a", "xx"]
    title = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 6)))
    products = [(n, rng.choice(["", f" k{n} ", "same"]), rng.choice(["", "Arrow "]), title()) for n in range(60)]
    products += [(100, "", "", "abcd"), (101, "", "", "x" * 90 + " y")]
    offers = [(f"s{d}", d, 1000 * d + k, f"Store {d}", "EUR", rng.choice(["", f"K{rng.randrange(60)}", "SAME"]), title(),
               rng.choice(["", None, "arrow"]), 10.0 + k) for d in range(4) for k in range(25)]
    offers += [("s0", 0, 900, "Store 0", "EUR", "", "abcx", "", 1.0), ("s1", 1, 1900, "Store 1", "EUR", "", "abxy", "", 1.0),
               ("s2", 2, 2900, "Store 2", "EUR", "", "y " + "x" * 88, "", 1.0)]
    df = spark.createDataFrame([(*p, 100.0) for p in products], "ord long, sku string, brand string, title string, price_raw double")
    rows = match.match_all(df, offers_frame(spark, offers)).select("ord", F.explode("matches").alias("m")).collect()
    got = {(r.ord, r.m.comp_ord): (r.m.title, r.m.confidence) for r in rows}
    assert len(got) == len(rows)
    assert got == model(products, offers)
    assert got[100, 0] == ("abcx", 0.75) and (100, 1) not in got


def decide(price_raw, prices):
    to95 = lambda p: math.floor(p + 0.55) - 0.05
    net = price_raw / 1.21
    if len(prices) >= 2:
        s = sorted(prices)
        at = 0.6 * (len(s) - 1)
        lo = int(at)
        p60 = s[lo] + (at - lo) * (s[min(lo + 1, len(s) - 1)] - s[lo])
        raw = max(net * 1.35, min(net * 1.8, p60))
    else:
        raw = net * 1.35
    price = to95(max(raw, net * 1.2))
    anchor = to95(net * 1.5)
    return price, anchor if anchor > price else None, "competitor" if len(prices) >= 2 else "default"


def test_price_decision(spark):
    cases = [(649.0, [720.0, 765.0, 710.0, 800.0]), (649.0, []), (649.0, [900.0]), (649.0, [1.0, 2.0]),
             (649.0, [5000.0, 6000.0]), (0.0, [5.0, 6.0]), (649.0, [800.0, -1.0, 0.0]), (100.0, [120.0, 130.0, 125.0])]
    rows = [(n, raw, [(k, f"d{k}", "n", "t", p, 1.0) for k, p in enumerate(ps)]) for n, (raw, ps) in enumerate(cases)]
    priced = pricing.price_products(spark.createDataFrame(rows, f"ord long, price_raw double, matches {match.MATCH}"))
    got = {r.ord: r for r in priced.select("ord", "pricing_meta.*").collect()}
    for n, (raw, ps) in enumerate(cases):
        price, anchor, method = decide(raw, [p for p in ps if p > 0])
        assert (got[n].new_price, got[n].compare_at_price, got[n].method) == (
            pytest.approx(price), anchor if anchor is None else pytest.approx(anchor), method)
    assert got[0].p60 == 756.0 and got[5].margin_pct == 0.0


def test_rates(spark):
    rates = spark.createDataFrame(
        [("2024-01-01", "GBP", 0.8), ("2024-02-01", "gbp", 0.5), ("2024-02-01", "USD", 0.0), ("2024-03-01", "GBP", 9.0)],
        "d string, currency string, rate double").select(F.col("d").cast("date").alias("rate_date"), "currency", "rate")
    offers = offers_frame(spark, [("a", 0, n, "A", cur, "", "t", "", 10.0) for n, cur in enumerate(["EUR", "GBP", "usd", "JPY"])])
    got = fx.convert_offers(offers, fx.rates_as_of(rates, "2024-02-15")).orderBy("offer_ord").collect()
    assert [r.price_eur for r in got] == [10.0, 20.0, 10.0, 10.0]
    none = fx.convert_offers(offers, fx.rates_as_of(rates, "2023-01-01")).collect()
    assert {r.price_eur for r in none} == {10.0}


def test_apply_pricing_and_audit(spark):
    products = spark.createDataFrame(
        [(n, f"S{n}", "Arrow", f"title {n}", 100.0 + n, f"u{n}") for n in range(20)],
        "ord long, sku string, brand string, title string, price_raw double, url string")
    offers = offers_frame(spark, [(f"d{d}", d, d * 100 + n, f"D{d}", "EUR", f"s{n}", "zzz", "q", 90.0) for d in range(3) for n in range(0, 20, 2)])
    rates = spark.createDataFrame([], "currency string, rate double")
    priced = pricing.apply_pricing(products, offers, rates)
    assert priced.count() == 20 and set(products.columns) < set(priced.columns)
    rows = pricing.audit(priced)
    assert rows.count() == 10 * 3 + 10
    summary = pricing.pricing_summary(priced).first()
    eligible = priced.filter("pricing_meta.compare_at_price IS NOT NULL").count()
    assert summary.competitor_based == 10 and summary.on_sale == round(eligible * 0.3)


def test_heavy_key_join_is_exact(spark):
    """A third of the rows on one key, a third without any."""
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    right = spark.createDataFrame([("hot", 1), (None, 5)] + [(f"k{n}", n + 10) for n in range(40)], "key string, v int")
    plain = left.join(right, "key", "left")
    for rows, heavy in ((1000, {(None, 3), ("hot", 3)}), (50, {(None, 60), ("hot", 60)} | {(f"k{n}", 2) for n in range(50)}), (10**6, set())):
        assert {tuple(r) for r in heavy_keys(left, "key", rows).collect()} == heavy
        got = join_lookup(left, right, "key", F.col("id"), rows_per_task=rows)
        assert sorted(map(str, got.select("id", "key", "v").collect())) == sorted(map(str, plain.select("id", "key", "v").collect()))
        assert join_lookup(left, right, "key", F.col("id"), "inner", rows_per_task=rows).count() == plain.filter("v IS NOT NULL").count()
    assert heavy_keys(left, "key", 50, 0.3).count() == 2 and heavy_keys(left.limit(0), "key").count() == 0


def test_hot_key_is_dealt_to_many_tasks(spark):
    left = spark.range(6000).select("id", F.lit("hot").alias("key"))
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = join_lookup(left, right, "key", F.col("id"), rows_per_task=50).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2400


def test_drop_matching(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    gone = spark.createDataFrame([("hot", 2000), ("k1", 10)], "key string, n long")
    for rows_per_task in (1, 1000, 10**6):
        got = drop_matching(rows, gone, "key", rows_per_task)
        assert got.columns == rows.columns and got.count() == rows.filter("key IS NULL OR key NOT IN ('hot', 'k1')").count()
