"""The training-data operators against brute force, and on awkward rows: nulls, empty and long texts, ties, repeated rows,
empty tables, and other columns with clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarifold.llm import (
    chat, decontaminate, line_dedup, lm_scoring, mixing, nearest, ngram_join, queries, sharding, suffix_dedup, toxicity,
)
from tarifold.llm.hashing import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, n_lines int, size int"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text):
    w = WORD.findall(low(text))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def awkward():
    base = " ".join(f"w{i % 37}x{i}" for i in range(60))
    texts = [
        None, "", "   ", "one", "One", base, base, base.upper(), base.replace("w5x5 ", "other "), base + " tail words here",
        "x" * 3000, "a " * 400, "line number one\nshared line of text\n\nshort", "Shared line of text  \nanother line here\nshort",
        "shared line of text", base + "\n" + "y" * 500, "z" * 450 + base, "naïve été ça b c d", "b\\n<x> [INST]",
    ]
    rows = [(i, t, "en", "hot" if i % 3 else None, None, "u", 1, 2) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[0], (None, base, None, None, None, None, None, None), (None, None, None, "s", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(awkward(), SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return spark.createDataFrame([], docs.schema)


def brute_components(rows, percent=80):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return Counter((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def test_ngram_join_equals_brute_force(spark, docs, nothing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = ngram_join.jaccard_components(docs).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)
    kept = ngram_join.one_of_each_component(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect() if r["text"] and "w5x5 " in r["text"].lower()].count(5) == 1
    assert ngram_join.jaccard_components(nothing).count() == 0


def test_ngram_join_of_many_near_copies(spark, tmp_path):
    """Chains, and a group larger than any that is held together, in which all segments are common."""
    random = np.random.default_rng(3)
    base = [f"v{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base)
        for j in random.choice(80, random.integers(0, 4), replace=False):
            words[j] = f"new{i}_{j}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(60)]
    rows += [(1000 + k, " ".join(chain[k * 5:] + [f"c{60 + i}" for i in range(k * 5)])) for k in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.jaccard_components(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)


def test_ngram_join_of_unlike_texts_that_share_a_phrase(spark, tmp_path):
    """Thousands of short texts around one phrase, none alike, and a pair that is: few pairs come to be compared."""
    rows = [(i, f"name{i} thanks you all very much") for i in range(2000)]
    rows += [(3000 + i, f"dear name{i} thanks you all very much") for i in range(1000)]
    rows += [(5000 + i, f"oh dear name{i} thanks you all very much") for i in range(1000)]
    rows += [(7000 + i, f"a{i} b{i} c{i} d{i} e{i} f{i} g{i} thanks you all very much") for i in range(300)]
    rows += [(9000, "Name7 thanks you all very much"), (9001, "one two three four five six seven eight nine"),
             (9002, "one two three four five six seven eight nine ten")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.jaccard_components(spark.read.parquet(str(tmp_path / "d"))).collect()
    linked = {9000: 7, 9002: 9001}
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(
        (d, len(grams(t)), linked.get(d, d)) for d, t in rows)


def test_ngram_join_makes_a_near_pair_once_not_once_per_group(spark, tmp_path, monkeypatch):
    """Near copies on both sides of the threshold share hundreds of groups; what their joins may look at grows with the texts."""
    random = np.random.default_rng(8)
    base = [f"w{random.integers(10**6)}" for _ in range(300)]
    rows = []
    for i in range(200):
        text = [*base]
        for j in random.choice(300, random.integers(3, 9), replace=False):
            text[j] = f"x{random.integers(10**6)}"
        rows.append((i, " ".join(text)))
    kept = []

    def noted(df, name, by=None, _stored=ngram_join.stored):
        kept.append((name, table := _stored(df, name, by)))
        return table

    monkeypatch.setattr(ngram_join, "stored", noted)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    found = ngram_join.jaccard_components(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows)
    members = next(table for name, table in kept if name == "join-members")
    sizes = [r["count"] for r in members.where("not light").groupBy("gid").count().collect()]
    assert sizes and sum(sizes) <= 25 * len(rows)


def test_ngram_join_moves_the_texts_of_its_pairs_only(spark, tmp_path, monkeypatch):
    """Unlike texts that share a phrase are in groups, but sketches rule their pairs out before texts move; sketches don't outgrow their sets."""
    random = np.random.default_rng(9)
    footer = " ".join(f"f{i}" for i in range(60))
    rows = [(i, " ".join(f"w{random.integers(10**6)}" for _ in range(90 + i % 7)) + " " + footer) for i in range(120)]
    rows += [(500, rows[3][1] + " end"), (501, rows[4][1] + " close"), (502, " ".join(f"l{i}" for i in range(3000)))]
    kept = []

    def noted(df, name, by=None, _stored=ngram_join.stored):
        kept.append((name, table := _stored(df, name, by)))
        return table

    monkeypatch.setattr(ngram_join, "stored", noted)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/d")
    found = ngram_join.jaccard_components(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows)
    pairs = [{x for r in table.collect() for x in r} for name, table in kept if name == "join-sized"]
    texts = [[r["rep"] for r in table.collect()] for name, table in kept if name == "join-texts"]
    assert texts and all(len(t) == len(set(t)) for t in texts)
    assert [set(t) for t in texts] == [p for p in pairs if p]
    grouped = next(table for name, table in kept if name == "join-members").select("rep").distinct().count()
    assert max(map(len, texts)) <= 8 < grouped
    sizes = next(table for name, table in kept if name == "join-sizes")
    assert sizes.where(F.size("sketch") * 64 > F.greatest(F.lit(64 * ngram_join.COARSE), 2 * F.col("n"))).isEmpty()


def test_asked_texts_are_exact_however_full_the_bit_table_is(spark, monkeypatch):
    rows = spark.range(300).select(F.col("id").alias("uid"), (F.col("id") * 3).alias("mark"), F.concat(F.lit("t"), "id").alias("text"))
    # a wanted row of another mark, or that isn't there, gets no text
    wanted = spark.range(0, 400, 2).select(F.col("id").alias("rep"), F.when(F.col("id") == 10, -1).otherwise(F.col("id") * 3).alias("mark"))
    for words in (1, 1 << 17):
        monkeypatch.setattr(ngram_join, "MARKED", words)
        got = ngram_join.asked_for(rows, wanted).collect()
        assert Counter(map(tuple, got)) == Counter((i, f"t{i}") for i in range(0, 300, 2) if i != 10)


def test_ngram_join_of_long_near_copies(spark, tmp_path):
    """Two texts of 600 KB each, together more than is hashed at once."""
    words = [f"long{i:06d}" for i in range(600_000 // 11)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-9], "other", "end"])), (3, "short text of no kin")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = ngram_join.jaccard_components(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows)


def test_no_pair_of_a_large_batch_is_skipped():
    """Several MiB of pairs in one batch, every other one alike, of sizes that put cuts at all places."""
    random = np.random.default_rng(5)
    pairs = []
    for k in range(120):
        words = [f"p{k}w{i}" for i in range(random.integers(100, 5000))]
        pairs.append((" ".join(words), " ".join(words[3:] if k % 2 else [w + "z" for w in words])))
    batch = pd.DataFrame({"a": range(120), "b": range(1000, 1120), "ta": [a for a, _ in pairs], "tb": [b for _, b in pairs]})
    assert sum(len(a) + len(b) for a, b in pairs) > 4 << 20
    got = pd.concat(ngram_join._verify(80)(iter([batch])))["a"].tolist()
    assert got == [k for k, (a, b) in enumerate(pairs) if 100 * len(grams(a) & grams(b)) >= 80 * len(grams(a) | grams(b))]


def test_every_size_of_set_finds_its_partners():
    """Entries of sets at exactly the allowed difference meet, at each size."""
    random = np.random.default_rng(1)
    for n in [1, 2, 3, 4, 5, 7, 8, 11, 15, 16, 31, 40, 64, 100, 250]:
        for _ in range(20):
            whole = np.sort(random.choice(1 << 40, n + n // 4 + 1, replace=False).astype(np.uint64) << np.uint64(8))
            a, b = whole[:n], np.sort(random.permutation(whole)[:max(1, n)])
            a, b = np.sort(a), np.sort(b)
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common):
                b = np.sort(np.concatenate([a[: -(n // 9)] if n >= 9 else a, whole[n:n + n // 9]]))
                common = len(np.intersect1d(a, b))
                assert 100 * common >= 80 * (len(a) + len(b) - common)
            sig, owner, _, _ = ngram_join.entries(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80)
            # the lowest bit tells one-deletion neighbours, which need a whole segment to meet
            shorter = (sig & np.uint64(1)).astype(bool)
            keys = [{w: set((sig >> np.uint64(1))[(owner == o) & (shorter <= w)]) for w in (False, True)} for o in (0, 1)]
            assert keys[0][False] & keys[1][True] or keys[0][True] & keys[1][False], n


def test_shingle_sets_equal_plain_ones():
    texts = [r[1] or "" for r in awkward()]
    _, at = shingle_sets([t.encode() for t in texts])
    assert np.diff(at).tolist() == [len(grams(t)) for t in texts]


def test_line_dedup(docs, nothing):
    rows = [(r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["text"]) for r in docs.collect()]
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(low(line).strip(" \t\n\x0b\f\r"), set()).add(d)
    expected = Counter()
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(k := low(x).strip(" \t\n\x0b\f\r")) >= 10 and len(holders[k]) >= 2 and d > min(holders[k]))]
        expected[(d, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    got = line_dedup.line_dedup(docs.drop("n_lines")).collect()
    assert Counter((r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == expected
    assert line_dedup.line_dedup(docs.drop("n_lines"), min_docs=3).count() == len(rows)
    assert line_dedup.line_dedup(nothing.drop("n_lines")).count() == 0


def test_sharding_is_contiguous_and_balanced(docs, nothing):
    for keep_order in (False, True):
        got = sharding.shard_by_bytes(docs.drop("size"), 4, keep_order=keep_order).collect()
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in awkward())
        total = sum(r["size"] for r in got)
        for s in range(4):
            some = [r for r in got if r["shard"] == s]
            assert sorted(r["slot"] for r in some) == list(range(len(some)))
            assert abs(sum(r["size"] for r in some) - total / 4) <= max(r["size"] for r in got)
        assert all(r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) and r["size"] == len((r["text"] or "").encode()) + 8 for r in got)
    assert sharding.shard_by_bytes(nothing.drop("size"), 4).count() == 0


def test_added_columns_beside_columns_of_the_same_names(docs):
    """The given columns stay as they are, the added ones get a free name."""
    cases = [
        (line_dedup.line_dedup, ("n_lines", "n_dropped", "kept_text", "gone", "doc", "mark", "own_id")),
        (lambda d: sharding.shard_by_bytes(d, 4), ("size", "text_crc32", "shard", "slot", "row_no", "at", "range")),
        (lambda d: mixing.mix_sources(d, seed=4), ("repetition_rate", "n_copies", "copy", "shuffle_key", "weight", "source_key")),
    ]
    plain = docs.select("doc_id", "text", "source")
    for operator, names in cases:
        alone = operator(plain)
        both = operator(plain.withColumns({n: F.lit("given") for n in names}))
        assert both.where(" OR ".join(f"{n} <> 'given'" for n in names)).count() == 0
        added = [c for c in alone.columns if c not in plain.columns]
        renamed = both.select(*plain.columns, *[F.col(f"_{c}" if c in names else c).alias(c) for c in added])
        assert Counter(map(str, renamed.collect())) == Counter(map(str, alone.collect()))


def test_shards_are_cut_from_one_order(spark):
    rows = [(i * 37 % 1000, "x" * (i * 7919 % 300)) for i in range(1000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    start, total = 0, sum(len(t) + 8 for _, t in rows)
    for r in sorted(got, key=lambda r: r["doc_id"]):
        assert r["shard"] == start * 7 // total
        start += r["size"]


def poisson(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p = p * mean / k
        c += p
    return k


def test_mixing_draws_the_poisson_numbers(docs, nothing):
    got = mixing.mix_sources(docs, {"hot": 3, "s": 1, "": 0}, total_rows=60, seed=4).collect()
    sizes = Counter(r[3] or "" for r in awkward())
    expected = Counter()
    for row in awkward():
        source = row[3] or ""
        rate = {"hot": 3, "s": 1, "": 0}[source] / 4 * 60 / sizes[source]
        draws = max(math.ceil(rate / 64), 1)
        key = f"4:{'' if row[0] is None else row[0]}:{source}"
        n = sum(poisson(rate / draws, int(hashlib.md5(f"{key}:{j}".encode()).hexdigest()[:13], 16) / 2**52) for j in range(1, draws + 1))
        expected[(row[0], row[1])] += n
    assert Counter((r["doc_id"], r["text"]) for r in got) == +expected
    assert mixing.mix_sources(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([
        (1, awkward()[5][1], "x"), (2, "not there at all in any text", "x"), (3, None, "x"), (4, "", "x"), (5, "ONE", "x"),
        (6, " ".join(awkward()[5][1].split()[10:30]), "x"), (7, awkward()[5][1], "x"), (None, "shared line of text", "x"),
    ], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in decontaminate.find_items(docs, items).collect()}
    expected = {}
    for d, t in {(r[0], r[1]) for r in awkward()}:
        for item in items.collect():
            q, x = grams(item["text"]), grams(t)
            if q and 100 * len(q & x) >= 80 * len(q):
                expected[(d, item["item_id"])] = (max(len(q & x), expected.get((d, item["item_id"]), (0,))[0]), len(q))
    assert got == expected
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns
    leaked = {d for d, _ in expected}
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r[0] for r in awkward() if r[0] not in leaked)
    assert decontaminate.find_items(nothing, items).count() == 0
    assert decontaminate.find_items(docs, items.limit(0)).count() == 0


def brute_repeats(texts, span):
    starts = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if starts[t[i:i + span]] > 1:
                mark[i:i + span] = b"\1" * span
        kept = bytes(x for x, m in zip(t, mark, strict=True) if not m)
        out.append((len(t), sum(mark), len(re.findall(rb"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("span", [40, 200])
def test_suffix_dedup_equals_brute_force(docs, nothing, span):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    expected = Counter((d, *x) for (d, _), x in zip(rows, brute_repeats([t for _, t in rows], span), strict=True))
    got = suffix_dedup.remove_repeats(docs, span, with_text=True).collect()
    assert Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == expected
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)
    assert suffix_dedup.remove_repeats(nothing, span).count() == 0


def test_lm_scores(spark, docs, nothing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    train = F.col("doc_id") % 4 != 0
    counts = Counter()
    for d, t in rows:
        if d is not None and d % 4:
            counts.update([*WORD.findall(low(t)), ""])
    n, v = sum(counts.values()), len(counts)
    for r in lm_scoring.score_texts(docs, train).collect():
        texts = [t for d, t in rows if d == r["id"]]
        tokens = [[*WORD.findall(low(t)), ""] for t in texts]
        assert r["train_tokens"] == n
        assert any(len(w) == r["n_tokens"] and sum(counts[x] > 0 for x in w) == r["n_known"] and abs(
            sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) - r["base_score"]) < 1e-6 * abs(r["base_score"]) for w in tokens)
        assert r["score"] < 0
    assert lm_scoring.score_texts(nothing, train).count() == 0
    assert lm_scoring.score_texts(docs, F.lit(False)).where("n_known = 0").count() == len(rows)


def test_lm_probabilities_sum_to_one(spark, tmp_path):
    """p(word | start) over all words and the unknown one, from texts of one word and texts of it with a word more."""
    random = np.random.default_rng(2)
    learn = [" ".join(random.choice(list("abcde"), random.integers(1, 6))) for _ in range(60)]
    words = [*"abcde", "zzz"]
    rows = [(i, t, True) for i, t in enumerate([*learn])] + [(1000, "", False)] + [
        (2000 + i, w, False) for i, w in enumerate(words)] + [
        (3000 + 10 * i + j, f"{w} {x}", False) for i, w in enumerate(words) for j, x in enumerate(words)]
    spark.createDataFrame(rows, "doc_id long, text string, t boolean").coalesce(1).write.parquet(str(tmp_path / "d"))
    p = {r["id"]: 10 ** r["score"] for r in lm_scoring.score_texts(spark.read.parquet(str(tmp_path / "d")), F.col("t")).collect()}
    # p("") = p(end | start); p(w) = p(w | start) p(end | w); p(w x) p(y) / ... : solve p(end | w) from ratios of pairs
    end_after = {}
    for i, w in enumerate(words):  # p(w w) / p(w) = p(w | w)
        follow = {x: p[3000 + 10 * i + j] for j, x in enumerate(words)}
        # follow[x] = p(w|start) p(x|w) p(end|x); unknown ends: one equation for each w in the p(end|x)
        end_after[w] = follow
    m = np.array([[end_after[w][x] / p[2000 + i] for x in words] for i, w in enumerate(words)])
    # sum over x of p(x|w) = 1 - p(end|w), with p(x|w) = m[w,x] e_w / e_x
    e = np.full(len(words), 0.3)
    for _ in range(500):
        e = 1 / (1 + (m / e[None, :]).sum(axis=1))
    assert abs(p[1000] + sum(p[2000 + i] / e[i] for i in range(len(words))) - 1) < 1e-3


def test_nearest_neighbours(spark):
    random = np.random.default_rng(5)
    v = random.normal(size=(900, 12))
    v[300:600] = v[0]  # a third of all are one vector
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    rows += [(900, None, 1), (901, [0.0] * 12, 1), (902, [float("nan")] * 12, 1), (903, [None] * 12, 1), (904, [1.0] * 3, 1), (None, [1.0] * 12, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in nearest.nearest_neighbours(table, table.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 50))
    hit = 0
    for q, found in got.items():
        far = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(900), far)) if i != q][:10]
        assert len(found) == 10 and all(abs(far[i] - s) < 1e-9 for i, s in found)
        hit += len({i for i, _ in found} & set(order))
    assert hit / (10 * len(got)) >= 0.9
    assert [i for i, _ in got[0]] == list(range(300, 310))
    few = table.where("vec_id < 4")
    assert nearest.nearest_neighbours(few, few).groupBy("query_id").count().where("count <> 3").count() == 0
    assert nearest.nearest_neighbours(table.limit(0), table.limit(0)).count() == 0


def test_nearest_neighbours_of_repeated_rows(spark):
    """Each id asks once; repeated candidates are candidates each, but never those of the query's own id."""
    v = np.random.default_rng(6).normal(size=(120, 6))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(0, v[0].tolist())] * 40 + [(50, v[50].tolist()), (7, v[7].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids, all_v = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    got = {}
    for r in nearest.nearest_neighbours(table, table.where("vec_id % 50 = 0"), probes=11).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for q in (0, 50, 100):
        far = np.sqrt(((all_v - v[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != q][:10]
        assert got[q] == [(n + 1, ids[i]) for n, i in enumerate(order)]
    assert len(got) == 3


def test_toxicity_learns_nothing_from_held_out_labels(spark):
    random = np.random.default_rng(12)
    plain = ["".join(random.choice(list("aeioubdkl"), 5)) for _ in range(200)]
    text = lambda i: " ".join([*random.choice(plain, 40), *["grobnix fulzator"] * (i % 4 == 0)])
    table = spark.createDataFrame([(i, text(i)) for i in range(200)], "doc_id long, text string")
    models = [toxicity.fit_toxicity(table.where("doc_id % 5 <> 0"), spark.createDataFrame(
        [(i, held if i % 5 == 0 else int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")) for held in (0, 1)]
    assert models[0] is not None and models[0] == models[1]


def test_toxicity_learns_and_bears_awkward_rows(spark, docs, nothing):
    random = np.random.default_rng(8)
    plain = ["".join(random.choice(list("aeioubdkl"), 5)) for _ in range(400)]
    bad = ["grobnix", "fulzator", "skumwert", "pathozid"]
    rows, marks = [], []
    for i in range(600):
        words = list(random.choice(plain, 60))
        if i % 3 == 0:
            for j in random.choice(60, 5, replace=False):
                words[j] = bad[random.integers(4)]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 3 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(table.where("doc_id % 5 <> 0"), labels)
    scored = toxicity.toxicity_scores(table.where("doc_id % 5 = 0"), model).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in scored]) > 0.9
    assert toxicity.toxicity_scores(docs, model).where("score between 0 and 1").count() == len(awkward())
    assert toxicity.fit_toxicity(nothing, labels) is None
    assert toxicity.toxicity_scores(docs, None).where("score = 0").count() == len(awkward())
    assert toxicity.toxicity_scores(nothing, model).count() == 0


def test_toxicity_learns_from_texts_that_share_a_phrase():
    random = np.random.default_rng(9)
    word = lambda: "".join(random.choice(list("aeioubdkl"), 6))
    bad = ["grobnix", "fulzator", "skumwert", "pathozid"]
    footer = " ".join(word() for _ in range(40))
    # up to ten words with one phrase in all of them, and longer ones above one footer
    short = lambda i: f"{word()} {word()} {bad[i % 4]} you really are {bad[i // 4 % 4]} {word()}"
    plain = lambda: " ".join(word() for _ in range(40))
    for toxic in ([short(i) for i in range(400)], [f"{plain()} {bad[i % 4]} {word()} {bad[i // 4 % 4]} {footer}" for i in range(400)]):
        docs = [toxicity.word_list(t) for t in toxic]
        assert len(toxicity._different(docs)) == 400
        model = toxicity.train([*toxic, *(plain() + " " + footer for _ in range(400))], [1] * 400 + [0] * 400, 0.5)
        plain_c, toxic_c = toxicity.compressor(model.ordinary), toxicity.compressor(model.toxic)
        assert toxicity.features(toxic[0], plain_c, toxic_c)[0] > toxicity.features(plain(), plain_c, toxic_c)[0]
        # near copies of a class that is large enough teach once; a small class is not emptied
        assert len(toxicity._different([*docs, *([*d, b"end"] for d in docs[:50] if len(d) > 40)])) == 400
        assert len(toxicity._different(docs[:1] * 5)) == 5


def test_chat_round_trip(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t} <|end|> \\l \\b " + "x" * (t * 40 % 700), "c") for t in range(60)]
    rows += [(2, 0, "system", "be kind", "c"), (2, 1, "user", None, "c"), (2, 2, "assistant", "</s>[INST] ok", "c"), (2, 2, "assistant", "</s>[INST] ok", "c")]
    rows += [(3, 0, "system", "alone", "c"), (None, None, None, None, None), (4, 0, "assistant", "y" * 9000, "c")]
    rows += [(5, t, ["system", "user", "assistant"][min(t, 1 + t % 2)], f"m{t} " + "z" * 300, "c") for t in range(30)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_conversations(table, budget=256, history=64)
    back = {}
    for r in chat.read_back(windows).orderBy("window").collect():
        turns, answers = back.setdefault(r["conv_id"], ([], []))
        turns += [(t["role"], t["text"]) for t in r["turns"]]
        answers += r["answers"]
    for conv in {r[0] for r in rows}:
        some = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        assert back[conv] == ([(r[2] or "", r[3] or "") for r in some], [r[3] or "" for r in some if r[2] == "assistant"])
    assert windows.where("conv_id = 5 and text not like '<|turn|>system%'").count() == 0
    assert windows.where("conv_id = 1 and n_context > 0").count() > 0
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_all_ten_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages_take_effect(spark):
    """Each stage against brute force on its own input; the classifier's against its own scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {}
    inputs = {r["doc_id"]: r["text"] for r in docs.collect()}
    from tarifold.llm.common import stored
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "test-stage")
        ids = Counter(r["doc_id"] for r in out.collect())
        if name != "sharding":
            assert out.columns == columns
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert len(ids) >= 0.8 * len(inputs) - sum(1 for y in labels.values() if y)
        elif name == "ngram_join":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert set(ids) == {c for _, _, c in brute_components(rows)}
        elif name == "decontamination":
            items = [grams(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            clean = {r["doc_id"] for r in docs.collect() if not any(q and 100 * len(q & grams(r["text"])) >= 80 * len(q) for q in items)}
            assert set(ids) == clean
        elif name == "mixing":
            assert set(ids) <= texts.keys() and 0.5 < sum(ids.values()) / len(texts) < 1.6
        else:
            assert ids == Counter(r["doc_id"] for r in docs.collect())
        texts = {r["doc_id"]: r["text"] for r in out.collect()}
        assert all(inputs[d] == t for d, t in texts.items())
        docs = out


def test_sketches_never_rule_out_a_link(spark):
    """Pairs on both sides of the threshold and of a doubling of the sketch: no link is lost, most far pairs are."""
    rng = np.random.default_rng(5)
    rows = []
    for size in [1, 2, 4, 15, 16, 17, 60, 64, 70, 255, 256, 300]:
        for changed in range(0, size + 1, max(1, size // 12)):
            a = np.unique(rng.integers(0, 1 << 48, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 48, changed // 2, dtype=np.uint64)]))
            if not len(b):
                continue
            sa, sb = ngram_join.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            common = len(np.intersect1d(a, b))
            share = 100 * common / (len(a) + len(b) - common)
            rows.append((len(a), len(b), sa.tolist(), sb.tolist(), share))
    frame = spark.createDataFrame(rows, "na long, nb long, sa array<long>, sb array<long>, share double")
    got = frame.select("share", ngram_join.may_link(80, *map(F.col, ("na", "nb", "sa", "sb"))).alias("may")).collect()
    assert all(r["may"] for r in got if r["share"] >= 80)
    far = [r["may"] for r in got if r["share"] < 60]
    assert sum(far) < 0.1 * len(far)


def test_folded_sketches_never_rule_out_a_link(spark):
    """The sketch that pairs are held against in the join itself, on links of all sizes and on unlike sets of 200."""
    rng = np.random.default_rng(6)
    rows = []
    for size in [1, 2, 3, 4, 5, 9, 17, 33, 64, 65, 200, 1000, 5000]:
        for changed in (0, size // 9, size):
            a = np.unique(rng.integers(0, 1 << 48, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 48, changed, dtype=np.uint64)]))
            sa, sb = ngram_join.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            common = len(np.intersect1d(a, b))
            rows.append((len(a), sa.tolist(), len(b), sb.tolist(), size, 100 * common / (len(a) + len(b) - common)))
    frame = spark.createDataFrame(rows, "na long, sa array<long>, nb long, sb array<long>, size long, share double")
    sides = frame.select("size", "share", F.struct(F.col("na").alias("n"), *ngram_join.folded(F.col("sa"))).alias("x"),
                         F.struct(F.col("nb").alias("n"), *ngram_join.folded(F.col("sb"))).alias("y"))
    got = sides.select("size", "share", ngram_join.may_link_coarse(80, "x", "y").alias("may")).collect()
    assert all(r["may"] for r in got if r["share"] >= 80)
    assert not any(r["may"] for r in got if r["share"] == 0 and r["size"] <= 200)
