"""Order-dependent operators against plain sequential models."""

import random

import pytest
from pyspark.sql import functions as F

from tarifold.operators.dedupe import components, keep_first_by_two_keys
from tarifold.operators.handles import unique_handles
from tarifold.operators.sampling import exact_fraction
from tarifold.operators.translate import translation_batches
from tarifold.plans.ranks import global_position
from tarifold.session import ensure_checkpoint_dir


def greedy(rows):
    skus, urls, kept = set(), set(), []
    for ord_, sku, url in sorted(rows):
        sku = sku.strip()
        if (sku and sku in skus) or url in urls:
            continue
        if sku:
            skus.add(sku)
        urls.add(url)
        kept.append(ord_)
    return kept


def test_dedupe_example(spark):
    rows = [(1, "s1", "u1"), (2, "s2", "u1"), (3, "s2", "u3"), (4, "", ""), (5, " ", ""), (6, " s2 ", "u9")]
    df = spark.createDataFrame(rows, "ord long, sku string, url string")
    assert [r.ord for r in keep_first_by_two_keys(df).filter("kept").orderBy("ord").collect()] == [1, 3, 4]


def test_dedupe_random(spark):
    rng = random.Random(5)
    for share in (3, 60):
        rows = [(n * 3, rng.choice(["", f"s{rng.randrange(40)}"]) if rng.random() < 0.7 else "hot",
                 f"u{rng.randrange(share)}" if rng.random() < 0.6 else f"v{n}") for n in range(400)]
        df = spark.createDataFrame(rows, "ord long, sku string, url string").repartition(4)
        got = [r.ord for r in keep_first_by_two_keys(df).filter("kept").orderBy("ord").collect()]
        assert got == greedy(rows)


def chain(n, order):
    """Rows that share a sku with one neighbour and a url with the other."""
    return [(order[i], f"s{i // 2}", f"u{(i + 1) // 2}") for i in range(n)]


def test_dedupe_of_chains_takes_few_jobs(spark):
    """In rounds alone, a chain in order takes a round for every other row."""
    rng = random.Random(3)
    jobs = []
    for n, shuffled in ((1_000, False), (10_000, False), (10_000, True)):
        order = list(range(n))
        if shuffled:
            rng.shuffle(order)
        rows = chain(n, order) + [(n + i, "", f"x{i % 7}") for i in range(50)]
        df = spark.createDataFrame(rows, "ord long, sku string, url string")
        group = f"chain-{n}-{shuffled}"
        spark.sparkContext.setJobGroup(group, group)
        got = [r.ord for r in keep_first_by_two_keys(df).filter("kept").orderBy("ord").collect()]
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert got == greedy(rows)
    spark.sparkContext.setJobGroup("tests", "tests")
    assert jobs[1] < 1.6 * jobs[0] and jobs[1] < 400 and jobs[2] < 400


def test_dedupe_of_large_components_goes_on_in_rounds(spark):
    rng = random.Random(8)
    rows = [(1000 + i, f"s{rng.randrange(60)}", f"u{rng.randrange(80)}") for i in range(200)]
    rows += [(3000 + r[0], "c" + r[1], "c" + r[2]) for r in chain(30, list(range(30)))]
    df = spark.createDataFrame(rows, "ord long, sku string, url string")
    for rounds, largest in ((0, 10**6), (0, 40), (1, 5), (0, 0)):
        got = [r.ord for r in keep_first_by_two_keys(df, rounds, largest).filter("kept").orderBy("ord").collect()]
        assert got == greedy(rows)


def test_components(spark):
    rows = [(9, "a", "1"), (4, "b", "1"), (7, "b", "2"), (2, None, "3"), (8, None, "2"), (5, "c", "4"), (6, "c", "5"), (1, "d", "6")]
    df = spark.createDataFrame(rows, "ord long, sku string, url string")
    assert {r.ord: r.label for r in components(df).collect()} == {9: 4, 4: 4, 7: 4, 8: 4, 2: 2, 5: 5, 6: 5, 1: 1}


def test_dedupe_of_nothing(spark):
    df = spark.createDataFrame([], "ord long, sku string, url string")
    assert keep_first_by_two_keys(df).count() == 0


def handles_model(rows):
    def slug(x):
        return "-".join("".join(ch if ch.isalnum() else " " for ch in x.lower()).split())

    used, out = set(), []
    for _, title, sku in sorted(rows):
        h = slug(title)
        if h in used:
            h = f"{h}-{slug(sku)}" if sku else f"{h}-dup"
        h = h or "product"
        used.add(h)
        out.append(h)
    return out


def test_handles_random(spark):
    rng = random.Random(9)
    names = ["a", "a dup", "a s1", "a s1 dup", "b", "product", "", "--", "product dup", "b dup"]
    for _ in range(3):
        rows = [(n, rng.choice(names), rng.choice(["", "s1", "dup", "/"])) for n in range(120)]
        df = spark.createDataFrame(rows, "ord long, title string, sku string").repartition(4)
        assert [r.handle for r in unique_handles(df).orderBy("ord").collect()] == handles_model(rows)


def test_sample_sizes(spark):
    for n, size in ((0, 0), (1, 0), (5, 2), (15, 4), (1000, 300)):
        df = spark.range(n).withColumn("keep", F.col("id") >= 0)
        first = exact_fraction(df, F.col("keep"), "id").filter("sampled")
        again = exact_fraction(df.repartition(3), F.col("keep"), "id").filter("sampled")
        assert first.count() == size
        assert {r.id for r in first.collect()} == {r.id for r in again.collect()}


def test_positions_of_sparse_keys(spark):
    rng = random.Random(3)
    keys = sorted({rng.randrange(-(2**40), 2**62) for _ in range(500)} | set(range(100)))
    df = spark.createDataFrame([(k,) for k in keys], "ord long").repartition(4)
    got = {r.ord: r.pos for r in global_position(df, "ord", "pos").collect()}
    assert got == {k: n for n, k in enumerate(keys)}


def test_batches(spark):
    df = spark.range(23).select(F.col("id").alias("ord"), F.col("id").cast("string").alias("description_nl"))
    got = {r.batch: [i.ord for i in r["items"]] for r in translation_batches(df).collect()}
    assert got == {0: list(range(10)), 1: list(range(10, 20)), 2: [20, 21, 22]}


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
