"""Joins and look-ups that hold when one key owns a large part of all rows.

Two facts carry everything here:

* at most ``1 / share`` keys can each own more than ``share`` of the rows, so the set of
  heavy keys is small whatever the data are, and may be broadcast;
* a heavy key is dealt to as many tasks as its own row count asks for, so what one task gets of it does not
  grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1.0 / 10_000
ROWS_PER_TASK = 100_000
BUCKETS = 1 << 16


def heavy_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, share: float = HEAVY_SHARE) -> DataFrame:
    """``key`` and ``salts`` of the keys (NULL is one) that own more rows than a task should get and more than
    ``share`` of all: never more than ``1 / share`` rows.

    Counting is map-side combined, so a heavy key costs one row per task. A key owns no more rows than all keys of its hash
    bucket: buckets are counted first, and keys only in those that are heavy, so that not all keys are shuffled to be counted.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    counts = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n"))
    heavy = counts.crossJoin(F.broadcast(total.withColumnRenamed("n", "_of"))).filter(
        F.col("n") > F.greatest(F.col("_of") * F.lit(share), F.lit(float(rows_per_task)))).collect()
    if not heavy:
        return df.select(key, F.lit(0).alias("salts")).limit(0)
    buckets = df.sparkSession.createDataFrame([(r["_bucket"],) for r in heavy], "_bucket int")
    some = df.select(key).withColumn("_bucket", bucket).join(F.broadcast(buckets), "_bucket", "left_semi")
    owned = some.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _above(owned, key, heavy[0]["_of"], rows_per_task, share)


def _heavy(counts: DataFrame, key: str, rows_per_task: int, share: float) -> DataFrame:
    return _above(counts, key, counts.agg(F.sum("n")).scalar(), rows_per_task, share)


def _above(counts: DataFrame, key: str, total, rows_per_task: int, share: float) -> DataFrame:
    heavy = counts.filter(F.col("n") > F.greatest(total * F.lit(share), F.lit(float(rows_per_task))))
    return heavy.select(key, F.ceil(F.col("n") / rows_per_task).cast("int").alias("salts"))


def _as_local(heavy: DataFrame) -> DataFrame:
    """The few heavy keys as a local table, so that they are counted once; the optimizer drops the joins to an empty one."""
    rows = heavy.collect()
    return heavy.sparkSession.createDataFrame(rows, heavy.schema) if rows else heavy.limit(0)


def join_lookup(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "left",
                keys: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK, share: float = HEAVY_SHARE) -> DataFrame:
    """Join rows to a table that has one row per key.

    ``spread`` is any row-unique column of ``left``. Rows of a heavy key are spread over its salts, as many as its
    rows fill tasks, and its single right row is repeated as often. Rows without a key, which share
    one partition of an outer join, are spread likewise. The plan is the same whether there are such keys or not.

    Heavy keys are counted once, over ``keys``, by default ``left`` itself. Where ``left`` is
    the result of much work, pass the table its key comes from.
    """
    heavy = _as_local(heavy_keys((left if keys is None else keys).select(key), key, rows_per_task, share))
    marks = F.broadcast(heavy.select(F.col(key).alias("_key"), F.col("salts").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    # the null-safe match finds the salts of rows without a key as well
    salted = left.join(marks, left[key].eqNullSafe(F.col("_key")), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_key", "_salts")
    repeated = right.join(marks, right[key] == F.col("_key"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_key", "_salts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def drop_matching(rows: DataFrame, keys: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, share: float = HEAVY_SHARE) -> DataFrame:
    """Rows whose key is not in ``keys`` (one row per key, with its row count in ``n``).

    Heavy keys go first, by a broadcast of at most ``1 / share`` of them and without moving
    any row; what is left to shuffle has no heavy key among the dropped ones. Rows without a key match
    nothing and are set aside, so they are not shuffled either.
    """
    heavy = _as_local(_heavy(keys, key, rows_per_task, share)).select(key)
    rest = rows.filter(F.col(key).isNotNull()).join(F.broadcast(heavy), key, "left_anti")
    return rest.join(keys.select(key), key, "left_anti").select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))
