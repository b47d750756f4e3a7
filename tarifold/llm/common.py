"""Words, keys and stored intermediates that the operators share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six characters that part words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, lower-cased; NULL counts as empty."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), BLANK_CLASS + "+")
    return F.array_remove(parts, "")


def key128(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes; equal values get equal pairs."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)]


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: a lost executor costs nothing.

    The shuffle files behind it are of no use any more, but executors keep them until the driver
    happens to collect its garbage. It is asked to, or a chain of such tables piles up on their disks.
    With ``by`` the table is bucketed by that column, and joins on it don't move its rows again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if by is None:
        df.write.parquet(path)
    else:
        view = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(parts, by).sortBy(by).option("path", path).format("parquet").saveAsTable(view)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path) if by is None else spark.table(view)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
