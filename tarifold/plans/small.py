"""Joins to tables that are small by nature, with the size checked before it is relied on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import join_lookup

MAX_ROWS = 10_000


def local_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """A configuration-like table as a local one, so that what it takes to find its rows is done once; a larger one as it is."""
    rows = df.limit(max_rows + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= max_rows else df


def join_small(left: DataFrame, right: DataFrame, key: str, spread: Column, how: str = "left",
               max_rows: int = MAX_ROWS) -> DataFrame:
    """Join to a configuration-like table with one row per key.

    At most ``max_rows + 1`` rows are read to learn its size. Within the limit those rows are
    broadcast, ``left`` does not move and the table is not computed again; beyond it the join
    is the salted one.
    """
    rows = right.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return left.join(F.broadcast(right.sparkSession.createDataFrame(rows, right.schema)), key, how)
    return join_lookup(left, right, key, spread, how)
