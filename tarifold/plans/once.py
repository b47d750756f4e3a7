"""A boundary for costly expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    The optimizer pushes filters below projections and merges projections, and each time
    writes the full expression wherever its column is named. For parsed JSON that is read in
    twenty places this multiplies the work. A generator over a one-element array is not
    merged, costs no shuffle, and drops no row.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
