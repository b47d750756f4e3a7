"""Sharding: contiguous shards of near-equal size from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for NULL) and 8 for the record's frame."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                   keep_order: bool = False) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Rows are ordered by (id, text checksum, size), or with ``keep_order`` as they are stored, and dealt into ranges. Each range's total becomes
    an offset (one row per range), running sums within the range do the rest, and a row's shard
    is ``floor(bytes before it * shards / all bytes)``: contiguous, near equal to within one
    record. The table of places is narrow; the texts stay where they are until the last join.

    NULL ids come first. Rows that are equal in id, checksum and size are told apart by their
    place in the input, so even one id that owns a third of the rows is spread over many ranges;
    which of equal rows gets which slot is then without meaning. A very long text is one row and
    may fill a shard by itself, others then stay empty. An empty table gives an empty table.
    ``docs`` is read twice and should be a stored table, whose rows keep their order. Where it has a column of an added
    name, the added one gets ``_`` in front.
    """
    row = free_name(docs, "row_no")
    docs = docs.withColumn(row, F.monotonically_increasing_id())
    narrow = docs.select(
        row, F.col(id_col).alias("key"), record_size(F.col(text_col)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    order = [row] if keep_order else ["key", "text_crc32", "size", row]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written before it is read three times: ranges are then the same in each reading.
    ranged = stored(
        narrow.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "shard-ranges",
    )
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("range").orderBy(*order)
    placed = ranged.join(F.broadcast(offsets), "range").select(
        row, "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("at"), "all_bytes",
    )
    # floor(start * shards / all) in whole numbers, by decimal so that petabytes times shards don't overflow
    shard = F.floor(F.col("start").cast("decimal(38,0)") * shards / F.col("all_bytes")).cast("int")
    placed = stored(placed.select(row, "size", "text_crc32", "at", shard.alias("shard")), "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))  # one row per shard
    placed = placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("at") - F.col("first")).drop("at", "first")
    added = {c: free_name(docs, c) for c in ("size", "text_crc32", "shard", "slot")}
    return docs.join(placed.select(row, *[F.col(c).alias(name) for c, name in added.items()]), row).drop(row)
