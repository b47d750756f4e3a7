"""Order-dependent removal of duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, text_or_blank
from ..plans.skew import drop_matching, join_lookup
from ..session import ensure_checkpoint_dir


#: Rounds over all rows before what is left is parted into components, and the most rows of a component that one task walks.
ROUNDS = 3
LARGEST = 1_000_000


def keep_first_by_two_keys(products: DataFrame, rounds: int = ROUNDS, largest: int = LARGEST) -> DataFrame:
    """Add ``kept``: walking the rows by ``ord``, a row stays unless its non-blank ``sku`` or
    its ``url`` was seen on a row that stayed. Dropped rows claim neither key.

    Solved on the three key columns only. A round settles most rows: one that is the first of both its sku and its url
    among the undecided rows stays for certain, and every other undecided row that shares a key with it goes. What is left
    after ``rounds`` are chains, in which one row waits for the one before. They are parted into connected components, found
    in a logarithmic number of steps, and each component of at most ``largest`` rows is walked in order by one task. Only
    larger ones go on in rounds. The firsts are aggregates with map-side combine, joins are on the unique ``ord``, so a
    key that owns a third of the table is just another key.
    """
    ensure_checkpoint_dir(products.sparkSession)
    undecided = products.select(
        "ord", filled(F.col("sku")).alias("sku"), text_or_blank(F.col("url")).alias("url")
    ).checkpoint()
    kept_rounds, done = [], 0
    while not undecided.isEmpty():
        if done == rounds:
            kept, undecided = _walk_components(undecided, largest)
            kept_rounds.append(kept)
        else:
            kept, undecided = _round(undecided)
            kept_rounds.append(kept)
        done += 1

    if not kept_rounds:
        return products.withColumn("kept", F.lit(True))
    kept = kept_rounds[0]
    for more in kept_rounds[1:]:
        kept = kept.unionByName(more)
    return products.join(kept.withColumn("kept", F.lit(True)), "ord", "left").withColumn(
        "kept", F.coalesce("kept", F.lit(False))
    )


def _round(undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that stay for certain (``ord``), and those that are still undecided."""
    by_url = undecided.groupBy("url").agg(
        F.min(F.struct("ord", "sku")).alias("row"), F.count(F.lit(1)).alias("n_url")
    ).select("url", "row.*", "n_url")
    by_sku = undecided.filter("sku IS NOT NULL").groupBy("sku").agg(
        F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n_sku")
    )
    kept = by_url.join(by_sku.select("ord", "n_sku"), "ord", "left").filter(
        "sku IS NULL OR n_sku IS NOT NULL"
    ).checkpoint()
    urls = kept.select("url", F.col("n_url").alias("n"))
    skus = kept.filter("sku IS NOT NULL").select("sku", F.col("n_sku").alias("n"))
    return kept.select("ord"), drop_matching(drop_matching(undecided, urls, "url"), skus, "sku").checkpoint()


def _walk_components(undecided: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Rows that stay in components of at most ``largest`` rows, and all rows of the larger ones."""
    labelled = components(undecided)
    small = labelled.groupBy("label").agg((F.count(F.lit(1)) <= largest).alias("small"))
    labelled = join_lookup(labelled, small, "label", F.col("ord"), "inner").checkpoint()
    parts = int(undecided.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = labelled.filter("small").select("label", "ord", "sku", "url").repartition(parts, "label").sortWithinPartitions("label", "ord")
    return ordered.mapInArrow(_walk, "ord bigint").checkpoint(), labelled.filter("NOT small").select("ord", "sku", "url")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sequential rule, component by component; the keys of one component are in memory."""
    current, skus, urls = None, set(), set()
    for batch in batches:
        kept = []
        for label, at, sku, url in zip(*(batch.column(c).to_pylist() for c in ("label", "ord", "sku", "url"))):
            if label != current:
                current, skus, urls = label, set(), set()
            if url not in urls and (sku is None or sku not in skus):
                kept.append(at)
                urls.add(url)
                skus.add(sku)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["ord"])


def components(rows: DataFrame) -> DataFrame:
    """``rows`` (``ord, sku, url``) with ``label``: the smallest ``ord`` that shared keys lead to.

    In a step every tree of rows hooks onto the smallest tree that it shares a key with, and the hooks, which only ever point
    downwards, are followed to their ends by doubling. Trees that can still hook at least halve in number each step.
    """
    labelled = rows.withColumn("label", F.col("ord"))
    while True:
        by_url = labelled.groupBy("url").agg(F.min("label").alias("of_url"))
        by_sku = labelled.filter("sku IS NOT NULL").groupBy("sku").agg(F.min("label").alias("of_sku"))
        near = join_lookup(labelled, by_url, "url", F.col("ord"))
        near = join_lookup(near, by_sku, "sku", F.col("ord")).withColumn("near", F.least("label", "of_url", "of_sku"))
        hooks = near.groupBy("label").agg(F.min("near").alias("to")).checkpoint()
        if hooks.filter("to <> label").isEmpty():
            return labelled
        while True:
            ends = hooks.select(F.col("label").alias("to"), F.col("to").alias("further"))
            hooks = join_lookup(hooks, ends, "to", F.col("label")).checkpoint()
            if hooks.filter("further <> to").isEmpty():
                break
            hooks = hooks.select("label", F.col("further").alias("to"))
        labelled = join_lookup(labelled, hooks.select("label", "to"), "label", F.col("ord")).select(
            "ord", "sku", "url", F.col("to").alias("label")).checkpoint()


def unique_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter("kept").drop("kept")


def duplicates_log(flagged: DataFrame) -> DataFrame:
    return flagged.filter("NOT kept").select("title", "sku", "url")


def first_page_of_url(listing: DataFrame) -> DataFrame:
    """In-order paging: the page on which a url shows up first, per brand.

    ``listing`` has ``brand, page_no, url``.
    """
    return listing.groupBy("brand", "url").agg(F.min("page_no").alias("page_no"))


def new_urls(page: DataFrame, seen: DataFrame) -> DataFrame:
    """Urls of a page that were not seen before."""
    return page.select("url").distinct().join(seen.select("url").distinct(), "url", "left_anti")
