"""Benchmark decontamination: find short test items inside long documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, stored, words


def shingle_hashes(text: Column, n: int = 5) -> Column:
    """Hashed runs of ``n`` words; fewer words make one run of all; none without words."""

    def runs(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        return F.when(F.size(w) >= n, many).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), runs)


def item_sketches(items: DataFrame, percent: int = 80, n: int = 5,
                  id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per different set of item shingles: ``item`` (a number for it), ``item_ids``, ``item_grams``,
    ``n_item``, ``needed`` and the MinHash ``sketch``.

    Items are partitioned by their size q, which fixes how many minima are kept: a document that holds
    ``needed = ceil(percent * q / 100)`` of the q shingles misses at most ``q - needed``, so the
    ``q - needed + 1`` smallest hashes can't all be missing. This bottom-k sketch loses no document.
    """
    grams = F.array_sort(F.array_distinct(shingle_hashes(F.col(text_col), n)))
    base = items.select(F.col(id_col).alias("id"), grams.alias("item_grams")).where(F.size("item_grams") > 0)
    base = base.groupBy("item_grams").agg(F.sort_array(F.collect_set("id")).alias("item_ids"))
    q = F.size("item_grams")
    needed = F.ceil(q * percent / F.lit(100.0)).cast("int")
    by_hash = F.array_sort(F.transform("item_grams", lambda g: F.struct(F.xxhash64(F.lit(3), g).alias("h"), g.alias("g"))))
    return base.select(
        F.xxhash64("item_grams").alias("item"), "item_ids", "item_grams", q.cast("long").alias("n_item"),
        needed.alias("needed"), F.transform(F.slice(by_hash, F.lit(1), q - needed + 1), lambda x: x["g"]).alias("sketch"),
    )


def find_items(docs: DataFrame, items: DataFrame, percent: int = 80, n: int = 5,
               id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (``doc_id``, ``item_id``) where a document holds at least ``percent`` of an item's shingles.

    Containment search by bottom-k MinHash over size-partitioned items: every shingle of every document
    probes the items' sketches, and a row that meets one carries its own shingles into the exact check.
    The probe tables hold the benchmark only and are written first, so Spark knows their size: within its
    limit they are broadcast and no document moves, beyond it both joins are shuffled. What is grouped
    at last are verified pairs.

    Columns: doc_id, item_id, n_shared (long), n_item (long). Shingles are five words, or the whole text
    if it has fewer; texts that are NULL, empty or blank hold nothing and are held nowhere. Rows with the
    same id are one document (the largest ``n_shared`` counts), equal rows too; a NULL id is one document.
    Items of equal shingles are all reported; an item without id shows as a NULL ``item_id``. Either table
    may be empty and have any other columns.
    """
    index = stored(item_sketches(items, percent, n, item_id, item_text), "item-sketches")
    probes = stored(index.select("item", F.explode("sketch").alias("gram")), "item-probes")
    # explode_outer: a plain explode makes the optimizer add a filter that works the shingles out again
    grams = docs.select(F.col(id_col).alias("doc_id"), shingle_hashes(F.col(text_col), n).alias("grams"))
    met = grams.select("doc_id", "grams", F.explode_outer("grams").alias("gram")).join(probes, "gram")
    checked = met.join(index.select("item", "item_ids", "item_grams", "n_item", "needed"), "item").select(
        "doc_id", "item_ids", "n_item", "needed", F.size(F.array_intersect("item_grams", "grams")).alias("n_shared"),
    ).where("n_shared >= needed")
    return checked.select("doc_id", F.explode_outer("item_ids").alias("item_id"), "n_shared", "n_item").groupBy(
        "doc_id", "item_id").agg(F.max("n_shared").cast("long").alias("n_shared"), F.max("n_item").alias("n_item"))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80, n: int = 5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay. See :func:`find_items`."""
    found = find_items(docs, items, percent, n, id_col, text_col)
    leaked = free_name(docs, "leaked_id")
    found = found.select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found[leaked]), "left_anti")
