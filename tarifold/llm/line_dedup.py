"""Line dedup: drop lines that other documents hold too, except in the first document that has them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, free_name, key128, lower_ascii, stored

LAST_ID = 2**63 - 1


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``; all columns and rows stay.

    Lines are exploded to (key hash, document), counted with map-side combine, and only the
    numbers of the lines to drop come back to the texts. A text crosses one shuffle, once.

    A text that is NULL or empty is one empty line. Keys shorter than ``min_chars`` are never
    dropped. A document is its id, so a line twice in one document (or in repeated rows with one
    id) counts once and stays; a NULL id is one document that comes last. Ties can't happen: ids
    are compared, not rows. An empty table gives an empty table. Where ``docs`` has a column of an
    added name, the added one gets ``_`` in front.
    """
    own, mark = free_name(docs, "own_id"), free_name(docs, "own_text")
    n_lines, n_dropped, kept_text = (free_name(docs, n) for n in ("n_lines", "n_dropped", "kept_text"))
    docs = docs.withColumns({
        own: F.coalesce(F.col(id_col), F.lit(LAST_ID)), mark: F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
    })
    lines = F.split(F.coalesce(docs[text_col], F.lit("")), "\n", -1)
    exploded = docs.select(
        F.col(own).alias("doc"), F.col(mark).alias("mark"), F.posexplode(lines).alias("pos", "line"),
    ).withColumn("line", lower_ascii(F.btrim("line", F.lit(BLANKS)))).where(F.char_length("line") >= min_chars)
    first, second = key128(F.col("line"))
    # Written once: it is counted and joined, and the join's two sides then come from exchanges that can be split at a hot line.
    exploded = stored(exploded.select("doc", "mark", "pos", first.alias("h1"), second.alias("h2")), "lines")
    if min_docs == 2:  # two documents hold it when the smallest and the largest differ
        shared = exploded.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last"))
        shared = shared.where("keeper < last").drop("last")
    else:
        shared = exploded.select("h1", "h2", "doc").distinct().groupBy("h1", "h2")
        shared = shared.agg(F.min("doc").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= min_docs).drop("n")
    shared = stored(shared, "shared-lines")
    dropped = exploded.join(shared, ["h1", "h2"]).where("doc > keeper")
    dropped = dropped.groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone"))
    # The kept numbers are a set difference of integers, which is hashed, so very long texts stay linear.
    joined = docs.join(dropped, (docs[own] == dropped["doc"]) & (docs[mark] == dropped["mark"]), "left")
    all_lines = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_except(all_lines, F.coalesce(dropped["gone"], F.array().cast("array<int>")))
    return joined.select(
        *[docs[c] for c in docs.columns if c not in (own, mark)],
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(dropped["gone"]), F.lit(0)).cast("long").alias(n_dropped),
        F.when(dropped["gone"].isNull(), F.coalesce(docs[text_col], F.lit("")))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")).alias(kept_text),
    )
