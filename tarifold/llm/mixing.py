"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored

#: Means beyond this are drawn as a sum of several smaller ones, so that exp(-mean) stays a normal number.
STEP = 64.0


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of a text; the same on every engine."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_of(mean: Column, u: Column) -> Column:
    """Smallest k whose cumulative Poisson probability exceeds ``u``.

    The sum runs to mean + 12 sqrt(mean) + 20 terms, beyond which less than 2**-53 is left.
    """
    terms = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        more = s["cdf"] <= u
        return F.struct(p.alias("p"), F.when(more, s["cdf"] + p).otherwise(s["cdf"]).alias("cdf"),
                        F.when(more, i).otherwise(s["k"]).alias("k"))

    return F.aggregate(terms, start, step, lambda s: s["k"])


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, total_rows: int | None = None,
                seed: int = 11, shuffle: bool = True, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Each document as often as a Poisson number says whose mean brings its source to its weight.

    ``weights`` gives each source's part of the output (any positive scale; a source that it leaves
    out has weight 0 and goes). None: all sources alike. ``total_rows`` is the expected size of the
    output, the input's size if None. A source with n documents and weight w gets the mean
    ``w * total / n`` per document. Only one count per source is gathered, combined before the
    shuffle, so a source with a third of all rows costs nothing more.

    The number depends on (seed, id, source) alone, so a rerun or a lost executor draws the same;
    repeated rows draw the same number each. NULL sources are one source (key ``''``, shared with
    the empty name); NULL ids and NULL or empty texts are documents like others. An empty table
    gives an empty table. Added columns: ``repetition_rate``, ``n_copies``, ``copy`` (from 1),
    ``shuffle_key``, with ``_`` in front where ``docs`` has such a column. With ``shuffle`` the copies are dealt by range of that hash key and sorted by it.
    """
    name = free_name(docs, "source_key")
    rate, n_copies, copy, shuffle_key = (free_name(docs, c) for c in ("repetition_rate", "n_copies", "copy", "shuffle_key"))
    docs = docs.withColumn(name, F.coalesce(F.col(source_col), F.lit("")))
    sizes = docs.groupBy(name).agg(F.count("*").alias("n_of_source"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = [(str(k), float(v)) for k, v in weights.items()]
        given = docs.sparkSession.createDataFrame(given, f"{name} string, weight double")
        sizes = sizes.join(F.broadcast(given), name)
    sums = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("n_of_source").alias("n_all"))
    wanted = F.col("n_all").cast("double") if total_rows is None else F.lit(float(total_rows))
    rates = sizes.crossJoin(F.broadcast(sums)).select(  # one row on the right
        name, (F.col("weight") / F.col("all_weight") * wanted / F.col("n_of_source")).alias(rate),
    )
    rates = stored(rates, "mix-rates")  # its size is then known, and Spark broadcasts it only within its own limit
    rated = docs.join(rates, name)
    draws = F.greatest(F.ceil(F.col(rate) / STEP), F.lit(1)).cast("int")
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(name))
    part = F.col(rate) / draws
    number = F.aggregate(
        F.sequence(F.lit(1), draws), F.lit(0),
        lambda n, i: n + poisson_of(part, uniform(F.concat_ws(":", key, i.cast("string")))),
    )
    copies = rated.withColumn(n_copies, number).where(F.col(n_copies) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(n_copies))),
    ).withColumn(shuffle_key, F.md5(F.concat_ws(":", F.lit("order"), key, F.col(copy).cast("string")).cast("binary"))).drop(name)
    if shuffle:
        copies = copies.repartitionByRange(F.col(shuffle_key)).sortWithinPartitions(shuffle_key, id_col)
    return copies
