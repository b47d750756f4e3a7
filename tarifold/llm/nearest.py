"""Approximate nearest neighbours: inverted lists, scanned by blocks of rotated dimensions that give up on far candidates early."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Vectors of one list that one task scans; larger lists are split.
LIST_PART = 4096


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``id``, ``v`` as doubles, ``dims``) of the vectors that are not NULL, not zero, and whole and finite."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).withColumn("dims", F.size("v"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :], 0)


def centroids(sample: np.ndarray, lists: int, seed: int, rounds: int = 10) -> np.ndarray:
    random = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centre = distinct[random.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = squared(sample, centre).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, nearest, sample)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


def scan(query: np.ndarray, vectors: np.ndarray, k: int, block: int, doubt: float, step: int = 512) -> np.ndarray:
    """Which vectors may be among the k nearest. All arguments are rotated by the same random rotation.

    After d of D dimensions the partial distance, scaled by D/d, estimates the whole one; a candidate whose
    estimate exceeds the k-th best so far by more than the test's margin ``1 + doubt / sqrt(d)`` is abandoned.
    Vectors come ``step`` at a time, and the k-th best gets better with each step.
    """
    n, dims = vectors.shape
    kept, best = [], np.full(k, np.inf)
    for start in range(0, n, step):
        alive = np.arange(start, min(start + step, n))
        partial = np.zeros(len(alive))
        if best[-1] == np.inf:  # the first few are measured whole
            some = ((vectors[alive[:4 * k]] - query) ** 2).sum(axis=1)
            best = np.sort(np.concatenate([best, some]))[:k]
            seen = len(some)
        else:
            seen = 0
        bound = best[-1]
        for lo in range(0, dims, block):
            hi = min(lo + block, dims)
            partial = partial + ((vectors[alive, lo:hi] - query[lo:hi]) ** 2).sum(axis=1)
            # the margin vanishes at the last dimension, and rounding must not decide there
            margin = (1 + doubt / np.sqrt(hi)) ** 2 * hi / dims if hi < dims else 1 + 1e-9
            stays = partial <= bound * margin + 1e-12
            alive, partial = alive[stays], partial[stays]
        best = np.sort(np.concatenate([best, partial[alive >= start + seen]]))[:k]
        kept.append(alive)
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def enough_probes(sample: np.ndarray, centre: np.ndarray, k: int, target: float) -> int:
    """The fewest lists that find ``target`` of the k nearest of up to 256 sample vectors within the sample."""
    asked = sample[:256]
    far = squared(asked, sample)
    far[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(far, axis=1, kind="stable")[:, :min(k, max(len(sample) - 1, 1))]
    lists = squared(sample, centre).argmin(axis=1)
    order = np.argsort(np.argsort(squared(asked, centre), axis=1, kind="stable"), axis=1)  # when each list is probed
    needed = np.sort(np.take_along_axis(order, lists[near], axis=1).ravel()) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])


def _assign(centre: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = np.stack(batch["v"].to_numpy())
                yield pd.DataFrame({"list": squared(v, centre).argmin(axis=1).astype(np.int32), "id": batch["id"], "v": batch["v"]})

    return run


def _probe(centre: np.ndarray, probes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = np.argsort(squared(np.stack(batch["v"].to_numpy()), centre), axis=1, kind="stable")[:, :probes]
                yield pd.DataFrame({"query_id": batch["id"], "q": batch["v"], "list": list(near.astype(np.int32))})

    return run


def _search(rotation: np.ndarray, k: int, block: int, doubt: float):
    def run(key: tuple, members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        asked, found, scores = [], [], []
        if len(members) and len(queries):
            ids = members["id"].to_numpy()
            plain = np.stack(members["v"].to_numpy())
            turned = plain @ rotation
            for query_id, q in zip(queries["query_id"], queries["q"], strict=True):
                q = np.asarray(q, dtype=np.float64)
                others = np.flatnonzero(ids != query_id)  # the query's own rows set no bound
                near = others[scan(q @ rotation, turned if len(others) == len(ids) else turned[others], k, block, doubt)]
                score = np.sqrt(((plain[near] - q) ** 2).sum(axis=1))
                top = np.lexsort((ids[near], score))[:k]
                asked.append(np.full(len(top), query_id))
                found.append(ids[near][top])
                scores.append(score[top])
        if not asked:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return pd.DataFrame({"query_id": np.concatenate(asked), "vec_id": np.concatenate(found), "score": np.concatenate(scores)})

    return run


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, sample_rows: int = 20_000, lists: int | None = None,
                       probes: int | None = None, recall: float = 0.96, block: int = 16, doubt: float = 2.1, seed: int = 7,
                       id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): for each query its k nearest found, ties to the smaller id.

    The index is fitted on at most ``sample_rows`` vectors (smallest hash of the id), which is all that the driver sees; every
    vector is then assigned to its list. ``lists`` is the square root of the number of vectors, from 1 to 1024; a
    query probes ``probes`` lists, by default as many as give ``recall`` within the sample (vectors without any clusters need about
    half of the lists, clustered ones a few). Lists are split into parts of about ``LIST_PART``, so a
    vector that a third of all rows repeat is scanned by many tasks. Within a part, rotated vectors are
    scanned in column blocks and a test abandons most candidates early; those left get their exact distance on the
    original vectors. A query that finds fewer than k probes all lists.

    Rows whose vector is NULL, zero or has NULL or non-finite components take no part, nor do NULL ids or vectors of
    another length than most. Repeated rows of one id are candidates each, except for the query of that id; as a query an id is asked
    once (with its smallest vector). Fewer than k candidates: all of them. Empty tables give an empty table. Other columns play no part.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    base = usable(vectors, id_col, vector_col)
    lengths = base.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").first()
    if lengths is None:
        return empty
    dims, total = lengths["dims"], lengths["n"]
    base = base.where(F.col("dims") == dims).select("id", "v")
    asked = usable(queries, id_col, vector_col).where(F.col("dims") == dims).groupBy("id").agg(F.min("v").alias("v"))
    fit = base.withColumn("h", F.xxhash64(F.lit(seed), "id")).orderBy("h").limit(sample_rows).select("v").toPandas()
    sample = np.stack(fit["v"].to_numpy())
    lists = lists or int(np.clip(round(total ** 0.5), 1, 1024))
    centre = centroids(sample, lists, seed)
    probes = min(len(centre), probes or enough_probes(sample, centre, k, recall))
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))[0]

    kind = base.schema["id"].dataType.simpleString()
    index = stored(base.mapInPandas(_assign(centre), f"list int, id {kind}, v array<double>"), "ann-lists")
    parts = index.groupBy("list").agg(F.ceil(F.count("*") / LIST_PART).cast("int").alias("parts"))  # one row per list
    part = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")
    index = index.join(F.broadcast(parts), "list").select("list", part.alias("part"), "id", "v")

    def search(some: DataFrame, n: int) -> DataFrame:
        probed = some.mapInPandas(_probe(centre, n), f"query_id {kind}, q array<double>, list array<int>")
        probed = probed.select("query_id", "q", F.explode("list").alias("list")).join(F.broadcast(parts), "list")
        probed = probed.select("query_id", "q", "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        found = index.groupBy("list", "part").cogroup(probed.groupBy("list", "part")).applyInPandas(
            _search(rotation, k, block, doubt), f"query_id {kind}, vec_id {kind}, score double")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = stored(search(asked, probes), "ann-found")
    enough = found.where(F.col("rank") == min(k, max(total - 1, 1))).select(F.col("query_id").alias("id"))
    short = asked.join(enough, "id", "left_anti")
    if probes < len(centre) and not short.isEmpty():
        again = stored(search(short, len(centre)), "ann-found")
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")
