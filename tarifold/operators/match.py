"""Resolution of catalog products against the offers of other stores.

Per product and store there is at most one match: the first offer with the same sku, else the
most similar offer text at or above a threshold.
"""

from __future__ import annotations

import math
import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import LESS, TAG_BITS, UPPER, best_in_tile, comparison_text, near_keys, sorted_similarity
from ..functions.text import filled
from ..plans.once import computed_once
from ..plans.skew import join_lookup
from ..rules import settings as S
from ..session import ensure_checkpoint_dir

MATCH = (
    "array<struct<comp_ord:int,domain:string,name:string,title:string,price_eur:double,"
    "confidence:double>>"
)
# Texts and characters of our side and of the other side in a tile, and the most tasks that tiles are dealt to.
TILE_SIDE, TILE_CELLS = 1 << 12, 1 << 19
OTHER_SIDE, OTHER_CELLS = 1 << 16, 1 << 22
MOST_TASKS = 2000
# Characters whose keys are made at once.
KEYED_CHARACTERS = 1 << 18


def sku_key(c: Column) -> Column:
    return F.nullif(F.upper(filled(c)), F.lit(""))


def _match(confidence: Column) -> Column:
    return F.struct(
        "comp_ord", "domain", "name", "title", "price_eur", confidence.alias("confidence")
    )


def offers_by_sku(offers: DataFrame) -> DataFrame:
    """One row per sku with its first offer in every store, in store order.

    Aggregating before the join leaves one row per (sku, store), and one array of at most as
    many entries as there are stores.
    """
    match = _match(F.lit(1.0))
    return (
        offers.withColumn("sku_key", sku_key(F.col("sku")))
        .filter("sku_key IS NOT NULL")
        .groupBy("sku_key", "domain").agg(F.min_by(match, "offer_ord").alias("match"))
        .groupBy("sku_key").agg(F.sort_array(F.collect_list("match")).alias("by_sku"))
    )


def match_by_sku(products: DataFrame, offers: DataFrame) -> DataFrame:
    """Add ``by_sku``: the sku matches of each product in store order (confidence 1)."""
    keyed = products.withColumn("sku_key", sku_key(F.col("sku")))
    return _with_sku_matches(keyed, keyed, offers).drop("sku_key")


def _with_sku_matches(keyed: DataFrame, base: DataFrame, offers: DataFrame) -> DataFrame:
    joined = join_lookup(keyed, offers_by_sku(offers), "sku_key", F.col("ord"), keys=base)
    return joined.withColumn("by_sku", F.coalesce("by_sku", F.array().cast(MATCH)))


def _band_factor(threshold: float) -> float:
    """Lengths of alike texts differ by a factor of at most ``(2 - t) / t``: bands of slightly more
    than that factor put them into the same or a neighbouring band."""
    return (2.0 - threshold) / threshold * 1.02


def _length_band(threshold: float) -> Column:
    return F.floor(F.log(F.length("text").cast("double")) / F.lit(math.log(_band_factor(threshold)))).cast("int")


# --- near texts: a lossless index ---------------------------------------------------------------

def _near_keys(texts: DataFrame, near: float) -> DataFrame:
    """``key, id, tag`` for every key under which texts with a score of ``near`` or more meet, see ``near_keys``.

    Rows of numbers only: a text has about twice as many keys as characters. ``id`` is its hash; should two texts share one,
    their pairs are looked at together, and none is lost.
    """
    factor = _band_factor(near)

    def keyed(batches):
        for batch in batches:
            lengths = batch["text"].str.len().to_numpy()
            ends = np.flatnonzero(np.diff(np.cumsum(lengths) // KEYED_CHARACTERS, prepend=0)).tolist()
            for start, end in zip([0, *ends], [*ends, len(batch)], strict=True):
                if start < end:
                    row, key, tag = near_keys(list(batch["text"].iloc[start:end]), near, factor)
                    yield pd.DataFrame({"key": key, "id": batch["id"].to_numpy()[start:end][row], "tag": tag})

    return texts.select(F.xxhash64("text").alias("id"), "text").mapInPandas(keyed, "key long, id long, tag int")


def near_pairs(ours: DataFrame, theirs: DataFrame, near: float) -> DataFrame:
    """Pairs (``text``, ``other``) that can score ``near`` or more, each once; none that does is missing.

    The keys are many times the texts, which the size of the tables doesn't tell: the join is told never to broadcast them.
    """
    left = _near_keys(ours.select("text"), near)
    right = _near_keys(theirs.select("text"), near).withColumnsRenamed({"id": "_id", "tag": "_tag"})
    bits = F.col("tag").bitwiseAND(F.col("_tag"))
    met = left.join(right.hint("merge"), "key").where(bits.bitwiseAND(F.lit(LESS | UPPER)) == 0)
    # texts of alike lengths only; cheap, and most pairs that share a key by chance go here
    la, lb = F.shiftright("tag", TAG_BITS), F.shiftright("_tag", TAG_BITS)
    pairs = met.where(F.lit(2.0) * F.least(la, lb) >= F.lit(near - 1e-9) * (la + lb)).select("id", "_id").distinct()
    texts = ours.select(F.xxhash64("text").alias("id"), "text")
    others = theirs.select(F.xxhash64("text").alias("_id"), F.col("text").alias("other"))
    return pairs.join(texts.hint("merge"), "id").join(others.hint("merge"), "_id").select("text", "other")


def best_near(ours: DataFrame, theirs: DataFrame, near: float, pairs=None) -> DataFrame:
    """Best offer per (our text, store) among the pairs that score ``near`` or more."""
    met = near_pairs(ours, theirs, near)
    scored = met.withColumn("score", sorted_similarity(F.col("text"), F.col("other"), pairs)).where(F.col("score") >= near)
    carried = theirs.select(F.col("text").alias("other"), F.arrays_zip("stores", "offers").alias("_carried"))
    each = scored.join(carried.hint("merge"), "other").select("text", "score", F.inline("_carried").alias("comp_ord", "offer_ord"))
    return _winners(each)


def _winners(found: DataFrame) -> DataFrame:
    best = F.max(F.struct("score", (-F.col("offer_ord")).alias("later"))).alias("best")
    return found.groupBy("text", "comp_ord").agg(best).select(
        "text", "comp_ord", "best.score", (-F.col("best.later")).alias("offer_ord")
    )


# --- the rest: tiles ----------------------------------------------------------------------------

def _chunks(texts: DataFrame, threshold: float, most: int, cells: int) -> tuple[DataFrame, dict[int, int]]:
    """One row per chunk of ``texts`` with its length band, number and rows in one value, and the chunks of each band.

    A band has at most ``most`` texts and ``cells`` characters or entries of its lists a chunk, for short and for long texts
    alike. A chunk goes to many tiles: as one compressed value it is one row there, however many texts it has.
    """
    lists = [n for n in texts.columns if n != "text"]
    placed = texts.withColumn("bucket", _length_band(threshold))
    side = F.greatest(F.lit(16), F.least(F.lit(most), F.floor(F.lit(cells) / F.max(F.length("text")))))
    needed = [F.count(F.lit(1)) / side, *[F.sum(F.size(n)) / F.lit(cells) for n in lists]]
    rows = placed.groupBy("bucket").agg(F.greatest(*[F.ceil(x) for x in needed]).cast("int").alias("chunks")).collect()
    sizes = {r["bucket"]: max(1, r["chunks"]) for r in rows}
    known = texts.sparkSession.createDataFrame(list(sizes.items()), "bucket int, chunks int")
    chunk = F.pmod(F.xxhash64("text"), F.col("chunks")).cast("int")
    placed = placed.join(F.broadcast(known), "bucket").withColumn("chunk", chunk).drop("chunks")

    def as_value(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("text")  # alike ones side by side, which packs better
        flat = [np.concatenate([np.asarray(x) for x in pdf[n]]) for n in lists]
        value = pickle.dumps([list(pdf["text"]), *[([len(x) for x in pdf[n]], f) for n, f in zip(lists, flat, strict=True)]])
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "chunk": pdf["chunk"].iloc[:1], "rows": [zlib.compress(value, 1)]})

    packed = placed.groupBy("bucket", "chunk").applyInPandas(as_value, "bucket int, chunk int, rows binary")
    return packed, sizes


def _rows_of(value: bytes) -> list:
    """The texts of a chunk, and for each of its list columns one array per text."""
    texts, *lists = pickle.loads(zlib.decompress(value))
    return [texts, *[np.split(flat, np.cumsum(lengths)[:-1]) for lengths, flat in lists]]


def best_in_tiles(ours: DataFrame, theirs: DataFrame, threshold: float, pairs=None) -> DataFrame:
    """Best offer per (our text, store) for the stores that are not in ``done`` of our text.

    Both sides are cut into chunks by length band and hash, every pair of chunks that can hold a match meets in one
    small task, and a task gives out winners only, never pairs. Chunks of the other side are large: the more of their texts
    one of ours sees at once, the sooner its best is found and the fewer pairs are compared.
    """
    left, left_sizes = _chunks(ours.select("text", "done"), threshold, TILE_SIDE, TILE_CELLS)
    right, right_sizes = _chunks(theirs.select("text", "stores", "offers"), threshold, OTHER_SIDE, OTHER_CELLS)

    def meet(rows: DataFrame, sizes: dict[int, int], own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        near = F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)]))
        there = rows.sparkSession.createDataFrame(list(sizes.items()), f"{other[0]} int, chunks int")
        return (
            rows.withColumnsRenamed({"chunk": own[1]})
            .withColumn(other[0], near)
            .withColumnRenamed("bucket", own[0])
            .join(F.broadcast(there), other[0])
            .withColumn(other[1], F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .drop("chunks")
        )

    tile = ["lb", "lc", "rb", "rc"]
    tiles = sum(n * right_sizes.get(band + d, 0) for band, n in left_sizes.items() for d in (-1, 0, 1))
    tasks = max(1, min(tiles, MOST_TASKS))
    left = meet(left, right_sizes, ("lb", "lc"), ("rb", "rc")).repartition(tasks, *tile)
    right = meet(right, left_sizes, ("rb", "rc"), ("lb", "lc")).repartition(tasks, *tile)

    def winners(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(lp) and len(rp):
            texts, done = _rows_of(lp["rows"].iloc[0])
            there = _rows_of(rp["rows"].iloc[0])
            names = np.array(texts, dtype=object)
            for a, store, score, offer in best_in_tile(texts, *there, threshold, done, pairs):
                parts.append((names[a], store, score, offer))
        text, store, score, offer = (
            map(np.concatenate, zip(*parts)) if parts else (np.zeros(0, dtype=x) for x in (object, "int32", "float64", "int64")))
        return pd.DataFrame({"text": text, "comp_ord": store, "score": score, "offer_ord": offer})

    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(
        winners, "text string, comp_ord int, score double, offer_ord bigint"
    )
    return _winners(found)


def best_by_text(ours: DataFrame, theirs: DataFrame, threshold: float = S.MIN_CONFIDENCE, near: float = S.NEAR_CONFIDENCE,
                 pairs=None) -> DataFrame:
    """Best offer per (our text, store). ``ours`` has distinct ``text``; ``theirs`` distinct ``text`` with ``stores`` and
    ``offers``, arrays of the same length. Returns ``text, comp_ord, score, offer_ord``.

    Two rungs, as only the best offer counts. What scores ``near`` or more is found through an index and settles that
    store for that text. Only texts with stores left go on to the exhaustive tiles, and there only against texts that such a
    store carries. ``pairs`` is an accumulator that counts the pairs looked at.
    """
    if threshold >= near:
        return best_near(ours, theirs, threshold, pairs)
    settled = best_near(ours, theirs, near, pairs).checkpoint()
    stores = theirs.select(F.explode("stores").alias("s")).agg(F.count_distinct("s").alias("n")).first()["n"]
    done = settled.groupBy("text").agg(F.collect_list("comp_ord").alias("done"))
    open_ = ours.select("text").join(done, "text", "left").withColumn("done", F.coalesce("done", F.array().cast("array<int>")))
    rest = best_in_tiles(open_.where(F.size("done") < stores), theirs, threshold, pairs)
    return settled.unionByName(rest)


def offers_by_text(texts: DataFrame, offers: DataFrame, threshold: float = S.MIN_CONFIDENCE) -> DataFrame:
    """One row per distinct product text: its most similar offer of each store at or above
    ``threshold``, in store order; equal scores go to the earlier offer.

    Texts are scored once, however many rows share them. The text tables and the winners are
    narrow and read several times, so they are checkpointed.
    """
    ensure_checkpoint_dir(texts.sparkSession)
    theirs = computed_once(offers, text=F.nullif(comparison_text(F.col("vendor"), F.col("title")), F.lit("")))
    detail = F.struct("offer_ord", "domain", "name", "title", "price_eur")
    firsts = (
        theirs.filter("text IS NOT NULL").groupBy("text", "comp_ord").agg(F.min(detail).alias("first"))
        .select("text", "comp_ord", "first.*").checkpoint()
    )
    carried = firsts.groupBy("text").agg(F.collect_list(F.struct("comp_ord", "offer_ord")).alias("x")).select(
        "text", F.col("x.comp_ord").alias("stores"), F.col("x.offer_ord").alias("offers")
    ).checkpoint()
    ours = texts.filter("text IS NOT NULL").select("text").distinct().checkpoint()
    offer_key = F.struct("comp_ord", "offer_ord").alias("offer_key")
    best = best_by_text(ours, carried, threshold).select("text", "score", offer_key).checkpoint()

    confidence = F.floor(F.col("score") * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)
    details = firsts.select(offer_key, "comp_ord", "domain", "name", "title", "price_eur")
    return (
        join_lookup(best, details, "offer_key", F.col("text"), "inner")
        .groupBy("text").agg(F.sort_array(F.collect_list(_match(confidence))).alias("by_text"))
    )


def _text_key() -> Column:
    return F.nullif(comparison_text(filled(F.col("brand")), filled(F.col("title"))), F.lit(""))


def match_by_text(products: DataFrame, offers: DataFrame, threshold: float = S.MIN_CONFIDENCE) -> DataFrame:
    """Add ``by_text``: the text matches of each product in store order."""
    keyed = products.withColumn("text", _text_key())
    return _with_text_matches(keyed, keyed, offers, threshold).drop("text")


def _with_text_matches(keyed: DataFrame, base: DataFrame, offers: DataFrame, threshold: float) -> DataFrame:
    joined = join_lookup(keyed, offers_by_text(base, offers, threshold), "text", F.col("ord"), keys=base)
    return joined.withColumn("by_text", F.coalesce("by_text", F.array().cast(MATCH)))


def match_all(products: DataFrame, offers: DataFrame, threshold: float = S.MIN_CONFIDENCE) -> DataFrame:
    """Add ``matches``: per store the sku match, else the text match, in store order."""
    base = products.withColumn("sku_key", sku_key(F.col("sku"))).withColumn("text", _text_key())
    both = _with_text_matches(_with_sku_matches(base, base, offers), base, offers, threshold)
    by_sku = F.col("by_sku.domain")
    others = F.filter("by_text", lambda m: ~F.array_contains(by_sku, m["domain"]))
    return both.withColumn("matches", F.sort_array(F.concat("by_sku", others))).drop(
        "by_sku", "by_text", "sku_key", "text"
    )
