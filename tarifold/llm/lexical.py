"""Ranked lexical search: summed accumulators of short lists join document-at-a-time skipping over long ones."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

#: A-Z lower-cased, everything that parts terms a space; all bytes of other characters belong to terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Postings of one block of documents, documents of one run within it, and texts in one Arrow batch's slice.
BLOCK_POSTINGS = 2_000_000
BLOCK_DOCS = 65_536
RUN_DOCS = 4_096
#: Lists are summed up front while they hold less than this share of a block's documents together.
SHORT_SHARE = 0.25
#: Bytes of item texts that are searched in one pass.
PASS_BYTES = 64 << 20


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, with repeats."""
    return text.translate(TERM_BYTES).split()


@dataclass
class Items:
    """Items of a pass: ``numbers`` of their distinct terms, in ``vocabulary`` order, and their ids."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def _collected(items: DataFrame) -> Items:
    by_id: dict = {}
    for row in items.collect():
        by_id.setdefault(row["id"], set()).update(terms((row["text"] or "").encode()))
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*by_id.values())))}
    return Items(list(by_id), [np.array(sorted(vocabulary[t] for t in ts), dtype=np.int64) for ts in by_id.values()], vocabulary)


def _postings(vocabulary: dict[bytes, int], id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("length", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lengths, numbers, counts = [], [], []
                for text in part.column("text"):
                    found = terms(text.as_py() or b"")
                    held = Counter(vocabulary[t] for t in found if t in vocabulary)
                    lengths.append(len(found))
                    numbers.append(list(held))
                    counts.append(list(held.values()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(lengths, pa.int64()), pa.array(numbers, schema[2].type), pa.array(counts, schema[3].type)], schema=schema)

    return run


class Top:
    """The k best documents of an item so far: scores downwards, equal scores by id (NULL last)."""

    def __init__(self, k: int):
        self.k, self.best = k, []

    @property
    def bar(self) -> int:
        """A document with a lower score can't be among the best."""
        return self.best[-1][0] if len(self.best) == self.k else 1

    def add(self, scores: np.ndarray, places: np.ndarray, ids: list) -> None:
        """Documents by their ``places`` in ``ids``, which ascend."""
        first = np.lexsort((places, -scores))[: self.k]
        self.best += [(int(scores[i]), ids[places[i]]) for i in first]
        self.best = sorted(self.best, key=lambda x: (-x[0], x[1] is None, x[1]))[: self.k]


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], ids: list, top: Top, run_docs: int = RUN_DOCS) -> int:
    """Put the block's best documents into ``top``; returns how many documents were scored.

    ``ids`` are the block's documents, ascending; ``lists`` has for each term the ascending places of its documents and
    their impacts. The shortest lists are summed
    term by term into accumulators, which then are one more list, whose bound is the largest sum. Over this list and the
    long ones, documents are taken in runs: lists whose bounds together stay below the bar open no document; what the
    others open is looked up in them, from the highest bound down, and given up once it can't reach the bar any more.
    """
    docs = len(ids)
    lists = sorted(lists, key=lambda x: len(x[0]))
    held = np.cumsum([len(x[0]) for x in lists])
    short = max(1, int(np.searchsorted(held, docs * SHORT_SHARE, side="right"))) if lists else 0
    sums = np.zeros(docs, dtype=np.int64)
    for places, impacts in lists[:short]:
        sums[places] += impacts
    places = np.flatnonzero(sums)
    iterators = [(places, sums[places]), *lists[short:]]
    iterators = sorted((x for x in iterators if len(x[0])), key=lambda x: int(x[1].max()))
    bounds = np.cumsum([int(x[1].max()) for x in iterators])  # of the lists up to each, together
    scored = 0
    for first in range(0, docs, run_docs):
        last = min(first + run_docs, docs)
        idle = int(np.searchsorted(bounds, top.bar, side="left"))  # their documents can't reach the bar by themselves
        score = np.zeros(last - first, dtype=np.int64)
        opened = np.zeros(last - first, dtype=bool)
        for places, impacts in iterators[idle:]:
            a, b = np.searchsorted(places, (first, last))
            score[places[a:b] - first] += impacts[a:b]
            opened[places[a:b] - first] = True
        at = np.flatnonzero(opened)
        score = score[at]
        for n in range(idle - 1, -1, -1):
            able = score + bounds[n] >= top.bar
            at, score = at[able], score[able]
            if not len(at):
                break
            places, impacts = iterators[n]
            near = np.searchsorted(places, at + first)
            near[near == len(places)] = 0
            score = score + np.where(places[near] == at + first, impacts[near], 0)
        scored += len(at)
        good = score >= top.bar
        if good.any():
            top.add(score[good], first + at[good], ids)
    return scored


def impacts(weights: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """w * ((10^9 tf) div (1000 tf + 8 m)), m = 10 + (90 n N) div L."""
    longest = int(lengths.max(initial=0))
    if 90 * longest * n_docs < 2**63:
        share = 90 * lengths * n_docs // n_terms
    else:
        share = np.array([90 * int(x) * n_docs // n_terms for x in lengths], dtype=np.int64)
    return weights * (1_000_000_000 * tfs // (1000 * tfs + 8 * (10 + share)))


def _search(items: Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int, item_type: pa.DataType, id_type: pa.DataType):
    schema = pa.schema([("item", item_type), ("id", id_type), ("score", pa.int64())])

    def search(batches: list[pa.RecordBatch], tops: list[Top]) -> None:
        """One block: its postings by term and id, then every item."""
        table = pa.Table.from_batches(batches).combine_chunks()
        table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_end"))
        length = table["length"].to_numpy()
        doc = np.repeat(np.arange(len(length)), pc.list_value_length(table["terms"]).to_numpy())
        term, tf = (pc.list_flatten(table[c]).to_numpy().astype(np.int64) for c in ("terms", "tfs"))
        by_term = np.argsort(term, kind="stable")
        doc, term, tf = doc[by_term], term[by_term], tf[by_term]
        impact = impacts(weights[term], tf, length[doc], n_docs, n_terms)
        starts = np.searchsorted(term, np.arange(len(weights) + 1))
        ids = table["id"].to_pylist()
        for numbers, top in zip(items.terms, tops, strict=True):
            lists = [(doc[starts[t]:starts[t + 1]], impact[starts[t]:starts[t + 1]]) for t in numbers if starts[t] < starts[t + 1]]
            if lists:
                search_block(lists, ids, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in items.ids]
        waiting, held, docs = [], 0, 0
        for batch in batches:
            waiting.append(batch)
            held += pc.sum(pc.list_value_length(batch.column("terms"))).as_py() or 0
            docs += batch.num_rows
            if held >= BLOCK_POSTINGS or docs >= BLOCK_DOCS:
                search(waiting, tops)
                waiting, held, docs = [], 0, 0
        if docs:
            search(waiting, tops)
        for item, top in zip(items.ids, tops, strict=True):
            if top.best:
                scores, ids = zip(*top.best, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), item_type), pa.array(ids, id_type), pa.array(scores, pa.int64())], schema=schema)

    return run


def _one_pass(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    asked = _collected(items)
    id_kind, item_kind = docs.schema["id"].dataType, items.schema["id"].dataType
    postings = stored(docs.mapInArrow(
        _postings(asked.vocabulary, to_arrow_type(id_kind)), f"id {id_kind.simpleString()}, length long, terms array<int>, tfs array<int>"), "postings")
    whole = postings.agg(F.count_if(F.col("length") > 0).alias("docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(asked.vocabulary), dtype=np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the vocabulary
        weights[row["term"]] = math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * row["count"] + 1)))
    return postings.where(F.size("terms") > 0).mapInArrow(
        _search(asked, weights, whole["docs"], whole["terms"], k, to_arrow_type(item_kind), to_arrow_type(id_kind)),
        f"item {item_kind.simpleString()}, id {id_kind.simpleString()}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(``item_id``, ``rank`` from 1, ``doc_id``, ``score``): each item's k documents of the highest score above 0.

    Documents are tokenised where they lie; what is written are the postings of the items' terms, document by
    document. Every task then searches the documents it holds for all items, block by block, and hands on k of them
    per item at most; these meet in one top-k per item. Counts (documents, terms, document frequencies) cover all rows.

    Items are the queries: they are taken in passes of about ``pass_bytes`` of item text by a hash of their id, and
    one pass's terms are all that the driver and each task hold beside a block. Rows that share an item id are one item
    with the terms of all; a NULL id is one item. Documents are rows: repeated ones count and rank each, equal scores
    by id, NULL last. NULL, empty and termless texts are no documents and items of no result. Empty tables give an
    empty table. Other columns play no part.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    items = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text"))
    passes = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // pass_bytes) or 1
    found = None
    for n in range(passes):
        some = items.where(F.coalesce(F.pmod(F.xxhash64("id"), F.lit(passes)), F.lit(0)) == n)
        part = _one_pass(docs, some, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
