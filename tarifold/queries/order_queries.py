"""Order-dependent operators: duplicates, handles, positions, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import url_slug
from ..operators import dedupe, handles
from ..plans.ranks import global_position
from . import sqltext as Q
from .registry import query

c = F.col

_DOCS = """SELECT doc_id AS ord, 'https://doc.example/' || md5(text) AS url, lang || ' ' || source AS title,
  CASE WHEN n_chars % 7 = 0 THEN '' WHEN n_chars % 11 = 0 THEN '  ' ELSE ' S' || CAST(n_chars % 400 AS STRING) END AS sku FROM documents"""


# Walks the rows one by one and carries the keys seen on kept rows.
def _walk(rows: str) -> str:
    return f"""
rows_in AS MATERIALIZED (SELECT *, trim(sku) AS k, row_number() OVER (ORDER BY ord) AS n FROM ({rows}) d),
walk(n, skus, urls, keep) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), false
  UNION ALL
  SELECT r.n, CASE WHEN ok AND k <> '' THEN list_append(skus, k) ELSE skus END, CASE WHEN ok THEN list_append(urls, url) ELSE urls END, ok
  FROM walk w JOIN rows_in r ON r.n = w.n + 1,
    LATERAL (SELECT NOT ((k <> '' AND list_contains(skus, k)) OR list_contains(urls, url)) AS ok) x
)"""


_WALK = _walk(_DOCS)


def flagged(t):
    return dedupe.keep_first_by_two_keys(t.sql(_DOCS))


@query("greedy_deduplication", f"WITH RECURSIVE {_WALK} SELECT r.ord, w.keep AS kept FROM walk w JOIN rows_in r ON r.n = w.n")
def _(t):
    return flagged(t).select("ord", "kept")


@query("duplicates_log", f"WITH RECURSIVE {_WALK} SELECT r.title, r.sku, r.url FROM walk w JOIN rows_in r ON r.n = w.n WHERE NOT keep")
def _(t):
    return dedupe.duplicates_log(flagged(t))


@query("duplicate_count", f"""WITH RECURSIVE {_WALK} SELECT CAST(count_if(NOT keep) AS BIGINT) AS duplicates, CAST(count_if(keep) AS BIGINT) AS unique_rows
FROM walk w WHERE n > 0""")
def _(t):
    from ..operators.summaries import duplicate_count

    return duplicate_count(flagged(t))


_ORDERS = """SELECT o_orderkey AS ord, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'C' || CAST(o_custkey AS STRING) END AS sku,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || o_orderstatus AS url FROM orders"""


@query("greedy_deduplication_of_orders", f"WITH RECURSIVE {_walk(_ORDERS)} SELECT r.ord, w.keep AS kept FROM walk w JOIN rows_in r ON r.n = w.n")
def _(t):
    return dedupe.keep_first_by_two_keys(t.sql(_ORDERS)).select("ord", "kept")


_TITLES = """SELECT p_partkey AS ord, CASE WHEN p_size = 1 THEN '---' WHEN p_size = 2 THEN 'Product'
  WHEN p_size = 3 THEN p_name || '-dup' WHEN p_size = 4 THEN p_name || ' s 5' ELSE p_name || ' ' || p_type END AS title,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE 'S/' || CAST(p_size AS STRING) END AS sku FROM part"""
_HANDLES = f"""
slugs AS MATERIALIZED (SELECT ord, {Q.url_slug('title')} AS slug, CASE WHEN sku <> '' THEN '-' || {Q.url_slug('sku')} ELSE '-dup' END AS suffix,
  row_number() OVER (ORDER BY ord) AS n FROM ({_TITLES}) t),
walk(n, used, handle) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), ''
  UNION ALL
  SELECT s.n, list_append(used, h), h FROM walk w JOIN slugs s ON s.n = w.n + 1,
    LATERAL (SELECT CASE WHEN slug = '' THEN 'product' WHEN list_contains(used, slug) THEN slug || suffix ELSE slug END AS h) x
)"""


@query("unique_handles", f"WITH RECURSIVE {_HANDLES} SELECT s.ord, w.handle FROM walk w JOIN slugs s ON s.n = w.n")
def _(t):
    return handles.unique_handles(t.sql(_TITLES)).select("ord", "handle")



@query("first_value_per_label", """
SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) FILTER (l_returnflag = 'R') AS returned,
  arg_min(l_partkey, (l_linenumber, l_partkey)) FILTER (l_returnflag = 'A') AS accepted FROM lineitem GROUP BY l_orderkey""")
def _(t):
    at = F.struct("l_linenumber", "l_partkey")
    first = lambda flag: F.min_by("l_partkey", F.when(c("l_returnflag") == flag, at))
    return t("lineitem").groupBy("l_orderkey").agg(first("R").alias("returned"), first("A").alias("accepted"))


@query("ordered_distinct", """
SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM (
  SELECT doc_id, word, min(pos) AS pos FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents) x
  GROUP BY doc_id, word) y GROUP BY doc_id""")
def _(t):
    return t("documents").select("doc_id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words"))


@query("append_if_absent", """
SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS words FROM (
  SELECT doc_id, word, min(pos) AS pos FROM (SELECT doc_id, unnest(list_concat(string_split(text, ' '), string_split(source || ' the ' || lang, ' '))) AS word,
    generate_subscripts(list_concat(string_split(text, ' '), string_split(source || ' the ' || lang, ' ')), 1) AS pos FROM documents) x
  GROUP BY doc_id, word) y GROUP BY doc_id""")
def _(t):
    from ..operators.extract import add_if_absent

    more = F.split(F.concat("source", F.lit(" the "), "lang"), " ")
    return t("documents").select("doc_id", F.array_join(add_if_absent(F.split("text", " "), more), " ").alias("words"))


@query("row_positions", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM (SELECT o_orderkey * 70000 AS o_orderkey FROM orders) o")
def _(t):
    keys = t("orders").select((c("o_orderkey") * 70000).alias("o_orderkey"))
    return global_position(keys, "o_orderkey", "pos")


@query("fixed_size_batches", """
WITH p AS (SELECT doc_id, text, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 10) AS BIGINT) AS batch FROM documents)
SELECT batch, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY doc_id) AS ids, md5(string_agg(text, '|' ORDER BY doc_id)) AS texts FROM p GROUP BY batch""")
def _(t):
    from ..operators.translate import translation_batches

    batches = translation_batches(t("documents").select(c("doc_id").alias("ord"), c("text").alias("description_nl")))
    return batches.select(
        "batch", F.size("items").cast("bigint").alias("n"),
        F.array_join(F.transform("items", lambda i: i["ord"].cast("string")), "|").alias("ids"),
        F.md5(F.encode(F.array_join("items.description_nl", "|"), "utf-8")).alias("texts"))


_LISTING = """SELECT CAST(l_returnflag AS STRING) AS brand, CAST(l_linenumber AS INT) AS page_no, 'https://shop.example/p' || CAST(l_partkey AS STRING) AS url FROM lineitem"""


@query("first_page_of_url", f"SELECT brand, url, min(page_no) AS page_no FROM ({_LISTING}) x GROUP BY brand, url")
def _(t):
    return dedupe.first_page_of_url(t.sql(_LISTING))


_SEEN = "SELECT 'https://shop.example/p' || CAST(p_partkey AS STRING) AS url FROM part WHERE p_type = 'PROMO'"


@query("new_urls", f"SELECT url FROM ({_LISTING}) x EXCEPT SELECT url FROM ({_SEEN}) y")
def _(t):
    return dedupe.new_urls(t.sql(_LISTING), t.sql(_SEEN))


@query("page_slug_handles", f"""SELECT page_id, {Q.url_slug('html')} AS slug FROM pages""")
def _(t):
    return t("pages").select("page_id", url_slug(c("html")).alias("slug"))


