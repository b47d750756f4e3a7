"""Run counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export, summaries, translate
from . import inputs as I
from . import sqltext as Q
from .registry import query

c = F.col

_FETCHED = """SELECT regexp_extract(url, '://([^/]*)', 1) AS brand, CASE WHEN length(html) > 4000 THEN 503 ELSE 200 END AS status,
  length(html) <= 4000 AND length(html) > 2000 AS is_product FROM pages"""


@query("scrape_funnel", f"""SELECT brand, count(*) AS urls, CAST(count_if(is_product) AS BIGINT) AS products, CAST(count_if(status <> 200) AS BIGINT) AS failures
FROM ({_FETCHED}) x GROUP BY brand""")
def _(t):
    return summaries.scrape_funnel(t.sql(_FETCHED))


@query("cleaned_descriptions", f"""SELECT CAST(count_if({Q.clean('description_nl')} <> description_nl) AS BIGINT) AS cleaned, count(*) AS products
FROM ({I.DESCRIPTIONS}) d""")
def _(t):
    return summaries.cleaned_count(translate.clean_all(t.sql(I.DESCRIPTIONS)))


_IMAGES = """SELECT DISTINCT l_partkey AS ord, l_suppkey AS pos, CAST(l_suppkey AS STRING) || '.jpg' AS image, 'S' || CAST(l_partkey % 300 AS STRING) AS sku FROM lineitem"""


@query("image_manifest", f"""
WITH x AS ({_IMAGES}), s AS (SELECT p_partkey AS ord, CASE WHEN p_size = 50 THEN '' ELSE 'S' || CAST(p_size AS VARCHAR) || p_name END AS sku FROM part WHERE p_partkey IN (SELECT ord FROM x)),
last AS (SELECT sku, max(ord) AS ord FROM s GROUP BY sku)
SELECT l.sku, (SELECT string_agg(image, '|' ORDER BY pos) FROM x WHERE x.ord = l.ord) AS images FROM last l""")
def _(t):
    lists = t.sql(_IMAGES).groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("pos", "image"))).alias("x"))
    part = t.sql("SELECT p_partkey AS ord, CASE WHEN p_size = 50 THEN '' ELSE 'S' || CAST(p_size AS STRING) || p_name END AS sku FROM part")
    manifest = export.image_manifest(part.join(lists, "ord", "left").withColumn("images", c("x.image")))
    return manifest.select("sku", F.array_join("images", "|").alias("images"))
