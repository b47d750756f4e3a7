"""Translations, images, quality flags, caches and other look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.wording import cache_key, numbered_blocks
from ..operators import images, quality, summaries, translate
from ..operators.fitment import normalize_brand
from ..rules import dictionaries as D
from ..sources import readers, writers
from . import inputs as I
from . import sqltext as Q
from .registry import query

c = F.col

# Products whose descriptions repeat, and a cache that knows some of the texts.
_DESCRIBED = f"""
SELECT p.*, coalesce(d.text, '') AS description_nl FROM ({I.PRODUCTS}) p LEFT JOIN documents d ON d.doc_id = p.ord
"""
_CACHE = """SELECT md5(text) AS key, CASE WHEN max(lang) = 'en' THEN text WHEN max(lang) = 'de' THEN '' ELSE 'EN ' || text END AS text_en
FROM documents WHERE lang <> 'es' GROUP BY text"""
_LOOKED_UP = f"""
SELECT p.ord, p.title, p.description_nl, coalesce(nullif(k.text_en, ''), p.description_nl) AS description_en
FROM ({_DESCRIBED}) p LEFT JOIN ({_CACHE}) k ON md5(p.description_nl) = k.key"""


@query("translation_lookup", f"SELECT ord, description_en FROM ({_LOOKED_UP}) x")
def _(t):
    return translate.look_up_translations(t.sql(_DESCRIBED), t.sql(_CACHE)).select("ord", "description_en")


@query("translation_outcome", f"""SELECT ord, description_en = description_nl AS translation_failed, {Q.title_terms('title')} AS title_en FROM ({_LOOKED_UP}) x""")
def _(t):
    return translate.look_up_translations(t.sql(_DESCRIBED), t.sql(_CACHE)).select("ord", "translation_failed", "title_en")


def with_fitment_struct(df):
    return df.withColumn("fitment", F.struct("make", "model", "year"))


@query("translation_misses", f"""
WITH p AS ({_DESCRIBED}), first AS (SELECT md5(description_nl) AS key, min(ord) AS ord FROM p GROUP BY 1)
SELECT f.key, f.ord, p.description_nl, concat_ws(' | ', nullif(brand, ''), nullif({Q.title_terms('title')}, ''), nullif(make, ''), nullif(model, ''), nullif(year, '')) AS context
FROM first f JOIN p ON p.ord = f.ord WHERE f.key NOT IN (SELECT key FROM ({_CACHE}) k)""")
def _(t):
    return translate.translation_misses(with_fitment_struct(t.sql(_DESCRIBED)), t.sql(_CACHE))


_FRESH = "SELECT md5(text) AS key, upper(max(source)) AS text_en FROM documents WHERE lang IN ('es', 'fr') GROUP BY text"


@query("translation_cache_update", f"""
SELECT coalesce(f.key, k.key) AS key, coalesce(f.text_en, k.text_en) AS text_en FROM ({_CACHE}) k FULL JOIN ({_FRESH}) f ON f.key = k.key""")
def _(t):
    path = t.scratch("translations")
    writers.write_translation_cache(t.sql(_CACHE), path)
    stored = readers.translation_cache(t.spark, path)
    return translate.add_translations(stored, t.sql(_FRESH)).select("key", "text_en")


@query("answers_to_cache", """
SELECT md5(text) AS key, max('T' || text) AS text_en FROM documents WHERE text IS NOT NULL GROUP BY text""")
def _(t):
    texts = t("documents").filter("text IS NOT NULL").groupBy("text").agg(F.min("doc_id").alias("ord"))
    batches = translate.translation_batches(texts.select("ord", c("text").alias("description_nl")))
    # The answer an external translator would give: every text of the batch, numbered.
    numbered = F.transform("items", lambda i, k: F.concat(F.lit("["), (k + 1).cast("string"), F.lit("]\nT"), i["description_nl"]))
    answered = batches.withColumn("answer", F.array_join(numbered, "\n\n"))
    return translate.answers_to_translations(answered, c("answer"), numbered_blocks)


@query("raw_product_cache", f"SELECT ord, url, title, sku, brand, price_raw, product_type FROM ({I.PRODUCTS}) p")
def _(t):
    path = t.scratch("raw_products")
    writers.write_raw_products(t.sql(I.PRODUCTS), path)
    return readers.raw_products(t.spark, path).select("ord", "url", "title", "sku", "brand", "price_raw", "product_type")


# Positions in files of growing size, so that the readers' order (by size) is not that of the names.
@query("raw_product_array", f"""
SELECT row_number() OVER (ORDER BY floor(sqrt(ord)), ord) - 1 AS ord, url, title, sku FROM ({I.PRODUCTS}) p""")
def _(t):
    path = t.scratch("product_arrays")
    rows = t.sql(I.PRODUCTS).withColumn("file", F.lpad(F.floor(F.sqrt("ord")).cast("string"), 9, "0"))
    cells = F.sort_array(F.collect_list(F.struct("ord", F.struct("url", "title", "sku", "brand", "price_raw").alias("cell"))))
    arrays = rows.groupBy("file").agg(F.to_json(F.transform(cells, lambda r: r["cell"])).alias("value"))
    arrays.write.partitionBy("file").text(path)
    return readers.raw_products_document(t.spark, f"{path}/*").select("ord", "url", "title", "sku")


_LISTED = "SELECT DISTINCT p_type AS brand, 'https://shop.example/' || p_name AS url, CAST(p_size % 3 AS INT) AS page_no FROM part"


@query("url_checkpoint", f"SELECT brand, url, page_no FROM ({_LISTED}) x")
def _(t):
    path = t.scratch("urls")
    writers.write_url_checkpoint(t.sql(_LISTED), path)
    return readers.url_checkpoint(t.spark, path).select("brand", "url", "page_no")


@query("brands_still_to_collect", "SELECT DISTINCT p_brand AS brand FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 7 AND p_type = 'PROMO')")
def _(t):
    part = t("part")
    path = t.scratch("urls")
    done = part.filter("p_size = 7 AND p_type = 'PROMO'").select(
        c("p_brand").alias("brand"), c("p_name").alias("url"), F.lit(0).alias("page_no"))
    writers.write_url_checkpoint(done, path)
    stored = readers.url_checkpoint(t.spark, path)
    return summaries.not_yet_collected(part.select(c("p_brand").alias("brand")).distinct(), stored)


@query("fx_feed", f"SELECT rate_date, upper(currency) AS currency, round(rate, 6) AS rate FROM ({I.FX}) f UNION ALL SELECT DISTINCT rate_date, 'EUR', 1e0 FROM ({I.FX}) g")
def _(t):
    path = t.scratch("fx")
    cube = F.concat(F.lit('<Cube currency="'), "currency", F.lit('" rate="'), c("rate").cast("string"), F.lit('"/>'))
    days = t.sql(I.FX).groupBy("rate_date").agg(F.array_join(F.collect_list(cube), "").alias("cubes"))
    document = F.concat(
        F.lit('<gesmes:Envelope xmlns:gesmes="g"><Cube><Cube time="'), c("rate_date").cast("string"), F.lit('">'), "cubes",
        F.lit('<Cube currency="BAD" rate="n/a"/></Cube></Cube></gesmes:Envelope>'))
    # One document per file, as the feed is published.
    days.select(document.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.fx_feed(t.spark, path).select("rate_date", "currency", F.round("rate", 6).alias("rate"))


# Image metadata from the lines: one address per part and supplier, many of them shared.
_META = """
SELECT 'https://img.example' || CASE WHEN l_partkey % 17 = 0 THEN '/banner' ELSE '' END || '/' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '.jpg' AS url,
  CASE WHEN min(l_quantity) < 4 THEN 404 ELSE 200 END AS status, CASE WHEN max(l_tax) > 7e-2 THEN 'text/html' ELSE 'image/jpeg' END AS content_type,
  CASE WHEN max(l_linenumber) = 7 THEN NULL WHEN max(l_linenumber) = 6 THEN 0 ELSE CAST(floor(min(l_extendedprice)) AS BIGINT) END AS content_length,
  CASE WHEN max(l_discount) > 9e-2 THEN NULL ELSE CAST(floor(max(l_quantity) * 20) AS INT) END AS width, CAST(floor(min(l_quantity) * 20) AS INT) AS height
FROM lineitem GROUP BY l_partkey, l_suppkey
"""
_OK = """status = 200 AND starts_with(content_type, 'image/') AND (coalesce(content_length, 0) = 0 OR content_length >= 10000)
  AND (width IS NULL OR height IS NULL OR width >= 800 OR height >= 800) AND url NOT LIKE '%/banner%'"""
_SHOWN = """SELECT DISTINCT l_partkey AS ord, l_suppkey AS pos, 'https://img.example' || CASE WHEN l_partkey % 17 = 0 THEN '/banner' ELSE '' END || '/' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '.jpg' AS image FROM lineitem"""
_VALID = f"""
valid AS (SELECT ord, image, pos, row_number() OVER (PARTITION BY ord ORDER BY pos) AS rn FROM ({_SHOWN}) s JOIN ({_META}) m ON m.url = s.image WHERE {_OK}),
validated AS (SELECT p.ord, title, p.url, sku, brand, make, model, year, price_raw, (SELECT array_to_string(list(image ORDER BY pos), '|') FROM valid v WHERE v.ord = p.ord AND rn <= 10) AS images,
  (SELECT least(count(*), 10) FROM valid v WHERE v.ord = p.ord) AS n FROM ({I.PRODUCTS}) p)"""


def _address(part, supplier):
    """The image address of ``_SHOWN``."""
    folder = F.when(part % 17 == 0, "/banner").otherwise("")
    return F.concat(F.lit("https://img.example"), folder, F.lit("/"), part.cast("string"), F.lit("-"), supplier.cast("string"), F.lit(".jpg"))


def illustrated(t):
    """Products with the images of ``_SHOWN``; what is shuffled are the two keys, from which an address is made afterwards."""
    listed = t("lineitem").groupBy("l_partkey").agg(F.sort_array(F.collect_set(F.struct("l_suppkey"))).alias("x"))
    shown = listed.select(c("l_partkey").alias("ord"), F.transform("x", lambda x: _address(c("l_partkey"), x["l_suppkey"])).alias("images"))
    none = F.array().cast("array<string>")
    return t.sql(I.PRODUCTS).join(shown, "ord", "left").withColumn("images", F.coalesce("images", none))


def validated(t):
    return images.validate_images(illustrated(t), t.sql(_META))


@query("image_quality", f"SELECT url, {_OK} AS ok FROM ({_META}) m")
def _(t):
    return t.sql(_META).select("url", images.passes_quality().alias("ok"))


@query("validated_images", f"WITH {_VALID} SELECT ord, coalesce(images, '') AS images FROM validated")
def _(t):
    return validated(t).select("ord", F.array_join("validated_images", "|").alias("images"))


@query("importable_products", f"WITH {_VALID} SELECT ord FROM validated WHERE n > 0")
def _(t):
    return images.importable(validated(t)).select("ord")


@query("missing_images_log", f"WITH {_VALID} SELECT title, url, sku FROM validated WHERE n = 0")
def _(t):
    return images.missing_images(validated(t))


@query("image_outcomes", f"""WITH {_VALID} SELECT CAST(count_if(n > 0) AS BIGINT) AS importable, CAST(count_if(n = 0) AS BIGINT) AS missing,
  CAST(count_if(n = 1) AS BIGINT) AS one_image, CAST(count_if(n > 1) AS BIGINT) AS more_images FROM validated""")
def _(t):
    return images.image_outcomes(validated(t))


@query("images_to_fetch", f"""
WITH {_VALID}, listed AS (SELECT ord, image, row_number() OVER (PARTITION BY ord ORDER BY pos) AS rn FROM ({_SHOWN}) s),
chosen AS (SELECT ord, image, rn FROM valid UNION ALL SELECT ord, image, rn FROM listed WHERE ord NOT IN (SELECT ord FROM valid)),
named AS (SELECT replace(trim(sku), '/', '-') || '/' || lpad(CAST(rn AS VARCHAR), 2, '0') || '.jpg' AS path, image FROM chosen JOIN validated USING (ord) WHERE rn <= 10 AND trim(sku) <> '')
SELECT path, image AS url FROM named WHERE path NOT LIKE '%/01.jpg'""")
def _(t):
    products = validated(t)
    present = products.select(F.concat("sku", F.lit("/01.jpg")).alias("path"))
    return images.images_to_fetch(products, present)


_FLAGS = "missing_sku missing_brand missing_make missing_model missing_year translation_failed no_valid_images zero_price".split()
_CHECKED = f"""
WITH {_VALID}, q AS (SELECT title, url, list_filter([CASE WHEN sku = '' THEN 'missing_sku' END, CASE WHEN brand = '' THEN 'missing_brand' END, CASE WHEN make = '' THEN 'missing_make' END,
  CASE WHEN model = '' THEN 'missing_model' END, CASE WHEN year = '' THEN 'missing_year' END, CASE WHEN t.failed THEN 'translation_failed' END,
  CASE WHEN n = 0 THEN 'no_valid_images' END, CASE WHEN price_raw > 990 THEN 'zero_price' END], lambda f: f IS NOT NULL) AS flags
  FROM validated JOIN (SELECT ord, description_en = description_nl AS failed FROM ({_LOOKED_UP}) l) t USING (ord))"""


def checked(t):
    translated = translate.look_up_translations(t.sql(_DESCRIBED), t.sql(_CACHE)).select("ord", "translation_failed")
    price = F.when(c("price_raw") > 990, 0.0).otherwise(c("price_raw"))
    return quality.quality_report(with_fitment_struct(validated(t).join(translated, "ord")).withColumn("price_raw", price))


@query("quality_flags", f"{_CHECKED} SELECT title, url, array_to_string(flags, '|') AS flags FROM q WHERE len(flags) > 0")
def _(t):
    return checked(t).select("title", "url", F.array_join("flags", "|").alias("flags"))


@query("quality_issue_counts", f"{_CHECKED} SELECT flag, count(*) AS products FROM (SELECT unnest(flags) AS flag FROM q) x GROUP BY flag")
def _(t):
    return quality.issue_counts(checked(t))


@query("selected_brands", "SELECT p_partkey, p_brand AS brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#12', 'Brand#7')")
def _(t):
    return summaries.select_brands(t("part").select("p_partkey", c("p_brand").alias("brand")), " Brand#1,Brand#12 ,, Brand#7", D.BRANDS)


@query("default_brands", f"SELECT doc_id, brand FROM (SELECT doc_id, split_part('akrapovic,unknown,fmf,qd', ',', CAST(n_chars % 4 AS INT) + 1) AS brand FROM documents) x WHERE brand IN {Q.in_list(D.BRANDS)}")
def _(t):
    docs = t.sql("SELECT doc_id, split_part('akrapovic,unknown,fmf,qd', ',', CAST(n_chars % 4 AS INT) + 1) AS brand FROM documents")
    return summaries.select_brands(docs, None, D.BRANDS)


@query("union_of_brands", f"SELECT brand, count(*) AS products FROM (SELECT {Q.brand('brand')} AS brand FROM ({I.PRODUCTS}) p) x GROUP BY brand")
def _(t):
    return t.sql(I.PRODUCTS).groupBy(normalize_brand(c("brand")).alias("brand")).agg(F.count(F.lit(1)).alias("products"))


@query("known_texts", "SELECT doc_id FROM documents WHERE md5(text) IN (SELECT md5(text) FROM documents WHERE lang = 'en')")
def _(t):
    docs = t("documents").withColumn("key", cache_key(c("text")))
    return docs.join(docs.filter("lang = 'en'").select("key").distinct(), "key", "left_semi").select("doc_id")
