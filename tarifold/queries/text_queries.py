"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money, seo, tags, text, wording, years
from ..functions.similarity import token_sort_similarity
from ..operators.extract import after_last_slash, strip_cache
from ..operators.fitment import normalize_brand, normalize_make
from ..operators.offers import tag_list
from ..operators.translate import clean_all
from . import inputs as I
from . import sqltext as Q
from .registry import query

AS_OF = 2026
c = F.col


def bar(x):
    return F.array_join(x, "|")


@query("brand_names", f"SELECT ord, {Q.brand('brand')} AS brand FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", normalize_brand(c("brand")).alias("brand"))


_RAW_MAKE = f"SELECT p_partkey AS ord, {I.MAKE} AS make FROM part"


@query("make_names", f"SELECT ord, {Q.make('make')} AS make FROM ({_RAW_MAKE}) p")
def _(t):
    return t.sql(_RAW_MAKE).select("ord", normalize_make(c("make")).alias("make"))


@query("title_case", f"SELECT doc_id, {Q.title_case('text')} AS text FROM documents")
def _(t):
    return t("documents").select("doc_id", text.title_case(c("text")).alias("text"))


_WHOLE = "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)"
_PRICE_TEXTS = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE l_linenumber
  WHEN 1 THEN '€ ' || {_WHOLE} || ',50' WHEN 2 THEN '1.' || {_WHOLE} || ',00' WHEN 3 THEN {_WHOLE} || '.5'
  WHEN 4 THEN '1,' || {_WHOLE} || '.00' WHEN 5 THEN 'was $' || {_WHOLE} WHEN 6 THEN '' ELSE 'n/a' END AS price_text
FROM lineitem
"""
_DOTLESS = r"""CASE WHEN regexp_matches(price_text, '\d\.\d{3}') THEN replace(price_text, '.', '') ELSE price_text END"""


@query("localised_price", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  coalesce(try_cast(CASE WHEN length(digits) - length(replace(digits, '.', '')) <= 1 THEN digits END AS DOUBLE), 0) AS price
FROM (SELECT *, regexp_replace(replace({_DOTLESS}, ',', '.'), '[^0-9.]', '', 'g') AS digits FROM ({_PRICE_TEXTS}) x) y""")
def _(t):
    return t.sql(_PRICE_TEXTS).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        text.parse_price(c("price_text")).alias("price"),
    )


_UNTAGGED = "regexp_replace(html, '<[^>]+>', ' ', 'g')"


@query("strip_markup", f"SELECT page_id, {Q.strip(_UNTAGGED)} AS text FROM pages")
def _(t):
    return t("pages").select("page_id", text.strip_tags(c("html")).alias("text"))


_CACHED = """SELECT p_partkey AS ord, 'https://img.example/media' || CASE WHEN p_size % 2 = 0 THEN '/cache/' || md5(p_name) || '/'
  WHEN p_size % 3 = 0 THEN '/cache/' || upper(md5(p_name)) || '/' ELSE '/' END || replace(p_name, ' ', '_') || '.jpg' AS url FROM part"""


@query("original_image_url", f"SELECT ord, regexp_replace(url, '/cache/[a-f0-9]{{32}}/', '/', 'g') AS url FROM ({_CACHED}) x")
def _(t):
    return t.sql(_CACHED).select("ord", strip_cache(c("url")).alias("url"))


_YEARS = """SELECT p_partkey AS ord, CASE p_size % 8 WHEN 0 THEN '2019 – 2023' WHEN 1 THEN '2019/2023' WHEN 2 THEN '2021 +'
  WHEN 3 THEN '2019-23' WHEN 4 THEN '2022' WHEN 5 THEN '' WHEN 6 THEN '20' || CAST(10 + p_partkey % 90 AS STRING) || '-20' || CAST(10 + p_size AS STRING)
  ELSE '20' || CAST(10 + p_partkey % 90 AS STRING) || '+' END AS year FROM part"""


@query("clean_year", f"SELECT ord, {Q.clean_year('year')} AS year FROM ({_YEARS}) x")
def _(t):
    return t.sql(_YEARS).select("ord", years.clean_year(c("year")).alias("year"))


@query("expand_years", f"""SELECT ord, {Q.joined(Q.years('y', AS_OF))} AS years
FROM (SELECT ord, {Q.clean_year('year')} AS y FROM ({_YEARS}) x) z""")
def _(t):
    cleaned = t.sql(_YEARS).withColumn("y", years.clean_year(c("year")))
    return cleaned.select("ord", bar(years.expand_years(c("y"), AS_OF)).alias("years"))


@query("tag_slug", f"SELECT doc_id, {Q.tag_slug('text')} AS slug FROM documents")
def _(t):
    return t("documents").select("doc_id", text.tag_slug(c("text")).alias("slug"))


@query("url_slug", f"SELECT doc_id, {Q.url_slug('text')} AS slug FROM documents")
def _(t):
    return t("documents").select("doc_id", text.url_slug(c("text")).alias("slug"))


@query("title_terms", f"SELECT ord, {Q.title_terms('title')} AS title_en FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", wording.translate_title(c("title")).alias("title_en"))


@query("clean_description", f"SELECT ord, {Q.clean('description_nl')} AS description_nl FROM ({I.DESCRIPTIONS}) d")
def _(t):
    return t.sql(I.DESCRIPTIONS).select("ord", wording.clean_description(c("description_nl")).alias("description_nl"))


_BOTH = f"SELECT ord, description_nl, CASE WHEN lang = 'en' THEN source || '. Cheapest deal!  Ok.' ELSE '' END AS description_en FROM ({I.DESCRIPTIONS}) d"


@query("clean_all_descriptions", f"""
SELECT ord, nl AS description_nl, en AS description_en, nl <> description_nl OR en <> description_en AS cleaned
FROM (SELECT *, {Q.clean('description_nl')} AS nl, {Q.clean('description_en')} AS en FROM ({_BOTH}) b) x""")
def _(t):
    return clean_all(t.sql(_BOTH)).select("ord", "description_nl", "description_en", "cleaned")


_TEXT = "(title || ' ' || description_nl)"
def _text():
    return tags.tag_text(c("title"), c("description_nl"))


@query("type_tags", f"SELECT ord, 'TYPE_' || {Q.type_label(_TEXT)} AS tag FROM ({I.PRODUCT_TEXTS}) p")
def _(t):
    return t.sql(I.PRODUCT_TEXTS).select("ord", tags.type_tag(_text()).alias("tag"))


@query("material_tags", f"""SELECT ord, {Q.joined(f"list_transform({Q.material_labels(_TEXT)}, lambda m: 'MAT_' || m)")} AS tags
FROM ({I.PRODUCT_TEXTS}) p""")
def _(t):
    return t.sql(I.PRODUCT_TEXTS).select("ord", bar(tags.material_tags(_text())).alias("tags"))


@query("euro_tags", f"SELECT ord, {Q.euro(_TEXT)} AS tag FROM ({I.PRODUCT_TEXTS}) p")
def _(t):
    return t.sql(I.PRODUCT_TEXTS).select("ord", tags.euro_tag(_text()).alias("tag"))


@query("road_use_tags", f"SELECT ord, {Q.road(_TEXT)} AS tag FROM ({I.PRODUCT_TEXTS}) p")
def _(t):
    return t.sql(I.PRODUCT_TEXTS).select("ord", tags.road_tag(_text()).alias("tag"))


@query("category_tags", f"SELECT ord, {Q.category('product_type')} AS tag FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", tags.category_tag(c("product_type")).alias("tag"))


@query("vehicle_tags", f"""SELECT ord, {Q.named('BRAND_', 'brand')} AS brand_tag, {Q.named('MAKE_', 'make')} AS make_tag,
  {Q.named('MODEL_', 'model')} AS model_tag, {Q.joined(f"list_transform({Q.years('year', AS_OF)}, lambda y: 'YEAR_' || y)")} AS year_tags
FROM ({I.PRODUCTS}) p""")
def _(t):
    return t.sql(I.PRODUCTS).select(
        "ord", tags.named_tag("BRAND_", c("brand")).alias("brand_tag"), tags.named_tag("MAKE_", c("make")).alias("make_tag"),
        tags.named_tag("MODEL_", c("model")).alias("model_tag"), bar(tags.year_tags(c("year"), AS_OF)).alias("year_tags"))


def _tags():
    return tags.build_tags(c("brand"), c("make"), c("model"), c("year"), c("title"), c("description_nl"),
                           c("product_type"), c("price_raw") > 950, AS_OF)


@query("tag_lists", f"SELECT ord, array_to_string({Q.tags(AS_OF, 'price_raw > 950')}, ', ') AS tags FROM ({I.PRODUCT_TEXTS}) p")
def _(t):
    return t.sql(I.PRODUCT_TEXTS).select("ord", F.array_join(_tags(), ", ").alias("tags"))


@query("product_types", f"""SELECT ord, {Q.product_type('tag_list')} AS type
FROM (SELECT ord, {Q.tags(AS_OF, 'false')} AS tag_list FROM ({I.PRODUCT_TEXTS}) p) x""")
def _(t):
    tagged = t.sql(I.PRODUCT_TEXTS).withColumn("tag_list", _tags())
    return tagged.select("ord", tags.product_type_of(c("tag_list")).alias("type"))


def _seo():
    return [c(x) for x in ("brand", "product_type", "make", "model", "year")]


@query("seo_titles", f"SELECT ord, {Q.seo_title('brand', 'product_type')} AS seo_title FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", seo.seo_title(*_seo()).alias("seo_title"))


@query("meta_descriptions", f"SELECT ord, {Q.meta_description('brand', 'product_type')} AS meta FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", seo.meta_description(
        c("brand"), c("make"), c("model"), c("year"), c("product_type")).alias("meta"))


@query("alt_texts", f"SELECT ord, {Q.alt_text('brand', 'product_type')} AS alt FROM ({I.PRODUCTS}) p")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", seo.alt_text(*_seo()).alias("alt"))


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
_line = _LINE.split(", ")


@query("money_text", f"SELECT {_LINE}, {Q.money('l_extendedprice / l_quantity')} AS price FROM lineitem")
def _(t):
    return t("lineitem").select(*_line, money.money_text(c("l_extendedprice") / c("l_quantity")).alias("price"))


@query("net_and_flat_price", f"""SELECT {_LINE}, round(l_extendedprice / 121e-2, 6) AS net,
  round(l_extendedprice / 121e-2 * 135e-2, 6) AS flat FROM lineitem""")
def _(t):
    price = c("l_extendedprice")
    return t("lineitem").select(
        *_line, F.round(money.net_price(price), 6).alias("net"), F.round(money.flat_export_price(price), 6).alias("flat"))


@query("round_to_95", f"SELECT {_LINE}, round({Q.to_95('l_extendedprice / l_quantity')}, 6) AS price FROM lineitem")
def _(t):
    return t("lineitem").select(*_line, F.round(money.to_95(c("l_extendedprice") / c("l_quantity")), 6).alias("price"))


@query("text_keys", "SELECT doc_id, md5(text) AS key FROM documents")
def _(t):
    return t("documents").select("doc_id", wording.cache_key(c("text")).alias("key"))


_ANSWERS = """SELECT conv_id, turn, 'note [1] ' || text || CASE WHEN turn % 2 = 0 THEN ' [3]  third ' || role || ' [3] last ' || role ELSE '' END AS answer FROM conversations"""


@query("numbered_blocks", rf"""
WITH found AS (SELECT conv_id, turn, regexp_extract_all(answer, '\[(\d+)\]', 1) AS n,
    list_transform(string_split_regex(answer, '\[\d+\]')[2:], lambda x: {Q.strip('x')}) AS body FROM ({_ANSWERS}) a)
SELECT conv_id, turn, {', '.join(f"coalesce(list_filter(list_zip(n, body), lambda z: z[1] = '{i}')[-1][2], '') AS b{i}" for i in (1, 2, 3))}
FROM found""")
def _(t):
    blocks = t.sql(_ANSWERS).withColumn("b", wording.numbered_blocks(c("answer"), F.lit(3)))
    return blocks.select("conv_id", "turn", *[F.try_element_at("b", F.lit(i)).alias(f"b{i}") for i in (1, 2, 3)])


@query("context_hints", f"""SELECT ord, concat_ws(' | ', nullif(brand, ''), nullif({Q.title_terms('title')}, ''), nullif(make, ''),
  nullif(model, ''), nullif(year, '')) AS hint FROM ({I.PRODUCTS}) p""")
def _(t):
    return t.sql(I.PRODUCTS).select("ord", wording.context_hint(
        c("brand"), c("title"), c("make"), c("model"), c("year")).alias("hint"))


_PAIRS = """SELECT p_partkey AS ord, p_name || ' ' || p_type AS a, lower(p_brand) || ' ' || CASE p_size % 4 WHEN 0 THEN p_type || ' ' || p_name
  WHEN 1 THEN replace(p_name, 'o', 'oo') WHEN 2 THEN p_type ELSE p_name || ' kit' END AS b FROM part"""


@query("token_sort_similarity", f"""
WITH sorted AS MATERIALIZED (SELECT ord, {Q.sorted_tokens('lower(a)')} AS a, {Q.sorted_tokens('lower(b)')} AS b FROM ({_PAIRS}) x),
chars AS MATERIALIZED ({Q.alphabet('sorted', 'a')}), ours AS MATERIALIZED ({Q.coded('sorted', 'a')}), theirs AS MATERIALIZED ({Q.coded('sorted', 'b', True)}),
pairs AS (SELECT ord, ours.*, theirs.* FROM sorted JOIN ours USING (a) JOIN theirs USING (b))
SELECT ord, round({Q.SIMILARITY}, 6) AS score FROM pairs""")
def _(t):
    return t.sql(_PAIRS).select("ord", F.round(token_sort_similarity(c("a"), c("b")), 6).alias("score"))


@query("availability", "SELECT doc_id, regexp_extract('http://schema.org/' || source || '/' || lang, '[^/]*$') AS availability FROM documents")
def _(t):
    value = F.concat(F.lit("http://schema.org/"), "source", F.lit("/"), "lang")
    return t("documents").select("doc_id", after_last_slash(value).alias("availability"))


_TAG_TEXTS = """SELECT p_partkey AS ord, CASE p_size % 3 WHEN 0 THEN '["' || p_type || '","' || p_name || ', x"]'
  WHEN 1 THEN ' ' || p_type || ' ,, ' || p_name || ',' ELSE '' END AS tags FROM part"""


@query("tag_text_to_list", rf"""SELECT ord, array_to_string(CASE WHEN starts_with(tags, '[') THEN from_json(tags, '["VARCHAR"]')
  ELSE list_filter(list_transform(string_split(tags, ','), lambda x: trim(x)), lambda x: x <> '') END, '|') AS tags FROM ({_TAG_TEXTS}) x""")
def _(t):
    return t.sql(_TAG_TEXTS).select("ord", bar(tag_list(c("tags"))).alias("tags"))


_TRANSLATED = "SELECT doc_id, text AS source_text, CASE WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN '' ELSE upper(source) END AS translated FROM documents"


@query("blank_translation_keeps_source", f"SELECT doc_id, coalesce(nullif(translated, ''), source_text) AS text FROM ({_TRANSLATED}) x")
def _(t):
    return t.sql(_TRANSLATED).select("doc_id", wording.keep_source_if_blank(c("translated"), c("source_text")).alias("text"))

