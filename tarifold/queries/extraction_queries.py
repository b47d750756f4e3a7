"""Extraction from page text: the given pages, and shop pages built from the parts table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup
from ..operators import extract, fitment
from ..rules import dictionaries as D
from . import inputs as I
from . import sqltext as Q
from .registry import query

c = F.col

# A shop page per part. The fields of a page depend on the part, so that every layer and every
# fallback is used: broken, single, listed and nested JSON-LD; with and without tables.
_ESC = "replace(p_name, ' ', '-')"
LD = f"""CASE p_size % 5
  WHEN 0 THEN '{{"@type":"Product","name":" LD ' || p_name || '","mpn":"MPN' || CAST(p_partkey AS STRING) || '","sku":"","gtin13":"87' || CAST(p_partkey AS STRING) || '","brand":"arrow","offers":{{"price":"1.2' || CAST(10 + p_size AS STRING) || ',50","availability":"http://schema.org/InStock"}},"image":"https://img.example/cache/' || md5(p_name) || '/a.jpg"}}'
  WHEN 1 THEN '[{{"@type":"WebSite"}},{{"@type":["Thing","Product"],"name":"LD list ' || p_name || '","sku":"LS' || CAST(p_partkey AS STRING) || '","description":"<p>Fine</p> ' || p_type || '","brand":{{"name":"mivv"}},"offers":[{{"lowPrice":' || CAST(p_retailprice AS STRING) || '}}],"image":["https://img.example/b.png",{{"url":"https://img.example/c.webp"}},"https://img.example/logo.png"]}}]'
  WHEN 2 THEN '{{"@graph":[{{"@type":"BreadcrumbList"}},{{"@type":"Product","name":"","sku":"G' || CAST(p_partkey AS STRING) || '","gtin":"GT' || CAST(p_size AS STRING) || '","offers":{{"price":' || CAST(p_size AS STRING) || '}}}}]}}'
  WHEN 3 THEN '{{"@type":"Product","name":"broken'
  ELSE '{{"@type":"Organization","name":"not a product"}}' END"""
HTML = f"""
SELECT p_partkey AS ord, 'https://shop.example/' || {_ESC} || '-' || CAST(p_partkey AS STRING) AS url, p_type, p_name, p_size, p_partkey, p_retailprice,
'<html><head>' ||
CASE WHEN p_size % 3 = 0 THEN '<meta property="og:title" content="first"><meta content="OG ' || p_name || ' &amp; more" property="og:title"/><meta property="og:description" content="og &lt;b&gt; text"><meta property="og:image" content="https://img.example/og' || CAST(p_size AS STRING) || '.jpeg"><meta property="og:price:amount" content="' || CAST(2000 + p_size AS STRING) || '.00">' ELSE '' END ||
'<script type="application/ld+json">not json</script><script type="application/ld+json">' || {LD} || '</script>' ||
CASE WHEN p_size % 2 = 0 THEN '<script type="text/x-magento-init">{{"g":{{"data":[{{"thumb":"https:\\/\\/img.example\\/t.jpg","img":"https:\\/\\/img.example\\/cache\\/' || md5(p_type) || '\\/g1.jpg","full":"https:\\/\\/img.example\\/g2' || p_type || '.jpg"}},{{"url":"https:\\/\\/img.example\\/icon.png"}}]}}}}</script>' ELSE '' END ||
'</head><body>' ||
CASE WHEN p_size % 4 = 0 THEN '<nav><a href="/">Home</a> <a href="/x"> </a><a href="/u">Uitlaten</a><a href="/t"><b>' || p_type || '</b></a></nav>' WHEN p_size % 4 = 1 THEN '<div class="nav breadcrumbs"><a href="/">Shop</a><a href="/d">Dempers</a></div>' ELSE '' END ||
CASE WHEN p_size % 7 = 0 THEN '' ELSE '<h1 class="t"> ' || p_type || ' <span>' || {I.MAKE} || '</span> ' || {I.MODEL} || ' ' || {I.YEAR} || '</h1>' END ||
'<div class="sku">D' || CAST(p_partkey AS STRING) || '</div><div itemprop="brand"><span itemprop="name">Sc Project</span></div>' ||
'<span class="old-price"><span class="price">€ 1,00</span></span>' ||
CASE WHEN p_size % 6 = 5 THEN '' ELSE '<span class="price special">€ ' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || ',90</span>' END ||
'<div class="product-description"><p>Voor ' || p_name || '</p></div>' ||
'<img class="x" src="/media/catalog/product/' || p_type || '.jpg"><img src="/static/x.jpg"><img data-src="https://cdn.example/media/catalog/product/y.png" src="data:image/gif">' ||
CASE p_size % 5 WHEN 1 THEN '<table><caption>Geschikt voor <b>motor</b></caption><tr><th>Merk</th><td> Yamaha </td></tr><tr><td>Model</td><td>MT-' || CAST(p_size AS STRING) || '</td><td>z</td></tr><tr><td>Model</td><td>other</td></tr><tr><td>x</td></tr></table>' WHEN 2 THEN '<table><caption>Maten</caption><tr><td>Merk</td><td>None</td></tr></table>' ELSE '' END ||
CASE p_size % 3 WHEN 1 THEN '<table class="data shop_attributes"><tr><th>Fabrikant</th><td>harley</td></tr><tr><th>Type</th><td>Road <i>King</i></td></tr><tr><th>Bouwjaar</th><td>2019 – 23</td></tr></table>' ELSE '' END ||
'</body></html>' AS html
FROM part
"""


def shop_pages(t):
    """The shop pages; the parts are dealt out before a page is built from each."""
    return t.sql(HTML, spread="part")


def pages(t):
    return markup.with_page(shop_pages(t))


def landed(t):
    """The given pages."""
    return markup.with_page(t("pages"))


def join(x):
    return F.array_join(x, "|")


# What the builder above put into each page, said in SQL.
_LD_NAME = "CASE p_size % 5 WHEN 0 THEN 'LD ' || p_name WHEN 1 THEN 'LD list ' || p_name ELSE '' END"
_OG_TITLE = "CASE WHEN p_size % 3 = 0 THEN 'OG ' || p_name || ' & more' ELSE '' END"
_H1 = rf"CASE WHEN p_size % 7 = 0 THEN 'Sc Project' ELSE trim(p_type || {I.MAKE} || {Q.strip(f'{I.MODEL} || {chr(39)} {chr(39)} || {I.YEAR}')}) END"
_SLUG = f"replace({_ESC} || '-' || CAST(p_partkey AS VARCHAR), '-', ' ')"
_TITLE = f"coalesce(nullif({_LD_NAME}, ''), nullif({_OG_TITLE}, ''), nullif({_H1}, ''), {Q.title_case(_SLUG)})"
_LD_PRICE = "CASE p_size % 5 WHEN 0 THEN 1200 + 10 + p_size + 5e-1 WHEN 1 THEN p_retailprice WHEN 2 THEN CAST(p_size AS DOUBLE) END"
_OG_PRICE = "CASE WHEN p_size % 3 = 0 THEN 2000e0 + p_size END"
_DOM_PRICE = "CASE WHEN p_size % 6 <> 5 THEN floor(p_retailprice) + 9e-1 END"
_PRICE = f"least({_LD_PRICE}, {_OG_PRICE}, {_DOM_PRICE})"
_SKU = """CASE p_size % 5 WHEN 0 THEN 'MPN' || CAST(p_partkey AS VARCHAR) WHEN 1 THEN 'LS' || CAST(p_partkey AS VARCHAR)
  WHEN 2 THEN 'G' || CAST(p_partkey AS VARCHAR) ELSE 'D' || CAST(p_partkey AS VARCHAR) END"""
_LD_IMAGES = """CASE p_size % 5 WHEN 0 THEN ['https://img.example/a.jpg'] WHEN 1 THEN ['https://img.example/b.png', 'https://img.example/c.webp'] ELSE [] END"""
_GALLERY = "CASE WHEN p_size % 2 = 0 THEN ['https://img.example/g1.jpg', 'https://img.example/g2' || p_type || '.jpg'] ELSE [] END"
_OG_IMAGE = "CASE WHEN p_size % 3 = 0 THEN ['https://img.example/og' || CAST(p_size AS VARCHAR) || '.jpeg'] ELSE [] END"
_DOM_IMAGES = "['https://shop.example/media/catalog/product/' || p_type || '.jpg', 'https://cdn.example/media/catalog/product/y.png']"
_IMAGES = f"list_concat({_LD_IMAGES}, {_GALLERY}, {_OG_IMAGE}, {_DOM_IMAGES})"
_CRUMBS = "CASE p_size % 4 WHEN 0 THEN ['Uitlaten', p_type] WHEN 1 THEN ['Dempers'] ELSE [] END"

# Title layer of fitment, for any text column.


def title_year_sql(x: str) -> str:
    return rf"regexp_extract({x}, '(?:^|[^0-9])(20\d{{2}}\+|20\d{{2}}[–\-/](?:20)?\d{{2}}|20\d{{2}})(?:[^0-9]|$)', 1)"


def title_make_sql(x: str) -> str:
    return "CASE " + " ".join(rf"WHEN regexp_matches({x}, '\b{m}\b', 'i') THEN '{m}'" for m in D.MAKES) + " ELSE '' END"


def title_model_sql(x: str, make: str) -> str:
    after = f"substr({x}, instr(lower({x}), lower({make})) + length({make}))"
    after = rf"regexp_replace({after}, '^\s*[-–—/]\s*', '')"
    after = rf"regexp_replace({after}, '\b(abs|se|sp|rs|euro\s*\d|e5|e4)\b', '', 'gi')"
    words = rf"regexp_extract({after}, '^\s*([A-Z0-9]{{1,4}}[\w\-.]{{0,25}}(?:\s+[A-Z0-9][\w\-.]{{0,20}})?)', 1)"
    bare = rf"regexp_replace(regexp_replace(trim({words}), '\s*20\d{{2}}.*$', ''), '[-–—/., ]+$', '')"
    return f"CASE WHEN {make} <> '' AND length({bare}) >= 2 THEN {bare} ELSE '' END"


@query("first_filled_field", f"SELECT ord, {_TITLE} AS title FROM ({HTML}) h")
def _(t):
    staged = extract.with_json_ld(pages(t)).withColumn("_og", extract.open_graph(c("_page")))
    return staged.select("ord", extract.first_filled(
        c("_ld.name"), extract.og_value(c("_og"), "og:title"), extract.dom_title(c("_page")), extract.title_from_slug(c("url"))).alias("title"))


@query("json_ld_product", f"""SELECT ord, {_LD_NAME} AS name, CASE WHEN p_size % 5 < 3 THEN {_SKU} ELSE '' END AS sku,
  CASE p_size % 5 WHEN 0 THEN '87' || CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'GT' || CAST(p_size AS VARCHAR) ELSE '' END AS gtin,
  CASE p_size % 5 WHEN 0 THEN 'arrow' WHEN 1 THEN 'mivv' ELSE '' END AS brand, CASE WHEN p_size % 5 = 1 THEN 'Fine  ' || p_type ELSE '' END AS description,
  CASE WHEN p_size % 5 = 0 THEN 'InStock' ELSE '' END AS availability, coalesce({_LD_PRICE}, 0) AS price, {Q.joined(_LD_IMAGES)} AS images FROM ({HTML}) h""")
def _(t):
    ld = extract.with_json_ld(pages(t)).withColumn("offer", F.try_element_at(extract.json_items(c("_ld.offers")), F.lit(1)))
    filled = extract.first_filled
    return ld.select(
        "ord", filled(c("_ld.name")).alias("name"), filled(F.nullif("_ld.sku", F.lit("")), c("_ld.mpn")).alias("sku"),
        filled(c("_ld.gtin"), c("_ld.gtin13")).alias("gtin"), filled(extract.named_or_text(c("_ld.brand"))).alias("brand"),
        filled(extract.strip_tags(c("_ld.description"))).alias("description"),
        extract.after_last_slash(F.get_json_object("offer", "$.availability")).alias("availability"),
        extract.ld_price(c("offer")).alias("price"), F.coalesce(join(extract.ld_images(c("_ld.image"))), F.lit("")).alias("images"))


@query("tolerant_json", f"SELECT ord, p_size % 5 < 3 AS found FROM ({HTML}) h")
def _(t):
    return extract.with_json_ld(pages(t)).select("ord", c("json_ld").isNotNull().alias("found"))


@query("gallery_images", f"SELECT ord, {Q.joined(_GALLERY)} AS images FROM ({HTML}) h")
def _(t):
    return pages(t).select("ord", join(extract.gallery_images(c("_page"))).alias("images"))


@query("open_graph", f"""SELECT ord, {_OG_TITLE} AS title, CASE WHEN p_size % 3 = 0 THEN 'og   text' ELSE '' END AS description,
  {Q.joined(_OG_IMAGE)} AS image, coalesce({_OG_PRICE}, 0) AS price FROM ({HTML}) h""")
def _(t):
    og = pages(t).select("ord", extract.open_graph(c("_page")).alias("og"))
    value = lambda name: extract.og_value(c("og"), name)
    return og.select(
        "ord", value("og:title").alias("title"), extract.strip_tags(value("og:description")).alias("description"),
        join(extract.usable_images(F.array(value("og:image")), False)).alias("image"),
        extract.parse_price(value("og:price:amount")).alias("price"))


@query("page_body_fields", f"""SELECT ord, {_H1} AS title, 'D' || CAST(p_partkey AS VARCHAR) AS sku, 'Sc Project' AS brand,
  '<div class="product-description"><p>Voor ' || p_name || '</p></div>' AS description FROM ({HTML}) h""")
def _(t):
    return pages(t).select(
        "ord", extract.dom_title(c("_page")).alias("title"), extract.dom_sku(c("_page")).alias("sku"),
        extract.dom_brand(c("_page")).alias("brand"), extract.dom_description(c("_page")).alias("description"))


@query("page_body_prices", f"SELECT ord, coalesce(CAST({_DOM_PRICE} AS VARCHAR), '') AS prices FROM ({HTML}) h")
def _(t):
    prices = F.transform(extract.dom_prices(c("_page")), lambda p: p.cast("string"))
    return pages(t).select("ord", join(prices).alias("prices"))


@query("page_body_images", f"SELECT ord, {Q.joined(_DOM_IMAGES)} AS images FROM ({HTML}) h")
def _(t):
    return pages(t).select("ord", join(extract.dom_images(c("_page"), c("url"))).alias("images"))


@query("lowest_price", f"SELECT ord, coalesce({_PRICE}, 0) AS price FROM ({HTML}) h")
def _(t):
    staged = extract.with_json_ld(pages(t)).withColumn("offer", F.try_element_at(extract.json_items(c("_ld.offers")), F.lit(1)))
    og = extract.parse_price(extract.og_value(extract.open_graph(c("_page")), "og:price:amount"))
    candidates = F.concat(F.array(extract.ld_price(c("offer")), og), extract.dom_prices(c("_page")))
    return staged.select("ord", extract.lowest_price(candidates).alias("price"))


@query("title_from_slug", rf"""SELECT page_id, {Q.title_case("replace(string_split(rtrim(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), '/')[-1], '-', ' ')")} AS title FROM pages""")
def _(t):
    return t("pages").select("page_id", extract.title_from_slug(c("url")).alias("title"))


@query("heading_titles", rf"""SELECT page_id, {Q.strip(r"replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '\s*<[^>]+>\s*', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&apos;', chr(39)), '&nbsp;', chr(160)), '&euro;', '€'), '&pound;', '£'), '&amp;', '&')")} AS title FROM pages""")
def _(t):
    return landed(t).select("page_id", extract.dom_title(c("_page")).alias("title"))


@query("breadcrumb_paths", f"""SELECT ord, {Q.joined(_CRUMBS)} AS crumbs, coalesce(({_CRUMBS})[-1], '') AS product_type FROM ({HTML}) h""")
def _(t):
    crumbs = pages(t).select("ord", extract.breadcrumbs(c("_page")).alias("b"))
    return crumbs.select("ord", join(c("b")).alias("crumbs"), extract.last_crumb(c("b")).alias("product_type"))


@query("navigation_of_pages", rf"""
SELECT page_id, coalesce(array_to_string(list_filter(list_transform(regexp_extract_all(regexp_extract(html, '(?is)<nav[^>]*>(.*?)</nav>', 1), '(?is)<a\b[^>]*>(.*?)</a>', 1),
  lambda x: {Q.strip('x')}), lambda x: x <> '' AND lower(x) NOT IN {Q.in_list(D.BREADCRUMB_DENYLIST)}), '|'), '') AS crumbs FROM pages""")
def _(t):
    return landed(t).select("page_id", join(extract.breadcrumbs(c("_page"))).alias("crumbs"))


_TABLE_FIT = """CASE WHEN p_size % 5 = 1 THEN 'Yamaha' ELSE '' END AS make, CASE WHEN p_size % 5 = 1 THEN 'MT-' || CAST(p_size AS VARCHAR) ELSE '' END AS model, '' AS year"""
_ATTR_FIT = """CASE WHEN p_size % 3 = 1 THEN 'harley' ELSE '' END AS make, CASE WHEN p_size % 3 = 1 THEN 'Road King' ELSE '' END AS model,
  CASE WHEN p_size % 3 = 1 THEN '2019 – 23' ELSE '' END AS year"""


def parts(df, column):
    return df.select("ord", *[c(f"{column}.{p}").alias(p) for p in fitment.PARTS])


@query("fitment_from_captioned_table", f"SELECT ord, {_TABLE_FIT} FROM ({HTML}) h")
def _(t):
    return parts(pages(t).withColumn("f", fitment.from_captioned_tables(c("_page"))), "f")


@query("fitment_from_attribute_table", f"SELECT ord, {_ATTR_FIT} FROM ({HTML}) h")
def _(t):
    return parts(pages(t).withColumn("f", fitment.from_attribute_table(c("_page"))), "f")


_TITLE_FIT = f"""SELECT *, {title_model_sql('title', 'make')} AS model FROM (SELECT ord, title, {title_make_sql('title')} AS make, {title_year_sql('title')} AS year FROM"""


@query("fitment_from_title", f"SELECT ord, make, model, year FROM ({_TITLE_FIT} ({I.PRODUCTS}) p) x) y")
def _(t):
    staged = t.sql(I.PRODUCTS).select("ord", "title").withColumn("make", fitment.title_make(c("title")))
    return staged.select(
        "ord", "make", fitment.title_model(c("title"), c("make")).alias("model"), fitment.title_year(c("title")).alias("year"))


_MERGED = f"""
SELECT ord, CASE WHEN mk = '' THEN '' ELSE {Q.make('mk')} END AS make, {Q.strip('md')} AS model, {Q.clean_year('yr')} AS year FROM (
  SELECT a.ord, coalesce(nullif(a.make, ''), CASE WHEN need THEN nullif(b.make, '') END, t.make) AS mk, coalesce(nullif(a.model, ''), CASE WHEN need THEN nullif(b.model, '') END, t.model) AS md,
    coalesce(nullif(a.year, ''), CASE WHEN need THEN nullif(b.year, '') END, t.year) AS yr
  FROM (SELECT *, make = '' OR model = '' AS need FROM (SELECT ord, {_TABLE_FIT} FROM h) x) a JOIN (SELECT ord, {_ATTR_FIT} FROM h) b USING (ord)
  JOIN ({_TITLE_FIT} (SELECT ord, {_TITLE} AS title FROM h) q) x) t USING (ord)) z"""


@query("fitment_merged", f"WITH h AS ({HTML}) {_MERGED}")
def _(t):
    page = c("_page")
    staged = extract.with_json_ld(pages(t)).withColumn("title", extract.first_filled(
        c("_ld.name"), extract.og_value(extract.open_graph(page), "og:title"), extract.dom_title(page), extract.title_from_slug(c("url"))))
    return parts(fitment.with_fitment(staged), "fitment")


@query("valid_products", f"SELECT ord FROM ({HTML}) h WHERE {_PRICE} IS NOT NULL")
def _(t):
    return extract.extract_products(shop_pages(t)).select("ord")


@query("page_scan", f"""WITH h AS ({HTML}), f AS ({_MERGED})
SELECT ord, url, {_TITLE} AS title, {_SKU} AS sku, CASE p_size % 5 WHEN 0 THEN 'Arrow' WHEN 1 THEN 'Mivv' ELSE 'SC-Project' END AS brand, {_PRICE} AS price_raw,
  CASE WHEN p_size % 5 = 1 THEN 'Fine  ' || p_type WHEN p_size % 3 = 0 THEN 'og   text' ELSE '<div class="product-description"><p>Voor ' || p_name || '</p></div>' END AS description_nl,
  {Q.joined(_IMAGES)} AS images, {Q.joined(_CRUMBS)} AS breadcrumbs, make, model, year, coalesce(({_CRUMBS})[-1], '') AS product_type,
  CASE p_size % 5 WHEN 0 THEN '87' || CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'GT' || CAST(p_size AS VARCHAR) ELSE '' END AS gtin,
  CASE WHEN p_size % 5 = 0 THEN 'InStock' ELSE '' END AS availability FROM h JOIN f USING (ord) WHERE {_PRICE} IS NOT NULL""")
def _(t):
    found = extract.extract_products(shop_pages(t))
    return found.select("ord", "url", "title", "sku", "brand", "price_raw", "description_nl", join("images").alias("images"),
                        join("breadcrumbs").alias("breadcrumbs"), "fitment.*", "product_type", "gtin", "availability")


_ABS = """CASE WHEN starts_with(href, '/') THEN origin || href ELSE origin || '/' || href END"""


@query("product_links", rf"""
WITH a AS (SELECT page_id AS ord, regexp_extract(url, '^[^:]+://[^/?#]*') AS origin, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages),
l AS (SELECT DISTINCT ord, {_ABS} AS link FROM a)
SELECT ord, link FROM l WHERE regexp_matches(regexp_extract(link, '^[^:]+://[^/?#]*([^?#]*)', 1), '{D.PRODUCT_PATH}', 'i')
  AND NOT regexp_matches(regexp_extract(link, '^[^:]+://[^/?#]*([^?#]*)', 1), '/({"|".join(D.NON_PRODUCT_SEGMENTS)})(/|$)', 'i')""")
def _(t):
    return extract.product_links(t("pages").withColumnRenamed("page_id", "ord"))


_LINES = """SELECT DISTINCT CASE WHEN l_tax > 5e-2 THEN 'https://img.example' ELSE 'ftp://img.example' END || CASE l_linenumber WHEN 1 THEN '/logo' WHEN 2 THEN '/icon' WHEN 3 THEN '/p' ELSE '' END
  || '/' || CAST(l_partkey AS STRING) || CASE l_returnflag WHEN 'R' THEN '.JPG/w' WHEN 'A' THEN '.jpeg' ELSE '.svg' END AS url FROM lineitem"""


@query("image_addresses", f"""SELECT url, starts_with(url, 'http') AND NOT (url LIKE '%/logo%' OR url LIKE '%/icon%' OR url LIKE '%/banner%' OR url LIKE '%/placeholder%'
  OR url LIKE '%s.w.org%' OR url LIKE '%data:%') AND regexp_matches(url, '\\.(jpe?g|png|webp|gif)', 'i') AS ok FROM ({_LINES}) x""")
def _(t):
    return t.sql(_LINES).select("url", extract.is_image_url(c("url")).alias("ok"))


_STATUS = "SELECT page_id, url, CASE WHEN length(html) > 4000 THEN 503 WHEN length(html) > 3000 THEN NULL ELSE 200 END AS status FROM pages"


@query("failed_pages", f"SELECT url FROM ({_STATUS}) x WHERE coalesce(status, 0) <> 200")
def _(t):
    return extract.failed_pages(t.sql(_STATUS))


@query("denied_navigation", f"""SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) x
WHERE lower(word) NOT IN {Q.in_list(D.CATEGORY_DENYLIST)}""")
def _(t):
    words = t("documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    return words.filter(~F.lower("word").isin(*D.CATEGORY_DENYLIST))

