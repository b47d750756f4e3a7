"""Landed product pages to raw product rows.

Fields come from four places in this order: JSON-LD, the embedded gallery (images only),
OpenGraph, the page body. Everything is a projection of the page row: no shuffle, and the page
text is dropped as soon as the fields are out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions.text import (
    first_filled, parse_price, strip, strip_tags, text_or_blank, title_case,
)
from ..plans.once import computed_once
from ..rules import dictionaries as D
from ..rules import settings as S
from .fitment import from_attribute_table, from_captioned_tables, normalize_brand, with_fitment

TEXTS = "array<string>"
LD_NODE = (
    "`name` STRING, `sku` STRING, `mpn` STRING, `gtin` STRING, `gtin13` STRING, "
    "`description` STRING, `brand` STRING, `offers` STRING, `image` STRING"
)


def none_texts() -> Column:
    return F.array().cast(TEXTS)


# --- images ---------------------------------------------------------------------------------

def strip_cache(url: Column) -> Column:
    """Resized copy of an image to the address of the original."""
    return F.regexp_replace(url, S.IMAGE_CACHE, "/")


def is_image_url(url: Column, skip=S.IMAGE_SKIP_FRAGMENTS) -> Column:
    unwanted = F.lit(False)
    for fragment in skip:
        unwanted = unwanted | url.contains(fragment)
    return url.startswith("http") & ~unwanted & url.rlike(S.IMAGE_EXTENSION)


def usable_images(urls: Column, strip_copies: bool = True) -> Column:
    """Image addresses of an array, in order."""
    clean = F.transform(urls, strip_cache) if strip_copies else urls
    return F.filter(clean, lambda u: is_image_url(u))


def add_if_absent(*arrays: Column) -> Column:
    """Arrays appended to one another, each value at its first place only."""
    return F.array_distinct(F.concat(*arrays))


# --- JSON-LD --------------------------------------------------------------------------------

def json_items(text: Column) -> Column:
    """Members of a JSON list, or the one value, each as text."""
    listed = F.coalesce(F.from_json(text, TEXTS), none_texts())
    return F.when(text.isNull() | (strip(text) == ""), none_texts()).when(
        strip(text).startswith("["), listed
    ).otherwise(F.array(text))


def _type_is_product(node: Column) -> Column:
    kind = F.from_json(node, "`@type` STRING")["@type"]
    return F.array_contains(json_items(kind), "Product")


def _children(node: Column) -> Column:
    return json_items(F.from_json(node, "`@graph` STRING")["@graph"])


def _all_nodes(script: Column) -> Column:
    """Nodes of a script level by level, ``@graph`` in ``@graph`` without limit.

    Each level has a key that is written out or holds an escape, so there are at most as many levels as such places.
    """
    levels = F.sequence(F.lit(0), F.regexp_count(script, F.lit(r"@graph|\\u")))
    top = json_items(script)
    zero = F.struct(top.alias("nodes"), top.alias("last"))

    def step(s: Column, _: Column) -> Column:
        below = F.flatten(F.transform(s["last"], _children))
        return F.when(F.size(s["last"]) == 0, s).otherwise(
            F.transform(F.array(below), lambda b: F.struct(F.concat(s["nodes"], b).alias("nodes"), b.alias("last")))[0])

    return F.aggregate(levels, zero, step, lambda s: s["nodes"])


def ld_scripts(page: Column) -> Column:
    """Bodies of the page's JSON-LD scripts that can be parsed."""
    return F.filter(M.scripts_of_type(page, "application/ld+json"), lambda s: F.try_parse_json(s).isNotNull())


def with_json_ld(pages: DataFrame, scripts: Column | None = None) -> DataFrame:
    """Add ``json_ld``, the text of the first product node, and ``_ld``, its fields.

    Scripts (by default those of ``_page``) count in page order, unparsable ones are skipped, members of ``@graph`` come after
    all nodes of the level above in their script.
    """
    scripts = ld_scripts(F.col("_page")) if scripts is None else scripts
    nodes = computed_once(pages, _nodes=F.flatten(F.transform(scripts, _all_nodes)))
    found = computed_once(nodes, json_ld=F.try_element_at(F.filter("_nodes", _type_is_product), F.lit(1)))
    return computed_once(found.drop("_nodes"), _ld=F.from_json("json_ld", LD_NODE))


def named_or_text(value: Column) -> Column:
    """``{"name": …}`` or plain text."""
    return F.when(value.startswith("{"), F.get_json_object(value, "$.name")).otherwise(value)


def after_last_slash(value: Column) -> Column:
    return F.substring_index(text_or_blank(value), "/", -1)


def ld_images(image: Column) -> Column:
    """One address, or a list of addresses and ``{"url": …}`` objects."""
    items = F.when(image.startswith("{"), none_texts()).otherwise(json_items(image))
    urls = F.transform(items, lambda i: F.when(i.startswith("{"), F.get_json_object(i, "$.url")).otherwise(i))
    return usable_images(F.array_compact(urls))


def ld_price(offer: Column) -> Column:
    """Price candidate of an offer: its own ``price``, else its own ``lowPrice``, whatever nested offers say.

    A JSON number with a fraction or an exponent is taken as it is; text and whole numbers are read as localised text. JSON's
    own rules tell them apart: the value is read by its type, not by its spelling.
    """

    def read(v: Column) -> Column:
        key = F.when(F.variant_get(v, "$.price", "variant").isNotNull(), "price").otherwise("lowPrice")
        value = F.when(key == "price", F.variant_get(v, "$.price", "variant")).otherwise(F.variant_get(v, "$.lowPrice", "variant"))
        kind = F.schema_of_variant(value)
        text = F.when(kind.rlike("^(?:STRING|BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "string"))
        number = F.when(kind.rlike("^(?:DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double"))
        return F.when(number > 0, number).otherwise(parse_price(text_or_blank(text)))

    return F.when(F.ltrim(offer).startswith("{"), F.transform(F.array(F.try_parse_json(offer)), read)[0]).otherwise(F.lit(0.0))


# --- gallery --------------------------------------------------------------------------------

def gallery_images(page: Column) -> Column:
    """Addresses under ``full``, ``img``, ``src`` and ``url`` in the gallery scripts, in
    document order."""
    scripts = F.filter(
        M.scripts_of_type(page, "text/x-magento-init"), lambda s: F.try_parse_json(s).isNotNull()
    )
    pair = F.lit(rf'(?s)"({"|".join(S.GALLERY_KEYS)})"\s*:\s*"(.*?(?<!\\)(?:\\\\)*)"')
    raw = F.flatten(F.transform(scripts, lambda s: F.regexp_extract_all(s, pair, F.lit(2))))
    decoded = F.transform(
        raw, lambda v: F.from_json(F.concat(F.lit('["'), v, F.lit('"]')), TEXTS)[0]
    )
    return usable_images(F.array_compact(decoded))


# --- OpenGraph ------------------------------------------------------------------------------

def open_graph(page: Column) -> Column:
    """``og:*`` properties as ``array<struct<property, content>>`` in page order."""
    pairs = F.transform(M.elements(page, M.by_name("meta")), lambda n: F.struct(
        M.value_of(n, "property").alias("property"), M.value_of(n, "content").alias("content")
    ))
    return F.filter(pairs, lambda p: p["property"].startswith("og:") & (p["content"] != ""))


def og_value(pairs: Column, name: str) -> Column:
    """Last value of a property, ``""`` if absent."""
    hits = F.filter(pairs, lambda p: p["property"] == name)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["content"], F.lit(""))


# --- page body ------------------------------------------------------------------------------

def first_element_text(page: Column, *conditions) -> Column:
    """Text of the first element of the first kind that is present at all."""
    found = F.coalesce(*[M.first(M.elements(page, c)) for c in conditions])
    return text_or_blank(M.text_of(page, found))


def dom_title(page: Column) -> Column:
    return first_element_text(page, M.by_name("h1"), M.with_attribute("itemprop", "name"))


def dom_sku(page: Column) -> Column:
    return first_element_text(page, M.with_attribute("itemprop", "sku"), M.with_class("sku"))


def dom_brand(page: Column) -> Column:
    brands = M.elements(page, M.with_attribute("itemprop", "brand"))
    names = M.descendants(page, brands, M.with_attribute("itemprop", "name"))
    return text_or_blank(M.text_of(page, F.coalesce(M.first(names), M.first(brands))))


def dom_description(page: Column) -> Column:
    """The description element with its markup."""
    whole = M.elements(page, M.class_matches("description"))
    value = M.first(M.descendants(page, whole, M.with_class("value")))
    return text_or_blank(M.markup_of(page, F.coalesce(value, M.first(whole))))


def dom_prices(page: Column) -> Column:
    """Positive prices of all price elements that are not inside an old-price wrapper."""
    is_old = lambda n: M.with_class("old-price")(n) | M.with_attribute("data-price-type", "oldPrice")(n)
    old = M.outermost(M.elements(page, is_old))
    boxes = M.elements(page, M.with_class("price"))
    inserted = M.descendants(page, boxes, M.by_name("ins"))
    amounts = M.descendants(page, inserted, M.with_class("amount"))
    found = F.filter(F.concat(boxes, inserted, amounts), lambda n: ~F.exists(old, lambda o: (o["at"] < n["at"]) & (n["at"] < o["after"])))
    return F.filter(F.transform(found, lambda n: parse_price(M.text_of(page, n))), lambda v: v > 0)


def dom_images(page: Column, url: Column) -> Column:
    tags = M.elements(page, M.by_name("img"))
    by_src = F.filter(tags, lambda t: M.value_of(t, "src").contains(S.PRODUCT_MEDIA))
    by_data = F.filter(tags, lambda t: M.value_of(t, "data-src").contains(S.PRODUCT_MEDIA))
    source = lambda t: F.coalesce(*[F.nullif(M.value_of(t, a), F.lit("")) for a in S.IMAGE_ATTRIBUTES])
    found = F.array_compact(F.transform(F.concat(by_src, by_data), source))
    return usable_images(F.transform(found, lambda r: M.absolute_url(M.origin_of(url), r)))


def title_from_slug(url: Column) -> Column:
    path = F.regexp_replace(M.path_of(url), "/+$", "")
    return title_case(F.replace(F.substring_index(path, "/", -1), F.lit("-"), F.lit(" ")))


def breadcrumbs(page: Column, denylist=D.BREADCRUMB_DENYLIST) -> Column:
    """Links of the first kind of navigation that has any, without blanks and site pages."""
    links = lambda condition: M.descendants(page, M.elements(page, condition), M.by_name("a"))
    options = [links(c) for c in (M.by_name("nav"), M.with_class("breadcrumb"), M.with_class("breadcrumbs"))]
    chosen = F.coalesce(*[F.transform(F.array(o), lambda x: F.when(F.size(x) > 0, x))[0] for o in options])
    texts = F.coalesce(F.transform(chosen, lambda n: M.text_of(page, n)), none_texts())
    return F.filter(texts, lambda t: (t != "") & ~F.lower(t).isin(*denylist))


def last_crumb(crumbs: Column) -> Column:
    return text_or_blank(F.try_element_at(crumbs, F.lit(-1)))


def lowest_price(candidates: Column) -> Column:
    """Smallest positive candidate: a sale price beats the list price."""
    return F.coalesce(F.array_min(F.filter(candidates, lambda v: v > 0)), F.lit(0.0))


def is_product(title: Column, price: Column) -> Column:
    return (title != "") & (price != 0)


# --- the whole scan -------------------------------------------------------------------------

def page_fields(page: Column, url: Column) -> Column:
    """All that a product row takes from its page, so that the page itself goes no further."""
    return F.struct(
        ld_scripts(page).alias("scripts"), gallery_images(page).alias("gallery"), open_graph(page).alias("og"), dom_title(page).alias("title"),
        dom_sku(page).alias("sku"), dom_brand(page).alias("brand"), dom_description(page).alias("description"), dom_prices(page).alias("prices"),
        dom_images(page, url).alias("images"), breadcrumbs(page).alias("breadcrumbs"), from_captioned_tables(page).alias("table_fit"),
        from_attribute_table(page).alias("attribute_fit"),
    )


def extract_products(pages: DataFrame) -> DataFrame:
    """One row per page that has a title and a price. ``pages`` has ``ord, url, html``.

    Intermediate columns keep shared parts (fields, nodes, the title's make) from being worked
    out once per field that uses them.
    """
    url, og = F.col("url"), F.col("_p.og")
    fields = computed_once(M.with_page(pages).select("ord", "url", "_page"), _p=page_fields(F.col("_page"), url)).drop("_page")
    staged = with_json_ld(fields, F.col("_p.scripts"))
    staged = computed_once(staged, _offer=F.try_element_at(json_items(F.col("_ld.offers")), F.lit(1)))
    staged = computed_once(
        staged,
        title=first_filled(F.col("_ld.name"), og_value(og, "og:title"), F.col("_p.title"), title_from_slug(url)),
        price_raw=lowest_price(F.concat(
            F.array(ld_price(F.col("_offer")), parse_price(og_value(og, "og:price:amount"))), F.col("_p.prices"))),
    )
    found = with_fitment(staged.filter(is_product(F.col("title"), F.col("price_raw"))), F.col("_p.table_fit"), F.col("_p.attribute_fit"))
    return found.select(
        "ord", "url", "title",
        first_filled(F.coalesce(F.nullif("_ld.sku", F.lit("")), "_ld.mpn"), F.col("_p.sku")).alias("sku"),
        normalize_brand(first_filled(named_or_text(F.col("_ld.brand")), F.col("_p.brand"))).alias("brand"),
        "price_raw",
        first_filled(
            strip_tags(F.col("_ld.description")), strip_tags(og_value(og, "og:description")),
            F.col("_p.description")).alias("description_nl"),
        add_if_absent(
            ld_images(F.col("_ld.image")), F.col("_p.gallery"),
            usable_images(F.array(og_value(og, "og:image")), strip_copies=False), F.col("_p.images")).alias("images"),
        F.col("_p.breadcrumbs").alias("breadcrumbs"),
        "fitment",
        last_crumb(F.col("_p.breadcrumbs")).alias("product_type"),
        first_filled(F.coalesce(F.nullif("_ld.gtin", F.lit("")), "_ld.gtin13")).alias("gtin"),
        first_filled(after_last_slash(F.get_json_object("_offer", "$.availability"))).alias("availability"),
        F.lit(S.WEIGHT_GRAMS).alias("weight_grams"),
        text_or_blank(F.col("json_ld")).alias("json_ld"),
    )


def product_links(pages: DataFrame) -> DataFrame:
    """Distinct product addresses a listing page links to: ``ord, link``.

    A product link stays on the page's host and has a one-part path that is not a site page.
    Links of a page are made distinct within its row, so nothing is shuffled.
    """
    origin = F.col("origin")
    on_site = lambda u: (M.host_of(u) == M.host_of(origin)) & is_product_path(M.path_of(u))
    linked = M.elements(F.col("_page"), lambda n: (n["name"] == "a") & F.array_contains(n["names"], "href"))
    return (
        M.with_page(pages).select("ord", M.origin_of(F.col("url")).alias("origin"), linked.alias("tags"))
        .withColumn("links", F.transform("tags", lambda n: M.absolute_url(origin, M.value_of(n, "href"))))
        .select("ord", F.explode(F.array_distinct(F.filter("links", on_site))).alias("link"))
    )


def is_product_path(path: Column, segments=D.NON_PRODUCT_SEGMENTS, form: str = D.PRODUCT_PATH) -> Column:
    return ~path.rlike(rf"(?i)/(?:{'|'.join(segments)})(?:/|$)") & path.rlike("(?i)" + form)


def failed_pages(pages: DataFrame) -> DataFrame:
    """Addresses that could not be fetched; pages without a product are not among them."""
    return pages.filter(F.coalesce("status", F.lit(0)) != 200).select("url")
