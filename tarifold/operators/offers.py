"""Offer normalisation: landed store payloads to one offer layout.

A landed payload row has ``domain, page_no, status, payload``: one answer of one store.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_number, strip, text_or_blank
from ..plans.once import computed_once
from ..plans.small import join_small, local_if_small
from ..rules import settings as S
from ..schemas import OFFER_COLUMNS, SHOPIFY_PAYLOAD, WOOCOMMERCE_PAYLOAD

Format = Callable[[DataFrame, DataFrame], DataFrame]


def competitor_defaults(config: DataFrame) -> DataFrame:
    """Store configuration with its blanks filled in."""
    return config.select(
        F.col("comp_ord").cast("int").alias("comp_ord"),
        "domain",
        F.coalesce("name", "domain").alias("name"),
        F.coalesce("market", F.lit("EU")).alias("market"),
        F.upper(F.coalesce("currency", F.lit("EUR"))).alias("currency"),
        F.coalesce("includes_vat", F.lit(False)).alias("includes_vat"),
        F.lower(F.coalesce("type", F.lit("auto"))).alias("type"),
    )


def usable_pages(payloads: DataFrame, items: Column, blocked=S.BLOCK_STATUSES) -> DataFrame:
    """Pages that count: none of a store that blocked any page; of the others, those before
    the first page without items. A page that failed otherwise has no items; one without a
    status was read. One small row per store decides."""
    status = F.coalesce(F.col("status"), F.lit(200))
    empty = (F.coalesce(items, F.lit(0)) == 0) | (status != 200)
    verdict = payloads.groupBy("domain").agg(
        F.max(status.isin(*blocked)).alias("_blocked"), F.min(F.when(empty, F.col("page_no"))).alias("_end"),
    )
    joined = join_small(payloads, verdict, "domain", F.col("page_no"), "inner")
    ends = F.col("_end").isNull() | (F.col("page_no") < F.col("_end"))
    return joined.filter(~F.col("_blocked") & ends).drop("_blocked", "_end")


def without_vat(price: Column, includes_vat: Column, vat: Column | float = S.VAT_RATE) -> Column:
    rate = vat if isinstance(vat, Column) else F.lit(vat)
    return F.when(includes_vat, price / rate).otherwise(price)


def offer_position(page: Column, item: Column, variant: Column | None = None) -> Column:
    """Order within a store as one number: page, item on the page, variant of the item."""
    base = page.cast("bigint") * F.lit(10**10) + item * F.lit(10**5)
    return (base if variant is None else base + variant).cast("bigint")


def tag_list(c: Column) -> Column:
    """Tags given as a JSON array or as comma-separated text."""
    as_json = F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))
    as_text = F.filter(F.transform(F.split(c, ","), strip), lambda t: t != "")
    none = F.array().cast("array<string>")
    return F.when(c.isNull(), none).when(c.startswith("["), as_json).otherwise(as_text)


def _as_offers(items: DataFrame, competitors: DataFrame) -> DataFrame:
    """Positive-price items with their store's configuration, in the offer layout."""
    priced = items.filter(F.col("price_raw") > 0)
    joined = join_small(priced, competitor_defaults(competitors), "domain", F.col("offer_ord"), "inner")
    net = without_vat(F.col("price_raw"), F.col("includes_vat"))
    return joined.withColumn("price_eur", net).select(*OFFER_COLUMNS)


def shopify_offers(payloads: DataFrame, competitors: DataFrame) -> DataFrame:
    """One offer per variant; title, vendor and tags repeat."""
    parsed = computed_once(payloads, products=F.from_json("payload", SHOPIFY_PAYLOAD)["products"])
    pages = usable_pages(parsed, F.size("products"))
    variants = pages.select("domain", "page_no", F.posexplode("products").alias("p", "product")).select(
        "domain", "page_no", "p", "product.*"
    ).select("domain", "page_no", "p", "title", "vendor", "tags", F.posexplode("variants").alias("v", "variant"))
    return _as_offers(variants.select(
        "domain",
        offer_position(F.col("page_no"), F.col("p"), F.col("v")).alias("offer_ord"),
        strip(text_or_blank(F.col("variant.sku"))).alias("sku"),
        text_or_blank(F.col("title")).alias("title"),
        text_or_blank(F.col("vendor")).alias("vendor"),
        F.coalesce(plain_number(F.col("variant.price")), F.lit(0.0)).alias("price_raw"),
        tag_list(F.col("tags")).alias("tags"),
    ), competitors)


def minor_unit_price(prices: Column) -> Column:
    """Price in minor units: ``price`` else ``regular_price``; text that is no integer counts
    with its digits only."""
    raw = F.coalesce(
        F.nullif(prices["price"], F.lit("")), F.nullif(prices["regular_price"], F.lit("")), F.lit("0")
    )
    bare = strip(raw)
    whole = F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare.try_cast("bigint"))
    digits = F.regexp_replace(raw, r"[^0-9]", "").try_cast("bigint")
    scale = F.pow(F.lit(10.0), F.coalesce(prices["currency_minor_unit"], F.lit(2)).cast("double"))
    return F.coalesce(F.coalesce(whole, digits) / scale, F.lit(0.0))


def woocommerce_offers(payloads: DataFrame, competitors: DataFrame) -> DataFrame:
    """One offer per product; the first category stands in for the vendor."""
    parsed = computed_once(payloads, items=F.from_json("payload", WOOCOMMERCE_PAYLOAD))
    pages = usable_pages(parsed, F.size("items"))
    items = pages.select("domain", "page_no", F.posexplode("items").alias("p", "item"))
    names = F.transform(F.col("item.tags"), lambda t: text_or_blank(t["name"]))
    return _as_offers(items.select(
        "domain",
        offer_position(F.col("page_no"), F.col("p")).alias("offer_ord"),
        strip(text_or_blank(F.col("item.sku"))).alias("sku"),
        text_or_blank(F.col("item.name")).alias("title"),
        text_or_blank(F.try_element_at(F.col("item.categories"), F.lit(1))["name"]).alias("vendor"),
        minor_unit_price(F.col("item.prices")).alias("price_raw"),
        F.coalesce(names, F.array().cast("array<string>")).alias("tags"),
    ), competitors)


_FORMATS: dict[str, Format] = {"shopify": shopify_offers, "woocommerce": woocommerce_offers}


def register_offer_format(name: str, read: Format) -> None:
    """Teach the dispatcher a further payload format: ``read(payloads, competitors)`` returns
    offers. A configured ``type`` of that name uses it."""
    _FORMATS[name.lower()] = read


def offer_formats() -> list[str]:
    return list(_FORMATS)


def collect_offers(landed: Mapping[str, DataFrame], competitors: DataFrame) -> DataFrame:
    """Offers of all stores. ``landed`` holds the payload rows per format.

    A store with an explicit type uses that format only; an ``auto`` store uses the first
    format that yields any offer for it. Payloads of stores that don't use a format aren't parsed for it.
    """
    config = competitor_defaults(competitors)
    known = [n for n in _FORMATS if n in landed]
    offers, taken = None, None
    for name in known:
        wanted = config.filter((F.col("type") == name) | ~F.col("type").isin(*_FORMATS))
        if taken is not None:
            earlier = taken.join(config.filter(~F.col("type").isin(*_FORMATS)), "domain", "left_semi")
            wanted = wanted.join(earlier, "domain", "left_anti")
        # asking which stores are left reads all earlier payloads: once is enough
        wanted = local_if_small(wanted)
        pages = join_small(landed[name], wanted.select("domain").distinct(), "domain", F.col("page_no"), "left_semi")
        found = _FORMATS[name](pages, wanted)
        domains = found.select("domain").distinct()
        taken = domains if taken is None else taken.unionByName(domains)
        offers = found if offers is None else offers.unionByName(found)
    if offers is None:
        raise ValueError(f"no landed payloads for any of {list(_FORMATS)}")
    return offers
