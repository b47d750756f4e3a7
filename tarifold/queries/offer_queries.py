"""Offer payloads in the two store formats, built from the lines and parts tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import offers as O
from ..rules import settings as S
from . import inputs as I
from .registry import query

c = F.col

# Store configuration with blanks, and a type per store.
CONFIG = """
SELECT CAST(n_nationkey AS INT) AS comp_ord, 'store-' || CAST(n_nationkey AS STRING) AS domain,
  CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END AS name, CASE WHEN n_regionkey = 2 THEN NULL ELSE 'R' || CAST(n_regionkey AS STRING) END AS market,
  CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'gbp' ELSE 'EUR' END AS currency, CASE n_nationkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS includes_vat,
  CASE n_nationkey % 5 WHEN 0 THEN 'Shopify' WHEN 1 THEN 'woocommerce' WHEN 2 THEN 'auto' ELSE NULL END AS type
FROM nation
"""
CONFIG_FULL = f"""SELECT comp_ord, domain, coalesce(name, domain) AS name, coalesce(market, 'EU') AS market, upper(coalesce(currency, 'EUR')) AS currency,
  coalesce(includes_vat, false) AS includes_vat, lower(coalesce(type, 'auto')) AS type FROM ({CONFIG}) x"""

# One landed answer per part and store page: two items with two variants each. Page numbers
# count the parts of a supplier's nation; some stores block, some have an empty page.
_LANDED = """
SELECT 'store-' || CAST(s_nationkey AS STRING) AS domain, l_partkey AS page_no, max(CASE WHEN s_nationkey = 7 AND l_quantity > 49 THEN 429 ELSE 200 END) AS status,
  min(l_extendedprice) AS price, max(ascii(l_returnflag)) AS flag, max(l_linenumber) AS ln
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, l_partkey
"""
_PRICE = """CASE ln WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '0' ELSE CAST(CAST(floor(price) AS BIGINT) AS STRING) || '.5' END"""
SHOPIFY = f"""
SELECT domain, page_no, status, CASE WHEN domain = 'store-10' AND page_no > 50 AND flag = 78 THEN '{{"products":[]}}' WHEN domain = 'store-12' THEN '[]' WHEN domain = 'store-13' THEN '{{"products":[]}}' ELSE
  '{{"products":[{{"title":"' || p_name || '","vendor":"' || p_brand || '","tags":' || CASE flag WHEN 82 THEN '["' || p_type || '","sale, x"]' ELSE '"' || p_type || ' , new,,"' END ||
  ',"variants":[{{"sku":" V' || CAST(page_no AS STRING) || ' ","price":"' || {_PRICE} || '"}},{{"sku":null,"price":"' || CAST(CAST(floor(price) AS BIGINT) AS STRING) || '"}}]}},' ||
  '{{"title":"second","vendor":null,"tags":[],"variants":[{{"sku":"W","price":"12.25"}}]}}]}}' END AS payload
FROM ({_LANDED}) l JOIN part ON p_partkey = page_no
"""
WOO = f"""
SELECT domain, page_no, status, CASE WHEN domain = 'store-14' OR domain = 'store-11' AND page_no > 50 AND flag = 78 THEN '[]' ELSE
  '[{{"name":"' || p_name || '","sku":" K' || CAST(page_no AS STRING) || '","tags":[{{"name":"' || p_type || '"}},{{"name":"t2"}}],"categories":' ||
  CASE flag WHEN 82 THEN '[]' ELSE '[{{"name":"' || p_brand || '"}},{{"name":"other"}}]' END || ',"prices":{{"price":' ||
  CASE ln WHEN 1 THEN '"",' WHEN 2 THEN 'null,' WHEN 3 THEN '"€ 12.50",' ELSE '"' || CAST(CAST(floor(price) AS BIGINT) AS STRING) || '",' END ||
  '"regular_price":"' || CAST(page_no AS STRING) || '"' || CASE flag WHEN 65 THEN ',"currency_minor_unit":0' ELSE '' END || '}}}}]' END AS payload
FROM ({_LANDED}) l JOIN part ON p_partkey = page_no
"""

_NUM = r"CASE WHEN regexp_matches(v.price, '^[0-9]+(\.[0-9]+)?$') THEN try_cast(v.price AS DOUBLE) ELSE 0 END"


def _usable_sql(source: str, items: str) -> str:
    return f"""SELECT l.* FROM ({source}) l JOIN (SELECT domain, coalesce(max(CASE WHEN status IN (403, 429, 451) THEN 1 ELSE 0 END), 0) AS blocked,
  min(CASE WHEN coalesce({items}, 0) = 0 THEN page_no END) AS last FROM ({source}) s GROUP BY domain) e USING (domain) WHERE blocked = 0 AND (last IS NULL OR page_no < last)"""


_SHOP_ITEMS = "json_array_length(json_extract(payload, '$.products'))"
_WOO_ITEMS = "CASE WHEN starts_with(payload, '[') THEN json_array_length(payload) END"
_FINISH = """SELECT o.domain, c.comp_ord, offer_ord, c.name, c.market, c.currency, c.includes_vat, sku, title, vendor, round(price_raw, 6) AS price_raw,
  round(CASE WHEN c.includes_vat THEN price_raw / 121e-2 ELSE price_raw END, 6) AS price_eur, array_to_string(tags, '|') AS tags
FROM {o} o JOIN cfg c ON o.domain = c.domain WHERE price_raw > 0 AND {types}"""
SHOPIFY_SQL = f"""
cfg AS ({CONFIG_FULL}),
shop_pages AS (SELECT domain, page_no, from_json(json_extract(payload, '$.products'), '[{{"title":"VARCHAR","vendor":"VARCHAR","tags":"JSON","variants":[{{"sku":"VARCHAR","price":"VARCHAR"}}]}}]') AS ps FROM ({_usable_sql(SHOPIFY, _SHOP_ITEMS)}) u),
shop_items AS (SELECT domain, page_no, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS i FROM shop_pages),
shop_variants AS (SELECT domain, page_no, i, p, unnest(p.variants) AS v, generate_subscripts(p.variants, 1) - 1 AS k FROM shop_items),
shop AS (SELECT domain, page_no * 10000000000 + i * 100000 + k AS offer_ord, trim(coalesce(v.sku, '')) AS sku, p.title AS title, coalesce(p.vendor, '') AS vendor, {_NUM} AS price_raw,
  CASE WHEN json_type(p.tags) = 'ARRAY' THEN from_json(p.tags, '["VARCHAR"]') ELSE list_filter(list_transform(string_split(p.tags->>'$', ','), lambda x: trim(x)), lambda x: x <> '') END AS tags FROM shop_variants)"""
_RAW = "coalesce(nullif(p.prices.price, ''), nullif(p.prices.regular_price, ''), '0')"
WOO_SQL = f"""
woo_pages AS (SELECT domain, page_no, from_json(payload, '[{{"name":"VARCHAR","sku":"VARCHAR","tags":[{{"name":"VARCHAR"}}],"categories":[{{"name":"VARCHAR"}}],"prices":{{"price":"VARCHAR","regular_price":"VARCHAR","currency_minor_unit":"INTEGER"}}}}]') AS ps FROM ({_usable_sql(WOO, _WOO_ITEMS)}) u),
woo_items AS (SELECT domain, page_no, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS i FROM woo_pages),
woo AS (SELECT domain, page_no * 10000000000 + i * 100000 AS offer_ord, trim(coalesce(p.sku, '')) AS sku, p.name AS title, coalesce(p.categories[1].name, '') AS vendor,
  CAST(regexp_replace({_RAW}, '[^0-9]', '', 'g') AS BIGINT) / pow(10e0, coalesce(p.prices.currency_minor_unit, 2)) AS price_raw, list_transform(p.tags, lambda x: x.name) AS tags FROM woo_items)"""


def shown(df):
    return df.select(*[
        F.round(x, 6).alias(x) if x.startswith("price") else F.array_join(x, "|").alias(x) if x == "tags" else c(x) for x in df.columns])


def landed(t):
    return t.sql(SHOPIFY), t.sql(WOO), t.sql(CONFIG)


@query("competitor_configuration", CONFIG_FULL)
def _(t):
    return O.competitor_defaults(t.sql(CONFIG))


@query("shopify_offers", f"WITH {SHOPIFY_SQL} {_FINISH.format(o='shop', types='true')}")
def _(t):
    shop, _woo, config = landed(t)
    return shown(O.shopify_offers(shop, config))


@query("woocommerce_offers", f"WITH cfg AS ({CONFIG_FULL}), {WOO_SQL} {_FINISH.format(o='woo', types='true')}")
def _(t):
    _shop, woo, config = landed(t)
    return shown(O.woocommerce_offers(woo, config))


_DISPATCH = f"""WITH {SHOPIFY_SQL}, {WOO_SQL},
s AS ({_FINISH.format(o='shop', types="c.type IN ('shopify', 'auto')")}),
w AS ({_FINISH.format(o='woo', types="(c.type = 'woocommerce' OR (c.type = 'auto' AND o.domain NOT IN (SELECT domain FROM s)))")}),
every AS (SELECT * FROM s UNION ALL SELECT * FROM w)"""


@query("offers_by_store_type", f"{_DISPATCH} SELECT * FROM every")
def _(t):
    shop, woo, config = landed(t)
    return shown(O.collect_offers({"shopify": shop, "woocommerce": woo}, config))


@query("store_yield", f"{_DISPATCH} SELECT comp_ord, domain, (SELECT count(*) FROM every e WHERE e.domain = c.domain) AS offers FROM cfg c")
def _(t):
    from ..operators.summaries import source_yield

    shop, woo, config = landed(t)
    return source_yield(O.competitor_defaults(config), O.collect_offers({"shopify": shop, "woocommerce": woo}, config))


@query("stores_with_data", f"{_DISPATCH} SELECT (SELECT count(DISTINCT domain) FROM every) AS with_data, count(*) AS sites FROM cfg")
def _(t):
    from ..operators.summaries import sites_with_data, source_yield

    shop, woo, config = landed(t)
    offers = O.collect_offers({"shopify": shop, "woocommerce": woo}, config)
    return sites_with_data(source_yield(O.competitor_defaults(config), offers))


@query("usable_payload_pages", f"SELECT domain, page_no FROM ({_usable_sql(SHOPIFY, _SHOP_ITEMS)}) u")
def _(t):
    parsed = t.sql(SHOPIFY).withColumn("n", F.size(F.from_json("payload", "products ARRAY<STRING>")["products"]))
    return O.usable_pages(parsed, c("n")).select("domain", "page_no")


@query("offers_with_store_details", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, c.domain, c.name, c.market, c.currency, c.includes_vat
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN ({CONFIG_FULL}) c ON c.comp_ord = s_nationkey""")
def _(t):
    from ..plans.small import join_small
    from ..plans.skew import join_lookup

    nations = t("supplier").select(c("s_suppkey").alias("l_suppkey"), c("s_nationkey").alias("comp_ord"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    placed = join_lookup(lines, nations, "l_suppkey", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), "inner")
    config = O.competitor_defaults(t.sql(CONFIG)).drop("type")
    return join_small(placed, config, "comp_ord", c("l_orderkey"), "inner").drop("comp_ord")


@query("vat_stripped_prices", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  round(CASE WHEN l_linestatus = 'F' THEN l_extendedprice / 121e-2 ELSE l_extendedprice END, 6) AS net FROM lineitem""")
def _(t):
    net = O.without_vat(c("l_extendedprice"), c("l_linestatus") == "F", S.VAT_RATE)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.round(net, 6).alias("net"))


@query("positive_prices", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice - 50000 AS price FROM lineitem WHERE l_extendedprice - 50000 > 0")
def _(t):
    priced = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (c("l_extendedprice") - 50000).alias("price"))
    return priced.filter(c("price") > 0)


_MINOR = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '12.50' WHEN 3 THEN '-5'
  WHEN 4 THEN 'free' ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS price,
  CASE l_returnflag WHEN 'R' THEN NULL WHEN 'A' THEN '' ELSE CAST(l_partkey AS STRING) END AS regular_price, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 3 END AS minor FROM lineitem"""


@query("minor_unit_prices", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  round(coalesce(coalesce(CASE WHEN regexp_matches(raw, '^[+-]?[0-9]+$') THEN CAST(raw AS BIGINT) END, try_cast(regexp_replace(raw, '[^0-9]', '', 'g') AS BIGINT)) / pow(10e0, coalesce(minor, 2)), 0), 6) AS price
FROM (SELECT *, coalesce(nullif(price, ''), nullif(regular_price, ''), '0') AS raw FROM ({_MINOR}) m) x""")
def _(t):
    prices = F.struct(c("price"), c("regular_price"), c("minor").alias("currency_minor_unit"))
    return t.sql(_MINOR).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                F.round(O.minor_unit_price(prices), 6).alias("price"))


@query("offers_of_all_stores", f"SELECT domain, count(*) AS offers, round(avg(price_eur), 4) AS mean_price FROM ({I.FULL_OFFERS}) o GROUP BY domain")
def _(t):
    return t.sql(I.FULL_OFFERS).groupBy("domain").agg(
        F.count(F.lit(1)).alias("offers"), F.round(F.avg("price_eur"), 4).alias("mean_price"))


