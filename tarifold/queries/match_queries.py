"""Matching, currency conversion, price decision and sample."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fx, match, pricing, sampling
from ..rules import settings as S
from . import inputs as I
from . import sqltext as Q
from .registry import Tables, query

c = F.col


def all_offers(t: Tables):
    return t.sql(I.FULL_OFFERS)


def converted(t: Tables, offers: str = I.FULL_OFFERS):
    return fx.convert_offers(t.sql(offers), fx.rates_as_of(t.sql(I.FX), I.RUN_DATE))


def flat_matches(df, column="matches"):
    """One row per product and match, with rounded numbers."""
    rows = df.select("ord", F.explode(column).alias("m")).select("ord", "m.*")
    return rows.select(
        "ord", "comp_ord", "domain", "name", "title", F.round("price_eur", 6).alias("price_eur"),
        F.round("confidence", 6).alias("confidence"))


# --- equivalent SQL ---------------------------------------------------------------------------

_EUR = "CASE WHEN o.currency <> 'EUR' AND r.rate <> 0 THEN o.price_eur / r.rate ELSE o.price_eur END"


def converted_sql(offers: str) -> str:
    return f"SELECT o.* REPLACE ({_EUR} AS price_eur) FROM ({offers}) o LEFT JOIN ({I.RATES}) r ON upper(o.currency) = r.currency"


def sku_matches_sql(products: str) -> str:
    """First offer with the sku in each store; needs tables offers and products."""
    return f"""
SELECT ord, comp_ord, domain, name, title, price_eur, 1e0 AS confidence FROM (
  SELECT p.ord, o.comp_ord, o.domain, o.name, o.title, o.price_eur,
    row_number() OVER (PARTITION BY p.ord, o.domain ORDER BY o.offer_ord) AS rn
  FROM ({products}) p JOIN offers o ON upper(trim(p.sku)) = upper(trim(o.sku)) AND trim(p.sku) <> '') x
WHERE rn = 1"""


# Text matches of tables products and offers: distinct texts are compared once, then products and offers come back to them.
TEXT_MATCHES = f"""
ours AS MATERIALIZED (SELECT ord, {Q.sorted_tokens("lower(trim(trim(brand) || ' ' || trim(title)))")} AS a FROM products),
theirs AS MATERIALIZED (SELECT *, {Q.sorted_tokens("lower(trim(vendor || ' ' || title))")} AS b FROM offers),
chars AS MATERIALIZED ({Q.alphabet('ours', 'a')}), our_texts AS MATERIALIZED ({Q.coded('ours', 'a')}), their_texts AS MATERIALIZED ({Q.coded('theirs', 'b', True)}),
pairs AS MATERIALIZED (SELECT * FROM our_texts, their_texts WHERE 8 * least(la, lb) >= 3 * (la + lb)
  AND 8 * list_sum(list_transform(list_zip(na, nb), lambda z: least(z[1], z[2]))) >= 3 * (la + lb)),
alike AS MATERIALIZED (SELECT a, b, {Q.SIMILARITY} AS score FROM pairs),
best_text AS (SELECT a, comp_ord, arg_max(offer_ord, {{'s': score, 'o': -offer_ord}}) AS offer_ord, max(score) AS score
  FROM alike JOIN theirs USING (b) WHERE score >= 75e-2 GROUP BY a, comp_ord),
text_matches AS MATERIALIZED (SELECT ord, o.comp_ord, o.domain, o.name, o.title, o.price_eur, floor(t.score * 10000e0 + 5e-1) / 10000e0 AS confidence
  FROM ours JOIN best_text t USING (a) JOIN offers o ON o.comp_ord = t.comp_ord AND o.offer_ord = t.offer_ord)
"""


def matches_sql(products: str, offers: str) -> str:
    """Tables products, offers, text_matches, sku_matches and matches."""
    return f"""offers AS MATERIALIZED ({converted_sql(offers)}), products AS MATERIALIZED ({products}), {TEXT_MATCHES},
sku_matches AS MATERIALIZED ({sku_matches_sql('SELECT * FROM products')}),
matches AS MATERIALIZED (SELECT * FROM sku_matches UNION ALL
  SELECT * FROM text_matches t WHERE NOT EXISTS (SELECT 1 FROM sku_matches s WHERE s.ord = t.ord AND s.domain = t.domain))"""


_OFFERS = f"offers AS MATERIALIZED ({converted_sql(I.FULL_OFFERS)})"
ALL_MATCHES = matches_sql(I.FULL_PRODUCTS, I.FULL_OFFERS)
_MATCH_COLUMNS = "ord, comp_ord, domain, name, title, round(price_eur, 6) AS price_eur, round(confidence, 6) AS confidence"

# Decision from a table matches(ord, comp_ord, …) and products(ord, …).
DECISION = f"""
positive AS (SELECT * FROM matches WHERE price_eur > 0),
per_product AS (SELECT ord, count(*) AS n, quantile_cont(price_eur, 6e-1) AS p60q FROM positive GROUP BY ord),
base AS (SELECT p.*, coalesce(n, 0) AS n, CASE WHEN n >= 2 THEN p60q END AS p60, price_raw / 121e-2 AS net
  FROM products p LEFT JOIN per_product USING (ord)),
priced AS (SELECT *, {Q.to_95('''greatest(net * 12e-1, CASE WHEN n >= 2 THEN greatest(net * 135e-2, least(net * 18e-1, p60)) ELSE net * 135e-2 END)''')} AS price,
  {Q.to_95('net * 15e-1')} AS anchor FROM base),
decided AS (SELECT *, CASE WHEN anchor > price THEN anchor END AS compare_at, CASE WHEN n >= 2 THEN 'competitor' ELSE 'default' END AS method,
  floor(CASE WHEN net > 0 THEN (price - net) / net * 100e0 ELSE 0 END * 10e0 + 5e-1) / 10e0 AS margin FROM priced)
"""
SALE = """
ranked AS (SELECT ord, row_number() OVER (ORDER BY md5('42|' || CAST(ord AS VARCHAR)), ord) AS rn, count(*) OVER () AS m FROM decided WHERE compare_at <> 0),
on_sale AS (SELECT ord FROM ranked WHERE rn <= round_even(CAST(m * 3e-1 AS DOUBLE), 0))
"""


# --- queries ----------------------------------------------------------------------------------

@query("fx_as_of", f"SELECT currency, round(rate, 6) AS rate, rate_date FROM ({I.RATES}) r")
def _(t):
    return fx.rates_as_of(t.sql(I.FX), I.RUN_DATE).select("currency", F.round("rate", 6).alias("rate"), "rate_date")


@query("fx_conversion", f"SELECT offer_ord, currency, round(price_eur, 6) AS price_eur FROM ({converted_sql(I.FULL_OFFERS)}) o")
def _(t):
    return converted(t).select("offer_ord", "currency", F.round("price_eur", 6).alias("price_eur"))


@query("sku_match", f"WITH {_OFFERS}, m AS ({sku_matches_sql(I.FULL_PRODUCTS)}) SELECT {_MATCH_COLUMNS} FROM m")
def _(t):
    return flat_matches(match.match_by_sku(t.sql(I.FULL_PRODUCTS), converted(t)), "by_sku")


@query("text_match", f"WITH {ALL_MATCHES} SELECT {_MATCH_COLUMNS} FROM text_matches")
def _(t):
    return flat_matches(match.match_by_text(t.sql(I.FULL_PRODUCTS), converted(t)), "by_text")


@query("match_fan_out", f"WITH {ALL_MATCHES} SELECT {_MATCH_COLUMNS} FROM matches")
def _(t):
    return flat_matches(match.match_all(t.sql(I.FULL_PRODUCTS), converted(t)))


@query("best_match_per_store", f"""WITH {ALL_MATCHES}
SELECT domain, count(*) AS matches, CAST(count_if(confidence = 1) AS BIGINT) AS certain, round(min(confidence), 6) AS lowest FROM matches GROUP BY domain""")
def _(t):
    rows = flat_matches(match.match_all(t.sql(I.FULL_PRODUCTS), converted(t)))
    return rows.groupBy("domain").agg(
        F.count(F.lit(1)).alias("matches"), F.count_if(c("confidence") == 1).alias("certain"),
        F.round(F.min("confidence"), 6).alias("lowest"))


# Long texts: brand and title of the trade.
@query("text_match_full_titles", f"WITH {matches_sql(I.PRODUCTS, I.TRADE_OFFERS)} SELECT {_MATCH_COLUMNS} FROM text_matches")
def _(t):
    return flat_matches(match.match_by_text(t.sql(I.PRODUCTS), converted(t, I.TRADE_OFFERS)), "by_text")


_PRICED = f"WITH {ALL_MATCHES}, {DECISION}"


def priced_products(t: Tables):
    """Products priced from all their matches, by sku and by text."""
    return pricing.price_products(match.match_all(t.sql(I.FULL_PRODUCTS), converted(t)))


def decided(t: Tables):
    """The decisions alone, written once: the sample reads its input twice."""
    return priced_products(t).select("ord", "pricing_meta").checkpoint()


@query("price_decision", f"""{_PRICED}
SELECT ord, sku, round({Q.cents('net')}, 6) AS net_cost, round(compare_at, 6) AS compare_at_price, round(price, 6) AS new_price,
  round(margin, 6) AS margin_pct, method, round({Q.cents('round(p60, 9)')}, 6) AS p60, round({Q.cents('net * 135e-2')}, 6) AS min_clamp,
  round({Q.cents('net * 18e-1')}, 6) AS max_clamp, n AS matches FROM decided""")
def _(t):
    m = "pricing_meta."
    return priced_products(t).select(
        "ord", "sku", *[F.round(m + x, 6).alias(x) for x in ("net_cost", "compare_at_price", "new_price", "margin_pct")],
        m + "method", *[F.round(m + x, 6).alias(x) for x in ("p60", "min_clamp", "max_clamp")],
        F.size(m + "competitor_prices").cast("bigint").alias("matches"))


@query("competitor_percentile", f"{_PRICED} SELECT ord, round(p60, 6) AS p60 FROM base WHERE n >= 2")
def _(t):
    from ..functions.money import percentile

    matched = match.match_all(t.sql(I.FULL_PRODUCTS), converted(t))
    prices = matched.select("ord", F.transform(F.filter("matches", lambda m: m["price_eur"] > 0), lambda m: m["price_eur"]).alias("x"))
    return prices.filter(F.size("x") >= S.MIN_MATCHES).select(
        "ord", F.round(percentile(c("x"), S.TARGET_PERCENTILE), 6).alias("p60"))


@query("competitor_mean", f"""{_PRICED} SELECT ord, round(avg({Q.cents('price_eur')}), 6) AS mean_price FROM positive GROUP BY ord""")
def _(t):
    from ..functions.money import array_mean

    prices = priced_products(t).select("ord", F.round(array_mean(c("pricing_meta.competitor_prices")), 6).alias("mean_price"))
    return prices.filter("mean_price IS NOT NULL")


@query("match_count_gate", f"{_PRICED} SELECT ord, n AS matches, method FROM decided")
def _(t):
    return priced_products(t).select(
        "ord", F.size("pricing_meta.competitor_prices").cast("bigint").alias("matches"), "pricing_meta.method")


@query("ordered_competitor_prices", f"""{_PRICED}
SELECT ord, string_agg(printf('%.2f', {Q.cents('price_eur')}), '|' ORDER BY comp_ord) AS prices,
  string_agg(domain || '/' || name || '/' || title, '|' ORDER BY comp_ord) AS stores FROM positive GROUP BY ord""")
def _(t):
    meta = c("pricing_meta")
    priced = priced_products(t).filter(F.size("pricing_meta.competitor_prices") > 0)
    return priced.select(
        "ord", F.array_join(F.transform(meta["competitor_prices"], lambda p: F.format_string("%.2f", p)), "|").alias("prices"),
        F.array_join(F.transform(meta["competitor_meta"], lambda m: F.concat_ws("/", m["domain"], m["name"], m["title"])), "|").alias("stores"))


@query("sale_sample", f"{_PRICED}, {SALE} SELECT ord, round(compare_at, 6) AS sale_price FROM decided JOIN on_sale USING (ord)")
def _(t):
    sold = pricing.mark_sale(decided(t)).filter("sale_price IS NOT NULL")
    return sold.select("ord", F.round("sale_price", 6).alias("sale_price"))


@query("exact_fraction_of_orders", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn, count(*) OVER () AS n FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey FROM r WHERE rn <= round_even(CAST(n * 3e-1 AS DOUBLE), 0)""")
def _(t):
    flagged = sampling.exact_fraction(t("orders"), c("o_orderstatus") == "F", "o_orderkey")
    return flagged.filter("sampled").select("o_orderkey")


@query("batch_pricing", f"""WITH {ALL_MATCHES}, {DECISION}, {SALE}
SELECT d.ord, round(price, 6) AS price, method, round({Q.cents('round(p60, 9)')}, 6) AS p60, n AS matches, round(margin, 6) AS margin_pct,
  round(CASE WHEN s.ord IS NOT NULL THEN compare_at END, 6) AS sale_price FROM decided d LEFT JOIN on_sale s ON s.ord = d.ord""")
def _(t):
    rates = fx.rates_as_of(t.sql(I.FX), I.RUN_DATE)
    priced = pricing.apply_pricing(t.sql(I.FULL_PRODUCTS), all_offers(t), rates)
    return priced.select(
        "ord", F.round("export_price_computed", 6).alias("price"), "pricing_meta.method", F.round("pricing_meta.p60", 6).alias("p60"),
        F.size("pricing_meta.competitor_prices").cast("bigint").alias("matches"),
        F.round("pricing_meta.margin_pct", 6).alias("margin_pct"), F.round("sale_price", 6).alias("sale_price"))


@query("pricing_report", f"""{_PRICED}
SELECT d.sku, d.title, d.url, method, round(price, 6) AS new_price, round(compare_at, 6) AS compare_at_price,
  (SELECT string_agg(domain, '|' ORDER BY comp_ord) FROM positive x WHERE x.ord = d.ord) AS stores FROM decided d""")
def _(t):
    report = pricing.pricing_report(priced_products(t))
    stores = F.nullif(F.array_join("competitor_meta.domain", "|"), F.lit(""))
    return report.select("sku", "title", "url", "method", F.round("new_price", 6).alias("new_price"),
                         F.round("compare_at_price", 6).alias("compare_at_price"), stores.alias("stores"))


@query("competitor_audit", f"""{_PRICED}
SELECT d.sku AS "SKU", d.title AS "Title", url AS "URL", round({Q.cents('net')}, 6) AS "Net Cost (EUR)", round(compare_at, 6) AS "Compare At Price (EUR)",
  round(price, 6) AS "New Price (EUR)", round(margin, 6) AS "Margin %", method AS "Pricing Method", round({Q.cents('round(p60, 9)')}, 6) AS "P60 Price (EUR)",
  round({Q.cents('net * 135e-2')}, 6) AS "Min Clamp (EUR)", round({Q.cents('net * 18e-1')}, 6) AS "Max Clamp (EUR)", m.name AS "Competitor Name",
  m.domain AS "Competitor Domain", m.title AS "Competitor Matched Title", round({Q.cents('m.price_eur')}, 6) AS "Competitor Price (EUR)",
  round(m.confidence, 6) AS "Match Confidence" FROM decided d LEFT JOIN positive m ON m.ord = d.ord""")
def _(t):
    rows = pricing.audit(priced_products(t))
    kinds = dict(rows.dtypes)
    return rows.select(*[F.round(f"`{n}`", 6).alias(n) if kinds[n] == "double" else c(f"`{n}`") for n in rows.columns])


@query("pricing_summary", f"""{_PRICED}, {SALE}
SELECT CAST(count_if(method = 'competitor') AS BIGINT) AS competitor_based, CAST(count_if(method = 'default') AS BIGINT) AS default_based,
  (SELECT count(*) FROM on_sale) AS on_sale, count(*) AS products FROM decided""")
def _(t):
    return pricing.pricing_summary(pricing.mark_sale(decided(t)))
