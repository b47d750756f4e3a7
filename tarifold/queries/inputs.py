"""Inputs derived from the given tables, as SQL text that both engines run unchanged.

Every derivation keeps all rows of its tables.
"""

# Product titles of the trade: kind, finish, article name, make, model, year.
_TITLE = """
CASE p_type WHEN 'STANDARD' THEN 'Slip-On demper' WHEN 'MEDIUM' THEN 'Racing Line Uitlaatsysteem'
  WHEN 'PROMO' THEN 'Optionele linkpijp' WHEN 'SMALL' THEN 'dB-killer'
  WHEN 'ECONOMY' THEN 'Hitte-schild' ELSE 'Volledig systeem' END
|| ' ' || CASE p_size % 7 WHEN 0 THEN 'RVS' WHEN 1 THEN 'Mat zwart' WHEN 2 THEN 'Goud verguld'
  WHEN 3 THEN 'Carbon' WHEN 4 THEN 'voor en van' WHEN 5 THEN 'Titanium' ELSE 'Gepolijst' END
|| ' ' || p_name || ' ' || {make} || ' ' || {model} || ' ' || {year}
"""
MAKE = """CASE p_size % 11 WHEN 0 THEN 'Honda' WHEN 1 THEN 'Yamaha' WHEN 2 THEN 'KTM'
  WHEN 3 THEN 'BMW' WHEN 4 THEN 'Moto Guzzi' WHEN 5 THEN 'Gas Gas' WHEN 6 THEN 'Harley-Davidson'
  WHEN 7 THEN 'Royal Enfield' WHEN 8 THEN 'Ducati' WHEN 9 THEN 'Acme' ELSE 'honda' END"""
MODEL = """CASE p_partkey % 6 WHEN 0 THEN 'CB650R' WHEN 1 THEN 'MT-09' WHEN 2 THEN '890 Duke R'
  WHEN 3 THEN 'V7' WHEN 4 THEN '- S1000RR ABS' ELSE 'X' END"""
YEAR = """CASE p_partkey % 5 WHEN 0 THEN '2019-2023' WHEN 1 THEN '2021+' WHEN 2 THEN '2020/23'
  WHEN 3 THEN '2018' ELSE '' END"""
TITLE = _TITLE.format(make=MAKE, model=MODEL, year=YEAR)

BRAND = """CASE p_size % 6 WHEN 0 THEN 'akrapovic' WHEN 1 THEN ' SC-PROJECT ' WHEN 2 THEN 'vance & hines'
  WHEN 3 THEN '' ELSE p_brand END"""

# Catalog rows: ord, url, title, sku, brand, price_raw, product_type, make, model, year.
PRODUCTS = f"""
SELECT p_partkey AS ord, 'https://shop.example/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS STRING) AS url,
  {TITLE} AS title, CASE WHEN p_size = 50 THEN '' ELSE 'SKU-' || CAST(p_partkey AS STRING) END AS sku,
  {BRAND} AS brand, p_retailprice AS price_raw,
  CASE p_type WHEN 'STANDARD' THEN 'Slip-On Uitlaten' WHEN 'MEDIUM' THEN 'Outlet' WHEN 'PROMO' THEN ''
    WHEN 'SMALL' THEN 'Service' ELSE p_type || ' / ' || p_name END AS product_type,
  CASE p_size % 11 WHEN 9 THEN '' WHEN 10 THEN 'Honda' ELSE {MAKE} END AS make,
  CASE p_partkey % 6 WHEN 5 THEN '' ELSE {MODEL} END AS model,
  {YEAR} AS year
FROM part
"""

# Stores: one per nation, so their number is fixed at any scale.
STORES = """
SELECT CAST(n_nationkey AS INT) AS comp_ord, 'store-' || CAST(n_nationkey AS STRING) AS domain,
  n_name AS name, r_name AS market,
  CASE n_nationkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'USD' WHEN 3 THEN 'JPY'
    ELSE CASE WHEN n_nationkey > 10 THEN 'CHF' ELSE 'XXX' END END AS currency,
  n_nationkey % 2 = 0 AS includes_vat
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# Offers: what a supplier asks for a part, in the store of the supplier's nation. Deeply
# discounted lines name the sku, the others only a title.
OFFERS = f"""
SELECT s.domain, s.comp_ord, l_suppkey * 10000000000 + l_partkey AS offer_ord, s.name, s.market,
  s.currency, s.includes_vat,
  CASE WHEN deepest >= 1e-1 THEN ' sku-' || CAST(l_partkey AS STRING) ELSE '' END AS sku,
  {{title}} AS title, {{vendor}} AS vendor,
  asked * CASE s.currency WHEN 'JPY' THEN 150e0 ELSE 1e0 END AS price_raw,
  asked * CASE s.currency WHEN 'JPY' THEN 150e0 ELSE 1e0 END / CASE WHEN s.includes_vat THEN 121e-2 ELSE 1e0 END AS price_eur
FROM (SELECT l_partkey, l_suppkey, min(l_extendedprice) / 50e0 AS asked, max(l_discount) AS deepest, max(ascii(l_returnflag)) AS flag
    FROM lineitem GROUP BY l_partkey, l_suppkey) l
  JOIN supplier ON l_suppkey = s_suppkey JOIN ({STORES}) s ON s.comp_ord = s_nationkey
  JOIN part ON l_partkey = p_partkey
"""
# Offer titles with brand, kind and article in several orders: many distinct ones.
FULL_OFFERS = OFFERS.format(
    title="""CASE flag WHEN 82 THEN p_name || ' ' || lower(p_type) WHEN 78 THEN lower(p_type) || ' ' || p_name || ' kit'
      ELSE upper(p_name) || ' ' || p_type END""", vendor="p_brand")
# Offer titles of the trade, without the year or with a word more.
TRADE_OFFERS = OFFERS.format(
    title=f"CASE flag WHEN 82 THEN {_TITLE.format(make=MAKE, model=MODEL, year=chr(39) * 2)} WHEN 78 THEN upper({TITLE}) ELSE 'Origineel ' || {TITLE} END",
    vendor=BRAND)

# Products whose comparison text is brand, kind and article.
FULL_PRODUCTS = """
SELECT p_partkey AS ord, 'https://shop.example/' || CAST(p_partkey AS STRING) AS url, p_type || ' ' || p_name AS title,
  CASE WHEN p_size = 50 THEN '' ELSE 'SKU-' || CAST(p_partkey AS STRING) END AS sku, p_brand AS brand, p_retailprice AS price_raw
FROM part
"""

# Currency snapshots, one per month of orders.
FX = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS rate_date,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'GBP' WHEN '2' THEN 'usd' WHEN '3' THEN 'JPY' WHEN '4' THEN 'AUD' ELSE 'CHF' END AS currency,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 85e-2 WHEN '2' THEN 108e-2 WHEN '3' THEN 160e0 WHEN '4' THEN 165e-2 ELSE 0e0 END
    * (1e0 + (count(*) % 10) / 100e0) AS rate
FROM orders GROUP BY 1, 2, substr(o_orderpriority, 1, 1)
"""
RUN_DATE = "1999-06-15"

RATES = f"""
SELECT upper(currency) AS currency, rate, rate_date FROM ({FX}) f
WHERE rate_date = (SELECT max(rate_date) FROM ({FX}) g WHERE rate_date <= CAST('{RUN_DATE}' AS DATE))
"""

# Descriptions: every document, with sentences a shop would add.
DESCRIPTIONS = """
SELECT doc_id AS ord, CASE WHEN lang = 'en' THEN text || ' Buy at Source-Shop today! Titanium slip-on.'
    WHEN lang = 'fr' THEN text || ' Stuur ons een bericht via de knop. Carbon linkpijp, Euro 5 e-keur.'
    WHEN lang = 'de' THEN text || '<br><br/><br /> De goedkoopste uitlaat!   Zwart RVS, not for road use.'
    ELSE text || ' Acme has been a Honda dealer. Wij hebben jarenlange ervaring.  Goud de-cat track day.' END AS description_nl,
  source, lang, n_chars
FROM documents
"""

# Catalog rows with their descriptions.
PRODUCT_TEXTS = f"""
SELECT p.*, coalesce(d.description_nl, '') AS description_nl
FROM ({PRODUCTS}) p LEFT JOIN ({DESCRIPTIONS}) d ON p.ord = d.ord
"""
