"""Offers, pages, images, files and whole runs on small inputs."""

import csv
import glob
import json
import struct
import zlib

from tarifold.operators import extract, images, offers, quality, translate
from tarifold.plans import runs
from tarifold.queries import ORACLES, QUERIES
from tarifold.schemas import EXPORT_COLUMNS, FX, OFFER
from tarifold.sources import readers, writers
from tarifold.streaming import pages as stream

CONFIG = "comp_ord int, domain string, name string, market string, currency string, includes_vat boolean, type string"
PAGE = """<html><head><meta property="og:title" content="OG"><script type="application/ld+json">{"bad":</script>
<script type="application/ld+json">{"@graph":[{"@type":"Org"},{"@type":["Thing","Product"],"name":" Akra Slip-On Honda CB650R %s ",
"sku":"%s","brand":{"name":"akrapovič"},"offers":[{"price":649.5,"availability":"http://schema.org/InStock"}],
"image":["https://a/media/cache/0123456789abcdef0123456789abcdef/p.jpg",{"url":"https://a/q.png"}],"description":"<p>Hi. Source-shop rules.</p>"}]}</script>
<script type="text/x-magento-init">{"x":[{"img":"https:\\/\\/a\\/g1.jpg"}]}</script></head><body><nav><a>Home</a><a>Uitlaten</a></nav><h1>Dom</h1>
<span class="old-price"><span class="price">€ 100,00</span></span><span class="price">€ 599,00</span><img src="/media/catalog/product/d.jpg">
<table class="woocommerce-product-attributes"><tr><th>Merk motor</th><td>Yamaha</td></tr><tr><th>Model</th><td>MT-09</td></tr></table></body></html>"""


def pages(spark):
    rows = [(1, "https://s.nl/one", PAGE % ("2019-2023", "A1"), 200), (2, "https://s.nl/two", PAGE % ("2021+", "A1"), 200),
            (3, "https://s.nl/three", PAGE % ("x", ""), 200), (4, "https://s.nl/none", "<h1>No price</h1>", 200), (5, "https://s.nl/down", "", 503)]
    return spark.createDataFrame(rows, "ord long, url string, html string, status int")


def test_extraction(spark):
    row = extract.extract_products(pages(spark)).orderBy("ord").first()
    assert (row.title, row.sku, row.brand, row.price_raw) == ("Akra Slip-On Honda CB650R 2019-2023", "A1", "Akrapovic", 599.0)
    assert row.images == ["https://a/media/p.jpg", "https://a/q.png", "https://a/g1.jpg", "https://s.nl/media/catalog/product/d.jpg"]
    assert tuple(row.fitment) == ("Yamaha", "MT-09", "2019-2023")
    assert (row.breadcrumbs, row.availability) == (["Uitlaten"], "InStock")
    assert extract.extract_products(pages(spark)).count() == 3


def test_stream_extraction_equals_batch(spark, tmp_path):
    landed = str(tmp_path / "landed")
    pages(spark).withColumnRenamed("ord", "page_id").drop("status").write.parquet(landed)
    for _ in range(2):
        stream.write_products(stream.stream_products(spark, landed), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_offer_formats(spark):
    config = spark.createDataFrame([(0, "a", "A", None, None, True, "shopify"), (1, "b", None, "NL", "gbp", None, "woocommerce"), (2, "c", None, None, None, None, None)], CONFIG)
    shop = [{"products": [{"title": "T", "vendor": "V", "tags": "x, y,,", "variants": [{"sku": " k ", "price": "121"}, {"price": "abc"}, {"price": ""}, {"price": "0"}]}]}]
    woo = [{"name": "W", "sku": "w", "tags": [{"name": "t"}], "categories": [], "prices": {"price": "12.50", "currency_minor_unit": 2}},
           {"name": "X", "sku": "", "tags": [], "categories": [{"name": "cat"}], "prices": {"price": "", "regular_price": "700", "currency_minor_unit": 0}}]
    schema = "domain string, page_no int, status int, payload string"
    shops = spark.createDataFrame([("a", 1, 200, json.dumps(shop[0])), ("a", 2, 200, '{"products":[]}'), ("a", 3, 200, json.dumps(shop[0])), ("b", 1, 200, json.dumps(shop[0]))], schema)
    woos = spark.createDataFrame([("b", 1, 200, json.dumps(woo)), ("c", 1, 200, json.dumps(woo[1:])), ("a", 1, 200, json.dumps(woo))], schema)
    got = offers.collect_offers({"shopify": shops, "woocommerce": woos}, config).orderBy("comp_ord", "offer_ord").collect()
    assert [(r.domain, r.sku, r.title, r.vendor, round(r.price_eur, 2), r.tags) for r in got] == [
        ("a", "k", "T", "V", 100.0, ["x", "y"]), ("b", "w", "W", "", 12.5, ["t"]), ("b", "", "X", "cat", 700.0, []), ("c", "", "X", "cat", 700.0, [])]
    blocked = shops.unionByName(spark.createDataFrame([("a", 9, 403, None)], schema))
    assert offers.shopify_offers(blocked, config).filter("domain = 'a'").count() == 0


def test_registered_format(spark):
    config = spark.createDataFrame([(0, "a", None, None, None, None, "feed")], CONFIG)
    offers.register_offer_format("feed", lambda landed, cfg: landed.join(cfg.select("domain"), "domain"))
    got = offers.collect_offers({"feed": spark.createDataFrame([("a", 1), ("z", 2)], "domain string, price int")}, config)
    assert [r.price for r in got.collect()] == [1]
    offers._FORMATS.pop("feed")


def png(width, height):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    pixels = zlib.compress(b"".join(b"\0" + b"\0" * width for _ in range(height)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", pixels) + chunk(b"IEND", b"")


def test_image_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(30, 20))
    (tmp_path / "b.jpg").write_bytes(b"not an image")
    rows = {r.url.rsplit("/", 1)[-1]: r for r in readers.image_files(spark, str(tmp_path)).collect()}
    assert (rows["a.png"].width, rows["a.png"].height, rows["a.png"].content_type) == (30, 20, "image/png")
    assert rows["b.jpg"].width is None and rows["b.jpg"].content_length == 12


def test_image_rules(spark):
    meta = spark.createDataFrame(
        [("http://i/1.jpg", 200, "image/jpeg", 20000, 800, 10), ("http://i/2.jpg", 200, "image/jpeg", 9999, 900, 900), ("http://i/3", 200, "image/png", 0, None, None),
         ("http://i/4.jpg", 404, "image/png", 20000, 900, 900), ("http://i/5.jpg", 200, "text/html", 20000, 900, 900), ("http://i/6.jpg", 200, "image/png", None, 799, 799)],
        "url string, status int, content_type string, content_length long, width int, height int")
    products = spark.createDataFrame([(1, [f"http://i/{n}.jpg" for n in (6, 1, 2)] + ["http://i/3"]), (2, ["http://i/4.jpg"]), (3, [])], "ord long, images array<string>")
    got = {r.ord: r.validated_images for r in images.validate_images(products, meta).collect()}
    assert got == {1: ["http://i/1.jpg", "http://i/3"], 2: [], 3: []}


def test_translation_cache(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, text_en string")
    new = spark.createDataFrame([("b", "3"), ("c", "4")], "key string, text_en string")
    assert {tuple(r) for r in translate.add_translations(old, new).collect()} == {("a", "1"), ("b", "3"), ("c", "4")}


def test_quality_flags_without_optional_steps(spark):
    df = extract.extract_products(pages(spark))
    flags = {r.url: r.flags for r in quality.quality_report(df).collect()}
    assert flags["https://s.nl/three"] == ["missing_sku", "missing_year", "no_valid_images"]


def test_full_run_and_reprice(spark, tmp_path):
    out = str(tmp_path / "run")
    offer_rows = [(f"d{d}", d, d, f"D{d}", "EU", "EUR", False, "a1", "t", "v", 800.0 + d, 800.0 + d, []) for d in range(3)]
    named = ["domain", "comp_ord", "offer_ord", "name", "market", "currency", "includes_vat", "sku", "title", "vendor", "price_raw", "price_eur", "tags"]
    offer_table = spark.createDataFrame([dict(zip(named, r)) for r in offer_rows], OFFER)
    meta = spark.createDataFrame([("https://a/q.png", 200, "image/png", 20000, 900, 900), ("https://a/g1.jpg", 200, "image/png", 20000, 900, 900)],
                                 "url string, status int, content_type string, content_length long, width int, height int")
    translations = spark.createDataFrame([("x", "y")], "key string, text_en string")
    inputs = runs.Inputs(offer_table, spark.createDataFrame([], FX), translations, meta)
    settings = runs.Settings(out, "2026-01-01", 2026)
    rows = runs.full_run(pages(spark), inputs, settings)
    # Page 2 repeats the sku of page 1; pages 1 and 3 have two valid images each.
    assert rows.count() == 4 and rows.select(*[f"`{n}`" for n in EXPORT_COLUMNS]).count() == 4
    first = rows.filter("ord = 1 AND pos = 0").first()
    assert first["Handle"] == "akra-slip-on-honda-cb650r-2019-2023" and first["Body (HTML)"] == "Hi."
    assert first["Variant Price"] == "800.95"
    assert spark.read.json(f"{out}/duplicates").count() == 1
    assert [r.url for r in spark.read.json(f"{out}/failed_pages").collect()] == ["https://s.nl/down"]
    with open(glob.glob(f"{out}/import_csv/part-*.csv")[0], newline="") as f:
        assert next(csv.reader(f)) == EXPORT_COLUMNS
    again = runs.reprice(spark.read.parquet(f"{out}/tables/raw_products"), inputs, runs.Settings(str(tmp_path / "again"), "2026-01-01", 2026))
    assert again.filter("pos = 0").count() == 3


def test_csv_round_trip(spark, tmp_path):
    texts = ['plain', 'with "quotes", and commas', "line\nbreak", "", " padded "]
    rows = spark.createDataFrame([(n, 0, str(n), x) for n, x in enumerate(texts)], "ord long, pos int, Id string, Text string")
    writers.write_import_csv(rows, str(tmp_path / "csv"))
    got = []
    for path in sorted(glob.glob(str(tmp_path / "csv/part-*.csv"))):
        with open(path, newline="") as f:
            got += [r["Text"] for r in csv.DictReader(f)] if f.readable() else []
    assert got == texts


def test_missing_tables_read_as_empty(spark, tmp_path):
    assert readers.translation_cache(spark, str(tmp_path / "no")).count() == 0
    assert readers.competitors(spark, str(tmp_path / "no")).count() == 0


def test_registry():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
