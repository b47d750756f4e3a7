"""What keeps work spread and memory bounded, whatever the size of the tables."""

import random
import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tarifold.functions import markup, similarity, wording
from tarifold.operators import offers
from tarifold.queries import extraction_queries, registry
from tarifold.session import ensure_checkpoint_dir


def parts(spark, folder, n):
    spark.range(n).selectExpr(
        "id AS p_partkey", "concat('part ', id) AS p_name", "'SMALL' AS p_type", "CAST(id % 50 AS INT) AS p_size", "CAST(id AS DOUBLE) AS p_retailprice",
    ).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return registry.Tables(spark, str(folder))


def test_pages_of_one_small_file_are_dealt_to_many_tasks(spark, tmp_path):
    n = 3 * registry.ROWS_PER_TASK
    shop = extraction_queries.shop_pages(parts(spark, tmp_path, n))
    sizes = shop.select("ord").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 3 and max(sizes) <= 1.1 * registry.ROWS_PER_TASK
    assert shop.select("ord").distinct().count() == n


def test_a_spread_table_without_rows(spark, tmp_path):
    assert extraction_queries.shop_pages(parts(spark, tmp_path, 0)).collect() == []


def test_pages_are_given_back_in_bounded_runs():
    long = "<p>" * (markup.CHARACTERS_PER_RUN // 3)
    texts = [long, "a", long, None, *["<b>x</b>"] * (markup.PAGES_PER_RUN + 5)]
    runs = list(markup._runs(pa.array(texts)))
    assert [t or "" for t in texts] == [t for run in runs for t in run]
    assert max(map(len, runs)) == markup.PAGES_PER_RUN
    assert all(len(run) == 1 or sum(map(len, run)) <= markup.CHARACTERS_PER_RUN for run in runs)
    assert list(markup._runs(pa.array([], pa.string()))) == []


def test_pages_of_a_run_keep_to_themselves():
    pages = markup._pages(["<ul><li class='a  b'>x", "", "</ul>y<p>z"]).to_pylist()
    assert [[n["name"] for n in p["nodes"]] for p in pages] == [["ul", "li"], [], ["p"]]
    assert [(n["at"], n["after"], n["close"], n["last"]) for n in pages[0]["nodes"]] == [(0, 2, 2, 1), (1, 2, 2, 1)]
    assert pages[2]["nodes"][0]["at"] == 0 and pages[2]["tokens"] == ["</ul>", "<p>"]
    assert pages[0]["nodes"][1]["classes"] == " a b " and pages[1]["gaps"] == [""]


def test_payloads_of_other_stores_are_not_parsed_for_a_format(spark):
    seen = {}

    def reader(name, read):
        def wrapped(payloads, competitors):
            seen[name] = sorted(r["domain"] for r in payloads.select("domain").distinct().collect())
            return read(payloads, competitors)
        return wrapped

    config = spark.createDataFrame(
        [(1, "a", "shopify"), (2, "b", "woocommerce"), (3, "c", "auto"), (4, "d", None), (4, "d", None)], "comp_ord int, domain string, type string",
    ).selectExpr("*", "CAST(NULL AS STRING) AS name", "CAST(NULL AS STRING) AS market", "CAST(NULL AS STRING) AS currency", "CAST(NULL AS BOOLEAN) AS includes_vat")
    shop = '{"products":[{"title":"t","variants":[{"sku":"s","price":"2.5"}]}]}'
    woo = '[{"name":"n","sku":"k","prices":{"price":"250"}}]'
    layout = "domain string, page_no int, status int, payload string"
    landed = {
        "shopify": spark.createDataFrame([(d, 1, 200, shop if d != "d" else "{}") for d in "abcd"], layout),
        "woocommerce": spark.createDataFrame([(d, 1, 200, woo) for d in "abcd"], layout),
    }
    formats = dict(offers._FORMATS)
    try:
        for name, read in formats.items():
            offers.register_offer_format(name, reader(name, read))
        found = offers.collect_offers(landed, config)
        rows = sorted((r["domain"], r["title"], r["price_raw"]) for r in found.collect())
    finally:
        offers._FORMATS.update(formats)
    assert seen == {"shopify": ["a", "c", "d"], "woocommerce": ["b", "d"]}
    assert rows == [("a", "t", 2.5), ("b", "n", 2.5), ("c", "t", 2.5), ("d", "n", 2.5), ("d", "n", 2.5)]


def test_an_answer_is_cut_once_however_many_texts_it_holds(spark):
    def seconds(n):
        answers = spark.range(1).select(F.concat(*[F.lit(f"[{k + 1}] " + "text " * 4000) for k in range(n)]).alias("a")).checkpoint()
        blocks = answers.select(wording.numbered_blocks(F.col("a"), F.lit(n)).alias("b"))
        start = time.perf_counter()
        assert blocks.first()["b"] == [("text " * 4000).strip()] * n
        return time.perf_counter() - start

    ensure_checkpoint_dir(spark)
    seconds(2)
    assert seconds(200) < 15  # 4 MB; 800 MB where each number cuts the answer again


def test_answers_without_numbers(spark):
    rows = spark.createDataFrame([("[2] b [1] a [2] c", 3), ("none", 2), (None, 2), ("[1] x", 0)], "a string, n int").coalesce(1)
    got = [r["b"] for r in rows.select(wording.numbered_blocks(F.col("a"), F.col("n")).alias("b")).collect()]
    assert got == [["a", "c", ""], ["", ""], ["", ""], []]


def test_subsequences_across_words_and_steps(monkeypatch):
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(4)
    texts = ["".join(rng.choice("ab cé") for _ in range(n)) for n in (1, 63, 64, 65, 128, 129, 200)] + ["a" * 64, "a" * 130]
    pairs = [(a, b) for a in texts for b in texts]
    monkeypatch.setattr(similarity, "PAIRS_PER_STEP", 7)
    got = similarity.pair_scores(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    assert list(got) == [2.0 * lcs(a, b) / (len(a) + len(b)) for a, b in pairs]


def test_a_word_of_all_masks_is_read_as_it_lies_in_memory():
    encoded = similarity.Encoded(["a" * 100, "b"], similarity.alphabet_of(["ab"]))
    masks = similarity.position_masks(encoded, 2)
    assert masks.shape == (2, 3, 2) and all(masks[:, :, w].flags.c_contiguous for w in range(2))
