"""Inputs and look-ups that shuffle little, and tables that are worked out once."""

import pytest
from pyspark.sql import functions as F

from tarifold.plans.skew import heavy_keys
from tarifold.queries import catalog_queries, export_queries, registry


def test_keys_are_shuffled_for_counting_only_where_some_are_heavy(spark):
    rows = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    assert "Aggregate" not in heavy_keys(rows, "key", 500)._jdf.queryExecution().optimizedPlan().toString()
    hot = rows.unionByName(rows.select(F.lit("hot").alias("key"))).unionByName(rows.select(F.lit(None).cast("string").alias("key")))
    assert sorted(map(tuple, heavy_keys(hot, "key", 500).collect()), key=str) == [("hot", 2), (None, 2)]


def shop(spark, folder):
    spark.createDataFrame(
        [(1, "a", "Brand#1", "SMALL", 3, 10.0), (17, "b", None, "PROMO", 4, 11.0), (None, "c", "x", "LARGE", 5, 12.0)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    ).write.parquet(f"{folder}/part.parquet")
    lines = [(1, 5), (1, 5), (1, 30), (1, None), (17, 2), (17, 2), (None, 7), (None, None), (9, 9)]
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long").write.parquet(f"{folder}/lineitem.parquet")
    return registry.Tables(spark, str(folder))


def test_images_are_those_of_the_statement(spark, tmp_path):
    t = shop(spark, tmp_path)
    want = t.sql(catalog_queries._SHOWN).groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("pos", "image"))).alias("x"))
    want = {r["ord"]: [x["image"] for x in r["x"]] for r in want.collect()}
    got = catalog_queries.illustrated(t)
    assert {r["ord"]: r["images"] for r in got.collect()} == {1: want[1], 17: want[17], None: []}
    assert None in want[1] and len(want[1]) == 3
    shown = catalog_queries.illustrated(t)._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange hashpartitioning(l_partkey") == 1 and "Exchange hashpartitioning(ord" not in shown


def test_the_catalog_of_the_export_is_worked_out_once(spark, tmp_path, monkeypatch):
    """Matching reads its products several times: they come from a written table."""
    class Seen(Exception):
        pass

    def seen(products, offers):
        raise Seen(products._jdf.queryExecution().optimizedPlan().toString(), products.collect())

    class Here:
        sql = staticmethod(lambda text: None)
        scratch = staticmethod(lambda name: f"{tmp_path}/{name}")

    Here.spark = spark
    rows = spark.createDataFrame([(1, "s", "b", "t", 2.0), (2, None, "", "u", 3.0)], "ord long, sku string, brand string, title string, price_raw double")
    texts = spark.createDataFrame([(1, "n", "e", "t"), (2, "n", "e", "t")], "ord long, description_nl string, description_en string, title_en string")
    monkeypatch.setattr(export_queries, "validated", lambda t: rows)
    monkeypatch.setattr(export_queries, "converted", lambda t, offers: None)
    monkeypatch.setattr("tarifold.operators.translate.look_up_translations", lambda a, b: texts)
    monkeypatch.setattr("tarifold.operators.match.match_all", seen)
    with pytest.raises(Seen) as found:
        export_queries.products(Here)
    plan, got = found.value.args
    assert "Join" not in plan and sorted(map(tuple, got)) == sorted(map(tuple, rows.collect()))
