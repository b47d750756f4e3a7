"""Counts that a run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.small import join_small


def scrape_funnel(pages: DataFrame) -> DataFrame:
    """Per brand: addresses, products found, failed fetches. ``pages`` has ``brand, status,
    is_product``."""
    return pages.groupBy("brand").agg(
        F.count(F.lit(1)).alias("urls"),
        F.count_if(F.col("is_product")).alias("products"),
        F.count_if(F.coalesce("status", F.lit(0)) != 200).alias("failures"),
    )


def source_yield(competitors: DataFrame, offers: DataFrame) -> DataFrame:
    """Offers per configured store; 0 for a store without any."""
    counts = offers.groupBy("domain").agg(F.count(F.lit(1)).alias("offers"))
    joined = join_small(competitors.select("comp_ord", "domain"), counts, "domain", F.col("comp_ord"))
    return joined.select("comp_ord", "domain", F.coalesce("offers", F.lit(0).cast("bigint")).alias("offers"))


def sites_with_data(per_store: DataFrame) -> DataFrame:
    return per_store.agg(
        F.count_if(F.col("offers") > 0).alias("with_data"), F.count(F.lit(1)).alias("sites")
    )


def cleaned_count(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(F.count_if(F.col("cleaned")).alias("cleaned"), F.count(F.lit(1)).alias("products"))


def duplicate_count(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if(~F.col("kept")).alias("duplicates"), F.count_if(F.col("kept")).alias("unique_rows"))


def select_brands(pages: DataFrame, wanted: str | None, default: list[str]) -> DataFrame:
    """Rows of the brands in a comma-separated list, or of the default brands."""
    names = [b.strip() for b in wanted.split(",") if b.strip()] if wanted is not None else default
    return pages.filter(F.col("brand").isin(*names))


def not_yet_collected(brands: DataFrame, collected: DataFrame) -> DataFrame:
    """Brands without a stored address list."""
    return brands.join(collected.select("brand").distinct(), "brand", "left_anti")
