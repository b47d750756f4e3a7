"""Data-quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_or_blank


def quality_flags() -> Column:
    """Flags of a product row, in report order."""

    def blank(name: str) -> Column:
        return text_or_blank(F.col(name)) == ""

    rules = [
        (blank("sku"), "missing_sku"),
        (blank("brand"), "missing_brand"),
        (blank("fitment.make"), "missing_make"),
        (blank("fitment.model"), "missing_model"),
        (blank("fitment.year"), "missing_year"),
        (F.coalesce("translation_failed", F.lit(False)), "translation_failed"),
        (F.coalesce(F.size("validated_images"), F.lit(0)) <= 0, "no_valid_images"),
        (F.coalesce("price_raw", F.lit(0.0)) == 0, "zero_price"),
    ]
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for condition, name in rules]))


# Columns that earlier, skippable steps add, and what stands in for them.
OPTIONAL = {"translation_failed": "boolean", "validated_images": "array<string>"}


def quality_report(products: DataFrame) -> DataFrame:
    """``title, url, flags`` of the products with at least one flag."""
    for name, kind in OPTIONAL.items():
        if name not in products.columns:
            products = products.withColumn(name, F.lit(None).cast(kind))
    return products.select("title", "url", quality_flags().alias("flags")).filter(F.size("flags") > 0)


def issue_counts(report: DataFrame) -> DataFrame:
    """Products per flag."""
    return report.select(F.explode("flags").alias("flag")).groupBy("flag").agg(
        F.count(F.lit(1)).alias("products")
    )
