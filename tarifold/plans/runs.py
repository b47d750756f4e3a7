"""The three complete runs, as compositions of operators.

Tables that several outputs read are written once and read back, so that neither an output nor
a lost executor makes the whole chain run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedupe import keep_first_by_two_keys, unique_rows
from ..operators.export import export_rows
from ..operators.extract import extract_products
from ..operators.fx import rates_as_of
from ..operators.images import importable, validate_images
from ..operators.pricing import apply_pricing
from ..operators.translate import clean_all, look_up_translations
from ..rules.settings import Store
from ..sources import writers as W


@dataclass
class Inputs:
    """Landed tables of a run. Leaving one out skips the step that needs it."""

    offers: DataFrame | None = None
    fx: DataFrame | None = None
    translations: DataFrame | None = None
    image_meta: DataFrame | None = None


@dataclass
class Settings:
    out: str
    run_date: str
    as_of_year: int
    store: Store = Store()


def _stored(df: DataFrame, settings: Settings, name: str) -> DataFrame:
    path = f"{settings.out}/tables/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def full_run(pages: DataFrame, inputs: Inputs, settings: Settings) -> DataFrame:
    """Pages to import table. ``pages`` has ``ord, url, html`` and, if known, ``status``."""
    if "status" in pages.columns:
        W.write_failed_pages(pages, f"{settings.out}/failed_pages")
        pages = pages.filter("status = 200")
    return replay(extract_products(pages), inputs, settings)


def replay(raw: DataFrame, inputs: Inputs, settings: Settings) -> DataFrame:
    """Raw products to import table; the raw cache is written first."""
    raw = _stored(raw, settings, "raw_products")
    flagged = _stored(keep_first_by_two_keys(raw), settings, "deduplicated")
    W.write_duplicates_log(flagged, f"{settings.out}/duplicates")
    products = clean_all(unique_rows(flagged), settings.store.source_keyword).drop("cleaned")
    if inputs.translations is not None:
        products = look_up_translations(products, inputs.translations)
    if inputs.image_meta is not None:
        validated = _stored(validate_images(products, inputs.image_meta), settings, "validated")
        W.write_missing_images_log(validated, f"{settings.out}/missing_images")
        products = importable(validated)
    products = _priced(products, inputs, settings)
    W.write_quality_report(products, f"{settings.out}/quality_report")
    return _exported(products, settings)


def reprice(raw: DataFrame, inputs: Inputs, settings: Settings) -> DataFrame:
    """Price and export a raw cache as it is: no removal of duplicates, cleaning, translation,
    image or quality checks."""
    return _exported(_priced(raw, inputs, settings), settings)


def _priced(products: DataFrame, inputs: Inputs, settings: Settings) -> DataFrame:
    if inputs.offers is None or inputs.fx is None:
        return _stored(products, settings, "products")
    rates = rates_as_of(inputs.fx, settings.run_date)
    priced = _stored(apply_pricing(products, inputs.offers, rates), settings, "products")
    W.write_pricing_report(priced, f"{settings.out}/pricing_report")
    W.write_audit_csv(priced, f"{settings.out}/competitor_audit")
    return priced


def _exported(products: DataFrame, settings: Settings) -> DataFrame:
    rows = _stored(export_rows(products, settings.as_of_year, settings.store), settings, "export")
    W.write_import_csv(rows, f"{settings.out}/import_csv")
    W.write_manifest(products, f"{settings.out}/image_manifest")
    return rows


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages with ``page_id`` as row order."""
    return spark.read.parquet(path).withColumnRenamed("page_id", "ord")
