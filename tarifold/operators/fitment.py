"""Make, model and year of the motorcycle a product fits.

Three layers: a captioned compatibility table, an attribute table, the title.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions.text import lookup, search_any, strip, text_or_blank, title_case
from ..functions.years import clean_year
from ..plans.once import computed_once
from ..rules import dictionaries as D

PARTS = ("make", "model", "year")
LABELS = {"make": D.MAKE_LABELS, "model": D.MODEL_LABELS, "year": D.YEAR_LABELS}


def normalize_brand(c: Column, names: dict[str, str] = D.BRAND_NAMES) -> Column:
    """Display name of a brand; unknown ones in title case; blank stays blank."""
    bare = strip(text_or_blank(c))
    return F.coalesce(lookup(F.lower(bare), names), title_case(bare))


def normalize_make(c: Column, names: dict[str, str] = D.MAKE_NAMES, makes=D.MAKES) -> Column:
    bare = strip(text_or_blank(c))
    known = {m.lower(): m for m in reversed(makes)} | names
    return F.coalesce(lookup(F.lower(bare), known), title_case(bare))


def _first_per_label(rows: Column) -> Column:
    """Of ``array<struct<label, value>>`` the first non-blank value of each label class."""

    def first(labels) -> Column:
        hits = F.filter(rows, lambda r: r["label"].isin(*labels) & (r["value"] != ""))
        return F.coalesce(F.try_element_at(hits, F.lit(1))["value"], F.lit(""))

    return F.struct(*[first(LABELS[p]).alias(p) for p in PARTS])


def _rows(page: Column, table: Column) -> Column:
    return F.filter(M.inside(page, table), M.by_name("tr"))


def from_captioned_tables(page: Column, caption_pattern: str = D.FITMENT_CAPTION) -> Column:
    """Tables whose caption speaks of fitment: first two cells of a row are label and value."""
    caption = lambda t: M.first(F.filter(M.inside(page, t), M.by_name("caption")))
    spoken = lambda t: search_any(F.coalesce(M.text_of(page, caption(t), " "), F.lit("")), caption_pattern)
    wanted = F.filter(M.elements(page, M.by_name("table")), spoken)
    rows = F.flatten(F.transform(wanted, lambda t: _rows(page, t)))
    cells = lambda r: F.filter(M.inside(page, r), M.by_name("th", "td"))
    pairs = F.transform(
        F.filter(F.transform(rows, cells), lambda c: F.size(c) >= 2),
        lambda c: F.struct(F.lower(M.text_of(page, c[0])).alias("label"), M.text_of(page, c[1]).alias("value")),
    )
    return _first_per_label(pairs)


def from_attribute_table(page: Column, class_pattern: str = D.ATTRIBUTE_TABLE_CLASS) -> Column:
    """The first attribute table: header cell and data cell of each row."""
    table = M.first(M.elements(page, lambda n: (n["name"] == "table") & M.class_matches(class_pattern)(n)))
    cell = lambda r, tag: M.first(F.filter(M.inside(page, r), M.by_name(tag)))
    cells = F.transform(_rows(page, table), lambda r: F.struct(cell(r, "th").alias("head"), cell(r, "td").alias("data")))
    pairs = F.transform(
        F.filter(cells, lambda x: x["head"].isNotNull() & x["data"].isNotNull()),
        lambda x: F.struct(F.lower(M.text_of(page, x["head"])).alias("label"), M.text_of(page, x["data"], " ").alias("value")),
    )
    return _first_per_label(F.coalesce(pairs, F.array().cast("array<struct<label:string,value:string>>")))


def title_year(title: Column) -> Column:
    return F.regexp_extract(
        title, r"(?<![0-9])(20[0-9]{2}\+|20[0-9]{2}[–\-/](?:20)?[0-9]{2}|20[0-9]{2})(?![0-9])", 1
    )


def title_make(title: Column, makes=D.MAKES) -> Column:
    """First make of the list, in list order, that stands in the title as a word."""
    hits = [F.when(search_any(title, rf"\b{re.escape(m)}\b"), F.lit(m)) for m in makes]
    return F.coalesce(*hits, F.lit(""))


def title_model(title: Column, make: Column) -> Column:
    """Model code after the make: one or two words, without trailing year."""
    at = F.instr(F.lower(title), F.lower(make))
    after = F.substring(title, at + F.length(make), F.length(title))
    after = F.regexp_replace(after, r"(?U)^\s*[-–—/]\s*", "")
    after = F.regexp_replace(after, r"(?iU)\b(?:abs|se|sp|rs|euro\s*\d|e5|e4)\b", "")
    words = F.regexp_extract(after, r"(?U)^\s*([A-Z0-9]{1,4}[\w\-.]{0,25}(?:\s+[A-Z0-9][\w\-.]{0,20})?)", 1)
    bare = F.regexp_replace(F.regexp_replace(strip(words), r"(?Ud)\s*20[0-9]{2}.*$", ""), r"[-–—/., ]+$", "")
    return F.when((make != "") & (F.length(bare) >= 2), bare).otherwise(F.lit(""))


def first_layer(part: str, table: Column, attributes: Column, title: Column) -> Column:
    """Attributes count only where the table lacks make or model, the title where anything is
    still missing."""
    need_attributes = (table["make"] == "") | (table["model"] == "")
    blank = F.lit("")
    second = F.when(need_attributes, F.nullif(attributes[part], blank))
    return F.coalesce(F.nullif(table[part], blank), second, F.nullif(title[part], blank), blank)


def normalised(fit: Column) -> Column:
    return F.struct(
        F.when(fit["make"] != "", normalize_make(fit["make"])).otherwise(F.lit("")).alias("make"),
        strip(fit["model"]).alias("model"),
        clean_year(fit["year"]).alias("year"),
    )


def with_fitment(pages: DataFrame, table: Column | None = None, attributes: Column | None = None, title: str = "title") -> DataFrame:
    """Add ``fitment`` out of the two tables' layers (by default those of ``_page``) and the title. The make found in the
    title is a column of its own on the way, as the model search starts from it."""
    name, page = F.col(title), F.col("_page")
    layers = computed_once(
        pages, _make=title_make(name), _table_fit=from_captioned_tables(page) if table is None else table,
        _attr_fit=from_attribute_table(page) if attributes is None else attributes,
    )
    layers = computed_once(layers, _title_fit=F.struct(
        F.col("_make").alias("make"), title_model(name, F.col("_make")).alias("model"),
        title_year(name).alias("year")))
    merged = computed_once(layers, _fit=F.struct(*[
        first_layer(p, F.col("_table_fit"), F.col("_attr_fit"), F.col("_title_fit")).alias(p) for p in PARTS]))
    return merged.withColumn("fitment", normalised(F.col("_fit"))).drop(
        "_make", "_title_fit", "_table_fit", "_attr_fit", "_fit"
    )
