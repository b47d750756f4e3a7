"""Readers. All take an explicit schema; a missing table reads as an empty one where the run
can go on without it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import plain_number
from ..operators.offers import competitor_defaults
from ..schemas import COMPETITOR, FX, IMAGE_META, PRODUCT, TRANSLATION


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def raw_products(spark: SparkSession, path: str) -> DataFrame:
    """Raw-product cache: JSON lines, or parquet when the path says so."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(PRODUCT).parquet(path)
    return spark.read.schema(PRODUCT).json(path)


def raw_products_document(spark: SparkSession, path: str) -> DataFrame:
    """A cache that is one JSON array per file, as other tools write it. Rows without an
    ``ord`` are numbered through, files in name order.

    Files are read in an order of the reader's own, each by one task from its start to its end. A row's place is thus the rows
    of the files before (one row a file is summed up) and its distance from the first row of its own file.
    """
    rows = spark.read.schema(PRODUCT).option("multiLine", True).json(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    files = rows.groupBy("_file").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(files, "_file").withColumn("ord", F.coalesce("ord", F.col("_at") + F.col("_shift"))).drop("_file", "_at", "_shift")


def competitors(spark: SparkSession, path: str) -> DataFrame:
    """Store configuration (JSON lines), defaults filled in; no file means no stores."""
    return competitor_defaults(read_or_empty(spark, path, COMPETITOR, "json"))


def fx_feed(spark: SparkSession, path: str) -> DataFrame:
    """Daily rate feed in XML: nested ``Cube`` elements with ``time``, ``currency``, ``rate``.

    Currencies in upper case, unparsable rates dropped, EUR = 1 added. A feed without a single
    rate besides EUR yields nothing.
    """
    schema = (
        "Cube STRUCT<Cube: ARRAY<STRUCT<_time: STRING, "
        "Cube: ARRAY<STRUCT<_currency: STRING, _rate: STRING>>>>>"
    )
    days = (
        spark.read.format("xml").option("rowTag", "gesmes:Envelope").schema(schema).load(path)
        .select(F.explode("Cube.Cube").alias("day"))
        .select(F.col("day._time").cast("date").alias("rate_date"), F.col("day.Cube").alias("cubes"))
    )
    rates = days.select("rate_date", F.explode("cubes").alias("c")).select(
        "rate_date", F.upper("c._currency").alias("currency"), plain_number(F.col("c._rate")).alias("rate")
    ).filter("currency <> '' AND rate IS NOT NULL")
    euro = rates.select("rate_date", F.lit("EUR").alias("currency"), F.lit(1.0).alias("rate")).distinct()
    return rates.filter("currency <> 'EUR'").unionByName(euro)


def fx_table(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, FX)


def translation_cache(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, TRANSLATION)


def url_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Collected addresses, one partition per brand."""
    return read_or_empty(spark, path, "url STRING, page_no INT, brand STRING")


def image_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata table of landed images."""
    return read_or_empty(spark, path, IMAGE_META)


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """The same layout from landed image files: sizes from the file listing, pixels from the
    built-in image reader. Undecodable files keep NULL pixels."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("content_length"))
    pixels = (
        spark.read.format("image").option("dropInvalid", True).load(path)
        .select(F.col("image.origin").alias("origin"), "image.width", "image.height")
    )
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    return files.join(
        pixels.withColumn("file", plain(F.col("origin"))), plain(F.col("path")) == F.col("file"), "left"
    ).select(
        F.col("path").alias("url"), F.lit(200).alias("status"),
        F.concat(F.lit("image/"), F.when(kind == "jpg", "jpeg").otherwise(kind)).alias("content_type"),
        "content_length", "width", "height",
    )
