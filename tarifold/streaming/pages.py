"""Page extraction as a stream: it is a projection of each page, so it needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.extract import extract_products

PAGES = "page_id BIGINT, url STRING, html STRING"


def stream_products(spark: SparkSession, landed: str, files_per_trigger: int = 1000) -> DataFrame:
    pages = (
        spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(landed)
        .withColumnRenamed("page_id", "ord")
    )
    return extract_products(pages)


def write_products(products: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last call and stop."""
    return (
        products.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
