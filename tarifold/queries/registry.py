"""Registration of queries and access to the tables of one data folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
#: Rows of a spread table that one task gets.
ROWS_PER_TASK = 4_000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, and SQL over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.parquet(path)

    def sql(self, text: str, spread: str | None = None) -> DataFrame:
        """SQL over the tables; the rows of the one named ``spread`` are dealt to as many tasks as they ask for."""
        for name in TABLES:
            if re.search(rf"\b{name}\b", text):
                (self.spread(name) if name == spread else self(name)).createOrReplaceTempView(name)
        return self.spark.sql(text)

    def spread(self, name: str) -> DataFrame:
        """A table whose narrow rows each ask for much work: files are cut by bytes, so one task may read all of them."""
        rows = self(name)
        return rows.repartition(max(1, -(-rows.count() // ROWS_PER_TASK)))

    def scratch(self, name: str) -> str:
        """A new path in the shared checkpoint folder."""
        return f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"


def query(name: str, oracle: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with its equivalent SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
