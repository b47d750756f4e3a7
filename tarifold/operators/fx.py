"""Currency rates: 1 EUR = ``rate`` units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.small import join_small


def rates_as_of(fx: DataFrame, run_date: str) -> DataFrame:
    """The newest snapshot on or before ``run_date``; no row where there is none.

    ``fx`` has ``rate_date, currency, rate``. One row per currency, so a few hundred at most.
    """
    known = fx.filter(F.col("rate_date") <= F.lit(run_date).cast("date"))
    newest = known.agg(F.max("rate_date").alias("d")).scalar()
    return (
        known.filter(F.col("rate_date") == newest)
        .groupBy(F.upper("currency").alias("currency"))
        .agg(F.max("rate").alias("rate"), F.max("rate_date").alias("rate_date"))
    )


def to_eur(price: Column, currency: Column, rate: Column) -> Column:
    """EUR stays; a missing or zero rate counts as EUR."""
    known = (F.upper(currency) != "EUR") & (rate != 0)
    return F.when(known, price / rate).otherwise(price)


def convert_offers(offers: DataFrame, rates: DataFrame, spread: str = "offer_ord") -> DataFrame:
    """``price_eur`` of every offer converted with its currency's rate."""
    table = rates.select(F.upper("currency").alias("_cur"), "rate")
    keyed = offers.withColumn("_cur", F.upper("currency"))
    joined = join_small(keyed, table, "_cur", F.col(spread))
    return joined.withColumn("price_eur", to_eur(F.col("price_eur"), F.col("currency"), F.col("rate"))).drop("_cur", "rate")
