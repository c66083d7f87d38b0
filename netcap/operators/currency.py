"""Conversion of original-currency amounts to the reporting currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.schemas import MONEY

# --- Fixed values: the simulator's conversion rates to TZS ---
# (source_type, currency, rate). Shares: TZS 1, USD 2500, EUR 2700,
# GBP 3100. Reserves, dividends, deductions: TZS 1, any other 2500.
DEFAULT_RATES = [
    ("SHARE", "TZS", "1"), ("SHARE", "USD", "2500"), ("SHARE", "EUR", "2700"),
    ("SHARE", "GBP", "3100"),
    ("RESERVE", "TZS", "1"), ("RESERVE", "USD", "2500"), ("RESERVE", "EUR", "2500"),
    ("RESERVE", "GBP", "2500"),
    ("DIVIDEND", "TZS", "1"), ("DIVIDEND", "USD", "2500"), ("DIVIDEND", "EUR", "2500"),
    ("DIVIDEND", "GBP", "2500"),
    ("DEDUCTION", "TZS", "1"), ("DEDUCTION", "USD", "2500"), ("DEDUCTION", "EUR", "2500"),
    ("DEDUCTION", "GBP", "2500"),
]
# --- end of fixed values ---


def rates_frame(spark: SparkSession, rows=None) -> DataFrame:
    """A rates table (source_type, currency, rate DECIMAL(20,6))."""
    df = spark.createDataFrame(rows or DEFAULT_RATES, "source_type string, currency string, rate string")
    return df.select("source_type", "currency", F.col("rate").cast("decimal(20,6)").alias("rate"))


def normalise_currency(events: DataFrame, rates: DataFrame, amount_col: str = "amount") -> DataFrame:
    """amount (original currency) -> ``amount`` in the reporting currency,
    ``round(org * rate, 2)`` exactly; keeps ``org_amount`` and ``rate``.
    An unmatched (source_type, currency) gives a NULL amount; route such
    rows with ``split_unrated``. Decoded feed events keep theirs in ``org_amount``.

    A second rate for the same (source_type, currency) fails the job: it would
    double every event it meets. The optimizer picks the join by size.
    """
    once = rates.groupBy("source_type", "currency").agg(
        F.max("rate").alias("rate"), F.count(F.lit(1)).alias("_rates"))
    once = once.select("source_type", "currency", F.when(F.col("_rates") == 1, F.col("rate")).otherwise(
        F.raise_error(F.concat(F.lit("more than one rate for "), F.col("source_type"), F.lit(" "),
                               F.col("currency"))).cast("decimal(20,6)")).alias("rate"))
    j = events.withColumnRenamed(amount_col, "org_amount").join(
        once, ["source_type", "currency"], "left")
    return j.withColumn("amount", F.round(F.col("org_amount") * F.col("rate"), 2).try_cast(MONEY))


def split_unrated(converted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rated events, dead letter with reason ``unknown_currency`` or
    ``amount_overflow``, if the converted amount is too large)."""
    over = F.col("amount").isNull() & F.col("org_amount").isNotNull()
    bad = converted.filter(F.col("rate").isNull() | over)
    raw = F.col("raw_payload") if "raw_payload" in converted.columns else F.to_json(F.struct("*"))
    topic = F.col("topic") if "topic" in converted.columns else F.lit(None).cast("string")
    reason = F.when(F.col("rate").isNull(), "unknown_currency").otherwise("amount_overflow")
    return (converted.filter(F.col("rate").isNotNull() & ~over),
            bad.select(raw.alias("raw"), topic.alias("topic"), reason.alias("reason")))
