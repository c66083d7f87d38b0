"""The capital position fold (flagship) and the single-feed aggregate.

One ``groupBy`` on (fsp_id, sector, reporting_date) with conditional sums,
maxima and a count. Spark plans it as a partial hash aggregate before the
shuffle and a final one after, so a key holding a third of all events
ships one partial row per map task, not its events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netcap.functions.columns import component_amount, sector_for_rule
from netcap.schemas import (
    KEY, SHARE, SOURCE_TYPES, STATE_COLUMNS, TOTAL, TOTAL_COLUMNS, UPDATE_COLUMNS,
)


def prepare_events(events: DataFrame, sector_mode: str = "submitted") -> DataFrame:
    """Unknown source types dropped, sector rule applied, rows with a NULL
    key column dropped (the sink's not-null enforcement)."""
    out = (events
           .filter(F.col("source_type").isin(*SOURCE_TYPES))
           .withColumn("sector", sector_for_rule("source_type", "sector", sector_mode)))
    return out.filter(F.col("fsp_id").isNotNull() & F.col("sector").isNotNull()
                      & F.col("reporting_date").isNotNull())


def position_aggregates() -> list:
    """The fold's aggregate expressions, shared by batch, stream and partials."""
    aggs = [F.sum(component_amount("source_type", s, "amount")).alias(TOTAL_COLUMNS[s])
            for s in SOURCE_TYPES]
    aggs += [F.max(F.when(F.col("source_type") == s, F.col("ingestion_time"))).alias(UPDATE_COLUMNS[s])
             for s in SOURCE_TYPES]
    aggs += [F.max("ingestion_time").alias("last_computed_at"),
             F.count(F.lit(1)).alias("event_count")]
    return aggs


def net_core_capital() -> F.Column:
    """share + reserves - dividends - deductions, exact."""
    return (F.col("share_capital_total") + F.col("reserves_total")
            - F.col("dividends_payable_total") - F.col("deductions_total")).cast(TOTAL)


def capital_position(events: DataFrame, sector_mode: str = "submitted") -> DataFrame:
    """Position state: one row per key with the four totals, net core
    capital, last update per component, last computed at and event count.

    Works on batch and streaming frames (``outputMode("update")``).
    """
    agg = prepare_events(events, sector_mode).groupBy(*KEY).agg(*position_aggregates())
    return agg.withColumn("net_core_capital", net_core_capital()).select(*STATE_COLUMNS)


def feed_totals(events: DataFrame, source_type: str = SHARE) -> DataFrame:
    """Single-feed aggregate (the print job): SUM, MAX(time), COUNT(*) per
    (fsp, sector, date) of one feed. No sector rule: a NULL sector is a
    group of its own."""
    total = TOTAL_COLUMNS[source_type]
    return (events.filter(F.col("source_type") == source_type)
            .groupBy(*KEY)
            .agg(F.sum(component_amount("source_type", source_type, "amount")).alias(total),
                 F.max("ingestion_time").alias("last_computed_at"),
                 F.count(F.lit(1)).alias("event_count")))
