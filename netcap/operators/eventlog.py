"""Rows of the append-only event log (the audit trail of every event)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netcap.functions.columns import composite_key
from netcap.operators.position import prepare_events

# Where the event came from (NULL for events that never were messages). Together they
# identify it: a replay repeats them, a resend doesn't.
PROVENANCE = {"topic": "string", "partition": "int", "offset": "long", "item_index": "int",
              "raw_payload": "string"}
LOG_COLUMNS = ["received_at", "source_type", "fsp_id", "sector", "reporting_date",
               "transaction_date", "amount", "message_key", *PROVENANCE]


def event_log_rows(events: DataFrame, sector_mode: str = "submitted") -> DataFrame:
    """One log row per event that enters the position fold.

    ``received_at`` is the ingestion time; a missing transaction date falls
    back to the reporting date; ``raw_payload`` is the item's JSON text when the
    events came from a feed.
    """
    ev = prepare_events(events, sector_mode)
    origin = [(F.col(c) if c in events.columns else F.lit(None)).cast(t).alias(c)
              for c, t in PROVENANCE.items()]
    return ev.select(
        F.col("ingestion_time").alias("received_at"), "source_type", "fsp_id", "sector",
        "reporting_date",
        F.coalesce("transaction_date", "reporting_date").alias("transaction_date"),
        "amount", composite_key().alias("message_key"), *origin)
