"""Schemas, names and fixed values shared by the whole library."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the reference's for right results ---
# Source types, in feed order: share capital, reserves, dividends payable,
# deductions.
SHARE, RESERVE, DIVIDEND, DEDUCTION = "SHARE", "RESERVE", "DIVIDEND", "DEDUCTION"
SOURCE_TYPES = (SHARE, RESERVE, DIVIDEND, DEDUCTION)
# Topic of each feed.
TOPICS = {
    SHARE: "share-capital",
    RESERVE: "other-capital",
    DIVIDEND: "dividends-payable",
    DEDUCTION: "core-capital-deductions",
}
# Name of the item array in each feed's payload; a decoder takes the first
# of these names that holds an array, whatever the topic.
ARRAY_FIELDS = {
    SHARE: "shareCapitalData",
    RESERVE: "otherCapitalAccountData",
    DIVIDEND: "dividendsPayableData",
    DEDUCTION: "coreCapitalDeductionsData",
}
ARRAY_FIELD_ORDER = tuple(ARRAY_FIELDS[s] for s in SOURCE_TYPES)
# Sector used by the "general" rule for every non-share item.
GENERAL_SECTOR = "GENERAL"
# FSP used when the envelope has none.
UNKNOWN_FSP = "UNKNOWN"
# Freshness limits in minutes: share 5, reserves 15, dividends 5,
# deductions 15. Age strictly below the limit is fresh.
DEFAULT_FRESHNESS_MINUTES = {SHARE: 5, RESERVE: 15, DIVIDEND: 5, DEDUCTION: 15}
# --- end of fixed values ---

# Measure column, last-update column and report label per source type.
TOTAL_COLUMNS = {
    SHARE: "share_capital_total",
    RESERVE: "reserves_total",
    DIVIDEND: "dividends_payable_total",
    DEDUCTION: "deductions_total",
}
UPDATE_COLUMNS = {
    SHARE: "last_share_update",
    RESERVE: "last_reserves_update",
    DIVIDEND: "last_dividends_update",
    DEDUCTION: "last_deductions_update",
}
# Short component names used in freshness columns and report documents.
COMPONENTS = {SHARE: "share", RESERVE: "reserves", DIVIDEND: "dividend", DEDUCTION: "deduct"}

KEY = ["fsp_id", "sector", "reporting_date"]

# Money: one event's amount is NUMERIC(20,4) like the relational schema. Totals
# have 34 digits before the point, so no sum of fed amounts can overflow (10^18
# of the largest ones would have to meet in one key).
MONEY = T.DecimalType(20, 4)
ADDEND = T.DecimalType(28, 4)
TOTAL = T.DecimalType(38, 4)

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("fsp_id", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("reporting_date", T.DateType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("amount", MONEY),
    T.StructField("ingestion_time", T.TimestampNTZType()),
])

STATE_COLUMNS = [
    "fsp_id", "sector", "reporting_date",
    "share_capital_total", "reserves_total", "dividends_payable_total", "deductions_total",
    "net_core_capital",
    "last_share_update", "last_reserves_update", "last_dividends_update", "last_deductions_update",
    "last_computed_at", "event_count",
]

# Shape of a Kafka record as the Kafka source exposes it; the file twin
# used without a broker stores the same columns with ``value`` as text.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])
