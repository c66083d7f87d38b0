"""Adapters from the driver's test tables to capital events.

The reference's inputs are live feeds; the test tables are generic. These
adapters map them onto the capital event schema by fixed rules so that
every query reads the given tables and its work grows with them.
Adapter E maps ``events``; adapter S maps the star schema
``lineitem x orders x customer``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.schemas import DEDUCTION, DIVIDEND, RESERVE, SHARE

# --- Fixed mapping values of the adapters ---
# events.event_type -> source type; anything else is UNKNOWN (dropped by the
# position fold, which exercises the unknown-type rule).
EVENT_TYPE_TO_SOURCE = {"signup": SHARE, "purchase": RESERVE, "view": DIVIDEND, "click": DEDUCTION}
UNKNOWN_SOURCE = "UNKNOWN"
# props.k % 5 -> sector; 4 gives no sector.
SECTOR_BY_K_MOD_5 = ["BANKING", "INSURANCE", "MICROFINANCE", "PENSION"]
# event_id % 4 -> currency of the original amount.
CURRENCY_BY_ID_MOD_4 = ["TZS", "USD", "EUR", "GBP"]
# event_id % 7 == 0 -> no transaction date in the submission.
NO_TRANSACTION_DATE_MOD = 7
# --- end of fixed values ---


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fsp_from_number(n: Column) -> Column:
    """``FSP`` + (n % 4 + 1) as three digits: FSP001..FSP004."""
    return F.concat(F.lit("FSP"), F.lpad((n % 4 + 1).cast("string"), 3, "0"))


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if default is not None else out


def _lookup_mod(values: list, n: Column, m: int) -> Column:
    """values[n % m] (SQL remainder, sign of n), NULL where the remainder
    has no value, negative ones included. One array lookup evaluates ``n``
    once (a CASE chain evaluates it once per branch). The array is padded so
    that ``n % m + m`` always falls inside it."""
    padded = [None] * (m - 1) + list(values) + [None] * (m - len(values))
    arr = F.array(*[F.lit(v).cast("string") for v in padded])
    return F.element_at(arr, (n % m + m).cast("int"))


def events_frame_to_capital(df: DataFrame, with_currency: bool = False) -> DataFrame:
    """Adapter E as a narrow projection; works on batch and streaming frames."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    reporting_date = F.col("ts").cast("date")
    cols = [
        F.col("event_id"),
        _case(F.col("event_type"), EVENT_TYPE_TO_SOURCE, UNKNOWN_SOURCE).alias("source_type"),
        fsp_from_number(F.col("user_id")).alias("fsp_id"),
        _lookup_mod(SECTOR_BY_K_MOD_5, k, 5).alias("sector"),
        reporting_date.alias("reporting_date"),
        F.when(F.col("event_id") % NO_TRANSACTION_DATE_MOD == 0, F.lit(None).cast("date"))
         .otherwise(reporting_date).alias("transaction_date"),
        F.col("value").try_cast("decimal(20,4)").alias("amount"),
        F.col("ts").alias("ingestion_time"),
    ]
    if with_currency:
        cols.append(_lookup_mod(CURRENCY_BY_ID_MOD_4, F.col("event_id"), 4).alias("currency"))
    return df.select(*cols)


def events_from_events(spark: SparkSession, sf_dir: str, with_currency: bool = False) -> DataFrame:
    """Adapter E: the ``events`` table as capital events."""
    src = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    return events_frame_to_capital(src, with_currency)


def events_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter S: one capital event per line item.

    source type from (returnflag, linestatus), FSP from the customer's
    nation, sector = market segment, reporting date = month end of the
    order date, amount = extended price, ingestion time = ship date.

    The small dimension is joined to orders first (the planner broadcasts
    customer only under the size threshold). The fact join lineitem-orders
    is pinned to a sort-merge join on the order key: the fact table grows
    with the data and must never be a broadcast candidate, even when a small
    test size makes its estimate look small; AQE splits skewed partitions of
    this join.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    oc = od.join(cu, od.o_custkey == cu.c_custkey, "inner")
    j = li.join(oc.hint("merge"), li.l_orderkey == oc.o_orderkey, "inner")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    source_type = (F.when((rf == "N") & (ls == "O"), F.lit(SHARE))
                   .when((rf == "N") & (ls == "F"), F.lit(RESERVE))
                   .when(rf == "A", F.lit(DIVIDEND))
                   .when(rf == "R", F.lit(DEDUCTION))
                   .otherwise(F.lit(UNKNOWN_SOURCE)))
    order_date = F.col("o_orderdate").cast("date")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
        source_type.alias("source_type"),
        fsp_from_number(F.col("c_nationkey")).alias("fsp_id"),
        F.col("c_mktsegment").alias("sector"),
        F.last_day(order_date).alias("reporting_date"),
        order_date.alias("transaction_date"),
        F.col("l_extendedprice").try_cast("decimal(20,4)").alias("amount"),
        F.col("l_shipdate").alias("ingestion_time"),
    )
