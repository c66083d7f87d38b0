"""Reports on the position state: lookup, freshness, documents, summaries,
roll-ups, printed text, table counts and late-arrival analysis.

Every report is a lazy DataFrame over the state (or the event log); the
clock is never read, ``as_of`` is an argument.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netcap.functions.columns import (
    age_seconds, as_timestamp_ntz, freshness_status, is_fresh,
)
from netcap.schemas import (
    COMPONENTS, DEFAULT_FRESHNESS_MINUTES, KEY, SOURCE_TYPES, TOTAL_COLUMNS, UPDATE_COLUMNS,
)


def _ts(value) -> Column:
    """A timestamp argument as UTC TIMESTAMP_NTZ: a string or datetime, converted if
    it has a zone, taken as UTC if not; or a Column of UTC wall-clock time."""
    if isinstance(value, Column):
        return as_timestamp_ntz(value)
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime.fromisoformat(str(value))
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


# --- R1: point lookup -------------------------------------------------------

def position(state: DataFrame, fsp_id: str, sector: str, reporting_date) -> DataFrame:
    """Zero or one state row for a full key. All three are required.

    The equalities push down to the scan: on a stored state partitioned by
    ``reporting_date`` only one date folder is listed, and row-group
    statistics skip the rest.
    """
    if not fsp_id or not sector or not reporting_date:
        raise ValueError("fsp_id, sector and reporting_date are required")
    return state.filter((F.col("fsp_id") == fsp_id) & (F.col("sector") == sector)
                        & (F.col("reporting_date") == _date(reporting_date)))


# --- R2 / R3: freshness -----------------------------------------------------

def with_freshness(state: DataFrame, as_of, thresholds_minutes: dict | None = None) -> DataFrame:
    """Add ``<component>_age_sec``, ``<component>_fresh`` per component and
    ``freshness_status``. ``as_of`` is a timestamp or a Column."""
    limits = dict(DEFAULT_FRESHNESS_MINUTES)
    limits.update(thresholds_minutes or {})
    now = _ts(as_of)
    cols, missing, fresh = [], [], []
    for s in SOURCE_TYPES:
        c, upd = COMPONENTS[s], F.col(UPDATE_COLUMNS[s])
        f = is_fresh(now, upd, limits[s])
        cols += [age_seconds(now, upd).alias(f"{c}_age_sec"), f.alias(f"{c}_fresh")]
        missing.append(upd.isNull())
        fresh.append(f)
    return state.select("*", *cols, freshness_status(missing, fresh).alias("freshness_status"))


# --- R4: position document --------------------------------------------------

def position_report(state: DataFrame, as_of, thresholds_minutes: dict | None = None) -> DataFrame:
    """The position document per key as a ``report`` struct (numbers as
    double, like the service) plus ``report_json``: the same with exact numbers in
    shortest form, missing ages as null and the time in ISO form."""
    f = with_freshness(state, as_of, thresholds_minutes)
    metrics = F.struct(*[
        F.struct(F.col(f"{COMPONENTS[s]}_fresh").alias("fresh"),
                 F.col(f"{COMPONENTS[s]}_age_sec").alias("ageSec")).alias(COMPONENTS[s])
        for s in SOURCE_TYPES])

    def document(kind: str) -> Column:
        number = lambda c, name: F.col(c).cast(kind).alias(name)
        return F.struct(
            F.col("fsp_id").alias("fspId"), F.col("sector").alias("sector"),
            F.col("reporting_date").alias("reportingDate"),
            F.col("last_computed_at").alias("asOf"),
            F.struct(number("share_capital_total", "shareCapital"),
                     number("reserves_total", "reserves"),
                     number("dividends_payable_total", "dividendsPayable"),
                     number("deductions_total", "deductions"),
                     number("net_core_capital", "netCoreCapital")).alias("positions"),
            F.col("freshness_status").alias("freshnessStatus"),
            metrics.alias("refreshMetrics"),
            F.col("event_count").alias("eventCount"),
        )

    text = F.to_json(document("decimal(38,4)"), {
        "ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"})
    # Closing zeros of the decimals go; no other value ends with a digit after a point.
    text = F.regexp_replace(F.regexp_replace(text, r"\.0+([,}])", "$1"),
                            r"(\.[0-9]*[1-9])0+([,}])", "$1$2")
    return f.select(*KEY, document("double").alias("report"), text.alias("report_json"))


def flatten_report(report_df: DataFrame) -> DataFrame:
    """The document as flat columns (for comparison and export)."""
    r = "report"
    cols = [F.col(f"{r}.fspId").alias("fspId"), F.col(f"{r}.sector").alias("sector"),
            F.col(f"{r}.reportingDate").alias("reportingDate"), F.col(f"{r}.asOf").alias("asOf")]
    for p in ("shareCapital", "reserves", "dividendsPayable", "deductions", "netCoreCapital"):
        cols.append(F.col(f"{r}.positions.{p}").alias(p))
    cols.append(F.col(f"{r}.freshnessStatus").alias("freshnessStatus"))
    for s in SOURCE_TYPES:
        c = COMPONENTS[s]
        cols += [F.col(f"{r}.refreshMetrics.{c}.fresh").alias(f"{c}Fresh"),
                 F.col(f"{r}.refreshMetrics.{c}.ageSec").alias(f"{c}AgeSec")]
    cols += [F.col(f"{r}.eventCount").alias("eventCount"), F.col("report_json")]
    return report_df.select(*cols)


# --- R5 / R6 / R7: summaries ------------------------------------------------

SUMMARY_MEASURES = [
    ("share_capital_total", "share_total"),
    ("reserves_total", "reserves_total"),
    ("dividends_payable_total", "dividends_total"),
    ("deductions_total", "deductions_total"),
    ("net_core_capital", "net_total"),
]


def _summary_aggs() -> list:
    return ([F.sum(src).alias(dst) for src, dst in SUMMARY_MEASURES]
            + [F.max("last_computed_at").alias("last_update")])


def summary(state: DataFrame, reporting_date, group_by: str | None = None) -> DataFrame:
    """Totals of one reporting date by ``sector``, by ``fsp`` or system-wide.

    Any other ``group_by`` value (None included) gives the system-wide row,
    with ``scope = 'SYSTEM'``; that row exists even when the date has no
    state (NULL sums), as a global aggregate does.
    """
    if not reporting_date:
        raise ValueError("reporting_date is required")
    day = state.filter(F.col("reporting_date") == _date(reporting_date))
    if group_by == "sector":
        return day.groupBy("sector").agg(*_summary_aggs())
    if group_by == "fsp":
        return day.groupBy("fsp_id").agg(*_summary_aggs())
    return day.agg(*_summary_aggs()).select(F.lit("SYSTEM").alias("scope"), "*")


# --- R9: multi-date roll-up -------------------------------------------------

def _level() -> Column:
    return (F.when(F.col("_gs") == 0, F.lit("sector"))
            .when(F.col("_gf") == 0, F.lit("fsp"))
            .otherwise(F.lit("market")))


def rollup(state: DataFrame) -> DataFrame:
    """(sector, date), (fsp, date) and (date) totals in one aggregation
    (GROUPING SETS: one shuffle, partial aggregation before it).
    ``level`` is ``sector``, ``fsp`` or ``market``."""
    g = state.groupingSets(
        [["sector", "reporting_date"], ["fsp_id", "reporting_date"], ["reporting_date"]],
        "sector", "fsp_id", "reporting_date",
    ).agg(*_summary_aggs(), F.grouping("sector").alias("_gs"), F.grouping("fsp_id").alias("_gf"))
    return g.select(_level().alias("level"), "sector", "fsp_id", "reporting_date",
                    *[dst for _, dst in SUMMARY_MEASURES], "last_update")


# --- R11: printed report ----------------------------------------------------

PRINT_LABELS = [
    ("Share Capital:", "share_capital_total", "last_share_update"),
    ("Reserves:", "reserves_total", "last_reserves_update"),
    ("Dividends Payable:", "dividends_payable_total", "last_dividends_update"),
    ("Deductions:", "deductions_total", "last_deductions_update"),
]
_UNIT_SUFFIX = {10 ** 3: "K", 10 ** 6: "M", 10 ** 9: "B", 10 ** 12: "T"}


def format_amount(c, unit: int = 10 ** 9) -> Column:
    """Amount in ``unit`` with one decimal, rounded half up, exact decimal
    arithmetic (multiplication by an exact decimal reciprocal), plus the
    unit's suffix: 8.0B."""
    if unit not in _UNIT_SUFFIX:
        raise ValueError(f"unit must be one of {sorted(_UNIT_SUFFIX)}")
    scaled = F.col(c) * F.lit(Decimal(1).scaleb(-len(str(unit)) + 1))
    text = F.round(scaled, 1).cast("decimal(38,1)").cast("string")
    return F.concat(text, F.lit(_UNIT_SUFFIX[unit]))


def report_text(unit: int = 10 ** 9) -> Column:
    """Title and as-of time, the four components with their last update time, and
    net core capital, the three parts with a blank line between them."""
    def line(label, amount_col, upd_col=None):
        parts = [F.rpad(F.lit(label), 22, " "), format_amount(amount_col, unit)]
        if upd_col:
            parts.append(F.concat(F.lit("  ("),
                                  F.coalesce(F.date_format(upd_col, "HH:mm"), F.lit("--:--")),
                                  F.lit(")")))
        return F.concat(*parts)
    return F.concat_ws(
        "\n",
        F.lit("Realtime Capital Position"),
        F.concat(F.lit("As of: "), F.date_format("last_computed_at", "HH:mm:ss")),
        F.lit(""),
        *[line(lbl, amt, upd) for lbl, amt, upd in PRINT_LABELS],
        F.lit(""),
        line("Net Core Capital:", "net_core_capital"),
    )


def printed_report(state: DataFrame, unit: int = 10 ** 9) -> DataFrame:
    """One text block per key."""
    return state.select(*KEY, report_text(unit).alias("report_text"))


def printed_rollup(state: DataFrame, unit: int = 10 ** 9) -> DataFrame:
    """One text block per date and FSP, per date and sector, and per date for the
    whole market (``level``), from one aggregation."""
    g = state.groupingSets(
        [["sector", "reporting_date"], ["fsp_id", "reporting_date"], ["reporting_date"]],
        "sector", "fsp_id", "reporting_date",
    ).agg(*[F.sum(c).alias(c) for c in [*TOTAL_COLUMNS.values(), "net_core_capital"]],
          *[F.max(c).alias(c) for c in [*UPDATE_COLUMNS.values(), "last_computed_at"]],
          F.grouping("sector").alias("_gs"), F.grouping("fsp_id").alias("_gf"))
    return g.select(_level().alias("level"), "sector", "fsp_id", "reporting_date",
                    report_text(unit).alias("report_text"))


# --- S8: two states by key ----------------------------------------------------

def position_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Net core capital and events of every key of two states, and the change of both; a
    key that one of them lacks counts as zero there. Bucketed copies
    (``tables.write_state_buckets``) are joined without a shuffle."""
    cols = ("net_core_capital", "event_count")
    old = before.select(*KEY, *[F.col(c).alias(f"{c}_before") for c in cols])
    new = after.select(*KEY, *[F.col(c).alias(f"{c}_after") for c in cols])
    both = new.hint("merge").join(old, KEY, "full")  # both are state tables: none is small
    sides = {f"{c}_{s}": F.coalesce(f"{c}_{s}", F.lit(0)) for c in cols for s in ("before", "after")}
    return both.select(
        *KEY, *[x.alias(name) for name, x in sides.items()],
        *[(sides[f"{c}_after"] - sides[f"{c}_before"]).alias(f"{c}_change") for c in cols])


# --- R12 / R13 / R14: table checks ------------------------------------------

def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each named table, one row per table."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def reporting_dates(state: DataFrame) -> DataFrame:
    """Distinct reporting dates, newest first."""
    return state.select("reporting_date").distinct().orderBy(F.col("reporting_date").desc())


def sample_key(state: DataFrame) -> DataFrame:
    """The first key in key order (deterministic sample for smoke checks)."""
    return state.select(*KEY).orderBy(*KEY).limit(1)


# --- R15: late arrivals -----------------------------------------------------

def late_arrivals(log: DataFrame) -> DataFrame:
    """Lag in days between receipt and reporting date, per source type:
    event count, maximum and mean lag."""
    lag = F.datediff(F.col("received_at").cast("date"), F.col("reporting_date"))
    return (log.select("source_type", lag.alias("lag_days"))
            .groupBy("source_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.max("lag_days").alias("max_lag_days"),
                 F.avg("lag_days").alias("mean_lag_days")))
