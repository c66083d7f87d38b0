"""Named end-to-end queries over the driver tables.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Money is
folded exactly as DECIMAL(20,4) and presented as DOUBLE at the very end
(``present``), the way the reports serve numbers.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netcap.operators.changelog import position_changelog
from netcap.operators.eventlog import event_log_rows
from netcap.operators.position import capital_position, feed_totals
from netcap.operators.reports import (
    flatten_report, late_arrivals, position, position_report, printed_report,
    printed_rollup, reporting_dates, rollup, sample_key, summary, with_freshness,
)
from netcap.operators.snapshot import end_of_reporting_day, official_position, take_snapshot
from netcap.operators.currency import normalise_currency, rates_frame, split_unrated
from netcap.sources.adapters import events_from_events, events_from_star
from netcap.sources.feeds import decode_feed
from netcap.sources.publish import to_messages

# Parameters of the registered report queries (the reports' own arguments).
LOOKUP_KEY = ("FSP001", "BANKING", "2024-01-15")
SUMMARY_DATE = "2024-01-15"
EMPTY_DATE = "1999-12-31"
# Freshness limits that suit the test data, in minutes (5 h / 15 h).
TEST_LIMITS = {"SHARE": 300, "RESERVE": 900, "DIVIDEND": 300, "DEDUCTION": 900}


def present(df: DataFrame) -> DataFrame:
    """Cast every decimal column to DOUBLE, after the exact fold."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _state(spark, sf_dir, sector_mode="submitted") -> DataFrame:
    return capital_position(events_from_events(spark, sf_dir), sector_mode)


def q_capital_position(spark, sf_dir):
    return present(_state(spark, sf_dir))


def q_capital_position_general(spark, sf_dir):
    return present(_state(spark, sf_dir, "general"))


def q_capital_position_star(spark, sf_dir):
    return present(capital_position(events_from_star(spark, sf_dir)))


def q_feed_totals_share(spark, sf_dir):
    return present(feed_totals(events_from_events(spark, sf_dir), "SHARE"))


def q_freshness(spark, sf_dir):
    return present(with_freshness(_state(spark, sf_dir), end_of_reporting_day(), TEST_LIMITS))


def q_position_report(spark, sf_dir):
    return flatten_report(position_report(_state(spark, sf_dir), end_of_reporting_day(),
                                          TEST_LIMITS))


def q_printed_report(spark, sf_dir):
    return printed_report(_state(spark, sf_dir), unit=10 ** 3)


def q_printed_rollup(spark, sf_dir):
    return printed_rollup(_state(spark, sf_dir), unit=10 ** 3)


def q_capital_position_exact(spark, sf_dir):
    """The totals as exact decimal text."""
    state = _state(spark, sf_dir)
    return state.select(*[F.col(f.name).cast("decimal(38,4)").cast("string").alias(f.name)
                          if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                          for f in state.schema.fields])


def q_position_lookup(spark, sf_dir):
    return present(position(_state(spark, sf_dir), *LOOKUP_KEY))


def q_summary_sector(spark, sf_dir):
    return present(summary(_state(spark, sf_dir), SUMMARY_DATE, "sector"))


def q_summary_fsp(spark, sf_dir):
    return present(summary(_state(spark, sf_dir), SUMMARY_DATE, "fsp"))


def q_summary_system(spark, sf_dir):
    return present(summary(_state(spark, sf_dir), SUMMARY_DATE, None))


def q_summary_system_empty(spark, sf_dir):
    return present(summary(_state(spark, sf_dir), EMPTY_DATE, None))


def q_rollup_all(spark, sf_dir):
    return present(rollup(_state(spark, sf_dir)))


def q_snapshot(spark, sf_dir):
    return present(take_snapshot(_state(spark, sf_dir)))


def q_official_position(spark, sf_dir):
    ev = events_from_events(spark, sf_dir)
    noon = F.col("reporting_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    early = capital_position(ev.filter(F.col("ingestion_time") < noon))
    first = take_snapshot(early, taken_at=noon)
    second = take_snapshot(capital_position(ev))
    return present(official_position(first.unionByName(second)))


def q_reporting_dates(spark, sf_dir):
    return reporting_dates(_state(spark, sf_dir))


def q_sample_key(spark, sf_dir):
    return sample_key(_state(spark, sf_dir))


def q_late_arrivals(spark, sf_dir):
    return late_arrivals(event_log_rows(events_from_star(spark, sf_dir)))


def q_event_log(spark, sf_dir):
    return present(event_log_rows(events_from_events(spark, sf_dir)))


def q_position_changelog(spark, sf_dir):
    return present(position_changelog(events_from_events(spark, sf_dir)))


def _roundtrip_events(spark, sf_dir):
    """Adapter E events -> feed messages (JSON) -> decoded events."""
    events, _dead = decode_feed(to_messages(events_from_events(spark, sf_dir)))
    return events


def q_json_roundtrip_position(spark, sf_dir):
    return present(capital_position(_roundtrip_events(spark, sf_dir)))


def q_json_roundtrip_events(spark, sf_dir):
    return present(_roundtrip_events(spark, sf_dir).select(
        "source_type", "fsp_id", "sector", "reporting_date", "transaction_date", "amount",
        "ingestion_time", "topic"))


def _rated_events(spark, sf_dir):
    conv = normalise_currency(events_from_events(spark, sf_dir, with_currency=True),
                              rates_frame(spark))
    rated, _dead = split_unrated(conv)
    return rated


def q_currency_normalised(spark, sf_dir):
    return present(capital_position(_rated_events(spark, sf_dir)))


def q_json_roundtrip_currency(spark, sf_dir):
    """Converted events sent with both amounts, decoded, and converted again from
    the original amount that came along: the same position."""
    sent = to_messages(_rated_events(spark, sf_dir), with_currency=True)
    events, _dead = decode_feed(sent)
    again, _unrated = split_unrated(normalise_currency(
        events.drop("amount"), rates_frame(spark), amount_col="org_amount"))
    return present(capital_position(again))


def q_feed_event_log(spark, sf_dir):
    """Log rows of decoded messages, with where each came from."""
    return present(event_log_rows(_roundtrip_events(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "capital_position": q_capital_position,
    "capital_position_general": q_capital_position_general,
    "capital_position_star": q_capital_position_star,
    "feed_totals_share": q_feed_totals_share,
    "freshness": q_freshness,
    "position_report": q_position_report,
    "printed_report": q_printed_report,
    "printed_rollup": q_printed_rollup,
    "capital_position_exact": q_capital_position_exact,
    "position_lookup": q_position_lookup,
    "summary_sector": q_summary_sector,
    "summary_fsp": q_summary_fsp,
    "summary_system": q_summary_system,
    "summary_system_empty": q_summary_system_empty,
    "rollup_all": q_rollup_all,
    "snapshot": q_snapshot,
    "official_position": q_official_position,
    "reporting_dates": q_reporting_dates,
    "sample_key": q_sample_key,
    "late_arrivals": q_late_arrivals,
    "event_log": q_event_log,
    "position_changelog": q_position_changelog,
    "json_roundtrip_position": q_json_roundtrip_position,
    "json_roundtrip_events": q_json_roundtrip_events,
    "currency_normalised": q_currency_normalised,
    "json_roundtrip_currency": q_json_roundtrip_currency,
    "feed_event_log": q_feed_event_log,
}
