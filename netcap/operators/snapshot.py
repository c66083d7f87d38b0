"""Regulatory snapshots and the official (end-of-day) position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netcap.operators.reports import _date, _ts
from netcap.schemas import KEY, STATE_COLUMNS

SNAPSHOT_COLUMNS = ["snapshot_taken_at", "snapshot_reporting_date"] + STATE_COLUMNS


def end_of_reporting_day(date_col: str = "reporting_date"):
    """Midnight after the reporting date, as TIMESTAMP_NTZ: the cut-off of
    an end-of-day snapshot."""
    return F.date_add(F.col(date_col), 1).cast("timestamp_ntz")


def take_snapshot(state: DataFrame, reporting_date=None, taken_at=None) -> DataFrame:
    """Copy the state rows of one reporting date, stamped with the cut-off.

    ``reporting_date=None`` snapshots every date (an end-of-day run over
    all open dates). ``taken_at`` is a timestamp or a Column; by default the
    end of each row's reporting date. Appending the same snapshot twice
    doubles the rows, as in the reference; the official position reads the
    newest one.
    """
    rows = state if reporting_date is None else state.filter(
        F.col("reporting_date") == _date(reporting_date))
    stamp = end_of_reporting_day() if taken_at is None else _ts(taken_at)
    return rows.select(stamp.alias("snapshot_taken_at"),
                       F.col("reporting_date").alias("snapshot_reporting_date"),
                       *STATE_COLUMNS)


def official_position(snapshots: DataFrame, reporting_date=None) -> DataFrame:
    """Newest snapshot row per key: the source of truth for a date.

    A ``max`` over a struct led by ``snapshot_taken_at`` is a partial
    aggregate (map-side combine), so a key with many snapshots never sits
    in one task as a whole; ties on the stamp break on the remaining
    fields, deterministically.
    """
    s = snapshots if reporting_date is None else snapshots.filter(
        F.col("snapshot_reporting_date") == _date(reporting_date))
    rest = [c for c in SNAPSHOT_COLUMNS if c not in KEY]
    newest = s.groupBy(*KEY).agg(F.max(F.struct(*rest)).alias("_n"))
    return newest.select(*[F.col(f"_n.{c}").alias(c) if c not in KEY else F.col(c)
                           for c in SNAPSHOT_COLUMNS])
