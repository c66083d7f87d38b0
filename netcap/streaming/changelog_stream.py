"""Per-event changelog on a stream: one output row per event (the reference's
process function: load or initialise, apply, store, emit).

A micro-batch collapses several updates of one key into one row in the streaming
aggregation; this job keeps each step. A stateful processor holds each key's totals,
last times and count in the state store (RocksDB); a micro-batch reads the state of the keys
that it has events of, and nothing of earlier batches' output. A key's events of one
micro-batch are put in (ingestion_time, event_id) order and prefix sums over whole
columns give the rows, which leave in pieces. Rows continue in order of arrival: they
equal the batch changelog of all events where a key's events arrive in time order.

All events of a key meet in one task, some 100 bytes each while their micro-batch is
worked on, so bound the micro-batches of a backlog (``maxOffsetsPerTrigger``,
``maxFilesPerTrigger``); the batch changelog splits such a key. Sums are whole numbers
of a ten-thousandth, in two 64-bit parts: exact, and a sum that no state could hold fails the
query. The rows are folders by batch id, overwritten on a retry: exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from netcap.operators.changelog import CHANGELOG_COLUMNS
from netcap.operators.position import net_core_capital, prepare_events
from netcap.schemas import (
    KEY, SOURCE_TYPES, STATE_COLUMNS, TOTAL, TOTAL_COLUMNS, UPDATE_COLUMNS,
)
from netcap.sources import tables
from netcap.streaming.position_stream import start_batches, use_rocksdb

PIECE = 50_000           # output rows at once
PART = 10 ** 9           # a total is high * PART + low ten-thousandths
NONE = -(1 << 62)        # no time yet; an event without a time comes before all others
MOST = 1 << 62

_N = range(len(SOURCE_TYPES))
_STATE = [f"{c}{k}" for c in ("hi", "lo", "t") for k in _N] + ["last", "n"]
STATE = ", ".join(f"{c} long" for c in _STATE)
ROWS = ("event_id long, source int, at long, fsp_id string, sector string, reporting_date date, "
        + STATE)
STATE_NAME = "totals"


class Changelog(StatefulProcessor):
    """Of a key: its state before, its events in order, the state after each."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState(STATE_NAME, STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.totals.get() if self.totals.exists() else None
        columns = ["event_id", "source", "at", "hi", "lo"]
        parts = [[x[c].to_numpy(np.int64) for c in columns] for x in rows]
        events = {c: np.concatenate([p[i] for p in parts]) for i, c in enumerate(columns)}
        order = np.lexsort((events["event_id"], events["at"]))
        steps = running({c: v[order] for c, v in events.items()}, before)
        self.totals.update(tuple(int(steps[c][-1]) for c in _STATE))
        for lo in range(0, len(order), PIECE):
            of = slice(lo, lo + PIECE)
            out = {c: v[of] for c, v in steps.items()}
            out |= dict(zip(KEY, ([k] * len(out["n"]) for k in key), strict=True))
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def running(events: dict[str, np.ndarray], before: tuple | None) -> dict[str, np.ndarray]:
    """The state after each of a key's events, which are in order."""
    was = dict(zip(_STATE, before or [0] * 8 + [NONE] * 5 + [0], strict=True))
    source, at = events["source"], events["at"]
    out = {"event_id": events["event_id"], "source": source.astype(np.int32), "at": at}
    for k in _N:
        own = source == k
        hi, lo = (np.where(own, events[c], 0) for c in ("hi", "lo"))
        if float(np.abs(hi).sum(dtype=float)) + abs(was[f"hi{k}"]) >= MOST or len(own) * PART >= MOST:
            raise OverflowError("a total exceeds what the changelog's state holds")
        low = lo.cumsum() + was[f"lo{k}"]
        out[f"hi{k}"], out[f"lo{k}"] = hi.cumsum() + was[f"hi{k}"] + low // PART, low % PART
        out[f"t{k}"] = np.maximum(np.maximum.accumulate(np.where(own, at, NONE)), was[f"t{k}"])
    out["last"] = np.maximum(np.maximum.accumulate(at), was["last"])
    out["n"] = np.arange(1, len(at) + 1) + was["n"]
    return out


def _coded(events: DataFrame, sector_mode: str) -> DataFrame:
    """Key, event_id and the event in whole numbers."""
    units = (F.coalesce("amount", F.lit(0)) * 10_000).cast("decimal(28,0)")
    source = F.array_position(F.array(*map(F.lit, SOURCE_TYPES)), F.col("source_type")) - 1
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), "ingestion_time")
    ev = prepare_events(events, sector_mode).withColumn("_units", units)
    return ev.select(*KEY, "event_id", source.cast("int").alias("source"),
                     F.coalesce(micros, F.lit(NONE)).alias("at"),
                     F.expr(f"_units div {PART}").alias("hi"),
                     F.expr(f"_units % {PART}").cast("long").alias("lo"))


def _time(micros: str) -> Column:
    at = F.timestamp_add("MICROSECOND", F.col(micros), F.expr("TIMESTAMP_NTZ'1970-01-01'"))
    return F.when(F.col(micros) > NONE, at)


def _total(k: int) -> Column:
    whole = F.col(f"hi{k}").cast("decimal(20,0)") * F.lit(PART) + F.col(f"lo{k}")
    return (whole * F.lit("0.0001").cast("decimal(4,4)")).cast(TOTAL)


def _state_columns() -> list[Column]:
    return [*[_total(k).alias(TOTAL_COLUMNS[s]) for k, s in enumerate(SOURCE_TYPES)],
            *[_time(f"t{k}").alias(UPDATE_COLUMNS[s]) for k, s in enumerate(SOURCE_TYPES)],
            _time("last").alias("last_computed_at"), F.col("n").alias("event_count")]


def changelog_rows(events: DataFrame, sector_mode: str = "submitted") -> DataFrame:
    """The changelog of a streaming frame of events, as a stream."""
    steps = _coded(events, sector_mode).groupBy(*KEY).transformWithStateInPandas(
        Changelog(), outputStructType=ROWS, outputMode="Append", timeMode="None")
    kind = F.element_at(F.array(*map(F.lit, SOURCE_TYPES)), F.col("source") + 1)
    return (steps.select("event_id", kind.alias("source_type"), _time("at").alias("ingestion_time"),
                         *KEY, *_state_columns())
            .withColumn("net_core_capital", net_core_capital()).select(*CHANGELOG_COLUMNS))


def start_changelog_stream(events: DataFrame, root: str, checkpoint: str,
                           sector_mode: str = "submitted",
                           trigger: dict | None = None) -> StreamingQuery:
    """Write ``root``/changelog, a folder per micro-batch."""
    use_rocksdb(events.sparkSession)
    return start_batches(
        changelog_rows(events, sector_mode),
        lambda df, bid: tables.write_delta(df, bid, f"{root}/changelog"), checkpoint, trigger)


def read_changelog(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/changelog").select(*CHANGELOG_COLUMNS)


def changelog_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The position of every key out of the changelog's state store."""
    held = tables.state_store(spark, checkpoint, batch_id, stateVarName=STATE_NAME)
    return (held.select("key.*", "value.*").select(*KEY, *_state_columns())
            .withColumn("net_core_capital", net_core_capital()).select(*STATE_COLUMNS))
