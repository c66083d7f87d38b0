"""Registered queries that run jobs with sinks: streaming folds, stored
state, snapshots and the event log. Each writes below a fresh folder of
the shared checkpoint folder, then returns a lazy read of what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.operators.eventlog import event_log_rows
from netcap.operators.position import capital_position
from netcap.operators.reports import late_arrivals, position, position_change
from netcap.operators.snapshot import official_position, take_snapshot
from netcap.plans.queries import LOOKUP_KEY, present
from netcap.session import work_dir
from netcap.sources import tables
from netcap.sources.adapters import (
    events_frame_to_capital, events_from_events, events_from_star, read_table,
)
from netcap.sources.feeds import admission, read_feed
from netcap.sources.publish import to_messages
from netcap.streaming.changelog_stream import read_changelog, start_changelog_stream
from netcap.streaming import rebuild
from netcap.streaming.position_stream import (
    file_event_stream, run_to_completion, start_feed_job, start_position_stream,
)

WAVES = 5
BUCKETS = 8
LOGGED_DATES = ("1996-01-31", "1996-02-29", "1996-03-31")


def _event_stream(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """``events.parquet`` (one file or a folder of part files), or ``path``, as a stream."""
    schema = read_table(spark, sf_dir, "events").schema
    # A pattern that matches this name only: a plain path would have to be a folder.
    path = path or f"{sf_dir.rstrip('/')}/events.parque[t]"
    return events_frame_to_capital(file_event_stream(spark, path, schema))


def _run_stream(spark, events, name, mode, with_log=False):
    root = work_dir(spark, name)
    log = f"{root}/event_log" if with_log else None
    run_to_completion(start_position_stream(events, root, f"{root}/_checkpoint", mode=mode,
                                            log_path=log))
    return root


def q_position_stream(spark, sf_dir):
    root = _run_stream(spark, _event_stream(spark, sf_dir), "position_stream", "stateful")
    return present(tables.read_state(spark, tables.state_path(root, "stateful"), "stateful"))


def q_position_stream_partials(spark, sf_dir):
    root = _run_stream(spark, _event_stream(spark, sf_dir), "position_partials", "partials",
                       with_log=True)
    return present(tables.read_state(spark, tables.state_path(root, "partials"), "partials"))


def q_stream_event_log(spark, sf_dir):
    root = _run_stream(spark, _event_stream(spark, sf_dir), "stream_log", "partials",
                       with_log=True)
    log = tables.read_event_log(spark, f"{root}/event_log").drop("batch_id")
    return present(log)


def q_state_from_store(spark, sf_dir):
    """The stream's position out of its state store: nothing else is written or folded."""
    root = work_dir(spark, "state_from_store")
    run_to_completion(start_position_stream(
        _event_stream(spark, sf_dir), root, f"{root}/_checkpoint", sink=tables.keep_in_store))
    return present(tables.read_state_store(spark, f"{root}/_checkpoint"))


def q_late_replay(spark, sf_dir):
    """The events cut into waves by user (each spans the whole month). Each wave's
    files arrive, then the job resumes from its checkpoint: every run brings
    events for dates already in the state."""
    root = work_dir(spark, "late_replay")
    src, events = f"{root}/input", read_table(spark, sf_dir, "events")
    for wave in range(WAVES):
        events.filter(F.pmod("user_id", F.lit(WAVES)) == wave).write.mode("append").parquet(src)
        run_to_completion(start_position_stream(_event_stream(spark, sf_dir, path=src), root,
                                                f"{root}/_checkpoint", mode="stateful"))
    return present(tables.read_state(spark, tables.state_path(root, "stateful"), "stateful"))


def damaged(messages: DataFrame) -> DataFrame:
    """The messages as a bad line would deliver some, by their event's id (the
    twin's offset): cut short, of a strange topic, without value, with an amount beyond
    any decimal, with an item before the good one that is no object, with a name that
    comes twice in the item, or with a transaction date that is none."""
    k = F.pmod("offset", F.lit(50))
    value = F.col("value")
    return messages.withColumns({
        "value": F.when(k == 0, F.substring(value, F.lit(1), F.length(value) - 5))
        .when(k == 2, F.lit(None))
        .when(k == 3, F.regexp_replace(value, '"tzsAmount":[^,}]*', '"tzsAmount":1e40'))
        .when(k == 4, F.regexp_replace(value, r"^(\{[^\[]*\[)", "$1 5,"))
        .when(k == 5, F.regexp_replace(value, '"tzsAmount":', '"tzsAmount":1,"tzsAmount":'))
        .when(k == 6, F.regexp_replace(value, '"transactionDate":"[^"]*"', '"transactionDate":"n/a"'))
        .otherwise(value),
        "topic": F.when(k == 1, F.lit("capital-drafts")).otherwise(F.col("topic"))})


def _run_feed(spark, sf_dir, name):
    """Events -> messages, some damaged, in a file twin -> the whole feed job."""
    root = work_dir(spark, name)
    damaged(to_messages(events_from_events(spark, sf_dir))).write.parquet(f"{root}/feed")
    records = read_feed(spark, "parquet", f"{root}/feed")
    run_to_completion(start_feed_job(records, root, f"{root}/_checkpoint"))
    return root


def q_feed_stream_position(spark, sf_dir):
    root = _run_feed(spark, sf_dir, "feed_position")
    return present(tables.read_state(spark, tables.state_path(root, "partials"), "partials"))


def q_feed_stream_log(spark, sf_dir):
    root = _run_feed(spark, sf_dir, "feed_log")
    return present(tables.read_event_log(spark, f"{root}/event_log").drop("batch_id",
                                                                           "raw_payload"))


def q_feed_dead_letter(spark, sf_dir):
    root = _run_feed(spark, sf_dir, "feed_dead_letter")
    return spark.read.parquet(f"{root}/dead_letter").groupBy("topic", "reason").agg(
        F.count(F.lit(1)).alias("messages"))


def q_feed_quality(spark, sf_dir):
    """How much the feed job took in and what was wrong, as it was counted on the way."""
    root = _run_feed(spark, sf_dir, "feed_quality")
    return tables.read_feed_quality(spark, f"{root}/feed_quality")


def q_rebuilt_position(spark, sf_dir):
    """The live state follows one sector rule; the rule changes, so all is rebuilt under the
    other one from the earliest message, two files a micro-batch, and readers are switched."""
    root = work_dir(spark, "rebuilt")
    (to_messages(events_from_events(spark, sf_dir)).repartition(WAVES, "offset")
     .write.parquet(f"{root}/feed"))
    records = read_feed(spark, "parquet", f"{root}/feed", admission("parquet", per_batch=2))
    rebuild.rebuild(records, f"{root}/job", sector_mode="general")
    rebuild.rebuild(records, f"{root}/job", sector_mode="submitted")
    return present(rebuild.read_live_state(spark, f"{root}/job"))


def q_rebuild_generations(spark, sf_dir):
    """What was counted in each generation of that state."""
    root = work_dir(spark, "generations")
    to_messages(events_from_events(spark, sf_dir)).write.parquet(f"{root}/feed")
    records = read_feed(spark, "parquet", f"{root}/feed")
    for rule in ("general", "submitted"):
        rebuild.rebuild(records, f"{root}/job", sector_mode=rule)
    return rebuild.generations(spark, f"{root}/job").drop("folder")


def q_late_arrivals_logged(spark, sf_dir):
    """Late arrivals of three reporting dates, from the stored log."""
    root = work_dir(spark, "late_logged")
    tables.append_event_log(event_log_rows(events_from_star(spark, sf_dir)), 0, root)
    return late_arrivals(tables.read_event_log(spark, root, LOGGED_DATES))


def _noon():
    return F.col("reporting_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")


def q_table_counts(spark, sf_dir):
    """State, log and snapshot as stored tables, counted by their files' footers."""
    root = work_dir(spark, "table_counts")
    ev = events_from_events(spark, sf_dir)
    tables.write_state_table(capital_position(ev), f"{root}/state")
    tables.append_event_log(event_log_rows(ev), 0, f"{root}/log")
    tables.write_snapshot(take_snapshot(tables.read_state_table(spark, f"{root}/state")),
                          f"{root}/snapshot")
    return tables.stored_counts(spark, capital_state=f"{root}/state",
                                capital_event_log=f"{root}/log",
                                capital_snapshot=f"{root}/snapshot")


def q_stored_reporting_dates(spark, sf_dir):
    """The dates of the stored log, from folder names."""
    root = work_dir(spark, "stored_dates")
    tables.append_event_log(event_log_rows(events_from_star(spark, sf_dir)), 0, root)
    return tables.stored_dates(spark, root, tables.LOG_FOLDERS)


def q_position_change_stored(spark, sf_dir):
    """Every key's position at noon against the end of the day, as bucketed copies."""
    root = work_dir(spark, "buckets")
    ev, run = events_from_events(spark, sf_dir), root.rsplit("-", 1)[1]
    copies = {"noon": ev.filter(F.col("ingestion_time") < _noon()), "day": ev}
    for name, of in copies.items():
        tables.write_state_buckets(capital_position(of), f"netcap_{name}_{run}",
                                   f"{root}/{name}", BUCKETS)
    return present(position_change(spark.table(f"netcap_noon_{run}"),
                                   spark.table(f"netcap_day_{run}")))


def q_stored_state_lookup(spark, sf_dir):
    root = work_dir(spark, "stored_state")
    tables.write_state_table(capital_position(events_from_events(spark, sf_dir)), root)
    stored = tables.read_state_table(spark, root)
    return present(position(stored, *LOOKUP_KEY))


def q_stored_official_position(spark, sf_dir):
    """Two snapshot runs appended to one snapshot table (noon and end of
    day of every date), read back, newest per key."""
    root = work_dir(spark, "snapshots")
    ev = events_from_events(spark, sf_dir)
    noon = F.col("reporting_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    tables.append_snapshot(
        take_snapshot(capital_position(ev.filter(F.col("ingestion_time") < noon)), taken_at=noon),
        root)
    tables.append_snapshot(take_snapshot(capital_position(ev)), root)
    return present(official_position(tables.read_snapshots(spark, root)))


def q_snapshot_rerun(spark, sf_dir):
    """The noon run, the end of day, and the noon run again, as after a failure: every
    snapshot row once."""
    root = work_dir(spark, "snapshot_rerun")
    ev = events_from_events(spark, sf_dir)
    noon = F.col("reporting_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    early = take_snapshot(capital_position(ev.filter(F.col("ingestion_time") < noon)), taken_at=noon)
    for run in (early, take_snapshot(capital_position(ev)), early):
        tables.write_snapshot(run, root)
    return present(tables.read_snapshots(spark, root))


def q_changelog_stream(spark, sf_dir):
    """Per-event changelog of the stream, written per batch and read back; equal
    to the batch changelog when each key's events arrive in time order."""
    root = work_dir(spark, "changelog_stream")
    run_to_completion(start_changelog_stream(_event_stream(spark, sf_dir), root,
                                             f"{root}/_checkpoint"))
    return present(read_changelog(spark, root))


STORED_QUERIES = {
    "changelog_stream": q_changelog_stream,
    "position_stream": q_position_stream,
    "position_stream_partials": q_position_stream_partials,
    "stream_event_log": q_stream_event_log,
    "late_replay": q_late_replay,
    "feed_stream_position": q_feed_stream_position,
    "feed_stream_log": q_feed_stream_log,
    "feed_dead_letter": q_feed_dead_letter,
    "feed_quality": q_feed_quality,
    "rebuilt_position": q_rebuilt_position,
    "rebuild_generations": q_rebuild_generations,
    "late_arrivals_logged": q_late_arrivals_logged,
    "state_from_store": q_state_from_store,
    "snapshot_rerun": q_snapshot_rerun,
    "table_counts": q_table_counts,
    "stored_reporting_dates": q_stored_reporting_dates,
    "position_change_stored": q_position_change_stored,
    "stored_state_lookup": q_stored_state_lookup,
    "stored_official_position": q_stored_official_position,
}
