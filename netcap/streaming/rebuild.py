"""Rebuild of the feed job's tables beside the live ones, and the switch to them.

Below ``base`` each generation is a whole feed job of its own (state, log, dead letter,
counts and checkpoint in one folder). ``generations`` names them: a folder per generation with
one row, written last and never changed; the newest accepted one is live. A reader asks once
and reads below that root, so it sees the old tables or the new ones, never a mix.

A rebuild reads the feeds from the earliest offset into the next generation, in micro-batches
as large as the source's admission options say, holds the tables against each other
(``reconcile``) and only then accepts it. Cut off anywhere, it is called again: the
generation's checkpoint resumes it, and until the last step readers stay with the old one.
A generation that contradicts itself is put down as not accepted; the next call starts afresh.
The live job is then started on the new root and its checkpoint, and goes on where the
rebuild ended. A feed without events makes no generation (``NotReconciled``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.operators.position import capital_position
from netcap.schemas import KEY, STATE_COLUMNS
from netcap.sources import tables
from netcap.streaming.position_stream import run_to_completion, start_feed_job

_COUNTS = ("events", "log_rows", "keys")
_ROW = "folder string, accepted boolean, " + ", ".join(f"{c} long" for c in _COUNTS)


class NotReconciled(ValueError):
    """A rebuilt generation contradicts itself or is empty; readers keep the old one."""


def generations(spark: SparkSession, base: str) -> DataFrame:
    """All finished generations, accepted or not, with what was counted in them."""
    try:
        found = spark.read.parquet(f"{base.rstrip('/')}/generations")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], f"generation long, {_ROW}")
        raise
    return found.select(F.col("generation").cast("long"), "folder", "accepted", *_COUNTS)


def live_root(spark: SparkSession, base: str) -> str:
    """The root that readers use, and that the live job runs on."""
    live = generations(spark, base).filter("accepted").agg(
        F.max_by("folder", "generation")).first()[0]
    if live is None:
        raise FileNotFoundError(f"no generation is accepted at {base}")
    return f"{base.rstrip('/')}/{live}"


def read_live_state(spark: SparkSession, base: str) -> DataFrame:
    """The live generation's position."""
    return tables.read_state(spark, tables.state_path(live_root(spark, base), "partials"),
                             "partials")


def read_live_log(spark: SparkSession, base: str, reporting_dates=None) -> DataFrame:
    return tables.read_event_log(spark, f"{live_root(spark, base)}/event_log", reporting_dates)


def reconcile(spark: SparkSession, root: str) -> dict:
    """Holds a job's tables against each other: the stored position must be the fold of the
    stored log, key by key and column by column, and the log can't hold more than the events that were
    counted as they were decoded. Both sides are partial aggregates before they are
    shuffled by key; only the counts come back."""
    try:
        log = tables.read_event_log(spark, f"{root}/event_log")
        state = tables.read_state(spark, tables.state_path(root, "partials"), "partials")
    except (AnalysisException, FileNotFoundError) as e:  # nothing, or no event, has come
        raise NotReconciled(f"{root}: no events") from e
    # The log holds what has passed the sector rule: it is folded as it is.
    folded = capital_position(log.withColumnRenamed("received_at", "ingestion_time"))
    rest = [c for c in STATE_COLUMNS if c not in KEY]
    both = state.select(*KEY, F.struct(*rest).alias("stored")).join(
        folded.select(*KEY, F.struct(*rest).alias("folded")), KEY, "full")
    seen = both.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(~F.col("stored").eqNullSafe(F.col("folded"))).alias("wrong"),
        F.coalesce(F.sum("folded.event_count"), F.lit(0)).alias("log_rows")).first()
    counted = tables.read_feed_quality(spark, f"{root}/feed_quality").filter(
        F.col("counted") == "events").first()
    events = counted.n if counted else 0
    if seen.wrong or seen.log_rows > events:
        raise NotReconciled(f"{root}: {seen.wrong} of {seen['keys']} keys differ from their log; "
                            f"{seen.log_rows} rows in the log, {events} events decoded")
    return {"events": events, "log_rows": seen.log_rows, "keys": seen["keys"]}


def settle(spark: SparkSession, base: str, generation: int, folder: str, accepted: bool,
           counts: dict | None = None) -> None:
    """Put a generation down; if accepted, readers use it from now on. One file, moved into
    place when it is whole. Its folder must be new: of two rebuilds that race for one number
    the second fails here, and changes nothing."""
    counts = counts or {}
    row = (folder, accepted, *[counts.get(c) for c in _COUNTS])
    (spark.createDataFrame([row], _ROW).coalesce(1).write.mode("error")
     .parquet(f"{base.rstrip('/')}/generations/generation={int(generation)}"))


def rebuild(records: DataFrame, base: str, sector_mode: str = "submitted",
            missing_fsp: str = "unknown", timeout_s: float | None = None) -> str:
    """Everything again from ``records`` (``feeds.read_feed`` from the earliest offset, with
    ``feeds.admission`` options) into the next generation; reconciled, then accepted. Returns
    the new root. The rules are part of the folder's name: a rebuild that was cut off is only
    resumed by one with the same rules."""
    spark = records.sparkSession
    last = generations(spark, base).agg(F.max("generation")).first()[0] or 0
    folder = f"generation-{last + 1}-{sector_mode}-{missing_fsp}"
    root = f"{base.rstrip('/')}/{folder}"
    run_to_completion(start_feed_job(records, root, f"{root}/_checkpoint", sector_mode,
                                     missing_fsp), timeout_s)
    try:
        counts = reconcile(spark, root)
    except NotReconciled:
        settle(spark, base, last + 1, folder, accepted=False)
        raise
    settle(spark, base, last + 1, folder, True, counts)
    return root
