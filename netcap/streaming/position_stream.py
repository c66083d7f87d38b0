"""Continuous capital position with Structured Streaming.

No watermark anywhere: the key holds ``reporting_date``, so a late or
corrected event updates its own period whenever it arrives, and state is
kept for ever (RocksDB state store, or no streaming state at all in
``partials`` mode).

``mode="stateful"``: the position aggregate runs as a streaming
aggregation (update mode); each micro-batch's changed keys are upserted as
absolute totals. ``mode="partials"``: one ``foreachBatch`` on the event
stream persists the micro-batch once, appends it to the event log and
writes its partial sums; readers fold the partials. Both are exactly once:
the checkpoint replays a failed batch with the same id, and the sinks
overwrite that batch's folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from netcap.operators.eventlog import event_log_rows
from netcap.operators.position import capital_position
from netcap.sources import tables
from netcap.sources.feeds import dead_letter, decode_rows, events_of, observed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State that never expires belongs off-heap: RocksDB store provider
    (set before the query's first start)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def position_stream(events: DataFrame, sector_mode: str = "submitted") -> DataFrame:
    """The continuous keyed aggregate: the batch fold on a streaming frame."""
    return capital_position(events, sector_mode)


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_batches(frame: DataFrame, write, checkpoint: str, trigger: dict | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Start ``write(batch, batch_id)`` on every micro-batch."""
    w = frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w.queryName(query_name) if query_name else w, trigger).start()


def start_position_stream(events: DataFrame, root: str, checkpoint: str,
                          mode: str = "stateful", sector_mode: str = "submitted",
                          log_path: str | None = None, trigger: dict | None = None,
                          query_name: str | None = None, sink=None) -> StreamingQuery:
    """Start the job writing the state below ``root`` (``state_<mode>``).

    ``trigger`` defaults to ``availableNow`` (drain what is there, then
    stop); pass ``{"processingTime": "1 second"}`` for a continuous job. A
    fresh ``checkpoint`` and ``root`` rebuild everything from the earliest
    offset (the reference's only recovery); an existing checkpoint resumes.

    ``sink(batch, batch_id)`` takes the changed keys' absolute totals instead of the
    delta folder (``tables.jdbc_state_writer``; ``tables.keep_in_store`` writes nothing, the
    state is then read with ``tables.read_state_store``); it needs ``mode="stateful"``,
    which keeps its state in RocksDB.
    """
    path = tables.state_path(root, mode)
    if mode == "stateful":
        if log_path is not None:
            raise ValueError("the event log needs mode='partials' (one scan feeding both sinks)")
        use_rocksdb(events.sparkSession)
        write = sink or (lambda df, bid: tables.upsert_state(df, bid, path))
        w = (position_stream(events, sector_mode).writeStream.outputMode("update")
             .foreachBatch(write).option("checkpointLocation", checkpoint))
        return _trigger(w.queryName(query_name) if query_name else w, trigger).start()
    if sink is not None:
        raise ValueError("a sink of absolute totals needs mode='stateful'")
    return start_batches(
        events, lambda df, bid: fold_batch(df, bid, path, log_path, sector_mode),
        checkpoint, trigger, query_name)


def start_feed_job(records: DataFrame, root: str, checkpoint: str,
                   sector_mode: str = "submitted", missing_fsp: str = "unknown",
                   trigger: dict | None = None, query_name: str | None = None,
                   sink=None) -> StreamingQuery:
    """The whole job: records of the four feeds (``feeds.read_feed``) are decoded
    and folded. One ``foreachBatch`` on one scan writes, below ``root``, the partial
    position (``state_partials``), the event log (``event_log``), what is wrong
    (``dead_letter``: raw, topic, reason) and how much (``feed_quality``).
    ``sink(partials, batch_id)`` takes the batch's partial sums besides
    (``tables.jdbc_partials_writer``)."""
    return start_batches(
        records, lambda df, bid: feed_batch(df, bid, root, sector_mode, missing_fsp, sink),
        checkpoint, trigger, query_name)


def feed_batch(records: DataFrame, batch_id: int, root: str, sector_mode: str = "submitted",
               missing_fsp: str = "unknown", sink=None) -> None:
    """One micro-batch of records into all sinks. The decoded rows are computed and kept
    once, and counted meanwhile; every sink filters them. All folders are by batch
    id, so a retry replaces them."""
    rows, seen = observed(decode_rows(records, missing_fsp))
    rows.persist()
    try:
        write_batch(events_of(rows), batch_id, tables.state_path(root, "partials"),
                    f"{root}/event_log", sector_mode, sink)
        tables.write_delta(dead_letter(rows).hint("rebalance"), batch_id, f"{root}/dead_letter")
        tables.write_feed_quality(records.sparkSession, seen.get, batch_id,
                                  f"{root}/feed_quality")
    finally:
        rows.unpersist()


def write_batch(events: DataFrame, batch_id: int, state_dir: str, log_path: str | None,
                sector_mode: str = "submitted", sink=None) -> None:
    """A micro-batch's log rows (if asked) and partial position. Idempotent by ``batch_id``."""
    if log_path is not None:
        tables.append_event_log(event_log_rows(events, sector_mode), batch_id, log_path)
    partials = capital_position(events, sector_mode)
    tables.write_delta(partials, batch_id, state_dir)
    if sink is not None:
        sink(partials, batch_id)


def fold_batch(batch: DataFrame, batch_id: int, state_dir: str, log_path: str | None,
               sector_mode: str = "submitted") -> None:
    """One micro-batch of events feeding both sinks from a single scan."""
    batch.persist()
    try:
        write_batch(batch, batch_id, state_dir, log_path, sector_mode)
    finally:
        batch.unpersist()


def start_console(events: DataFrame, sector_mode: str = "submitted",
                  trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Print every updated position row (debugging sink)."""
    w = (position_stream(events, sector_mode).writeStream.outputMode("update")
         .format("console").option("truncate", "false"))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query, however long it takes unless
    ``timeout_s`` is given, and surface its failure."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def file_event_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                      max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A file source (the broker-less twin of a topic)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


__all__ = ["ROCKSDB", "feed_batch", "file_event_stream", "fold_batch", "position_stream",
           "run_to_completion", "start_batches", "start_console", "start_feed_job",
           "start_position_stream", "use_rocksdb", "write_batch"]
