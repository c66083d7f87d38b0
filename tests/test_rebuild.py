"""Rebuild beside the live tables and the switch (T5), admission control (S1)."""

import datetime as dt

import pytest
from helpers import T0, ev, events_df

from netcap.operators.position import capital_position
from netcap.sources import tables
from netcap.sources.feeds import admission, kafka_options, read_feed
from netcap.sources.publish import to_messages
from netcap.streaming import rebuild as rb
from netcap.streaming.position_stream import run_to_completion, start_feed_job

SOURCES = ("SHARE", "RESERVE", "DIVIDEND", "DEDUCTION")


def _events(first, n):
    return [ev(first + i, SOURCES[i % 4], 10 + i, fsp=f"FSP00{i % 3}",
               sector="BANKING" if i % 5 else None, at=T0 + dt.timedelta(minutes=first + i))
            for i in range(n)]


def _feed(spark, path, chunks):
    for rows in chunks:
        to_messages(events_df(spark, rows)).coalesce(1).write.mode("append").parquet(path)


def test_admission_options():
    assert admission("kafka", 1000, min_partitions=64) == {"maxOffsetsPerTrigger": "1000", "minPartitions": "64"}
    assert kafka_options("b:9092", **admission("kafka", 5))["maxOffsetsPerTrigger"] == "5"
    assert admission("parquet", 3) == {"maxFilesPerTrigger": "3"}
    assert admission("json", max_bytes=1 << 20) == {"maxBytesPerTrigger": "1048576"}
    assert admission("kafka") == admission("parquet") == {}
    for wrong in (("kafka", None, 5, None), ("parquet", 1, 5, None), ("parquet", None, None, 4)):
        with pytest.raises(ValueError, match="bounded by"):
            admission(*wrong)


def test_bounded_batches_equal_one_batch(spark, tmp_dir):
    chunks = [_events(100 * i, 12) for i in range(5)]
    _feed(spark, f"{tmp_dir}/feed", chunks)
    got, batches = {}, {}
    for name, options in (("one", {}), ("bounded", admission("parquet", 2)),
                          ("bytes", admission("parquet", max_bytes=1))):
        root = f"{tmp_dir}/{name}"
        q = start_feed_job(read_feed(spark, "parquet", f"{tmp_dir}/feed", options), root,
                           f"{root}/_checkpoint")
        run_to_completion(q, 600)
        got[name] = sorted(tables.read_state(spark, f"{root}/state_partials", "partials").collect())
        batches[name] = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    assert batches["one"] == [60] and batches["bounded"] == [24, 24, 12]
    assert batches["bytes"] == [12] * 5
    want = sorted(capital_position(events_df(spark, [r for c in chunks for r in c])).collect())
    assert got["one"] == got["bounded"] == got["bytes"] == want


def test_damaged_state_is_rebuilt_beside_and_switched(spark, tmp_dir):
    feed, base = f"{tmp_dir}/feed", f"{tmp_dir}/job"
    _feed(spark, feed, [_events(0, 12), _events(100, 9)])
    records = read_feed(spark, "parquet", feed, admission("parquet", 1))
    with pytest.raises(FileNotFoundError):
        rb.live_root(spark, base)
    first = rb.rebuild(records, base, timeout_s=600)
    want = sorted(capital_position(events_df(spark, _events(0, 12) + _events(100, 9))).collect())
    assert sorted(rb.read_live_state(spark, base).collect()) == want
    # The live state takes a batch in twice: its log tells.
    state = tables.state_path(first, "partials")
    tables.write_delta(spark.read.parquet(f"{state}/batch_id=0"), 77, state)
    with pytest.raises(rb.NotReconciled, match="differ from their log"):
        rb.reconcile(spark, first)
    held = rb.read_live_state(spark, base)  # a reader that is at work while the rest happens
    assert sorted(held.collect()) != want
    second = rb.rebuild(records, base, timeout_s=600)
    assert second != first and rb.live_root(spark, base) == second
    assert sorted(rb.read_live_state(spark, base).collect()) == want
    assert rb.read_live_log(spark, base).count() == sum(r.event_count for r in want)
    assert sorted(held.collect()) != want  # still the old tables, whole
    # The live job goes on where the rebuild ended.
    _feed(spark, feed, [_events(200, 6)])
    run_to_completion(start_feed_job(records, second, f"{second}/_checkpoint"), 600)
    want = sorted(capital_position(events_df(
        spark, _events(0, 12) + _events(100, 9) + _events(200, 6))).collect())
    assert sorted(rb.read_live_state(spark, base).collect()) == want


def test_a_rebuild_that_fails_leaves_readers_alone(spark, tmp_dir, monkeypatch):
    feed, base = f"{tmp_dir}/feed", f"{tmp_dir}/job"
    _feed(spark, feed, [_events(0, 8), _events(50, 8)])
    records = read_feed(spark, "parquet", feed, admission("parquet", 1))
    first = rb.rebuild(records, base, timeout_s=600)
    whole, calls = tables.write_feed_quality, []

    def dies_once(*args):
        calls.append(args[2])
        if calls == [0, 1]:
            raise OSError("lost")
        return whole(*args)

    monkeypatch.setattr(tables, "write_feed_quality", dies_once)
    with pytest.raises(Exception, match="lost"):
        rb.rebuild(records, base, timeout_s=600)
    assert rb.live_root(spark, base) == first
    second = rb.rebuild(records, base, timeout_s=600)  # resumed: the first batch isn't read again
    assert calls == [0, 1, 1] and rb.live_root(spark, base) == second
    assert sorted(rb.read_live_state(spark, base).collect()) == sorted(
        tables.read_state(spark, f"{first}/state_partials", "partials").collect())
    # Tables that disagree aren't accepted, and the next rebuild starts afresh.
    monkeypatch.setattr(tables, "write_feed_quality", lambda s, counts, b, p: whole(
        s, {**counts, "events": 0}, b, p))
    with pytest.raises(rb.NotReconciled):
        rb.rebuild(records, base, timeout_s=600)
    assert rb.live_root(spark, base) == second
    monkeypatch.undo()
    fourth = rb.rebuild(records, base, timeout_s=600)
    assert rb.live_root(spark, base) == fourth
    assert [(r.generation, r.accepted) for r in rb.generations(spark, base).orderBy(
        "generation").collect()] == [(1, True), (2, True), (3, False), (4, True)]
    with pytest.raises(Exception, match="already exists"):
        rb.settle(spark, base, 4, "elsewhere", True)


def test_a_feed_without_events_makes_no_generation(spark, tmp_dir):
    _feed(spark, f"{tmp_dir}/feed", [[]])
    records = read_feed(spark, "parquet", f"{tmp_dir}/feed")
    with pytest.raises(rb.NotReconciled, match="no events"):
        rb.rebuild(records, f"{tmp_dir}/job", timeout_s=600)
    with pytest.raises(FileNotFoundError):
        rb.live_root(spark, f"{tmp_dir}/job")
