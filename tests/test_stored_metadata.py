"""Stored tables that are answered from footers and folder names (R12, R13), and joins of
bucketed copies (S8)."""

import datetime as dt

from helpers import T0, ev, events_df

from netcap.operators.eventlog import event_log_rows
from netcap.operators.position import capital_position
from netcap.operators.reports import position_change
from netcap.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _events(spark, n=24):
    return events_df(spark, [
        ev(i, ("SHARE", "RESERVE", "DIVIDEND", "DEDUCTION")[i % 4], 10 + i, fsp=f"FSP00{i % 3}",
           date=f"2024-01-{15 + i % 4:02d}", at=T0 + dt.timedelta(minutes=i)) for i in range(n)])


def test_counts_and_dates_read_no_row(spark, tmp_dir):
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    events = _events(spark)
    tables.write_state_table(capital_position(events), f"{tmp_dir}/state")
    for batch in (0, 1):
        tables.append_event_log(event_log_rows(events), batch, f"{tmp_dir}/log")
    counts = tables.stored_counts(spark, state=f"{tmp_dir}/state", log=f"{tmp_dir}/log")
    plan = _plan(counts)
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2
    assert "received_at" not in plan and "fsp_id" not in plan
    assert {r.table_name: r.row_count for r in counts.collect()} == {"state": 12, "log": 48}
    days = [dt.date(2024, 1, d) for d in (18, 17, 16, 15)]
    for path, folders in (("state", tables.STATE_FOLDERS), ("log", tables.LOG_FOLDERS)):
        dates = tables.stored_dates(spark, f"{tmp_dir}/{path}", folders)
        assert "PushedAggregation: [COUNT(*)]" in _plan(dates)
        assert [r.reporting_date for r in dates.collect()] == days
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == listed


def test_a_folder_without_rows_is_no_date(spark, tmp_dir):
    state = capital_position(_events(spark))
    tables.write_state_table(state, tmp_dir)
    state.drop("reporting_date").limit(0).coalesce(1).write.parquet(
        f"{tmp_dir}/reporting_date=2030-01-01")
    dates = tables.stored_dates(spark, tmp_dir)
    assert dt.date(2030, 1, 1) not in {r.reporting_date for r in dates.collect()}
    assert dates.count() == 4


def test_bucketed_copies_join_without_a_shuffle(spark, tmp_dir):
    events = _events(spark)
    early = events.filter("event_id < 9")
    for name, of in (("early_copy", early), ("late_copy", events)):
        tables.write_state_buckets(capital_position(of), name, f"{tmp_dir}/{name}", 4)
    change = position_change(spark.table("early_copy"), spark.table("late_copy"))
    plan = _plan(change)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    got = {(r.fsp_id, r.reporting_date): r for r in change.collect()}
    before = {(r.fsp_id, r.reporting_date): r for r in capital_position(early).collect()}
    after = {(r.fsp_id, r.reporting_date): r for r in capital_position(events).collect()}
    assert set(got) == set(after) and len(before) < len(after)
    for key, r in got.items():
        old = before[key].net_core_capital if key in before else 0
        assert r.net_core_capital_before == old
        assert r.net_core_capital_change == after[key].net_core_capital - old
        assert r.event_count_change == after[key].event_count - (
            before[key].event_count if key in before else 0)
