"""JDBC target against in-memory Derby (ships with Spark; lives only inside
this JVM, no server or port)."""

from decimal import Decimal

import pytest
from helpers import ev, events_df

from netcap.operators.position import capital_position
from netcap.schemas import EVENT_SCHEMA, STATE_COLUMNS
from netcap.sources.tables import jdbc_state_writer, merge_upsert_sql
from netcap.streaming.position_stream import (
    file_event_stream, run_to_completion, start_position_stream,
)

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
URL = "jdbc:derby:memory:netcap_test;create=true"
DDL = """CREATE TABLE capital_state (
 fsp_id VARCHAR(100) NOT NULL, sector VARCHAR(100) NOT NULL, reporting_date DATE NOT NULL,
 share_capital_total DECIMAL(20,4), reserves_total DECIMAL(20,4),
 dividends_payable_total DECIMAL(20,4), deductions_total DECIMAL(20,4),
 net_core_capital DECIMAL(20,4), last_share_update TIMESTAMP, last_reserves_update TIMESTAMP,
 last_dividends_update TIMESTAMP, last_deductions_update TIMESTAMP,
 last_computed_at TIMESTAMP, event_count BIGINT,
 PRIMARY KEY (fsp_id, sector, reporting_date))"""


def _target(spark):
    """A fresh target and staging table; (connection, run statement)."""
    jvm = spark.sparkContext._jvm  # test-only: run DDL/DML inside this JVM's Derby
    conn = jvm.java.sql.DriverManager.getConnection(URL)

    def run(sql):
        st = conn.createStatement()
        st.execute(sql)
        st.close()

    for t in ("capital_state", "capital_state_staging"):
        try:
            run(f"DROP TABLE {t}")
        except Exception:  # not there yet
            pass
    run(DDL)
    run(DDL.replace("capital_state (", "capital_state_staging (").replace(
        ",\n PRIMARY KEY (fsp_id, sector, reporting_date))", ")"))
    return conn, run


def _read(spark):
    return spark.read.jdbc(URL, "capital_state", properties=DRIVER).select(*STATE_COLUMNS).collect()


def test_staging_write_and_batch_upsert(spark):
    conn, run = _target(spark)
    write = jdbc_state_writer(URL, "capital_state", run, DRIVER, upsert_sql=merge_upsert_sql)
    b0 = capital_position(events_df(spark, [ev(1, "SHARE", 5), ev(2, "SHARE", 1, sector="X")]))
    b1 = capital_position(events_df(spark, [ev(1, "SHARE", 5), ev(3, "SHARE", 2)]))
    write(b0, 0)
    write(b1, 1)  # absolute totals of the changed key overwrite it
    got = {r.sector: r for r in _read(spark)}
    assert set(got) == {"BANKING", "X"}
    assert got["BANKING"].share_capital_total == Decimal("7.0000")
    assert got["BANKING"].event_count == 2
    conn.close()


def test_running_job_upserts_into_the_target(spark, tmp_dir):
    conn, run = _target(spark)
    rows = [[ev(1, "SHARE", 5), ev(2, "RESERVE", 1)], [ev(3, "SHARE", 2)]]
    for i, part in enumerate(rows):
        events_df(spark, part).coalesce(1).write.parquet(f"{tmp_dir}/in/f{i}")
    stream = file_event_stream(spark, f"{tmp_dir}/in/*", EVENT_SCHEMA, max_files_per_trigger=1)
    run_to_completion(start_position_stream(
        stream, tmp_dir, f"{tmp_dir}/ck", mode="stateful",
        sink=jdbc_state_writer(URL, "capital_state", run, DRIVER, upsert_sql=merge_upsert_sql)), 600)
    (r,) = _read(spark)
    assert (r.share_capital_total, r.net_core_capital, r.event_count) == (
        Decimal("7.0000"), Decimal("8.0000"), 3)
    conn.close()


def test_a_replayed_batch_is_added_once(spark, tmp_dir):
    """The feed job's partial sums; the job dies between staging and statement, or after both."""
    from netcap.sources.feeds import read_feed
    from netcap.sources.publish import to_messages
    from netcap.sources.tables import FENCE, jdbc_partials_writer, merge_add_sql
    from netcap.streaming.position_stream import start_feed_job

    conn, run = _target(spark)
    for t in ("capital_state", "capital_state_staging"):
        run(f"ALTER TABLE {t} ADD COLUMN {FENCE} BIGINT")
    rows = [[ev(1, "SHARE", 5), ev(2, "RESERVE", 1, sector="X")], [ev(3, "SHARE", 2)],
            [ev(4, "DEDUCTION", 1), ev(5, "SHARE", 1, sector="Y")]]
    for i, part in enumerate(rows):
        to_messages(events_df(spark, part)).coalesce(1).write.parquet(f"{tmp_dir}/in/f{i}")
    crashes = iter([None, "before", "after", None, None])

    def flaky(sql):
        crash = next(crashes)
        if crash == "before":
            raise RuntimeError("died between staging and statement")
        run(sql)
        if crash == "after":
            raise RuntimeError("died behind the statement")

    sink = jdbc_partials_writer(URL, "capital_state", flaky, DRIVER, add_sql=merge_add_sql)
    for died in (True, True, False):
        records = read_feed(spark, "parquet", f"{tmp_dir}/in/*", {"maxFilesPerTrigger": "1"})
        q = start_feed_job(records, f"{tmp_dir}/job", f"{tmp_dir}/ck", sink=sink)
        if died:
            with pytest.raises(Exception, match="died"):
                run_to_completion(q, 600)
        else:
            run_to_completion(q, 600)
    got = {tuple(r) for r in _read(spark)}
    want = capital_position(events_df(spark, [r for part in rows for r in part])).collect()
    assert got == {tuple(r) for r in want}
    conn.close()


def test_both_dialects_fence_by_batch():
    from netcap.sources.tables import merge_add_sql, postgres_add_sql
    assert "WHERE t.last_batch_id < EXCLUDED.last_batch_id" in postgres_add_sql("t", "s")
    assert "WHEN MATCHED AND t.last_batch_id < s.last_batch_id" in merge_add_sql("t", "s")


def test_the_upsert_is_required():
    with pytest.raises(TypeError):
        jdbc_state_writer(URL, "capital_state")
