"""Plan shape guards: the properties the 100 TB design relies on."""

from conftest import SF_SMALL

from netcap.plans import QUERIES


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # finalise the AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_fold_is_one_shuffle_with_partial_aggregation(spark):
    p = _plan(QUERIES["capital_position"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in p and "partial_max" in p and "partial_count" in p


def test_scan_reads_only_needed_columns(spark, capsys):
    QUERIES["capital_position"](spark, SF_SMALL).explain(mode="formatted")
    out = capsys.readouterr().out
    # five of the six events columns: event_id is not needed by the fold
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double," \
           "props:string>" in out


def test_fact_table_never_broadcast(spark):
    p = _plan(QUERIES["capital_position_star"](spark, SF_SMALL))
    assert "SortMergeJoin" in p
    for chunk in p.split("BroadcastExchange")[1:]:
        assert "l_orderkey" not in chunk.split("FileScan parquet")[1].split("]")[0]


def test_payload_parsed_once(spark):
    p = _plan(QUERIES["json_roundtrip_position"](spark, SF_SMALL))
    assert p.count("parseJson") == 1


def test_changelog_has_no_window_over_the_bare_key(spark):
    p = _plan(QUERIES["position_changelog"](spark, SF_SMALL))
    final = p.split("== Initial Plan ==")[0]
    windows = [line for line in final.split("\n") if "Window [" in line]
    # one over the chunks' totals, ordered by bucket; one over the events of a chunk
    over_events = [w for w in windows if "event_id" in w]
    assert len(windows) == 2 and len(over_events) == 1
    assert "_bucket" in over_events[0].split("], [")[1]


def test_changelog_shuffles_events_once_and_keeps_nothing(spark):
    p = _plan(QUERIES["position_changelog"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    # the events' exchange carries their ids, the chunks' exchanges don't
    assert sum("Exchange" in x and "rangepartitioning" in x for x in p.split("\n")) == 0
    assert "Scan ExistingRDD" not in p and "InMemoryTableScan" not in p
