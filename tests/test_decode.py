import datetime as dt
import json
from decimal import Decimal

from helpers import T0, ev, events_df, records_df

from netcap.operators.position import capital_position
from netcap.sources.feeds import decode_feed
from netcap.sources.publish import to_messages

SHARE_T = "share-capital"
RES_T = "other-capital"


def _msg(items, array="shareCapitalData", fsp="FSP001", **extra):
    d = {"fspInformationId": fsp, array: items}
    if fsp is None:
        d.pop("fspInformationId")
    d.update(extra)
    return json.dumps(d)


def _decode(spark, values, topic=SHARE_T, missing_fsp="unknown"):
    recs = records_df(spark, [(v, topic, i, T0) for i, v in enumerate(values)])
    good, bad = decode_feed(recs, missing_fsp)
    return good.collect(), bad.collect()


def test_two_items_one_message(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 5, "sectorSnaClassification": "BANKING"}
    good, bad = _decode(spark, [_msg([item, item])])
    assert len(good) == 2 and not bad
    assert good[0].ingestion_time == good[1].ingestion_time == T0
    assert good[0].event_id != good[1].event_id


def test_empty_and_absent_array(spark):
    good, bad = _decode(spark, [_msg([]), json.dumps({"fspInformationId": "FSP001"})])
    assert not good
    assert [b.reason for b in bad] == ["no_array"]


def test_first_array_name_that_is_an_array_wins(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 7, "sector": "BANKING"}
    v = json.dumps({"fspInformationId": "F", "shareCapitalData": {},
                    "otherCapitalAccountData": [item]})
    good, bad = _decode(spark, [v], topic=RES_T)
    assert len(good) == 1 and good[0].amount == Decimal("7.0000")
    assert good[0].source_type == "RESERVE"


def test_bad_messages_go_to_dead_letter(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    values = ["{not json", _msg([item])[:-5], json.dumps([{"shareCapitalData": [item]}]), None]
    good, bad = _decode(spark, values)
    assert not good
    assert len(bad) == 4
    assert {b.reason for b in bad} <= {"malformed", "null_value", "no_array"}
    assert any(b.reason == "null_value" for b in bad)


def test_missing_fsp(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    good, _ = _decode(spark, [_msg([item], fsp=None)])
    assert good[0].fsp_id == "UNKNOWN"
    good, _ = _decode(spark, [_msg([item], fsp=None)], missing_fsp="drop")
    assert not good


def test_amount_coercion(spark):
    base = {"reportingDate": "2024-01-15", "sectorSnaClassification": "B"}
    values = [_msg([dict(base)]), _msg([dict(base, tzsAmount="12.5")]),
              _msg([dict(base, tzsAmount="bad")])]
    good, bad = _decode(spark, values)
    assert sorted(g.amount for g in good) == [Decimal("0.0000"), Decimal("0.0000"),
                                              Decimal("12.5000")]
    assert not bad


def test_amount_overflow_dead_letter(spark):
    v = ('{"fspInformationId":"F","shareCapitalData":[{"reportingDate":"2024-01-15",'
         '"tzsAmount":123456789012345678.1234,"sectorSnaClassification":"B"}]}')
    good, bad = _decode(spark, [v])
    assert not good and [b.reason for b in bad] == ["amount_overflow"]


def test_bad_reporting_date(spark):
    base = {"tzsAmount": 1, "sectorSnaClassification": "B"}
    values = [_msg([dict(base, reportingDate="x")]), _msg([dict(base)]),
              _msg([dict(base, reportingDate=None)])]
    good, bad = _decode(spark, values)
    assert not good and [b.reason for b in bad] == ["bad_date"] * 3


def test_transaction_date_fallback_and_share_sector(spark):
    items = [{"reportingDate": "2024-01-15", "tzsAmount": 1},
             {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "",
              "transactionDate": "2024-01-10"}]
    good, _ = _decode(spark, [_msg(items)])
    by_sector = {g.sector: g for g in good}
    assert by_sector[None].transaction_date == dt.date(2024, 1, 15)
    assert by_sector[""].transaction_date == dt.date(2024, 1, 10)


def test_round_trip_is_identity(spark):
    rows = [ev(1, "SHARE", 8.0e9), ev(2, "RESERVE", 5.2e9, sector="INSURANCE"),
            ev(3, "DIVIDEND", 0.5e9), ev(4, "DEDUCTION", 0.3e9, tx_date="2024-01-10"),
            ev(5, "UNKNOWN", 1)]
    events = events_df(spark, rows)
    decoded, dead = decode_feed(to_messages(events))
    assert dead.count() == 0
    assert sorted(capital_position(decoded).collect()) == sorted(capital_position(events).collect())


def test_same_payload_twice_counts_twice(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 2, "sectorSnaClassification": "B"}
    recs = records_df(spark, [(_msg([item]), SHARE_T, i, T0) for i in range(2)])
    events, _ = decode_feed(recs)
    r = capital_position(events).collect()[0]
    assert r.event_count == 2 and r.share_capital_total == Decimal("4.0000")


def test_union_of_feeds_keeps_every_record(spark):
    from netcap.sources.feeds import union_feeds
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sector": "B"}
    share = records_df(spark, [(_msg([dict(item, sectorSnaClassification="B")]), SHARE_T, 0, T0)])
    res = records_df(spark, [(_msg([item], array="otherCapitalAccountData"), RES_T, 0, T0)] * 2)
    events, dead = decode_feed(union_feeds(share, res))
    assert sorted(e.source_type for e in events.collect()) == ["RESERVE", "RESERVE", "SHARE"]
    assert dead.count() == 0


def test_unknown_topic_is_a_dead_letter(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    good, bad = _decode(spark, [_msg([item])], topic="capital-drafts")
    assert not good and [(b.reason, b.topic) for b in bad] == [("unknown_topic", "capital-drafts")]


def test_numbers_beyond_any_decimal_are_not_zero(spark):
    v = ('{"fspInformationId":"F","shareCapitalData":[{"reportingDate":"2024-01-15",'
         '"tzsAmount":%s,"sectorSnaClassification":"B"}]}')
    good, bad = _decode(spark, [v % n for n in ("1e40", '"1e40"', "1" + "0" * 50)])
    assert not good and [b.reason for b in bad] == ["amount_overflow"] * 3
    good, bad = _decode(spark, [v % n for n in ('"NaN"', '"x"', "null", "true")])
    assert [g.amount for g in good] == [Decimal("0.0000")] * 4 and not bad


def test_digits_past_double_precision_are_kept(spark):
    v = ('{"fspInformationId":"F","shareCapitalData":[{"reportingDate":"2024-01-15",'
         '"tzsAmount":1234567890123456.7891,"sectorSnaClassification":"B"}]}')
    good, _ = _decode(spark, [v])
    assert good[0].amount == Decimal("1234567890123456.7891")


def test_an_item_that_is_no_object_costs_its_neighbours_nothing(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    good, bad = _decode(spark, [_msg([5, item, "x", None, item, [item]])])
    assert sorted(g.item_index for g in good) == [1, 4]
    assert [b.reason for b in bad] == ["bad_item"] * 4


def test_log_has_the_items_own_json_and_where_it_came_from(spark):
    from netcap.operators.eventlog import event_log_rows
    items = [{"reportingDate": "2024-01-15", "tzsAmount": n, "sectorSnaClassification": "B"}
             for n in (1, 2)]
    recs = records_df(spark, [(_msg(items), SHARE_T, 7, T0)])
    log = event_log_rows(decode_feed(recs)[0]).orderBy("item_index").collect()
    assert [(r.topic, r.partition, r.offset, r.item_index) for r in log] == [
        (SHARE_T, 0, 7, 0), (SHARE_T, 0, 7, 1)]
    assert [json.loads(r.raw_payload) for r in log] == items
    assert {r.message_key for r in log} == {"FSP001:B:2024-01-15"}


def test_message_key_keeps_its_parts(spark):
    from netcap.functions.columns import composite_key
    df = spark.createDataFrame([("F", None, None)], "fsp_id string, sector string, reporting_date date")
    assert df.select(composite_key().alias("k")).first().k == "F::"


def test_currency_travels_with_both_amounts(spark):
    from netcap.operators.currency import normalise_currency, rates_frame
    src = events_df(spark, [ev(1, "SHARE", 2), ev(2, "RESERVE", 3)]).selectExpr("*", "'USD' AS currency")
    sent = to_messages(normalise_currency(src, rates_frame(spark)), with_currency=True)
    got = {r.source_type: r for r in decode_feed(sent)[0].collect()}
    assert (got["SHARE"].org_amount, got["SHARE"].amount, got["SHARE"].currency) == (
        Decimal("2.0000"), Decimal("5000.0000"), "USD")
    again = normalise_currency(decode_feed(sent)[0].drop("amount"), rates_frame(spark), "org_amount")
    assert sorted(r.amount for r in again.collect()) == [Decimal("5000.0000"), Decimal("7500.0000")]


def test_a_second_rate_is_rejected(spark):
    import pytest
    from netcap.operators.currency import DEFAULT_RATES, normalise_currency, rates_frame
    src = events_df(spark, [ev(1, "SHARE", 2)]).selectExpr("*", "'USD' AS currency")
    double = rates_frame(spark, [*DEFAULT_RATES, ("SHARE", "USD", "2600")])
    with pytest.raises(Exception, match="more than one rate for SHARE USD"):
        normalise_currency(src, double).collect()


def test_kafka_options_fail_on_lost_data():
    from netcap.sources.feeds import kafka_options
    assert "failOnDataLoss" not in kafka_options("b:9092")


def test_record_time_is_utc_in_any_session_zone(spark):
    from netcap.functions.columns import utc_wall_clock
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = spark.sql("SELECT timestamp_seconds(1705312800) AS t").select(
            utc_wall_clock("t").alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert at == dt.datetime(2024, 1, 15, 10, 0)


def test_the_last_of_a_repeated_name_counts(spark):
    v = ('{"fspInformationId":"X","shareCapitalData":[{"reportingDate":"2024-01-15","tzsAmount":1,'
         '"tzsAmount":7,"sectorSnaClassification":"B"}],"fspInformationId":"F"}')
    good, bad = _decode(spark, [v])
    assert [(g.fsp_id, g.amount) for g in good] == [("F", Decimal("7.0000"))] and not bad


def test_a_bad_transaction_date_is_reported_and_its_money_counts(spark):
    base = {"reportingDate": "2024-01-15", "tzsAmount": 3, "sectorSnaClassification": "B"}
    values = [_msg([dict(base, transactionDate=d)]) for d in ("n/a", 5, "2024-02-30", "", " ", None)]
    good, bad = _decode(spark, values)
    assert {(g.amount, str(g.transaction_date)) for g in good} == {(Decimal("3.0000"), "2024-01-15")}
    assert len(good) == 6 and [b.reason for b in bad] == ["bad_transaction_date"] * 3
    assert all(json.loads(b.raw)["tzsAmount"] == 3 for b in bad)


def test_a_strange_topic_is_one_dead_letter_whatever_it_holds(spark):
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    good, bad = _decode(spark, [_msg([item, item]), _msg([])], topic="capital-drafts")
    assert not good and [b.reason for b in bad] == ["unknown_topic"] * 2


def test_rows_are_counted_by_reason_while_they_are_read(spark):
    from netcap.sources.feeds import REASONS, decode_rows, events_of, observed
    item = {"reportingDate": "2024-01-15", "tzsAmount": 1, "sectorSnaClassification": "B"}
    values = ["{", None, _msg([]), _msg([item, 5, dict(item, reportingDate="x")]),
              _msg([dict(item, transactionDate="x"), dict(item, tzsAmount="1e40")]), "{}"]
    rows, seen = observed(decode_rows(records_df(spark, [(v, SHARE_T, i, T0)
                                                         for i, v in enumerate(values)])))
    assert events_of(rows).count() == 2
    got = seen.get
    assert got.pop("rows") == 8 and got.pop("events") == 2
    assert {r: n for r, n in got.items() if n} == dict.fromkeys(
        ("malformed", "null_value", "no_array", "bad_item", "bad_date", "amount_overflow",
         "bad_transaction_date"), 1) and set(got) == set(REASONS)
