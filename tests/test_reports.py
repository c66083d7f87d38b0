import datetime as dt
from decimal import Decimal

from helpers import T0, ev, events_df

from netcap.operators.position import capital_position
from netcap.operators.reports import (
    position, position_report, printed_report, rollup, summary, with_freshness,
)
from netcap.operators.snapshot import official_position, take_snapshot

import pytest


def _state(spark, rows):
    return capital_position(events_df(spark, rows))


def _all_four(at_share, at_other=T0):
    return [ev(1, "SHARE", 1, at=at_share), ev(2, "RESERVE", 1, at=at_other),
            ev(3, "DIVIDEND", 1, at=at_other), ev(4, "DEDUCTION", 1, at=at_other)]


def test_freshness_boundaries(spark):
    as_of = T0 + dt.timedelta(minutes=5)
    cases = {
        "exact": (T0, False, 300),
        "just_under": (as_of - dt.timedelta(seconds=299, milliseconds=500), True, 300),
        "future": (as_of + dt.timedelta(seconds=10), True, -10),
    }
    for name, (at, fresh, age) in cases.items():
        r = with_freshness(_state(spark, _all_four(at, at_other=as_of)), as_of).collect()[0]
        assert r.share_fresh is fresh, name
        assert r.share_age_sec == age, name


def test_status_order(spark):
    as_of = T0 + dt.timedelta(hours=1)
    # one missing (no deduction) and one stale -> DELAYED wins
    rows = [ev(1, "SHARE", 1, at=T0), ev(2, "RESERVE", 1, at=as_of), ev(3, "DIVIDEND", 1, at=as_of)]
    assert with_freshness(_state(spark, rows), as_of).collect()[0].freshness_status == "DELAYED"
    r = with_freshness(_state(spark, _all_four(T0, as_of)), as_of).collect()[0]
    assert r.freshness_status == "PARTIAL" and r.deduct_age_sec == 0
    r = with_freshness(_state(spark, _all_four(as_of, as_of)), as_of).collect()[0]
    assert r.freshness_status == "LIVE"


def test_missing_component_has_null_age(spark):
    r = with_freshness(_state(spark, [ev(1, "SHARE", 1)]), T0).collect()[0]
    assert r.reserves_age_sec is None and r.reserves_fresh is False


def test_lookup_requires_all_keys(spark):
    st = _state(spark, [ev(1, "SHARE", 1)])
    with pytest.raises(ValueError):
        position(st, "FSP001", None, "2024-01-15")
    assert position(st, "FSP001", "BANKING", "2024-01-15").count() == 1
    assert position(st, "FSP001", "BANKING", "2024-01-16").count() == 0


def test_report_document(spark):
    st = _state(spark, _all_four(T0))
    r = position_report(st, T0).collect()[0].report
    assert r.positions.netCoreCapital == 0.0 and r.eventCount == 4
    assert r.refreshMetrics.share.fresh is True and r.freshnessStatus == "LIVE"


def test_summaries_and_empty_date(spark):
    rows = [ev(1, "SHARE", 10, sector="A"), ev(2, "SHARE", 5, sector="B", fsp="FSP002"),
            ev(3, "DEDUCTION", 1, sector="A")]
    st = _state(spark, rows)
    by_sector = {r.sector: r for r in summary(st, "2024-01-15", "sector").collect()}
    by_fsp = {r.fsp_id: r for r in summary(st, "2024-01-15", "fsp").collect()}
    system = summary(st, "2024-01-15").collect()
    assert by_sector["A"].net_total == Decimal("9.0000")
    assert sum(r.net_total for r in by_sector.values()) == sum(r.net_total for r in by_fsp.values()) \
        == system[0].net_total == Decimal("14.0000")
    assert system[0].scope == "SYSTEM"
    assert summary(st, "2000-01-01", "sector").count() == 0
    empty = summary(st, "2000-01-01", "anything").collect()
    assert len(empty) == 1 and empty[0].net_total is None


def test_rollup_levels(spark):
    rows = [ev(1, "SHARE", 10, sector="A"), ev(2, "SHARE", 5, sector="B", fsp="FSP002")]
    out = rollup(_state(spark, rows)).collect()
    levels = sorted(r.level for r in out)
    assert levels == ["fsp", "fsp", "market", "sector", "sector"]


def test_printed_report_text(spark):
    rows = [ev(1, "SHARE", 8.0e9), ev(2, "RESERVE", 5.2e9), ev(3, "DIVIDEND", 0.5e9),
            ev(4, "DEDUCTION", 0.3e9)]
    text = printed_report(_state(spark, rows)).collect()[0].report_text
    assert "Share Capital:        8.0B  (10:00)" in text
    assert text.endswith("Net Core Capital:     12.4B")


def test_two_snapshots_official_is_later(spark):
    st1 = _state(spark, [ev(1, "SHARE", 1)])
    st2 = _state(spark, [ev(1, "SHARE", 1), ev(2, "SHARE", 2)])
    s1 = take_snapshot(st1, "2024-01-15", T0)
    s2 = take_snapshot(st2, "2024-01-15", T0 + dt.timedelta(hours=1))
    both = s1.unionByName(s2)
    assert both.count() == 2
    off = official_position(both).collect()
    assert len(off) == 1 and off[0].share_capital_total == Decimal("3.0000")


def test_zoned_as_of_is_converted(spark):
    st = _state(spark, _all_four(T0))
    for as_of in ("2024-01-15T13:00:00+03:00", "2024-01-15 10:00:00",
                  dt.datetime(2024, 1, 15, 5, tzinfo=dt.timezone(dt.timedelta(hours=-5)))):
        r = with_freshness(st, as_of).collect()[0]
        assert r.share_age_sec == 0 and r.freshness_status == "LIVE"


def test_document_keeps_missing_ages_and_exact_numbers(spark):
    st = _state(spark, [ev(1, "SHARE", "1234567890123456.7000"), ev(2, "RESERVE", 20)])
    text = position_report(st, T0).collect()[0].report_json
    assert '"dividend":{"fresh":false,"ageSec":null}' in text
    assert '"shareCapital":1234567890123456.7,"reserves":20,"dividendsPayable":0,' in text
    assert '"asOf":"2024-01-15T10:00:00.000Z"' in text


def test_printed_layout(spark):
    rows = [ev(1, "SHARE", "8000000000", at=T0 + dt.timedelta(minutes=1)),
            ev(2, "RESERVE", "5200000000", at=T0 - dt.timedelta(minutes=2)),
            ev(3, "DIVIDEND", "500000000", at=T0),
            ev(4, "DEDUCTION", "300000000", at=T0 - dt.timedelta(minutes=5))]
    assert printed_report(_state(spark, rows)).collect()[0].report_text.split("\n") == [
        "Realtime Capital Position", "As of: 10:01:00", "",
        "Share Capital:        8.0B  (10:01)", "Reserves:             5.2B  (09:58)",
        "Dividends Payable:    0.5B  (10:00)", "Deductions:           0.3B  (09:55)", "",
        "Net Core Capital:     12.4B"]


def test_printed_rollup_has_every_level(spark):
    from netcap.operators.reports import printed_rollup
    rows = [ev(1, "SHARE", "1000000000", sector="A"),
            ev(2, "SHARE", "2000000000", sector="B", fsp="FSP002")]
    got = {(r.level, r.fsp_id or r.sector): r.report_text
           for r in printed_rollup(_state(spark, rows)).collect()}
    assert set(got) == {("sector", "A"), ("sector", "B"), ("fsp", "FSP001"), ("fsp", "FSP002"),
                        ("market", None)}
    assert "Net Core Capital:     3.0B" in got["market", None]
