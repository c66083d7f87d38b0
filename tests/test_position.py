import datetime as dt
import random
from decimal import Decimal

from helpers import T0, ev, events_df

from netcap.operators.position import capital_position, feed_totals


def _rows(df):
    return {tuple(r[:3]): r.asDict() for r in df.collect()}


def test_worked_example(spark):
    # 8.0B + 5.2B - 0.5B - 0.3B = 12.4B
    rows = [ev(1, "SHARE", 8.0e9), ev(2, "RESERVE", 5.2e9), ev(3, "DIVIDEND", 0.5e9),
            ev(4, "DEDUCTION", 0.3e9)]
    st = capital_position(events_df(spark, rows)).collect()
    assert len(st) == 1
    r = st[0]
    assert r.net_core_capital == Decimal("12400000000.0000")
    assert r.event_count == 4
    assert r.share_capital_total == Decimal("8000000000.0000")


def test_unknown_type_and_null_sector_dropped(spark):
    rows = [ev(1, "SHARE", 10), ev(2, "UNKNOWN", 99), ev(3, "RESERVE", 5, sector=None)]
    st = capital_position(events_df(spark, rows)).collect()
    assert len(st) == 1 and st[0].event_count == 1 and st[0].reserves_total == 0


def test_general_rule(spark):
    rows = [ev(1, "SHARE", 10, sector=""), ev(2, "SHARE", 10, sector=None),
            ev(3, "RESERVE", 5, sector="INSURANCE"), ev(4, "SHARE", 1, sector="PENSION")]
    sub = _rows(capital_position(events_df(spark, rows), "submitted"))
    gen = _rows(capital_position(events_df(spark, rows), "general"))
    # submitted: NULL dropped, empty kept
    assert {k[1] for k in sub} == {"", "INSURANCE", "PENSION"}
    # general: empty and NULL share sectors -> GENERAL, reserves -> GENERAL
    assert {k[1] for k in gen} == {"GENERAL", "PENSION"}
    g = [v for k, v in gen.items() if k[1] == "GENERAL"][0]
    assert g["event_count"] == 3 and g["share_capital_total"] == Decimal("20.0000")


def test_missing_amount_counts_as_zero(spark):
    rows = [ev(1, "SHARE", None), ev(2, "SHARE", 3)]
    r = capital_position(events_df(spark, rows)).collect()[0]
    assert r.share_capital_total == Decimal("3.0000") and r.event_count == 2
    only_null = capital_position(events_df(spark, [ev(1, "DIVIDEND", None)])).collect()[0]
    assert only_null.dividends_payable_total == Decimal("0.0000")


def test_last_updates_and_missing_components(spark):
    t1, t2 = T0, T0 + dt.timedelta(minutes=3)
    rows = [ev(1, "SHARE", 1, at=t2), ev(2, "SHARE", 1, at=t1), ev(3, "RESERVE", 1, at=t1)]
    r = capital_position(events_df(spark, rows)).collect()[0]
    assert r.last_share_update == t2 and r.last_reserves_update == t1
    assert r.last_dividends_update is None and r.last_computed_at == t2


def test_colon_in_sector_keeps_keys_distinct(spark):
    rows = [ev(1, "SHARE", 1, fsp="A:B", sector="C"), ev(2, "SHARE", 1, fsp="A", sector="B:C")]
    assert capital_position(events_df(spark, rows)).count() == 2


def test_permutation_invariance(spark):
    rnd = random.Random(7)
    rows = [ev(i, rnd.choice(["SHARE", "RESERVE", "DIVIDEND", "DEDUCTION"]),
               round(rnd.uniform(0, 1000), 2), fsp=f"FSP00{rnd.randint(1, 3)}",
               at=T0 + dt.timedelta(seconds=rnd.randint(0, 9999))) for i in range(300)]
    base = sorted(capital_position(events_df(spark, rows)).collect())
    for _ in range(2):
        rnd.shuffle(rows)
        assert sorted(capital_position(events_df(spark, rows).repartition(3)).collect()) == base


def test_feed_totals_groups_null_sector(spark):
    rows = [ev(1, "SHARE", 1, sector=None), ev(2, "SHARE", 2, sector=None), ev(3, "RESERVE", 5)]
    out = feed_totals(events_df(spark, rows)).collect()
    assert len(out) == 1 and out[0].sector is None and out[0].event_count == 2


def test_large_totals_dont_stop_the_job(spark):
    rows = [ev(i, "SHARE", "9999999999999999") for i in range(3)]
    r = capital_position(events_df(spark, rows)).collect()[0]
    assert r.share_capital_total == r.net_core_capital == 3 * Decimal("9999999999999999.0000")
