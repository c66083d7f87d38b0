"""Properties of the fold and the reports."""

import datetime as dt

from helpers import T0, ev, events_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from netcap.operators.changelog import position_changelog
from netcap.operators.position import capital_position
from netcap.operators.reports import summary

SOURCES = ["SHARE", "RESERVE", "DIVIDEND", "DEDUCTION", "UNKNOWN"]

event_rows = st.lists(
    st.tuples(st.sampled_from(SOURCES),
              st.decimals(min_value=0, max_value=10 ** 9, places=2, allow_nan=False),
              st.sampled_from(["FSP001", "FSP002"]), st.sampled_from(["A", "B", None]),
              st.sampled_from(["2024-01-15", "2024-01-16"]), st.integers(0, 10 ** 5)),
    min_size=1, max_size=40)


def _events(spark, rows):
    return events_df(spark, [ev(i, s, a, fsp=f, sector=sec, date=d, at=T0 + dt.timedelta(seconds=t))
                             for i, (s, a, f, sec, d, t) in enumerate(rows)])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=event_rows, seed=st.randoms())
def test_order_free_and_sums_agree(spark, rows, seed):
    base = capital_position(_events(spark, rows))
    shuffled = list(rows)
    seed.shuffle(shuffled)
    # any permutation of the events gives the same state (ids follow the rows)
    by_key = lambda df: sorted((r.fsp_id, r.sector, r.reporting_date, r.net_core_capital,  # noqa
                                r.event_count) for r in df.collect())
    assert by_key(base) == by_key(capital_position(_events(spark, shuffled)))
    # sum by sector = sum by fsp = system total
    for d in ("2024-01-15", "2024-01-16"):
        a = sum(r.net_total for r in summary(base, d, "sector").collect())
        b = sum(r.net_total for r in summary(base, d, "fsp").collect())
        c = summary(base, d).collect()[0].net_total or 0
        assert a == b == c


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=event_rows)
def test_last_changelog_row_is_state(spark, rows):
    df = _events(spark, rows)
    last = {}
    for r in position_changelog(df, bucket_seconds=60).collect():
        k = (r.fsp_id, r.sector, r.reporting_date)
        if k not in last or r.event_count > last[k][1]:
            last[k] = (r.net_core_capital, r.event_count)
    state = {(r.fsp_id, r.sector, r.reporting_date): (r.net_core_capital, r.event_count)
             for r in capital_position(df).collect()}
    assert last == state
