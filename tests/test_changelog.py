import datetime as dt
import random

from helpers import T0, ev, events_df

from netcap.operators.changelog import position_changelog
from netcap.operators.position import capital_position


def test_last_row_per_key_equals_state(spark):
    rnd = random.Random(3)
    rows = [ev(i, rnd.choice(["SHARE", "RESERVE", "DIVIDEND", "DEDUCTION"]), rnd.randint(1, 99),
               fsp=f"FSP00{rnd.randint(1, 3)}", at=T0 + dt.timedelta(seconds=rnd.randint(0, 10 ** 6)))
            for i in range(500)]
    df = events_df(spark, rows)
    cl = position_changelog(df, bucket_seconds=5000).collect()
    assert len(cl) == 500
    last = {}
    for r in cl:
        k = (r.fsp_id, r.sector, r.reporting_date)
        if k not in last or r.event_count > last[k].event_count:
            last[k] = r
    for s in capital_position(df).collect():
        r = last[(s.fsp_id, s.sector, s.reporting_date)]
        assert r.net_core_capital == s.net_core_capital and r.event_count == s.event_count
        assert r.last_share_update == s.last_share_update


def test_hot_key_split_across_buckets(spark):
    # one key holds most events; a bucket of a minute cuts it into 34 chunks
    rows = [ev(i, "SHARE", 1, at=T0 + dt.timedelta(seconds=i)) for i in range(2000)]
    rows += [ev(10_000 + i, "RESERVE", 2, fsp="FSP009", at=T0 + dt.timedelta(seconds=i))
             for i in range(50)]
    cl = position_changelog(events_df(spark, rows), bucket_seconds=60)
    hot = sorted((r.event_count, int(r.share_capital_total)) for r in cl.collect()
                 if r.fsp_id == "FSP001")
    assert hot == [(n, n) for n in range(1, 2001)]


def test_bucket_width_and_start_change_nothing(spark):
    rnd = random.Random(9)
    rows = [ev(i, rnd.choice(["SHARE", "RESERVE", "DIVIDEND", "DEDUCTION"]), rnd.randint(1, 99),
               fsp=f"FSP00{rnd.randint(1, 2)}", at=T0 + dt.timedelta(seconds=i // 3 * 40))
            for i in range(300)]
    rows += [ev(900 + i, "SHARE", 1, fsp="FSP001", at=None) for i in range(3)]
    whole = sorted(map(str, position_changelog(events_df(spark, rows), bucket_seconds=10 ** 6)
                       .collect()))
    for width in (1, 60, 3600):
        assert sorted(map(str, position_changelog(events_df(spark, rows), bucket_seconds=width)
                          .collect())) == whole
    first, second = [*rows[300:], *rows[:150]], rows[150:300]
    start = capital_position(events_df(spark, first))
    parts = (position_changelog(events_df(spark, first)).collect()
             + position_changelog(events_df(spark, second), start=start).collect())
    assert sorted(map(str, parts)) == whole


def _largest_piece(monkeypatch, run):
    """Rows of the largest piece that a run cuts, seen where events get their pieces."""
    from netcap.operators import changelog
    sizes, plain = [], changelog.in_pieces

    def watched(ev_, cuts):
        out = plain(ev_, cuts)
        sizes.append(out.groupBy(*changelog.KEY, "_bucket", "_piece").count().agg(
            {"count": "max"}).first()[0])
        return out
    monkeypatch.setattr(changelog, "in_pieces", watched)
    return run(), sizes


def test_a_burst_at_one_instant_is_cut(spark, monkeypatch):
    """A third of all events in one key at one instant, another third in one bucket of it."""
    rnd = random.Random(12)
    src = ["SHARE", "RESERVE", "DIVIDEND", "DEDUCTION"]
    burst = T0 + dt.timedelta(minutes=7)
    rows = [ev(i, rnd.choice(src), rnd.randint(1, 99), at=burst) for i in range(1000)]
    rows += [ev(rnd.getrandbits(62), rnd.choice(src), rnd.randint(1, 99),
                at=T0 + dt.timedelta(seconds=rnd.randint(0, 3599), microseconds=rnd.randint(0, 9)))
             for _ in range(1000)]
    rows += [ev(10 ** 6 + i, rnd.choice(src), 1, fsp=f"FSP{i % 40}", at=T0 + dt.timedelta(
        seconds=rnd.randint(0, 10 ** 6))) for i in range(960)]
    rows += [ev(5000 + i, "SHARE", 1, fsp="FSP9", at=None) for i in range(40)]
    df = events_df(spark, rows)
    whole = sorted(map(str, position_changelog(df).collect()))
    got, sizes = _largest_piece(monkeypatch, lambda: position_changelog(df, chunk_rows=30).collect())
    assert sorted(map(str, got)) == whole
    assert len(sizes) == 1 and sizes[0] <= 3 * 30
    start = capital_position(events_df(spark, rows[-40:]))
    assert sorted(map(str, position_changelog(df, chunk_rows=100, start=start).collect())) == sorted(
        map(str, position_changelog(df, start=start).collect()))


def test_small_chunks_are_not_cut(spark, monkeypatch):
    rows = [ev(i, "SHARE", 1, at=T0 + dt.timedelta(seconds=i)) for i in range(50)]
    _, sizes = _largest_piece(monkeypatch, lambda: position_changelog(events_df(spark, rows)).count())
    assert sizes == []


def test_equal_times_are_cut_by_a_feed_s_offset(spark, monkeypatch):
    from helpers import records_df

    from netcap.sources.feeds import decode_feed
    item = ('{"reportingDate":"2024-01-15","tzsAmount":%d,"sectorSnaClassification":"B"}')
    value = '{"fspInformationId":"F","shareCapitalData":[%s]}'
    recs = records_df(spark, [(value % ",".join(item % (k + n) for n in range(2)), "share-capital",
                               k, T0) for k in range(200)])
    events = decode_feed(recs)[0]
    order = ("ingestion_time", "offset", "partition", "topic", "item_index")
    got, sizes = _largest_piece(monkeypatch, lambda: position_changelog(
        events, order_by=order, chunk_rows=20).collect())
    assert sizes[0] <= 60
    totals, acc = [], 0
    for k in range(200):
        for n in range(2):
            acc += k + n
            totals.append((len(totals) + 1, acc))
    assert sorted((r.event_count, int(r.share_capital_total)) for r in got) == totals
