"""Partitions of keyed messages (K1)."""

import datetime as dt

from helpers import T0, ev, events_df

from netcap.functions.columns import keyed_partition, murmur2
from netcap.sources.publish import to_messages

# Signed results of the producers' murmur2, from its public definition's tests. Fixed values.
VECTORS = {
    "21": -973932308,
    "foobar": -790332482,
    "a-little-bit-long-string": -985981536,
    "a-little-bit-longer-string": -1486304829,
    "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
    "abc": 479470107,
}


def test_murmur2_gives_the_public_vectors(spark):
    df = spark.createDataFrame([(k, v) for k, v in VECTORS.items()], "k string, v long")
    for r in df.select("k", "v", murmur2("k").alias("h")).collect():
        assert r.h == r.v % (1 << 32), r.k


def test_partition_follows_the_key_alone(spark):
    keys = [(None,), ("",), ("é€",), *[(f"FSP00{i}:X:2024-01-{i:02d}",) for i in range(1, 10)]]
    df = spark.createDataFrame(keys, "k string")
    for n in (1, 4, 7):
        got = {r.k: r.p for r in df.select("k", keyed_partition("k", n).alias("p")).collect()}
        assert got.pop(None) is None
        assert all(0 <= p < n for p in got.values())
    events = [ev(i, s, 5, fsp=f"FSP00{i % 3}", at=T0 + dt.timedelta(seconds=i))
              for i, s in enumerate(("SHARE", "RESERVE", "DIVIDEND", "DEDUCTION") * 6)]
    sent = to_messages(events_df(spark, events), num_partitions=4)
    homes = {}
    for r in sent.select("key", "partition").collect():
        homes.setdefault(r.key, set()).add(r.partition)
    assert len(homes) == 3 and all(len(p) == 1 for p in homes.values())
