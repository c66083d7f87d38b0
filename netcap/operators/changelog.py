"""Per-event changelog of the position: the row emitted after each event.

A plain ``Window.partitionBy(key)`` would put every event of a key into
one task; with one key holding a third of all events that task would sort
a third of the data. Instead this is a distributed prefix sum over chunks,
a chunk being a key's events of one bucket of ingestion time:

1. total each (key, bucket) chunk (partial aggregation: a row per chunk and task); these
   totals are written, with the chunk's count of events;
2. chunks of more than ``chunk_rows`` events are cut: quantiles of their events' times, and
   of what orders events of equal times, taken from all of them by a mergeable sketch, are the
   bounds. A piece lies between two times that are bounds; a time that is a bound itself is
   a piece of its own, and is cut further by the second order. So a burst at one instant is cut as
   well; only the cut chunks are totalled again;
3. offset of each piece = sum / max of the pieces before it for the same
   key (a window over one row per piece);
4. join the events with the offsets and run the sums inside the piece.

Without a large chunk, the events are shuffled once, by (key, bucket). Bounds only say where
to cut: any give the same rows. ``chunk_rows`` is what one task may sort (a piece holds about
as many at most, as long as a chunk has no more than ``PIECES`` times as many).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netcap.functions.columns import component_amount, epoch_millis
from netcap.operators.position import net_core_capital, prepare_events
from netcap.schemas import ADDEND, KEY, SOURCE_TYPES, TOTAL, TOTAL_COLUMNS, UPDATE_COLUMNS
from netcap.session import work_dir

BUCKET_SECONDS = 3600
CHUNK_ROWS = 2_000_000
PIECES = 256             # of a chunk's quantiles
BROADCAST_CUTS = 1000    # chunks whose bounds (some 4 KB each) may be broadcast
NO_TIME = -(2 ** 62)     # the order's place of events without a time: before all others

CHANGELOG_COLUMNS = (["event_id", "source_type", "ingestion_time"] + KEY
                     + [TOTAL_COLUMNS[s] for s in SOURCE_TYPES] + ["net_core_capital"]
                     + [UPDATE_COLUMNS[s] for s in SOURCE_TYPES]
                     + ["last_computed_at", "event_count"])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _quantiles(c: str) -> Column:
    return F.percentile_approx(c, [k / PIECES for k in range(1, PIECES)], 10_000)


def chunk_bounds(ev: DataFrame, large: DataFrame, chunk_rows: int) -> DataFrame:
    """Of each large chunk, where it is cut by time and by the second order."""
    cuts = ev.join(large, [*KEY, "_bucket"]).groupBy(*KEY, "_bucket").agg(
        _quantiles("_at").alias("_t"), _quantiles("_second").alias("_s"),
        F.count(F.lit(1)).alias("_rows"))
    pieces = F.least(F.lit(PIECES), F.ceil(F.col("_rows") / chunk_rows)).cast("int")
    some = lambda c: F.transform(  # noqa: E731  evenly spread, one fewer than pieces
        F.sequence(F.lit(1), F.lit(PIECES - 1)), lambda k: F.when(
            F.floor(k * pieces / PIECES) > F.floor((k - 1) * pieces / PIECES), F.get(c, k - 1)))
    return cuts.select(*KEY, "_bucket", F.array_compact(some(F.col("_t"))).alias("_t_cuts"),
                       F.array_compact(some(F.col("_s"))).alias("_s_cuts"))


def in_pieces(ev: DataFrame, cuts: DataFrame) -> DataFrame:
    """``_piece`` of every event, rising with (time, second order); 0 in uncut chunks."""
    below = lambda cuts, c: F.size(F.filter(cuts, lambda x: x < F.col(c)))
    at_cut = F.exists("_t_cuts", lambda x: x == F.col("_at"))
    piece = ((2 * below("_t_cuts", "_at") + at_cut.cast("int")) * (PIECES + 1)
             + F.when(at_cut, below("_s_cuts", "_second")).otherwise(F.lit(0)))
    return (ev.join(cuts, [*KEY, "_bucket"], "left")
            .withColumn("_piece", F.when(F.col("_t_cuts").isNull(), F.lit(0)).otherwise(piece))
            .drop("_t_cuts", "_s_cuts"))


def position_changelog(events: DataFrame, sector_mode: str = "submitted",
                       order_by: tuple = ("ingestion_time", "event_id"),
                       bucket_seconds: int = BUCKET_SECONDS,
                       start: DataFrame | None = None,
                       chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Running totals, last update times and count of the key after each
    event, in (ingestion_time, event_id) order. The last row of a key equals
    its position state. ``order_by`` must be unique within a key and begin with the
    ingestion time; pass a feed's (offset, partition, topic, item_index) behind it where
    64-bit event ids may meet. Events of equal times are cut by the second of these, if it
    is a number. ``start`` is the keys' state before these events."""
    order = list(order_by)
    if order[0] != "ingestion_time":
        raise ValueError("order_by begins with ingestion_time: chunks follow it")
    m = {s: f"_m{i}" for i, s in enumerate(SOURCE_TYPES)}
    u = {s: f"_u{i}" for i, s in enumerate(SOURCE_TYPES)}
    prepared = prepare_events(events, sector_mode)
    second = next((c for c in order[1:2] if isinstance(prepared.schema[c].dataType, T.NumericType)),
                  None)
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01'"), "ingestion_time")
    ev = prepared.select(
        *KEY, *dict.fromkeys([*order, "event_id", "source_type"]),
        F.coalesce(F.floor(epoch_millis("ingestion_time") / (1000 * bucket_seconds)),
                   F.lit(NO_TIME)).alias("_bucket"),
        F.coalesce(micros, F.lit(NO_TIME)).alias("_at"),
        (F.coalesce(F.col(second), F.lit(0)) if second else F.lit(0)).cast("long").alias("_second"),
        *[component_amount("source_type", s, "amount").alias(m[s]) for s in SOURCE_TYPES],
        *[F.when(F.col("source_type") == s, F.col("ingestion_time")).alias(u[s])
          for s in SOURCE_TYPES])

    totals = [*[F.sum(m[s]).alias(m[s]) for s in SOURCE_TYPES],
              *[F.max(u[s]).alias(u[s]) for s in SOURCE_TYPES],
              F.max("ingestion_time").alias("_t"), F.count(F.lit(1)).alias("_n")]
    chunks = _written(ev.groupBy(*KEY, "_bucket").agg(*totals), "changelog-chunks")
    large = chunks.filter(F.col("_n") > chunk_rows).select(*KEY, "_bucket")
    many = large.count()
    if many:
        cuts = _written(chunk_bounds(ev, large, chunk_rows), "changelog-bounds")
        ev = in_pieces(ev, F.broadcast(cuts) if many <= BROADCAST_CUTS else cuts)
        again = ev.join(large, [*KEY, "_bucket"], "left_semi").groupBy(
            *KEY, "_bucket", "_piece").agg(*totals)
        chunks = chunks.filter(F.col("_n") <= chunk_rows).withColumn(
            "_piece", F.lit(0)).unionByName(again)
    else:
        chunks, ev = chunks.withColumn("_piece", F.lit(0)), ev.withColumn("_piece", F.lit(0))
    piece = [*KEY, "_bucket", "_piece"]
    before = Window.partitionBy(*KEY).orderBy("_bucket", "_piece").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = chunks.select(
        *piece,
        *[F.coalesce(F.sum(m[s]).over(before), F.lit(0).cast(TOTAL)).alias(f"_o{m[s]}")
          for s in SOURCE_TYPES],
        *[F.max(u[s]).over(before).alias(f"_o{u[s]}") for s in SOURCE_TYPES],
        F.max("_t").over(before).alias("_ot"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_on"))
    if start is not None:
        s0 = start.select(
            *KEY, *[F.col(TOTAL_COLUMNS[s]).alias(f"_s{m[s]}") for s in SOURCE_TYPES],
            *[F.col(UPDATE_COLUMNS[s]).alias(f"_s{u[s]}") for s in SOURCE_TYPES],
            F.col("last_computed_at").alias("_st"), F.col("event_count").alias("_sn"))
        offsets = offsets.join(s0, KEY, "left").select(
            *piece,
            *[(F.col(f"_o{m[s]}") + F.coalesce(f"_s{m[s]}", F.lit(0).cast(ADDEND))).cast(TOTAL)
              .alias(f"_o{m[s]}") for s in SOURCE_TYPES],
            *[F.greatest(f"_o{u[s]}", f"_s{u[s]}").alias(f"_o{u[s]}") for s in SOURCE_TYPES],
            F.greatest("_ot", "_st").alias("_ot"),
            (F.col("_on") + F.coalesce("_sn", F.lit(0))).alias("_on"))

    running = Window.partitionBy(*piece).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = ev.join(offsets, piece, "inner")
    out = j.select(
        "event_id", "source_type", "ingestion_time", *KEY,
        *[(F.col(f"_o{m[s]}") + F.sum(m[s]).over(running)).cast(TOTAL).alias(TOTAL_COLUMNS[s])
          for s in SOURCE_TYPES],
        *[F.greatest(F.col(f"_o{u[s]}"), F.max(u[s]).over(running)).alias(UPDATE_COLUMNS[s])
          for s in SOURCE_TYPES],
        F.greatest(F.col("_ot"), F.max("ingestion_time").over(running)).alias("last_computed_at"),
        (F.col("_on") + F.count(F.lit(1)).over(running)).alias("event_count"))
    return out.withColumn("net_core_capital", net_core_capital()).select(*CHANGELOG_COLUMNS)
