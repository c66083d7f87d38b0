"""Operator 7 - n-gram Jaccard join in size-banded tiles with bitmap signatures.

Documents are sets of 64-bit hashes of their distinct 5-word shingles. Two link
when 100 * |both| >= 75 * |either|, that is 7 * |both| >= 3 * (|a| + |b|). All links
that matter for connectivity are found, by exact tests:

1. One pass gives each document its set's size, its class (a digest of the
   set: exact copies are one class) and its bitmap signature, and counts all
   shingles in a table of ``BUCKETS`` hashed counters (a fixed size).
2. Linked sets share a shingle among the first floor(n/4) + 1 of each, in any one order
   of all shingles. The order is by counter, so that shingles that many documents share
   come last. Of these prefixes, shingles that only one class has leave; of
   shingles that exactly the same classes share, one stays. Hot ones (by their counter)
   aren't gathered to find that out: all their rows go on.
3. Star round: two classes of each shingle that share most of their prefixes are
   its centres (the second by a slightly disturbed rank). Every class is tested against the one of its centres with
   which it shares most of its prefix. That joins most of a large group of near copies
   by as many tests as it has classes.
4. Tile round, for what can still connect: where more than ``FEW`` classes have a
   shingle, they are cut into bands of size (a ratio of 4/3; linked sets are in the same or in neighbouring
   bands) and these into blocks of about ``BLOCK`` classes. A tile is a pair of blocks. In a
   tile, pairs of different components are tested by their bitmaps: every bit that
   only one set has stands for at least one shingle that the other lacks, which
   bounds the overlap from above. Only pairs that pass are rows. Pairs of the ``FEW``
   are made at once; all then pass the whole bitmaps. Of the pairs between two
   components the nearest is tested first; then all whose components still differ.
5. Tests are exact intersections of the sorted arrays of both, made again from
   the texts concerned. Components by minimum labels with pointer jumping.

What goes through the driver: the ``BUCKETS`` counters, and a bit field of fixed size
that only keeps texts without a part in any pair from being hashed again.

Defined results: null text and text without words: size 0, own component.
Fewer than five words: the whole sequence is the one shingle. Rows with the same
doc_id are judged each; null doc_id counts only for links, a component of such
rows alone has a null id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netcap.llm.common import fresh, text_or_empty, written

SHINGLE = 5
BUCKETS = 1 << 20      # counters of the order; shingles of over about 0.1 % of all documents come last
COUNTER_BLOCK = 1 << 16  # counters of one row while tasks' counts are added up
FAN_IN = 1024          # groups of tasks whose counts are added first
FEW = 8                # classes of a shingle whose pairs are made directly
BLOCK = 1024           # classes of one block of a tile
TILE_BYTES = 512       # of a bitmap in a tile, at most
FIRST_TOKENS = 16      # of a class, by which tiles tell whose turn a pair is
BITS = 4               # of a bitmap, times the next power of two above the set's size
HOT = 1 << 16          # counter, beyond four times the mean one, from which a shingle is hot
FILTER_WORDS = 1 << 16  # of the bit field of documents that take part, 64 bits each
CHUNK = 1 << 20        # bytes hashed at once

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in bytes, by differences of one running polynomial."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    while not _POWERS or len(_POWERS[0]) <= len(data):
        n = max(2 * len(data), 2 * CHUNK)
        _POWERS[:] = [_powers(_BASE, n), _powers(_INVERSE, n)]
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[0][:len(data)], out=run[1:])
    value = (run[end] - run[start]) * _POWERS[1][start]
    return _mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash per word of a long text, chunk by chunk."""
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        out.append(_words(data[at:end])[0])
        at = end
    return np.concatenate(out)


def _runs(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words."""
    x = w[:len(w) - k + 1] + np.uint64(k)
    for j in range(1, k):
        x = _mix(x) + w[j:len(w) - k + 1 + j]
    return _mix(x)


def _as_set(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text: words are split at ASCII white
    space, A-Z lower-cased. Short texts are hashed together, long ones alone."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = text.encode().lower()
        if held and size + len(data) > CHUNK:
            yield from _together(held)
            held, size = [], 0
        if len(data) > CHUNK:
            with np.errstate(over="ignore"):
                w = word_hashes(np.frombuffer(data, np.uint8))
                yield _as_set(_runs(w, min(SHINGLE, len(w)))) if len(w) else w
        else:
            held.append(data)
            size += len(data) + 1
    yield from _together(held)


def _together(texts: list[bytes]) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        w, start = _words(np.frombuffer(b"\n".join(texts), np.uint8))
        ends = np.cumsum([len(t) + 1 for t in texts])
        last = np.searchsorted(start, ends)
        runs = _runs(w, SHINGLE) if len(w) >= SHINGLE else w[:0]
        first = 0
        for end in last.tolist():
            n = end - first
            if n >= SHINGLE:
                yield _as_set(runs[first:end - SHINGLE + 1])
            else:
                yield _runs(w[first:end], n) if n else w[:0]
            first = end


def shingles(text: str) -> np.ndarray:
    return next(shingle_sets([text]))


def class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def bits_for(n: int) -> int:
    return BITS * max(64, 1 << (n - 1).bit_length())


def bitmap(s: np.ndarray) -> bytes:
    """Little-endian words of a bit per hash modulo the width: folding it in two
    gives the bitmap of half the width."""
    bits = np.zeros(bits_for(len(s)), np.uint8)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """Bitmaps (rows of words) folded to ``n`` words."""
    while words.shape[-1] > n:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a, n_b) -> np.ndarray:
    """Upper bound of the overlap; bitmaps of the same width."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def similar(overlap, n_a, n_b):
    return 7 * overlap >= 3 * (n_a + n_b)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty(F.col("text")).alias("text"))


# ---------------------------------------------------------------- passes over the texts

def set_pass(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, digest of the text, class, n, bitmap), and for each
    task its counts of shingles (block, counts: 32-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        names = ["doc_id", "digest", "class", "n", "bitmap", "block", "counts"]
        kinds = [*[pa.int64()] * 4, pa.binary(), pa.int32(), pa.binary()]
        for b in batches:
            sets = list(shingle_sets(b.column(1).to_pylist()))
            if sets:
                counts += np.bincount(bucket_of(np.concatenate(sets)), minlength=BUCKETS)
            cols = [b.column(0), b.column(2), [class_of(s) if len(s) else None for s in sets],
                    [len(s) for s in sets], [bitmap(s) if len(s) else None for s in sets],
                    [None] * len(sets), [None] * len(sets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) if isinstance(c, list) else c
                 for c, t in zip(cols, kinds, strict=True)], names)
        parts = counts.astype("<i8").reshape(-1, COUNTER_BLOCK)
        none = [None] * len(parts)
        cols = [*[none] * 5, range(len(parts)), [p.tobytes() for p in parts]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return _texts(docs).withColumn("digest", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, digest long, class long, n long, bitmap binary, block int, counts binary")


def bucket_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def counter_table(passed: DataFrame) -> np.ndarray:
    """All tasks' counts added up: in two rounds, so that no group is large."""
    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in t.column("counts").to_pylist())
        return pa.table({"block": t.column("block")[:1], "counts": pa.array([total.tobytes()])})

    kind = "block int, counts binary"
    rows = passed.filter(F.col("block").isNotNull()).select("block", "counts").withColumn(
        "group", F.pmod(F.xxhash64("counts"), F.lit(FAN_IN)))
    first = rows.groupBy("block", "group").applyInArrow(add, kind)
    out = np.zeros(BUCKETS, np.int64)
    for r in first.groupBy("block").applyInArrow(add, kind).collect():  # BUCKETS numbers
        out[r["block"] * COUNTER_BLOCK:(r["block"] + 1) * COUNTER_BLOCK] = np.frombuffer(
            r["counts"], "<i8")
    return out


def prefix_pass(docs: DataFrame, counters: np.ndarray) -> DataFrame:
    """class, prefix (hashes), hot (those of them that are): each class once per task."""
    hot = counters > HOT + 4 * counters.mean()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in batches:
            classes, prefixes, hots = [], [], []
            for s in shingle_sets(b.column(0).to_pylist()):
                if not len(s) or (c := class_of(s)) in met:
                    continue
                met.add(c)
                bucket = bucket_of(s)
                first = np.lexsort((s, counters[bucket]))[:len(s) // 4 + 1]
                is_hot = hot[bucket[first]]
                classes.append(c)
                prefixes.append(_signed(s[first[~is_hot]]))
                hots.append(_signed(s[first[is_hot]]))
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(prefixes, many), pa.array(hots, many)],
                ["class", "prefix", "hot"])

    return _texts(docs).select("text").mapInArrow(
        run, "class long, prefix array<long>, hot array<long>")


def array_pass(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """class, hashes: of documents whose id the bit field ``wanted`` may contain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            bits = wanted[(ids & (len(wanted) * 64 - 1)) >> 6] >> (ids & 63).astype(np.uint64)
            some = b.filter(pa.array((bits & np.uint64(1)).astype(bool)))
            sets = [s for s in shingle_sets(some.column(1).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "hashes"])

    return _texts(docs).mapInArrow(run, "class long, hashes binary")


# ---------------------------------------------------------------- candidates

def shared_prefixes(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(token, class, weight): prefix shingles of two or more classes, one for each set
    of classes, which stands for ``weight`` shingles; (class, shared): how many shared
    shingles each class's prefix has."""
    spark = prefixes.sparkSession
    # One pass gives both kinds; a shingle that isn't hot has a bounded number of rows.
    # Hot rows are spread over the tasks by their class.
    both = prefixes.select("class", F.explode(F.concat(
        F.transform("prefix", lambda t: F.struct(t.alias("token"), F.lit(None).cast("long").alias(
            "spread"))),
        F.transform("hot", lambda t: F.struct(t.alias("token"), F.col("class").alias("spread"))))
    ).alias("t")).select("t.token", "t.spread", "class")
    over = Window.partitionBy("token", "spread")
    rows = (both.withColumn("lo", F.min("class").over(over))
            .withColumn("hi", F.max("class").over(over))
            .filter(F.col("spread").isNotNull() | (F.col("lo") < F.col("hi")))
            .select("token", "class").distinct())
    rows = written(spark, rows, "op7-tokens")
    sets = rows.groupBy("token").agg(
        F.count("*").alias("size"), F.min("class").alias("lo"), F.max("class").alias("hi"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64("class", F.lit(1))).alias("xor"))
    one = sets.groupBy("size", "lo", "hi", "sum", "xor").agg(
        F.min("token").alias("token"), F.count("*").alias("weight"))
    return (written(spark, rows.join(one.select("token", "weight"), "token"), "op7-shared"),
            rows.groupBy("class").agg(F.count("*").alias("shared")))


def star_pairs(shared: DataFrame, degrees: DataFrame, classes: DataFrame) -> DataFrame:
    """a < b: every class with that centre of its shingles with which it shares most of them."""
    central = degrees.join(classes.select("class", "n"), "class").select(
        "class", (F.col("shared") / (F.floor(F.col("n") / 4) + 1)).alias("central"))
    disturbed = F.col("central") * (F.lit(0.9) + F.pmod(F.xxhash64("class"), F.lit(100)) / 1000)
    two = shared.join(central, "class").groupBy("token").agg(
        F.max(F.struct("central", "class")).alias("p"),
        F.max(F.struct(disturbed.alias("central"), "class")).alias("q"))
    centres = two.select("token", F.explode(F.array_distinct(F.array("p.class", "q.class"))).alias("b"))
    met = (shared.withColumnRenamed("class", "a").join(centres, "token")
           .filter(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.sum("weight").alias("w")))
    best = met.groupBy("a").agg(F.max_by("b", F.struct("w", "b")).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs`` that their bitmaps let pass: a, b, near (at most this
    Jaccard similarity)."""
    side = lambda x: classes.select(
        F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            maps = [batch.column(c).to_pylist() for c in ("bits_a", "bits_b")]
            width = [np.array([len(m) for m in ms], np.int64) // 8 for ms in maps]
            most = np.zeros(len(n_a), np.int64)
            for w_a, w_b in {*zip(width[0].tolist(), width[1].tolist(), strict=True)}:
                at = np.flatnonzero((width[0] == w_a) & (width[1] == w_b))
                x, y = (folded(np.frombuffer(b"".join([ms[i] for i in at]), np.uint64)
                               .reshape(len(at), w), min(w_a, w_b))
                        for ms, w in zip(maps, (w_a, w_b), strict=True))
                most[at] = overlap_bound(x, y, n_a[at], n_b[at])
            keep = similar(most, n_a, n_b)
            yield _scored(batch.column("a").to_numpy()[keep], batch.column("b").to_numpy()[keep],
                          (most / np.maximum(n_a + n_b - most, 1))[keep])

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, SCORED)


SCORED = "a long, b long, near double"


def _scored(a, b, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near, pa.float64())],
        ["a", "b", "near"])


def few_pairs(members: DataFrame) -> DataFrame:
    """a < b: pairs of different roots and similar size in each token."""
    side = lambda x: members.select(
        "token", F.col("class").alias(x), F.col("root").alias(f"r_{x}"), F.col("n").alias(f"n_{x}"))
    return (side("a").join(side("b"), "token")
            .filter((F.col("a") < F.col("b")) & (F.col("r_a") != F.col("r_b"))
                    & (4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")))
            .select("a", "b").distinct())


def tiled_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """a < b: pairs of different roots that the (folded) bitmaps let pass in a tile."""
    tile = ["token", "tile_band", "across", "i", "j"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = [folded(np.frombuffer(m, np.uint64), TILE_BYTES // 8).tobytes()
                    for m in b.column("bitmap").to_pylist()]
            yield b.set_column(b.num_columns - 1, "bitmap", pa.array(maps, pa.binary()))

    # A class has at most its prefix's tokens here.
    firsts = members.groupBy("class").agg(F.slice(
        F.array_sort(F.collect_set("token")), 1, FIRST_TOKENS).alias("firsts"))
    small = classes.select("class", "bitmap").mapInArrow(fold, "class long, bitmap binary")
    rows = tile_rows(members).join(small.join(firsts, "class"), "class").select(
        *tile, "part", "class", "root", "n", "bitmap", "firsts")
    return (rows.repartition(*tile).sortWithinPartitions(*tile)
            .mapInArrow(_run_tiles, "a long, b long").distinct())


def tile_rows(members: DataFrame) -> DataFrame:
    """``members``: token, class, root, n. A row per member and tile:
    token, band, next (whether across two bands), i, j, part, and the member."""
    members = members.withColumn("band", F.floor(
        F.log(F.col("n").cast("double")) / F.log(F.lit(4.0 / 3.0)) + 1e-9))
    blocks = members.groupBy("token", "band").agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks"))
    shifted = lambda d, name: blocks.select(
        "token", (F.col("band") + d).alias("band"), F.col("blocks").alias(name))
    m = (members.join(blocks, ["token", "band"])
         .join(shifted(-1, "above"), ["token", "band"], "left")
         .join(shifted(1, "below"), ["token", "band"], "left")
         .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks"))))
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    tile = lambda band, across, i, j, part: F.struct(
        band.alias("band"), F.lit(across).alias("across"), i.alias("i"), j.alias("j"),
        part.cast("int").alias("part"))
    own, band = F.col("own"), F.col("band")
    none = F.array().cast(
        "array<struct<band:bigint,across:boolean,i:bigint,j:bigint,part:int>>")
    tiles = F.concat(
        F.transform(up_to(F.col("blocks")), lambda k: tile(
            band, False, F.least(own, k), F.greatest(own, k), own > k)),
        F.when(F.col("above").isNotNull(), F.transform(up_to(F.col("above")), lambda k: tile(
            band, True, own, k, F.lit(0)))).otherwise(none),
        F.when(F.col("below").isNotNull(), F.transform(up_to(F.col("below")), lambda k: tile(
            band - 1, True, k, own, F.lit(1)))).otherwise(none))
    return m.select("token", F.explode(tiles).alias("t"), "class", "root", "n").select(
        "token", F.col("t.band").alias("tile_band"), "t.across", "t.i", "t.j", "t.part",
        "class", "root", "n")


def tile_pairs(rows: list[tuple], token: int, within: bool) -> list[tuple[int, int]]:
    """Pairs of one tile that may link: of different roots, by bitmaps. Classes that
    share several tokens meet in a tile of each; the smallest one that both have among
    their first tokens has the pair (without such a one, all of them).
    ``rows``: part, class, root, n, bitmap, firsts."""
    if len({r[2] for r in rows}) < 2:
        return []
    least = min(len(r[4]) for r in rows) // 8
    words = np.stack([folded(np.frombuffer(r[4], np.uint64), least) for r in rows])
    part, cls, root, n = (np.array([r[k] for r in rows]) for k in range(4))
    out = []
    places = np.arange(len(rows))
    for i in places:
        if not within and part[i]:
            continue
        others = places[i + 1:] if within else np.flatnonzero(part == 1)
        others = others[root[others] != root[i]]
        bound = overlap_bound(words[i], words[others], n[i], n[others])
        for k in others[similar(bound, n[i], n[others])]:
            if token == min(set(rows[i][5]).intersection(rows[k][5]), default=token):
                out.append((int(min(cls[i], cls[k])), int(max(cls[i], cls[k]))))
    return out


def _run_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by tile; a tile may go on in the next batch."""

    def flush() -> list[tuple[int, int]]:
        return tile_pairs(held, key[0], not key[2] and key[3] == key[4]) if held else []

    key, held = None, []
    for b in batches:
        pairs: list[tuple[int, int]] = []
        cols = [c.to_pylist() for c in b.columns]
        for row in zip(*cols, strict=True):
            if row[:5] != key:
                pairs += flush()
                key, held = row[:5], []
            held.append(row[5:])
        yield _pairs(pairs)
    yield _pairs(flush())


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    found = sorted(set(pairs))
    return pa.RecordBatch.from_arrays(
        [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])


# ---------------------------------------------------------------- exact tests and components

def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame,
             overlap: bool = False) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, by the exact sets, which are made from
    one document of each class; on demand with the number of shingles that both have."""
    spark = pairs.sparkSession
    ids = written(spark, pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
                  .join(classes.select("class", "doc_id"), "class"), "op7-ids")
    key = F.coalesce("doc_id", F.lit(0).cast("long"))
    word = F.shiftright(key.bitwiseAND(F.lit(FILTER_WORDS * 64 - 1)), 6).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    field = np.zeros(FILTER_WORDS, np.uint64)
    for r in ids.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).collect():
        field[r["w"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF  # at most FILTER_WORDS rows
    found = array_pass(docs, field)
    one = found.join(ids.select("class"), "class", "left_semi").groupBy("class").agg(
        F.any_value("hashes").alias("hashes"))
    arrays = written(spark, one, "op7-arrays")
    both = (pairs.join(arrays.select(F.col("class").alias("a"), F.col("hashes").alias("h_a")), "a")
            .join(arrays.select(F.col("class").alias("b"), F.col("hashes").alias("h_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, shared = [], []
            for x, y in zip(b.column("h_a").to_pylist(), b.column("h_b").to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both_ = np.intersect1d(s, t, assume_unique=True)
                keep.append(bool(similar(len(both_), len(s), len(t))))
                shared.append(len(both_))
            out = b.select(["a", "b"])
            if overlap:
                out = out.append_column("overlap", pa.array(shared, pa.int64()))
            yield out.filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "h_a", "h_b").mapInArrow(
        run, "a long, b long" + (", overlap long" if overlap else ""))


def components(links: DataFrame) -> DataFrame:
    """class, root: the smallest class that is reachable, for all classes with links."""
    spark = links.sparkSession
    edges = written(spark, links.select(F.explode(F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
        F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e")).select("e.*"),
        "op7-edges")
    labels = written(spark, edges.groupBy(F.col("x").alias("class")).agg(
        F.least(F.min("y"), F.col("x")).alias("root")), "op7-labels")
    while True:
        near = (edges.join(labels.select(F.col("class").alias("y"), "root"), "y")
                .groupBy(F.col("x").alias("class")).agg(F.min("root").alias("near")))
        hooked = labels.join(near, "class").select(
            "class", F.col("root").alias("old"), F.least("root", "near").alias("up"))
        jump = labels.select(F.col("class").alias("up"), F.col("root").alias("next"))
        new = written(spark, hooked.join(jump, "up").select(
            "class", "old", F.least("up", "next").alias("root")), "op7-labels")
        labels = new.select("class", "root")
        if new.filter(F.col("old") != F.col("root")).isEmpty():
            return labels


# ---------------------------------------------------------------- the join

def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose roots differ, with these in order: r_a < r_b."""
    for x in ("a", "b"):
        pairs = (pairs.join(roots.select(F.col("class").alias(x), F.col("root").alias(f"root_{x}")),
                            x, "left").withColumn(f"root_{x}", F.coalesce(f"root_{x}", x)))
    return pairs.filter(F.col("root_a") != F.col("root_b")).select(
        "a", "b", "near", F.least("root_a", "root_b").alias("r_a"),
        F.greatest("root_a", "root_b").alias("r_b"))


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows with size and class, classes, and the shingles that prefixes share, with degrees."""
    spark = docs.sparkSession
    passed = written(spark, set_pass(docs), "op7-sets")
    counters = counter_table(passed)
    rows = passed.filter(F.col("block").isNull()).drop("block", "counts")
    classes = written(spark, rows.filter(F.col("n") > 0).groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"),
        F.any_value("bitmap").alias("bitmap")), "op7-classes")

    return rows, classes, *shared_prefixes(prefix_pass(docs, counters))


def candidates(rooted: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of different roots that share a shingle of their prefixes and may link."""
    open_ = (rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                         F.count("*").alias("size"))
             .filter(F.col("lo") != F.col("hi")).select("token", "size"))
    members = rooted.join(open_, "token").join(classes.select("class", "n"), "class")
    members = written(rooted.sparkSession, members, "op7-open")
    return few_pairs(members.filter(F.col("size") <= FEW)).unionByName(
        tiled_pairs(members.filter(F.col("size") > FEW), classes)).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), n, class, root: one row per row of
    ``docs``; classes of one root are connected. No class and root without words."""
    spark = docs.sparkSession
    rows, classes, shared, degrees = prepared(docs)
    tried = written(spark, bounded(star_pairs(shared, degrees, classes), classes).select("a", "b"),
                    "op7-stars")
    links = written(spark, verified(tried, classes, docs), "op7-links")
    roots = components(links)

    rooted = (shared.drop("weight").join(roots, "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    made = candidates(rooted, classes)
    pairs = written(spark, bounded(made.join(tried, ["a", "b"], "left_anti"), classes), "op7-pairs")
    for nearest in (True, False):
        left = apart(pairs, roots)
        if nearest:
            left = left.groupBy("r_a", "r_b").agg(
                F.max_by(F.struct("a", "b"), F.struct("near", "a", "b")).alias("p")).select("p.*")
        left = written(spark, left.select("a", "b"), "op7-left")
        if left.isEmpty():
            break
        links = links.unionByName(written(spark, verified(left, classes, docs), "op7-links"))
        roots = components(links)
        pairs = pairs.join(left, ["a", "b"], "left_anti")

    return rows.join(roots, "class", "left").select(
        "doc_id", "digest", "n", "class", F.coalesce("root", "class").alias("root"))


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id: one row per row of ``docs``."""
    rows = grouped(docs)
    smallest = rows.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"), F.col("class").alias("class_id"))


def linked_classes(docs: DataFrame) -> DataFrame:
    """class_a < class_b, overlap: all pairs of classes that link, also inside one component,
    with the number of shingles that both have. ``ngram_join`` gives each row's class; rows of one
    class link with overlap ``n_shingles``. As large as there are links."""
    spark = docs.sparkSession
    _, classes, shared, _ = prepared(docs)
    # Every class its own root: no pair is left out.
    made = candidates(shared.drop("weight").withColumn("root", F.col("class")), classes)
    pairs = written(spark, bounded(made, classes).select("a", "b"), "op7-pairs")
    return verified(pairs, classes, docs, overlap=True).select(
        F.col("a").alias("class_a"), F.col("b").alias("class_b"), "overlap")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the one with the smallest
    (doc_id, digest of the text), null ids last; of equal rows one. Documents
    without words all stay, but for repeats of the same id and text."""
    names = docs.columns
    doc, digest, count = (fresh(names, c) for c in ("_doc", "_digest", "_nth"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    rows = grouped(docs)
    kept = (rows.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(place).alias("p"))
            .select("p.doc_id", "p.digest")
            .unionByName(rows.filter(F.col("root").isNull()).select("doc_id", "digest").distinct())
            .select(F.col("doc_id").alias(doc), F.col("digest").alias(digest)))
    own = F.xxhash64(text_or_empty(F.col("text")))
    held = docs.join(kept.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(
        F.col(doc)) & (own == F.col(digest)), "inner")
    nth = F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(F.lit(0)))
    return held.withColumn(count, nth).filter(F.col(count) == 1).select(
        *[F.col(f"`{c}`") for c in names])
