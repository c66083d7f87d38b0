"""Operator 6 - document fingerprints: invertible Bloom lookup sketches.

A text is a set of 64-bit digests of its paragraphs, long paragraphs being cut
into runs of at most ``WORDS`` words. The sketch has a number of cells; each
digest goes to three of them, one in each third, and a cell keeps the count,
the xor of digests and the xor of their checks. Two sketches of one size
subtract cell by cell: what both texts hold vanishes. Peeling then takes
digests out of cells that hold a single one, until nothing is left: these are
the digests in which the texts differ. If some cells stay, both
sketches are made again four times as large (with other places), until peeling
succeeds. The fingerprint is the sketch of the first size with the set's size,
in hexadecimal: it has a fixed length and equal texts have equal ones.

Likeness = digests in both / digests in either, by the recovered difference:
(a + b - d) / (a + b + d). Two empty sets are alike (1.0).

Whole batches are sketched and peeled at once. ``sketches`` and ``difference``
serve any two texts; ``fingerprint_edits`` is the registered query's job: it
compares each document with its edited text and with the next document (by
descending id). Rows are dealt into id ranges; each range's tasks get the first
document of the next range too, so no text moves but once.

Defined results: null text counts as empty; a null doc_id sorts last; rows with
the same id are ordered by text, descending, and the next one may be such a
row; a single document's next one is itself; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netcap.llm.common import text_or_empty

CELLS = 48          # of the first sketch; a multiple of three
GROWTH = 4          # of each retry
WORDS = 4           # of a paragraph's runs, at most
BATCH_CHARS = 4_000_000
ROWS_PER_RANGE = 4096
MAX_RANGES = 20_000

RUN = re.compile(r"[^\s]+(?:[^\S\n]+[^\s]+){0,%d}" % (WORDS - 1))
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; other seeds give independent values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def digests(text: str) -> np.ndarray:
    """The text's set of paragraph digests, sorted."""
    found = {xxhash.xxh3_64_intdigest(run) for run in RUN.findall(text)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


class Sketches:
    """Sketches of several sets, all with ``cells`` cells."""

    def __init__(self, owner: np.ndarray, values: np.ndarray, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int32)
        self.keys = np.zeros(n * cells, np.uint64)
        self.checks = np.zeros(n * cells, np.uint32)
        self.add(owner, values, np.ones(len(values), np.int32))

    def places(self, owner: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
        third = self.cells // 3
        return [owner * self.cells + j * third
                + (_mix(values, 3 * self.cells + j) % np.uint64(third)).astype(np.int64)
                for j in range(3)]

    def add(self, owner: np.ndarray, values: np.ndarray, sign: np.ndarray) -> None:
        check = check_of(values)
        for at in self.places(owner, values):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, values)
            np.bitwise_xor.at(self.checks, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(np.empty(0, np.int64), np.empty(0, np.uint64), self.n, self.cells)
        out.count = self.count - other.count
        out.keys = self.keys ^ other.keys
        out.checks = self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """(how many digests came out, whether all did) of each set; empties the cells."""
        found = np.zeros(self.n, np.int64)
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (check_of(self.keys) == self.checks))
            if not len(pure):
                break
            owner, value, sign = pure // self.cells, self.keys[pure], self.count[pure]
            # One digest may be alone in up to three cells: take it once.
            _, once = np.unique(np.stack([owner.astype(np.uint64), value]), axis=1,
                                return_index=True)
            owner, value, sign = owner[once], value[once], sign[once]
            self.add(owner, value, -sign)
            np.add.at(found, owner, 1)
        rest = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        return found, ~rest.reshape(self.n, self.cells).any(axis=1)

    def texts(self, sizes: np.ndarray) -> list[str]:
        """The fingerprints, ``sizes`` being the sets'."""
        rows = np.concatenate([
            sizes.astype("<u4").reshape(-1, 1).view(np.uint8),
            self.count.astype("<u2").reshape(self.n, -1).view(np.uint8),
            self.keys.astype("<u8").reshape(self.n, -1).view(np.uint8),
            self.checks.astype("<u4").reshape(self.n, -1).view(np.uint8)], axis=1)
        return [r.tobytes().hex() for r in rows]


def check_of(values: np.ndarray) -> np.ndarray:
    return (_mix(values, 0) >> np.uint64(32)).astype(np.uint32)


def sketches(sets: list[np.ndarray], cells: int = CELLS) -> Sketches:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return Sketches(owner, values, len(sets), cells)


def difference(a: list[np.ndarray], b: list[np.ndarray], first_a: Sketches,
               first_b: Sketches) -> np.ndarray:
    """Number of digests in which a[i] and b[i] differ, by peeling; failures are
    tried again with larger sketches. ``first_a`` and ``first_b``: their sketches."""
    out, done = first_a.minus(first_b).peel()
    cells = first_a.cells
    left = np.flatnonzero(~done)
    while len(left):
        cells *= GROWTH
        at, done = sketches([a[i] for i in left], cells).minus(
            sketches([b[i] for i in left], cells)).peel()
        out[left] = at
        left = left[~done]
    return out


def likeness(a: np.ndarray, b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    either = (a + b + differ) / 2.0
    return np.where(either > 0, (a + b - differ) / 2.0 / np.maximum(either, 1.0), 1.0)


def _batch(rows: list[tuple[int | None, str]], after: str) -> pa.RecordBatch:
    """Result of consecutive documents; ``after``: text of the one behind the last."""
    texts = [t for _, t in rows]
    following = [*texts[1:], after]
    edited = []
    for text, nxt in zip(texts, following, strict=True):
        cut = len(text) // 3
        edited.append(text[:len(text) - cut] + nxt[:cut])
    own = [digests(t) for t in [*texts, after]]
    changed = [digests(t) for t in edited]
    sizes, sizes_e = (np.array([len(s) for s in x], np.int64) for x in (own, changed))
    sk, sk_e = sketches(own), sketches(changed)
    n, c = len(rows), sk.cells
    first, second = sketches([]), sketches([])
    for part, lo in ((first, 0), (second, 1)):
        part.n, part.cells = n, c
        part.count, part.keys, part.checks = (
            x[lo * c:(lo + n) * c] for x in (sk.count, sk.keys, sk.checks))
    near_e = likeness(sizes[:n], sizes_e, difference(own[:n], changed, first, sk_e))
    near_n = likeness(sizes[:n], sizes[1:], difference(own[:n], own[1:], first, second))
    return pa.RecordBatch.from_arrays([
        pa.array([d for d, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array(first.texts(sizes[:n])), pa.array(sk_e.texts(sizes_e)),
        pa.array(near_e), pa.array(near_n)], [f.split()[0] for f in RESULT.split(", ")])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, in order, each range ended by a row of another one."""
    held: list[tuple[int | None, str]] = []
    chars = 0
    for b in batches:
        for doc, text, is_end in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                                     b.column("is_end").to_pylist(), strict=True):
            if held and (is_end or chars >= BATCH_CHARS):
                yield _batch(held, text)
                held, chars = [], 0
            if not is_end:
                held.append((doc, text))
                chars += len(text)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the rising ``bounds`` the value has reached, in two steps of
    about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = ceil(sqrt(len(bounds)))
    parts = [bounds[k:k + step] for k in range(0, len(bounds), step)]
    reached = lambda some: F.size(F.filter(some, lambda x: x <= value))
    part = reached(F.lit([p[0] for p in parts]).cast("array<long>"))
    within = F.element_at(F.array(*[F.lit(p).cast("array<long>") for p in parts]),
                          F.greatest(part, F.lit(1)))
    return F.when(part == 0, F.lit(0)).otherwise((part - 1) * step + reached(within))


def fingerprint_edits(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    text_or_empty(F.col("text")).alias("text"))
    ids = d.select("doc_id")
    n = ids.count()
    ranges = min(MAX_RANGES, max(1, -(-n // rows_per_range)))
    # One number per range goes to the driver; the ranges needn't be even.
    bounds = sorted(set(ids.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)],
                                           0.25 / ranges)
                        )) if ranges > 1 else []
    place = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        _range_of(F.col("doc_id"), [int(x) for x in bounds]))
    d = d.withColumn("range", place)
    # Ranges run downwards: the first document of a range has its highest id and text.
    firsts = ids.withColumn("range", place).groupBy("range").agg(F.max("doc_id").alias("doc_id"))
    heads = sorted(((r["range"], r["doc_id"]) for r in firsts.collect()), reverse=True)
    if not heads:
        return spark.createDataFrame([], RESULT)
    before = [heads[i - 1][0] for i in range(len(heads))]  # the first one ends the last
    ends = spark.createDataFrame(
        [(doc, of) for (_, doc), of in zip(heads, before, strict=True)], "doc_id long, of int")
    # At most MAX_RANGES pairs of numbers; a join by shuffle would move all texts once more.
    ends = (d.join(F.broadcast(ends.withColumnRenamed("doc_id", "head")),
                   F.col("doc_id").eqNullSafe(F.col("head")))
            .groupBy("of").agg(F.max("text").alias("text"))
            .select(F.lit(None).cast("long").alias("doc_id"), "text",
                    F.col("of").alias("range"), F.lit(True).alias("is_end")))
    dealt = (d.withColumn("is_end", F.lit(False)).unionByName(ends).repartition("range")
             .sortWithinPartitions("range", "is_end", F.desc_nulls_last("doc_id"),
                                   F.desc("text")))
    return dealt.select("doc_id", "text", "is_end").mapInArrow(_run, RESULT)
