"""Operator 4 - line dedup by winnowing over line hashes.

What goes: every line that lies in a run of lines with ``MIN_WORDS`` words or more which
occurs earlier too, in another document or the same one; the run's first place stays.

A window is as few whole lines as hold ``MIN_WORDS`` words, counted from its first line
forwards or from its last line backwards. The line with the smallest hash in a window is
its fingerprint; neighbouring windows mostly share theirs. Equal runs with so many words
contain equal windows, so they share fingerprints: that is guaranteed.

1. Each text gives its windows: position, fingerprint (the window's minimum), hash of the
   lines.
2. Positions are joined by fingerprint: fingerprints met only once in the corpus leave,
   with their windows.
3. Where a fingerprint meets, its match is extended both ways: the windows that begin and
   that end with each line around it are compared, by content, with all other places of
   that fingerprint; each finds its first occurrence, by (doc_id, text digest, line).
4. Windows that have an earlier equal are matches. Each line of a repeated run lies in a
   window, of either kind, inside that run: overlapping and touching matches grow together,
   to the run's first and last line, however short those are.
5. The runs' lines are deleted from the later places; the first stays.

Comparing with every earlier place this way, not with one of them, keeps the extension
whole: a run that goes on beside its second place only is found too. Counting and first
occurrences aggregate before the shuffle, so a line that is everywhere arrives as a row
per task. No pairs are made. A window's hash has 128 bits. Lines are compared without the
white space around them; white space is ASCII's, for words too.

Defined results: null and empty texts have no windows and stay (null text
counts as empty); lines without words go if a deleted run spans them, else
they stay. Rows with equal doc_id and text are the same
document: each gets the same result. A null doc_id sorts first. Equal doc_ids with
different texts are ordered by the texts' digests. A very long text is worked on as a
whole in its task, some ten numbers a line; its windows leave in Arrow batches. An empty table
gives no rows. Extra columns are kept by ``dedup_lines``, under their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from netcap.llm.common import fresh, text_or_empty, with_fields, written

MIN_WORDS = 10   # of a repeated run that is deleted

WINDOWS = ("doc_id long, digest long, first int, last int, fingerprint long, "
           "hash_hi long, hash_lo long")
_SIGN = 1 << 63


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def text_windows(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, int]]:
    """(first line, last line, fingerprint, content hash: two halves) of each window."""
    lines = [(k, s) for k, line in enumerate(text.split("\n")) if (s := line.encode().strip())]
    if not lines:
        return []
    hashes = [xxhash.xxh3_64_intdigest(s) for _, s in lines]
    words = np.cumsum([0] + [len(s.split()) for _, s in lines])
    # Of each line, the one with which the window is full.
    ends = np.searchsorted(words, words[:-1] + min_words, side="left")
    # And the one from which a window that ends with it is full.
    starts = np.searchsorted(words, words[1:] - min_words, side="right") - 1
    spans = sorted({*((i, e) for i, e in enumerate(ends.tolist()) if e <= len(lines)),
                    *((i, k + 1) for k, i in enumerate(starts.tolist()) if i >= 0)})
    out = []
    for i, e in spans:
        own = hashes[i:e]
        content = xxhash.xxh3_128_intdigest(b"\n".join([s for _, s in lines[i:e]]))
        out.append((lines[i][0], lines[e - 1][0], _signed(min(own)), _signed(content >> 64),
                    _signed(content & (1 << 64) - 1)))
    return out


def text_digest(text: Column) -> Column:
    return F.xxhash64(text_or_empty(text))


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of lines out of matched windows."""
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WINDOWS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for b in batches:
            rows = []
            for doc, digest, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += [(doc, digest, *w) for w in text_windows(text, min_words)]
            cols = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_digest(F.col("text")).alias("digest"),
                       text_or_empty(F.col("text")).alias("text")).mapInArrow(run, WINDOWS)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, digest, runs (array of (first, last)): what to delete of each document.

    The small sides of the joins, one row per key, are written first: a join of two
    plain shuffles can be split where a key is hot, one behind an aggregate can't."""
    spark = docs.sparkSession
    w = written(spark, windows(docs, min_words), "op4-windows")
    place = F.struct("doc_id", "digest", "first")
    # A fingerprint with one place only has nothing to match.
    met = (w.groupBy("fingerprint").agg(F.min(place).alias("a"), F.max(place).alias("b"))
           .filter(F.col("a") < F.col("b")).select("fingerprint"))
    shared = w.join(written(spark, met, "op4-met"), "fingerprint", "left_semi")
    content = ["hash_hi", "hash_lo"]  # which say the fingerprint too
    earliest = (shared.groupBy(*content)
                .agg(F.min(place).alias("a"), F.max(place).alias("b"))
                .filter(F.col("a") < F.col("b")).select(*content, "a"))
    later = shared.join(written(spark, earliest, "op4-first"), content).filter(place > F.col("a"))
    return (later.groupBy("doc_id", "digest")
            .agg(F.collect_set(F.struct("first", "last")).alias("runs")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, lines: str = "_lines",
                deleted: str = "_deleted") -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without repeated runs, and
    the numbers of lines before and deleted."""
    names = docs.columns
    key, digest, own = fresh(names, "_id"), fresh(names, "_digest"), fresh(names, "_runs")
    # By id and text: rows of one id, or without any, needn't meet in one group.
    runs = repeated_runs(docs, min_words).select(
        F.col("doc_id").alias(key), F.col("digest").alias(digest), F.col("runs").alias(own))
    joined = docs.join(runs.hint("shuffle_hash"),
                       F.col("doc_id").cast("long").eqNullSafe(F.col(key))
                       & (text_digest(F.col("text")) == F.col(digest)), "left").drop(key, digest)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, total, gone = [], [], []
            for text, runs in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist(),
                                  strict=True):
                text, n, k = without_runs(text, runs or [])
                texts.append(text)
                total.append(n)
                gone.append(k)
            cols = list(b.columns[:len(names)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(total, pa.int32()), pa.array(gone, pa.int32())],
                [*names, lines, deleted])

    return joined.mapInArrow(run, with_fields(
        docs, **{lines: IntegerType(), deleted: IntegerType()}))


def without_runs(text: str | None, runs: list[dict]) -> tuple[str | None, int, int]:
    """The text left, its number of lines before, and of deleted ones."""
    if not text:
        return text, 0, 0
    lines, gone = text.split("\n"), set()
    for first, last in merge_runs([(r["first"], r["last"]) for r in runs]):
        gone.update(range(first, last + 1))
    if gone:
        text = "\n".join([s for k, s in enumerate(lines) if k not in gone])
    return text, len(lines), len(gone)


def line_dedup_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_deleted, kept_chars, kept_md5 of every document."""
    out = dedup_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  text_or_empty(F.col("text")).alias("text")), min_words)
    return out.select("doc_id", F.col("_lines").alias("n_lines"),
                      F.col("_deleted").alias("n_deleted"), F.length("text").alias("kept_chars"),
                      F.md5("text").alias("kept_md5"))
