"""Operator 8 - language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (from a hash of its code point).
A trigram's vector binds its letters' vectors, rotated by their place, by
multiplication. A text's profile bundles (adds) the vectors of all its trigrams of
lower-case letters, runs of other characters counting as one gap. A language's prototype
bundles the profiles of all training documents of that language. The prediction
is the prototype of the highest cosine with the document's profile, both
less the mean direction of the prototypes; the score is the plain cosine.

Training sums whole numbers per task, then per (language, dimension) in Spark:
the result doesn't depend on the order. What goes to the driver, and back to
the tasks, is one vector per language. All training documents count, whole.

Defined results: null text, or text without letters: ``und``, score 0. Rows
with null lang or null doc_id don't train; a null doc_id counts as held out.
Repeated rows count as often as they come. Equal cosines: the first name.
Without any training row all is ``und``. Extra columns are ignored; an empty
table gives no rows. Texts of any length count whole: they are cut into parts of
``PART_CHARS`` code points whose profiles add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from netcap.llm.common import text_or_empty, with_fields

DIMENSIONS = 1024
UNDETERMINED = "und"
BATCH_CHARS = 1_000_000
PART_CHARS = 250_000
FOLDS = 5

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_vectors(codes: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """+1 and -1 by a hash of the code point; the gap (0) has a vector too."""
    words = dimensions // 64
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64)[:, None] * np.uint64(words)
             + np.arange(1, words + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def trigram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Letters' vectors rotated by 2, 1 and 0 places and multiplied."""
    parts = [(grams >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (42, 21, 0)]
    letters, at = np.unique(np.concatenate(parts), return_inverse=True)
    vectors, at = letter_vectors(letters, dimensions), at.reshape(3, -1)
    return (np.roll(vectors, 2, axis=1)[at[0]] * np.roll(vectors, 1, axis=1)[at[1]]
            * vectors[at[2]])


def parts(text: str) -> Iterator[tuple[str, bool, bool]]:
    """A lower-cased text cut into parts of ``PART_CHARS``, each with its neighbouring
    code point, if any, on either side: (part, one before, one behind). A trigram's middle
    letter is in one part only."""
    for at in range(0, max(len(text), 1), PART_CHARS):
        before, behind = at > 0, at + PART_CHARS < len(text)
        yield text[at - before:at + PART_CHARS + behind], before, behind


def trigrams(cut: list[tuple[str, bool, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of the parts; of each one met, its part and its place among these."""
    sizes = np.array([len(t) + 1 for t, _, _ in cut])
    codes = np.frombuffer("".join([f"\0{t}" for t, _, _ in cut] + ["\0"]).encode("utf-32-le"),
                          np.uint32)
    owner = np.append(np.repeat(np.arange(len(cut)), sizes), len(cut))
    ends = sizes.cumsum() if len(sizes) else np.array([], int)
    inner = np.ones(len(codes), bool)          # no neighbour of a part
    inner[(ends - sizes + 1)[[before for _, before, _ in cut]] if cut else []] = False
    inner[(ends - 1)[[behind for _, _, behind in cut]] if cut else []] = False
    letter = _letters()[codes]
    codes = np.where(letter, codes, 0).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]        # the first of each run of other characters
    keep[ends[:-1]] = True
    keep[:1] = True
    codes, owner, inner = codes[keep], owner[keep], inner[keep]
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    # A gap may stand first or last. The part's end is the gap of the next one.
    whole = (b != 0) & inner[1:-1] & (owner[:-2] == owner[1:-1])
    whole &= (owner[2:] == owner[1:-1]) | (c == 0)
    grams = (a[whole] << np.uint64(42)) | (b[whole] << np.uint64(21)) | c[whole]
    distinct, at = np.unique(grams, return_inverse=True)
    return distinct, owner[1:-1][whole], at


def bundles(of: np.ndarray, at: np.ndarray, n: int, vectors: np.ndarray) -> np.ndarray:
    """Sums of trigram vectors for each of ``n`` texts (or languages)."""
    out = np.zeros((n, vectors.shape[1]))
    v = len(vectors)
    if not v:
        return out
    dense = vectors.astype(np.float32)
    step = max(1, 2_000_000 // v)
    order = np.argsort(of, kind="stable")
    of, at = of[order], at[order]
    for lo in range(0, n, step):
        s, e = np.searchsorted(of, [lo, lo + step])
        rows = min(step, n - lo)
        counts = np.bincount((of[s:e] - lo) * v + at[s:e], minlength=rows * v).reshape(rows, v)
        out[lo:lo + rows] = counts.astype(np.float32) @ dense
    return out


def profiles(texts: list[str], of: np.ndarray, n: int, dimensions: int) -> np.ndarray:
    """Sums of the profiles of all texts with the same number (below ``n``) in ``of``.
    Parts are bundled by about ``BATCH_CHARS``, however long a text is."""
    out = np.zeros((n, dimensions))
    cut, owner, chars = [], [], 0

    def add() -> None:
        grams, part, at = trigrams(cut)
        rows, place = np.unique(np.array(owner), return_inverse=True)
        out[rows] += bundles(place[part], at, len(rows), trigram_vectors(grams, dimensions))

    for text, row in zip(texts, of, strict=True):
        for piece in parts(text.lower()):
            cut.append(piece)
            owner.append(row)
            chars += len(piece[0])
            if chars >= BATCH_CHARS:
                add()
                cut, owner, chars = [], [], 0
    if cut:
        add()
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``BATCH_CHARS`` bytes of text in each."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(
            zero_copy_only=False).cumsum()
        part = size // BATCH_CHARS
        for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.concatenate(
                [[0], np.flatnonzero(np.diff(part)) + 1, [len(size)]])), strict=True):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def train(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """``docs``: lang, text. Prototype of every language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in _pieces(batches):
            names, lang = np.unique(b.column("lang").to_numpy(zero_copy_only=False).astype(str),
                                    return_inverse=True)
            found = profiles(b.column("text").to_pylist(), lang, len(names), dimensions)
            for name, row in zip(names, np.rint(found).astype(np.int64), strict=True):
                sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions)), pa.array(row)],
                ["lang", "dim", "value"])

    parts = docs.mapInArrow(run, "lang string, dim long, value long")
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect():
        out.setdefault(r["lang"], np.zeros(dimensions))[r["dim"]] = r["value"]
    return out


def classify(texts: list[str], names: list[str], prototypes: np.ndarray) -> tuple[list, np.ndarray]:
    """Language and score of each text; ``prototypes``: one row per name, of length 1."""
    found = profiles(texts, np.arange(len(texts)), len(texts), prototypes.shape[1])
    norm = np.sqrt((found ** 2).sum(axis=1))
    found /= np.maximum(norm, 1e-30)[:, None]
    mean = prototypes.mean(axis=0)
    central = prototypes - mean
    central /= np.maximum(np.sqrt((central ** 2).sum(axis=1)), 1e-30)[:, None]
    # The document's own mean part shifts all cosines alike per prototype: less it, too.
    near = (found - mean) @ central.T
    best = near.round(9).argmax(axis=1)
    score = np.clip((found * prototypes[best]).sum(axis=1), 0.0, 1.0)
    none = norm == 0
    return ([UNDETERMINED if n else names[k] for n, k in zip(none, best, strict=True)],
            np.where(none, 0.0, score))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], lang: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """Adds language and score of the column ``text`` to ``docs``."""
    names = sorted(prototypes)
    rows = np.array([prototypes[n] / max(np.sqrt((prototypes[n] ** 2).sum()), 1e-30)
                     for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            found, near = (classify(texts, names, rows) if names
                           else ([UNDETERMINED] * len(texts), np.zeros(len(texts))))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(found, pa.string()), pa.array(near)],
                [*b.schema.names, lang, score])

    return docs.mapInArrow(run, with_fields(docs, **{lang: StringType(), score: DoubleType()}))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), text_or_empty(F.col("text")).alias("text"))


def identify(docs: DataFrame) -> DataFrame:
    """Learns from four fifths of ``docs`` and predicts all of them."""
    prototypes = train(training_rows(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id")).alias("held_out"),
                       text_or_empty(F.col("text")).alias("text"))
    return predict(rows, prototypes).select("doc_id", "held_out", "lang_pred", "score")
