"""Operator 5 - best-fit packing by a configuration linear program.

1. Every text is tokenized in Arrow batches (``tokenize``): the ids of the
   byte-level BPE file, then the end id 0. Documents longer than the
   capacity are cut; every piece but the first is full.
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever the
   corpus) goes to the driver. A configuration is a multiset of lengths that
   fits one sequence. The program "fewest configurations that cover the
   histogram" is solved by multiplicative weights: each length has a price
   that falls as it is covered, and one table of a knapsack dynamic program
   has, for the current prices, the dearest configuration that holds each
   length. Every pricing looks at all lengths.
3. Its fractional solution is rounded: configurations are used as many whole
   times as solution and stock allow, full ones first; what is left is a
   smaller program, until programs place little of it. Best fit decreasing, on
   counts of lengths, places that rest.
4. Pieces get ranks among those of their length (in two levels: a hot length
   is dealt over salts) and the rank's slot in the plan: sequence and offset.

No ids, texts or pieces pass the driver. The plan has at most a few thousand
entries. The ids are the tokenizer's; where its file allows, a faster encoder
with the same merges computes them, which the tests hold against it.

Defined results: null text counts as empty (one piece holding id 0); a null
doc_id is kept; repeated rows are packed each; equal rows are
interchangeable. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netcap.llm.common import text_or_empty, written

CAPACITY = 2048
END_ID = 0
TOKENIZER_FILE = "byte_bpe_50k.json"
CHUNK = 1 << 20              # characters looked at once
ROUNDS = 4                   # pricings of one program
STEP = 1.0                   # of the multiplicative weights
FLOOR = 0.02                 # share of its first price that a covered length keeps, as filling
FAVOUR = 1.0                 # power of the length in first prices per token
LEAST_USED = 0.03            # share of the tokens that a program must place for another one
SMALL = 16                   # sequences' worth that needs no program
PIECES_PER_SALT = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


# ---------------------------------------------------------------- tokens

def unassigned_ranges(database) -> Iterator[tuple[int, int]]:
    """Ranges of code points without a category in a Unicode database."""
    start = None
    for c in range(0x110001):
        unknown = c < 0x110000 and database.category(chr(c)) == "Cn"
        if unknown and start is None:
            start = c
        elif not unknown and start is not None:
            yield start, c - 1
            start = None


#: What is left to the tokenizer itself: characters without a category in Unicode 3.2, which
#: libraries of other versions may split otherwise, and long runs of white space.
_LONG_SPACE = re.compile(r"\s{200}")
_NEWER = re.compile("[" + "".join(
    f"\\U{lo:08x}-\\U{hi:08x}" for lo, hi in unassigned_ranges(unicodedata.ucd_3_2_0)) + "]")


def byte_alphabet() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones
    for themselves, the others are numbered on from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(others)}


def rank_encoder(path: str):
    """A faster encoder over the same file, or None if it isn't one whose ids
    rise with the merges' order (then merging by id is merging by rank)."""
    import public_tokenizers
    import tiktoken

    with open(path) as f:
        file = json.load(f)
    vocabulary, merges = file["model"].get("vocab"), file["model"].get("merges") or []
    if (file.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or file.get("normalizer"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    ids = [vocabulary.get("".join(m), -1) for m in pairs]
    special = {t["content"] for t in file.get("added_tokens", [])}
    alphabet = byte_alphabet()
    if ids != list(range(256, 256 + len(ids))) or not all(
            c in alphabet for t in vocabulary if t not in special for c in t):
        return None
    ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


class TextIds:
    """Ids of texts, as little-endian 32-bit bytes, as the tokenizer gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.encode = rank_encoder(path)

    def part(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        strange = not text.isascii() and _NEWER.search(text) or _LONG_SPACE.search(text)
        ids = (self.encode(text) if self.encode and not strange else
               self.tokenizer.encode(text, add_special_tokens=False).ids)
        return array("I", ids).tobytes()

    def ids(self, text: str) -> bytes:
        """All ids of a text. Special tokens written out in a text are found
        before words are split, as the tokenizer does. Long texts are cut where a
        space follows something else: no word of the pattern goes on there."""
        for content, i in self.special.items():
            if content in text:
                return array("I", [i]).tobytes().join(map(self.ids, text.split(content)))
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + CHUNK)
            while end < len(text) and not (text[end].isspace() and not text[end - 1].isspace()):
                end += 1
            out.append(self.part(text[at:end]))
            at = end
        return b"".join(out)


_IDS: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """One per worker and file."""
    if path not in _IDS:
        _IDS[path] = TextIds(path)
    return _IDS[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be short."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def tokenize(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = text_ids(path or default_tokenizer())
        end = array("I", [END_ID]).tobytes()
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = known.ids(text) + end
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length,
                                 zlib.crc32(ids[4 * start:4 * (start + length)])))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_or_empty(F.col("text")).alias("text")).mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the program

def knapsack(lengths: np.ndarray, stock: np.ndarray, price: np.ndarray,
             capacity: int) -> list[tuple[int, int, np.ndarray]]:
    """The table of the knapsack program for every room up to the capacity, of a
    length no more than its stock: lots (place, number) and the rooms that they improve."""
    worth = np.zeros(capacity + 1)
    lots = []
    for i in range(len(lengths)):
        size, left, lot = int(lengths[i]), min(int(stock[i]), capacity // int(lengths[i])), 1
        while left:
            lot = min(lot, left)
            w = lot * size
            with_it = worth[:capacity + 1 - w] + lot * price[i]
            lots.append((i, lot, with_it > worth[w:]))
            worth[w:] = np.maximum(with_it, worth[w:])
            left -= lot
            lot *= 2
    return lots


def best_fillings(lots: list[tuple[int, int, np.ndarray]], lengths: np.ndarray,
                  rooms: np.ndarray) -> list[dict[int, int]]:
    """Of each room the dearest filling, place -> how many, all out of one table."""
    room = rooms.copy()
    out: list[dict[int, int]] = [{} for _ in rooms]
    for i, lot, better in reversed(lots):
        w = lot * int(lengths[i])
        at = np.flatnonzero(room >= w)
        at = at[better[room[at] - w]]
        room[at] -= w
        for k in at.tolist():
            out[k][i] = out[k].get(i, 0) + lot
    return out


def solve(lengths: np.ndarray, stock: np.ndarray, capacity: int,
          rounds: int = ROUNDS) -> dict[tuple, float]:
    """Fractional solution by multiplicative weights: configuration (pairs of
    place and number) -> times. A length's price per token falls exponentially with
    the share of its stock that is covered. A pricing gives every uncovered length
    the dearest configuration that holds it; none covers a length more than STEP times in it."""
    cover = np.zeros(len(stock))
    first = lengths * (lengths / capacity) ** FAVOUR
    short = np.flatnonzero(lengths <= capacity // 2)     # a second piece is one of these
    out: dict[tuple, float] = {}
    for _ in range(rounds):
        wanted = np.flatnonzero(cover < 1.0)[::-1]
        if not len(wanted):
            break
        price = ((np.exp(-cover / STEP) + FLOOR) * first)[short]
        lots = knapsack(lengths[short], stock[short], price, capacity)
        fillings = best_fillings(lots, lengths[short], capacity - lengths[wanted])
        left = np.full(len(stock), STEP)
        for j, filling in zip(wanted.tolist(), fillings, strict=True):
            config = {j: 1}
            for k, many in filling.items():
                i = int(short[k])
                config[i] = config.get(i, 0) + many
            times = min(float(left[i]) * int(stock[i]) / many if many <= stock[i] else 0.0
                        for i, many in config.items())
            if times > 1e-9:
                for i, many in config.items():
                    share = times * many / int(stock[i])
                    left[i] -= share
                    cover[i] += share
                key = tuple(sorted(config.items()))
                out[key] = out.get(key, 0.0) + times
    return out


def best_fit(lengths: np.ndarray, stock: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best fit decreasing on counts: sequences filled alike are one entry, so the
    work follows the number of lengths, not of pieces."""
    free: dict[int, list[tuple[tuple, int]]] = {}        # room -> [(configuration, times)]
    rooms: list[int] = []                                # those in ``free``, ascending

    def put(room: int, config: tuple, times: int) -> None:
        if room not in free:
            insort(rooms, room)
        free.setdefault(room, []).append((config, times))

    for size, n in sorted(zip(lengths.tolist(), stock.tolist(), strict=True), reverse=True):
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                config, have = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            else:
                room, config, have = capacity, (), n
            many = min(room // size, n)
            used = min(have, n // many)
            if config and used < have:
                put(room, config, have - used)
            put(room - many * size, (*config, (size, many)), used)
            n -= many * used
    return [entry for entries in free.values() for entry in entries]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """[(configuration as ((length, number), ...), times)] that uses exactly the
    histogram. Programs follow each other on what the last one left while they use a
    share worth it (LEAST_USED); best fit ends. Of the places to end, the one with the fewest
    sequences is taken, the latest of equals."""
    out: list[tuple[tuple, int]] = []
    if histogram.get(capacity):
        out.append((((capacity, 1),), histogram[capacity]))
    lengths = np.array(sorted(x for x in histogram if x != capacity), int)
    stock = np.array([histogram[int(x)] for x in lengths], int)
    best: tuple[int, list[tuple[tuple, int]]] | None = None
    planned, share = 0, 1.0
    while share >= LEAST_USED and float(lengths @ stock) > SMALL * capacity:
        before, used = float(lengths @ stock), 0
        solution = solve(lengths, stock, capacity)
        # Rounding up, as far as the stock goes: the fullest first. Those with room wait for
        # the next program once half of the tokens are placed.
        fill = {c: sum(int(lengths[i]) * a for i, a in c) for c in solution}
        for c in sorted(solution, key=lambda c: (-fill[c], -max(i for i, _ in c), c)):
            if fill[c] < capacity and used >= before / 2:
                break
            times = min([ceil(solution[c]), *(int(stock[i]) // a for i, a in c)])
            if times > 0:
                for i, a in c:
                    stock[i] -= a * times
                out.append((tuple((int(lengths[i]), a) for i, a in c), times))
                used += times * fill[c]
                planned += times
        share = used / before
        lengths, stock = lengths[stock > 0], stock[stock > 0]
        rest = best_fit(lengths, stock, capacity)
        total = planned + sum(n for _, n in rest)
        if best is None or total <= best[0]:
            best = total, out + rest
    return best[1] if best else out + best_fit(lengths, stock, capacity)


class Slots:
    """Of each length, the slots that a plan gives to its pieces by rank."""

    def __init__(self, plan_: list[tuple[tuple, int]]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        ranks: dict[int, int] = {}
        sequence = 0
        for config, times in plan_:
            offset = 0
            for length, many in config:
                rank = ranks.get(length, 0)
                by_length.setdefault(length, []).append((rank, sequence, many, offset))
                ranks[length] = rank + many * times
                offset += many * length
            sequence += times
        self.sequences = sequence
        self.by_length = {x: np.array(v, np.int64).T for x, v in by_length.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for x in np.unique(length):
            first, base, many, start = self.by_length[int(x)]
            of = np.flatnonzero(length == x)
            e = np.searchsorted(first, rank[of], side="right") - 1
            within = rank[of] - first[e]
            sequence[of] = base[e] + within // many[e]
            offset[of] = start[e] + within % many[e] * x
        return sequence, offset


# ---------------------------------------------------------------- placing

def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``rank``, from 0 among the pieces of a length. A frequent length is dealt
    over salts by its count; the list of those lengths is at most ``capacity`` rows."""
    salts = [(x, -(-n // PIECES_PER_SALT)) for x, n in histogram.items() if n > PIECES_PER_SALT]
    many = pieces.sparkSession.createDataFrame(salts, "length long, salts long")
    salted = pieces.join(F.broadcast(many), "length", "left").withColumn("salt", F.coalesce(
        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")), F.lit(0))).drop("salts")
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    return (salted.withColumn("r", F.row_number().over(order)).join(before, ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("r") - 1).drop("salt", "r", "before"))


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = written(docs.sparkSession, tokenize(docs, capacity, path), "op5-pieces")
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(
        F.count("*").alias("n")).collect()}
    slots = Slots(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = slots.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in PIECE_COLUMNS), pa.array(sequence), pa.array(offset)],
                [*PIECE_COLUMNS, "sequence_id", "offset"])

    return ranked(pieces, histogram).mapInArrow(
        place, f"{PIECES}, sequence_id long, offset long")
