"""Operator 13 - quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes, each beginning
``STEP`` bytes after the one before (so they overlap) and the last one ending with
the text, so that all bytes are covered; a text shorter than a chunk is one, filled
up with a token of its own. In a chunk

1. every byte becomes a learned vector, and learned filters look at each run
   of ``WIDTH`` bytes; of each filter only its maximum over the chunk stays;
2. a hidden layer combines these maxima (so it also sees what a chunk lacks:
   a word repeated over and over excites few filters);

and the maxima of the hidden layer over all chunks of a text give, by a logistic
unit, one probability that the text is labelled 1.

Training is by back-propagation (Adam) on the driver, on a bounded sample: of
either label at most ``SAMPLE`` rows, those with the smallest hash of id and
text, and of a row at most ``TRAIN_CHUNKS`` chunks, spread over its whole length.
Both labels weigh the same in the loss, however frequent they are. Scoring reads every text whole, in Arrow batches; what the
tasks get is the network, some kilobytes.

Defined results: null text counts as empty; an empty text is one chunk of
filling. Rows without id are scored, count as held out and don't train; labels
without id, or other than 0 and 1, don't train; a text labelled more than once
trains with each label, as often as it comes. With labels of one kind only, or
none, every score is (ones + 1) / (labels + 2). Equal texts have equal scores. Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netcap.llm.common import text_or_empty
from netcap.llm.langid import held_out

CHUNK = 256          # bytes
STEP = 224           # from one chunk's first byte to the next one's
WIDTH = 6            # bytes that a filter sees
STRIDE = 2           # from one run of bytes that filters look at to the next
VECTOR = 4           # numbers that a byte becomes
FILTERS = 32
HIDDEN = 16
FILL = 256           # the token after a short text's end
SAMPLE = 600         # training rows of either label
TRAIN_CHUNKS = 64    # chunks of a training row
EPOCHS = 24
ROWS_PER_STEP = 24
RATE = 0.01
DECAY = 0.03
KEEP_FROM = 0.3      # score from which the prediction is 1
CHUNKS_AT_ONCE = 32

RESULT = "doc_id long, held_out boolean, score double, predicted int"


def chunk_starts(n: int) -> np.ndarray:
    """First bytes of the chunks of a text of ``n`` bytes."""
    if n <= CHUNK:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - CHUNK, STEP), n - CHUNK)


def chunks_of(text: bytes, starts: np.ndarray) -> np.ndarray:
    """The text's chunks as rows of tokens."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < CHUNK:
        out = np.full((1, CHUNK), FILL, np.int16)
        out[0, :len(data)] = data
        return out
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts].astype(np.int16)


@dataclass
class Network:
    """Weights by name, or the one score that all texts get."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def random(cls, seed: int = 13) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape, by):
            return (rng.standard_normal(shape) / np.sqrt(by)).astype(np.float32)

        return cls({
            "byte": normal(FILL + 1, VECTOR, by=1.0),
            "filter": normal(WIDTH * VECTOR, FILTERS, by=WIDTH * VECTOR),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS, HIDDEN, by=FILTERS),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, by=HIDDEN), "out_bias": np.zeros(1, np.float32)})

    def filtered(self, tokens: np.ndarray, where: bool = False) -> tuple:
        """Maxima of the filters over each chunk and, for training, where they are."""
        w = self.weights
        best = np.empty((len(tokens), FILTERS), np.float32)
        at = np.empty((len(tokens), FILTERS), np.int64) if where else None
        for lo in range(0, len(tokens), CHUNKS_AT_ONCE):
            part = tokens[lo:lo + CHUNKS_AT_ONCE]
            flat = w["byte"][part].reshape(len(part), -1)
            runs = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * VECTOR, axis=1)
            found = runs[:, ::STRIDE * VECTOR].reshape(-1, WIDTH * VECTOR) @ w["filter"]
            found = found.reshape(len(part), -1, FILTERS)
            best[lo:lo + len(part)] = found.max(axis=1)
            if where:
                at[lo:lo + len(part)] = found.argmax(axis=1)
        return best + w["filter_bias"], at

    def hidden(self, best: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(np.maximum(best, 0) @ w["hidden"] + w["hidden_bias"], 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts. Long ones are looked at in parts."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        pooled = np.zeros((len(texts), HIDDEN), np.float32)
        rows, owner = [], []

        def look():
            if rows:
                of = np.array(owner)
                np.maximum.at(pooled, of, self.hidden(self.filtered(np.concatenate(rows))[0]))
                rows.clear()
                owner.clear()

        for k, text in enumerate(texts):
            starts = chunk_starts(len(text))
            for lo in range(0, len(starts), CHUNKS_AT_ONCE):
                part = starts[lo:lo + CHUNKS_AT_ONCE]
                rows.append(chunks_of(text, part))
                owner.extend([k] * len(part))
                if len(owner) >= CHUNKS_AT_ONCE:
                    look()
        look()
        logit = pooled @ self.weights["out"] + self.weights["out_bias"]
        return 1.0 / (1.0 + np.exp(-logit.astype(np.float64)))

    def gradients(self, tokens: np.ndarray, owner: np.ndarray, label: np.ndarray,
                  weight: np.ndarray) -> tuple[float, dict]:
        """Weighted loss of some texts, and its gradient in every weight of the network."""
        w, n = self.weights, len(label)
        best, at = self.filtered(tokens, where=True)
        lit = np.maximum(best, 0)
        before = lit @ w["hidden"] + w["hidden_bias"]
        hidden = np.maximum(before, 0)
        first = np.searchsorted(owner, np.arange(n))
        pooled = np.maximum.reduceat(hidden, first, axis=0)
        logit = pooled @ w["out"] + w["out_bias"]
        p = 1.0 / (1.0 + np.exp(-logit))
        loss = float(weight @ np.logaddexp(0, np.where(label == 1, -logit, logit)))

        d_logit = ((p - label) * weight).astype(np.float32)
        out = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        # A maximum hands its gradient to where it was first reached.
        holds = hidden == pooled[owner]
        rank = holds.cumsum(axis=0) - (holds.cumsum(axis=0) - holds)[first][owner]
        d_hidden = (d_logit[:, None] * w["out"])[owner] * (holds & (rank == 1) & (before > 0))
        out["hidden"], out["hidden_bias"] = lit.T @ d_hidden, d_hidden.sum(axis=0)
        d_best = (d_hidden @ w["hidden"].T) * (best > 0)
        chunk, which = np.nonzero(d_best)
        d = d_best[chunk, which]
        seen = tokens[chunk[:, None], STRIDE * at[chunk, which][:, None] + np.arange(WIDTH)]
        vectors = w["byte"][seen].reshape(len(seen), -1)
        d_filter = np.zeros((FILTERS, WIDTH * VECTOR), np.float32)
        np.add.at(d_filter, which, vectors * d[:, None])
        out["filter"], out["filter_bias"] = d_filter.T, d_best.sum(axis=0)
        d_byte = np.zeros_like(w["byte"])
        np.add.at(d_byte, seen.ravel(), (w["filter"].T[which] * d[:, None]).reshape(-1, VECTOR))
        out["byte"] = d_byte
        return loss, out


def fit(samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS,
        seed: int = 13) -> Network:
    """``samples``: the chunks of each training text, as rows of tokens."""
    rng = np.random.default_rng(seed)
    net = Network.random(seed)
    weight = (1 / (2 * np.where(labels == 1, labels.mean(), 1 - labels.mean()))).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    steps, total = 0, epochs * -(-len(samples) // ROWS_PER_STEP)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for lo in range(0, len(order), ROWS_PER_STEP):
            of = order[lo:lo + ROWS_PER_STEP]
            owner = np.repeat(np.arange(len(of)), [len(samples[k]) for k in of])
            _, grads = net.gradients(np.concatenate([samples[k] for k in of]), owner, labels[of],
                                     weight[of] / len(of))
            steps += 1
            rate = RATE * (1 - steps / (total + 1))
            for name, g in grads.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                step = (first[name] / (1 - 0.9 ** steps)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** steps)) + 1e-8)
                net.weights[name] -= rate * (step + DECAY * net.weights[name])
    return net


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE
                    ) -> tuple[list[np.ndarray], np.ndarray, dict[int, int]]:
    """Chunks and labels of at most ``rows`` rows of either label, and how many labels of
    either kind there are to learn from. The ids of both tables meet first; only
    the texts that were chosen (a bounded number of rows, so broadcast) are cut."""
    key = F.col("doc_id").cast("long").alias("doc_id")
    marked = (labels.select(key, F.col("quality").cast("int").alias("quality"))
              .filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))))
    texts = docs.select(key, text_or_empty(F.col("text")).alias("text"))
    there = marked.join(texts.select("doc_id"), "doc_id", "left_semi")
    counts = {r["quality"]: r["n"] for r in there.groupBy("quality").agg(
        F.count("*").alias("n")).collect()}
    by_hash = there.withColumn("h", F.xxhash64("doc_id"))
    least = [by_hash.filter(F.col("quality") == q).orderBy("h", "doc_id").limit(rows)
             for q in (0, 1)]
    chosen = least[0].unionByName(least[1]).drop("h")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for text in b.column("text").to_pylist():
                data = text.encode()
                starts = chunk_starts(len(data))
                if len(starts) > TRAIN_CHUNKS:
                    starts = starts[np.linspace(0, len(starts) - 1, TRAIN_CHUNKS).astype(int)]
                parts.append(chunks_of(data, starts).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("quality"), b.column("h"), pa.array(parts, pa.binary())],
                ["quality", "h", "chunks"])

    pieces = (texts.join(F.broadcast(chosen), "doc_id")
              .select("quality", F.xxhash64("doc_id", "text").alias("h"), "text")
              .mapInArrow(cut, "quality int, h long, chunks binary"))
    samples, marks = [], []
    for q in (0, 1):
        # Again at most ``rows``: an id may stand for many texts.
        for r in (pieces.filter(F.col("quality") == q).orderBy("h", "chunks").limit(rows)
                  .collect()):
            samples.append(np.frombuffer(bytes(r["chunks"]), np.int16).reshape(-1, CHUNK))
            marks.append(q)
    return samples, np.array(marks, np.float32), counts


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Network:
    samples, marks, counts = training_sample(docs, labels, rows)
    if len(set(marks.tolist())) == 2:
        return fit(samples, marks)
    zeros, ones = (counts.get(q, 0) for q in (0, 1))
    return Network({}, (ones + 1) / (zeros + ones + 2))


def score_texts(docs: DataFrame, net: Network) -> DataFrame:
    """``docs``: doc_id, held_out, text. The result's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = net.scores([t.encode() for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(score),
                 pa.array((score >= KEEP_FROM).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.mapInArrow(run, RESULT)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """Learns from four fifths of the labelled ids and scores all documents."""
    net = train(docs, labels, rows)
    return score_texts(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        text_or_empty(F.col("text")).alias("text")), net)
