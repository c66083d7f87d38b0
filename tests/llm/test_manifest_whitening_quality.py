"""Merkle manifest, whitening and quality classifier against plain versions: nulls, ties,
repeated rows, empty tables, clashing names, and whole small tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netcap.llm import merkle, quality, whitening
from netcap.llm.common import read_table

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, tree string, at int, "
        "key string, held int, tie int")


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(digests):
    """The last digest, and the siblings (left, right) of every leaf, level by level."""
    paths, under = [[] for _ in digests], [[k] for k in range(len(digests))]
    while len(digests) > 1:
        upper, held = [], []
        for lo in range(0, len(digests), 16):
            run = digests[lo:lo + 16]
            for k in range(len(run)):
                for x in under[lo + k]:
                    paths[x].append(("".join(run[:k]), "".join(run[k + 1:])))
            upper.append(h("".join(run)))
            held.append([x for part in under[lo:lo + 16] for x in part])
        digests, under = upper, held
    return digests[0], paths


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    out, trees, by_source = [], {}, {}
    for row in rows:
        by_source.setdefault(row[1], []).append((plain_leaf(row), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        of = sorted(by_source[s], key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees[s] = (of, *plain_tree([x[0] for x in of]))
    root, tops = plain_tree([trees[s][1] for s in order]) if order else (None, [])
    for s, top in zip(order, tops, strict=True):
        of, subroot, paths = trees[s]
        for (leaf, row), path in zip(of, paths, strict=True):
            whole = path + top
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            acc = plain_leaf((*row[:4], lowered(row[4]))) if hit else leaf
            for left, right in whole:
                acc = h(left + acc + right)
            proof = h("".join(left + right for left, right in whole))
            out.append((row[0], leaf, subroot, root, proof, acc, acc == root))
    return sorted(out, key=str)


def merkle_frame(spark, rows):
    return spark.createDataFrame([(d, t, lang, s, n, "x", 1, "k", 2, 3) for d, s, lang, n, t in rows],
                                 DOCS)


def made(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_matches_plain(spark):
    rng = random.Random(11)
    rows = [(k, rng.choice(["hot", "hot", "b", "Ä", None]), rng.choice(["en", None]), k, f"Text {k} É")
            for k in range(900)]
    rows += [(None, "hot", None, None, None)] * 3 + [(7, "hot", "en", 1, "twice")] * 2
    rows += [(7, "hot", "en", 2, "Other"), (-5, "lone", "en", 0, ""), (None, None, None, None, "A")]
    rows += [(1000 + k, f"s{k}", "en", 1, "One ROW") for k in range(40)]
    rows += [(5000 + k, "many", "en", 1, "X" * (k % 7)) for k in range(257)]
    got = made(merkle.manifest(merkle_frame(spark, rows)))
    assert got == plain_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_manifest_of_few_rows(spark, n):
    rows = [(k, "s", "en", k, "A b") for k in range(n)]
    assert made(merkle.manifest(merkle_frame(spark, rows))) == plain_manifest(rows)


def test_manifest_of_missing_columns_and_another_check(spark):
    docs = merkle_frame(spark, [(k, "s", None, None, f"A{k}") for k in range(20)])
    got = merkle.manifest(docs.drop("lang", "n_chars"), check=F.col("text")).collect()
    assert all(r["verified"] for r in got)
    assert {r["leaf"] for r in got} == {r["leaf"] for r in merkle.manifest(docs).collect()}


def test_proof_rounds_double_the_distance(spark, monkeypatch):
    """Five levels below the top one: three self-joins."""
    joins, plain_written = [], merkle.written
    monkeypatch.setattr(merkle, "ARITY", 4)
    monkeypatch.setattr(merkle, "written", lambda s, df, name: (
        joins.append(name), plain_written(s, df, name))[1])
    rows = [(k, "s" if k else "t", "en", 1, "a") for k in range(300)]
    got = merkle.manifest(merkle_frame(spark, rows), check=F.col("text")).collect()
    assert len(got) == 300 and all(r["verified"] for r in got)
    assert joins.count("op11-jump") - 1 == 3


# ---------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>, x string, n int"


def vector_frame(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)


def plain_numbers(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def check_whitening(got, ids, x, most=32):
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, int((e > 1e-13 * e[0]).sum()))
    assert len(got) == n * k
    want = {}
    for i, row in zip(ids, centred @ v[:, :k] / np.sqrt(e[:k]), strict=True):
        want.setdefault(i, []).append(row)
    dev = {}
    for i, row in zip(ids, x.astype(object), strict=True):
        dev.setdefault(i, set()).add(sum((n * int(a) - int(b)) ** 2
                                         for a, b in zip(row, total, strict=True)))
    assert {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got}.pop() < 1e-8
    for r in got:
        assert r["deviation"] in dev[r["vec_id"]]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        assert min(abs(abs(r["whitened"]) - abs(w[r["component"] - 1]))
                   for w in want[r["vec_id"]]) < 1e-6


def test_whitening_of_a_table(spark):
    rows = read_table(spark, SF_SMALL, "embeddings").collect()
    got = whitening.whiten(read_table(spark, SF_SMALL, "embeddings")).collect()
    check_whitening(got, [r["vec_id"] for r in rows], plain_numbers([r["embedding"] for r in rows]))


def test_whitening_of_awkward_rows(spark):
    rng = np.random.default_rng(2)
    scale = np.array([900.0, 30, 5, 1, 0.5, 0.5])
    good = [(k, (rng.standard_normal(6) * scale).tolist()) for k in range(80)]
    good += [good[3], (None, good[4][1]), (3, good[5][1])]
    bad = [(100, None), (101, [1.0, None, 0, 0, 0, 0]), (102, [float("nan")] * 6), (104, []),
           (103, [float("inf"), 0, 0, 0, 0, 0]), (105, [1.0, 2.0])]
    got = whitening.whiten(vector_frame(spark, good + bad)).collect()
    check_whitening(got, [i for i, _ in good], plain_numbers([v for _, v in good]))


def test_whitening_finds_equal_deviations_and_drops_flat_dimensions(spark):
    rows = [(k, [float(x) for x in (a, b, c, 7)]) for k, (a, b, c) in enumerate(
        (a, b, c) for a in (-1, 1) for b in (-1, 1) for c in (-2, 2))]
    got = whitening.whiten(vector_frame(spark, rows)).collect()
    assert sorted({(r["component"], round(r["explained"], 9)) for r in got}) == [
        (1, round(4 / 6, 9)), (2, round(1 / 6, 9)), (3, round(1 / 6, 9))]
    y = np.array([[r["whitened"] for r in got if r["component"] == c] for c in (1, 2, 3)])
    assert np.allclose(y @ y.T / 8, np.eye(3)) and got[0]["identity_error"] < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)],
                                  [(1, None), (2, [])]])
def test_whitening_without_deviation(spark, rows):
    out = whitening.whiten(vector_frame(spark, rows))
    assert out.columns == [f.split()[0] for f in whitening.RESULT.split(", ")]
    assert out.count() == 0


def test_wide_deviations_are_exact_or_null():
    x = np.array([[10 ** 9, 0], [0, 3]], np.int64)
    about = whitening.Centre(2, np.array([10 ** 9, 3], object), 10 ** 9)
    assert about.deviations(x) == [10 ** 18 + 9] * 2
    wide = whitening.Centre(2 * 10 ** 10, np.array([10 ** 19, 0], object), 10 ** 9)
    assert wide.deviations(x) == [None, None]
    assert wide.rows(x)[0, 0] == 10 ** 9 - 10 ** 19 / (2 * 10 ** 10)


def test_bidiagonal_form_holds(spark):
    """X V = U B with orthonormal U and V, also where a direction nearly vanishes."""
    rng = np.random.default_rng(4)
    data = rng.standard_normal((60, 5)) @ np.diag([5000, 400, 30, 2, 1]) @ rng.standard_normal((5, 5))
    rows = whitening.fit_rows(vector_frame(spark, [(k, v) for k, v in enumerate(data.tolist())]))
    about = whitening.centre(rows)
    x = about.rows(np.array([r["x"] for r in rows.collect()], np.int64))
    b = whitening.bidiagonalise(rows, about)
    upper = np.diag(b.alpha) + np.diag(b.beta, 1)
    u = x @ b.w
    assert np.abs(b.v.T @ b.v - np.eye(5)).max() < 1e-12
    assert np.abs(u.T @ u - np.eye(5)).max() < 1e-6
    assert np.abs(x @ b.v - u @ upper).max() < 1e-9 * np.abs(x).max()


# ---------------------------------------------------------------- quality

LABELS = "doc_id long, quality int, toxic int, text string"


def test_chunks_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        starts = quality.chunk_starts(n)
        seen = np.zeros(n, int)
        for s in starts:
            seen[s:s + quality.CHUNK] += 1
        assert (seen > 0).all() and len(set(starts.tolist())) == len(starts)
        # Every run of bytes that a filter could see lies in one chunk.
        assert all(any(s <= k and k + quality.WIDTH <= s + quality.CHUNK for s in starts)
                   for k in range(n - quality.WIDTH + 1))


def plain_score(net, text):
    """The network, one chunk and one run of bytes at a time."""
    w, best = net.weights, []
    for s in quality.chunk_starts(len(text)):
        part = list(text[s:s + quality.CHUNK])
        part += [quality.FILL] * (quality.CHUNK - len(part))
        runs = [np.concatenate([w["byte"][t] for t in part[k:k + quality.WIDTH]])
                for k in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)]
        lit = np.maximum(np.max(np.array(runs) @ w["filter"], axis=0) + w["filter_bias"], 0)
        best.append(np.maximum(lit @ w["hidden"] + w["hidden_bias"], 0))
    return 1 / (1 + np.exp(-(np.max(best, axis=0) @ w["out"] + w["out_bias"][0])))


def test_scores_match_plain():
    net = quality.Network.random(3)
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in (0, 1, 256, 257, 900, 20_000, 3)]
    assert net.scores(texts) == pytest.approx([plain_score(net, t) for t in texts], abs=1e-5)


def test_gradients_match_differences():
    net = quality.Network.random(6)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(7)
    tokens = rng.integers(0, 257, (7, quality.CHUNK)).astype(np.int16)
    owner, label = np.array([0, 0, 1, 2, 2, 2, 3]), np.array([1, 0, 1, 0])
    weight = np.array([0.1, 0.4, 0.3, 0.2])
    _, grads = net.gradients(tokens, owner, label, weight)
    for name, g in grads.items():
        flat = net.weights[name].reshape(-1)
        for k in np.argsort(-np.abs(g.reshape(-1)))[:4]:
            flat[k] += 1e-3
            up, _ = net.gradients(tokens, owner, label, weight)
            flat[k] -= 2e-3
            down, _ = net.gradients(tokens, owner, label, weight)
            flat[k] += 1e-3
            assert (up - down) / 2e-3 == pytest.approx(g.reshape(-1)[k], rel=0.05, abs=1e-4), name


def test_quality_held_out_accuracy(spark):
    docs, labels = (read_table(spark, SF_MID, t) for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r["doc_id"]], r["quality"]) for r in labels.collect()
            if got[r["doc_id"]]["held_out"]]
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == r["held_out"] for d, r in got.items())
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert sum(r["predicted"] == q for r, q in held) >= 0.93 * len(held)
    good, bad = ([r["score"] for r, q in held if q == k] for k in (1, 0))
    assert np.mean([[a > b for a in good] for b in bad]) > 0.95


def test_quality_of_awkward_rows(spark):
    rows = [(k, ("good words here " if k % 2 else "||| bad ||| ") * (k % 9 + 1)) for k in range(120)]
    rows += [(None, None), (None, ""), (3, rows[3][1]), (500, None), (501, ""), (502, "x" * 300_000)]
    docs = spark.createDataFrame([(d, t, 1.0, "p") for d, t in rows],
                                 "doc_id long, text string, score double, quality string")
    marks = [(k, k % 2, 0, "t") for k in range(120)] + [(None, 1, 0, "t"), (3, 7, 0, "t"), (4, None, 0, "t")]
    got = quality.quality_scores(docs, spark.createDataFrame(marks, LABELS)).collect()
    assert len(got) == len(rows) and all(0.0 <= r["score"] <= 1.0 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[None][0]["held_out"] and len({r["score"] for r in by[3]}) == 1
    assert len({r["score"] for r in [*by[None], *by[500], *by[501]]}) == 1
    assert sum(by[k][0]["predicted"] == k % 2 for k in range(120)) >= 116


def test_quality_without_both_labels(spark):
    docs = spark.createDataFrame([(k, "t") for k in range(6)], "doc_id long, text string")
    of = lambda marks: {r["score"] for r in quality.quality_scores(
        docs, spark.createDataFrame(marks, LABELS)).collect()}
    trained = [k for k in range(6) if zlib.crc32(str(k).encode()) % 5]
    assert of([]) == {0.5}
    assert of([(k, 1, 0, "") for k in range(6)]) == {(len(trained) + 1) / (len(trained) + 2)}
    assert quality.quality_scores(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_the_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k % 40, "a b " * 20_000 if k % 3 else "t") for k in range(120)],
                                 "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2, 0, "") for k in range(40)], LABELS)
    samples, labels, counts = quality.training_sample(docs, marks, rows=5)
    assert len(samples) == len(labels) == 10 and sum(counts.values()) > 25
    assert max(map(len, samples)) == quality.TRAIN_CHUNKS
