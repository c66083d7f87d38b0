"""The pipeline against a chain of plain versions, stage by stage, and its registration."""

from collections import Counter

import plain
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from netcap.llm import line_dedup, mixing, packing
from netcap.llm.common import read_table

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _lang string, root int"
STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def counted(rows):
    return Counter(map(str, rows))


def plain_chain(rows):
    """[(doc_id, text, source)] after the first three stages."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    left = plain.dedup_lines([r[:2] for r in rows], line_dedup.MIN_WORDS)
    rows = [(d, left[d, t], s) for d, t, s in rows if left[d, t] or not t]
    groups = plain.components([r[:2] for r in rows])
    kept, out = set(), []
    for r, (doc, n, c) in sorted(zip(rows, groups, strict=True), key=lambda x: x[0][0]):
        if n and c in kept:
            continue
        kept.add(c)
        out.append(r)
    return out


@pytest.fixture(scope="module")
def small(spark):
    return read_table(spark, SF_SMALL, "documents")


def test_first_three_stages_match_the_plain_chain(spark, small):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in small.collect()]
    docs = small
    for name in ("language_id", "line_dedup", "ngram_join"):
        docs = STAGE[name](spark, docs, SF_SMALL)
        assert docs.columns == small.columns
    assert counted(rows_of(docs)) == counted((d, t) for d, t, _ in plain_chain(rows))
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_run_packs_what_the_stages_kept(spark, small):
    rows = plain_chain([(r["doc_id"], r["text"], r["source"]) for r in small.collect()])
    copies = plain.poisson_copies([(d, s) for d, _, s in rows])
    tok = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for (d, t, _), n in zip(rows, copies, strict=True):
        ids = plain.ids_of(t, tok)
        for k, (s, m) in enumerate(packing.cuts(len(ids), packing.CAPACITY)):
            want[d, k, s, m, plain.crc(ids[s:s + m])] += n
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, SF_SMALL).collect()]
    got = Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces)
    assert got == +want
    plain.check_packing(pieces, packing.CAPACITY)


def test_mix_copies_match_the_plain_distribution(spark, small):
    rows = [(r["doc_id"], r["source"]) for r in small.collect()]
    want = Counter({str(d): n for (d, _), n in zip(rows, plain.poisson_copies(rows), strict=True)})
    assert Counter(str(r["doc_id"]) for r in mixing.mix(small).collect()) == +want


def test_stages_take_awkward_rows(spark):
    long = " ".join(f"word{k}" for k in range(30))
    rows = [(0, None), (1, ""), (2, " 12 !"), (3, long), (3, long), (3, "other words here"), (4, long),
            (None, "a text without an id"), (5, "line one is here\n" + long), (6, long + "\nno more")]
    docs = spark.createDataFrame([(d, t, "en", None, None, "x", 1) for d, t in rows], DOCS)
    first = STAGE["language_id"](spark, docs, "")
    assert counted(rows_of(first)) == counted(rows[3:])
    second = STAGE["line_dedup"](spark, first, "")
    assert counted(rows_of(second)) == counted([
        (3, long), (3, long), (3, "other words here"), (None, "a text without an id"),
        (5, "line one is here"), (6, "no more")])
    third = STAGE["ngram_join"](spark, second, "")
    assert counted(rows_of(third)) == counted([
        (3, long), (3, "other words here"), (None, "a text without an id"),
        (5, "line one is here"), (6, "no more")])
    fourth = STAGE["source_mix"](spark, third, "")
    assert first.columns == second.columns == third.columns == fourth.columns == docs.columns
    assert {r["_lang"] for r in fourth.collect()} <= {"x"}
    plain.check_packing([r.asDict() for r in STAGE["packing"](spark, fourth, "").collect()], 2048)


def test_copies_among_blank_lines_go(spark):
    long = " ".join(f"word{k}" for k in range(30))
    rows = [(1, long), (2, long + "\n"), (3, "\n \t\n" + long), (4, f"\n{long}\n\n{long}\n"),
            (5, f"\n{long}\nmore\n"), (6, "\nown\n")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "x", 1) for d, t in rows], DOCS)
    left = STAGE["line_dedup"](spark, docs, "")
    assert counted(rows_of(left)) == counted([(1, long), (5, "\nmore\n"), (6, "\nown\n")])


def test_stages_take_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0
        docs = docs if name == "packing" else out


def test_registration():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()
