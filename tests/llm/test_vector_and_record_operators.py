"""Top-k search, WARC revisits, URL templates and tool calls: small frames with
nulls, ties, repeated rows, extra columns, empty tables."""

import datetime as dt
import json
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from netcap.llm import chat_tools, topk_search, url_filter, warc_revisit


def test_top_k_matches_all_products(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-9, 9) for _ in range(13)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]                # ties
    rows += [(400 + i, [1, 2, 3]) for i in range(3)]                  # another length
    rows += [rows[7], (7, rows[8][1]), (40, rows[9][1])]              # ids that come again
    odd = [(None, rows[0][1]), (500, None), (501, [])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows + odd],
                                    "vec_id long, vec array<long>, dim string")
    for blocks, pivots in ((64, 30), (4096, 0)):
        got = topk_search.top_k(vectors, F.col("vec_id") % 20 == 0, 20, blocks, 5, pivots).collect()
        assert sorted(map(tuple, got)) == plain.top_k(rows, lambda i: i % 20 == 0, 20)


def test_large_products_stay_exact():
    big = 1 << 30
    x = np.array([[big, 1], [big, 0], [-big, 5]], np.int64)
    ids = np.arange(3)
    none = np.empty((0, 2), np.int64)
    q, v, s = topk_search.search_block(ids, x, np.array([9]), np.array([[big, 1]], np.int64),
                                       np.empty(0, np.int64), none, 2)
    assert v[0].tolist() == [0, 1] and s[0].tolist() == [big * big + 1, big * big]


def test_bounds_are_upper_bounds():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(50, 37)), rng.normal(size=(20, 37))
    exact = x @ q.T
    for n in (1, 2, 4, 16, 64):
        bound = topk_search.features(x, n) @ topk_search.features(q, n).T
        assert (bound >= exact - 1e-9).all()


def test_usable_and_quantised(spark):
    rows = [(1, [0.5, -0.01]), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf")]),
            (5, None), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = df.filter(topk_search.usable(F.col("embedding"))).select(
        "vec_id", topk_search.quantised(F.col("embedding")).alias("v")).collect()
    assert [tuple(r) for r in kept] == [(1, [32, -1])]


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, vec array<long>")
    assert topk_search.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------------ WARC

T = dt.datetime(2024, 5, 1, 12, 0)
RECORD = ("record_id long, url string, kind string, captured timestamp, "
          "headers map<string,string>, digest string, bucket string, status string")


def record(i, url, kind, hours, headers=None, digest=None):
    return (i, url, kind, None if hours is None else T + dt.timedelta(hours=hours), headers, digest,
            "b", "s")


def test_revisits_take_the_latest_earlier_response(spark):
    u = "HTTP://Example.com:80/a/?utm_source=x&b=2&a=1#f"
    same = "https://example.com/a?a=1&b=2"
    rows = [
        record(1, u, "response", 0, {"ETag": '"1"', "X": "old", "Date": "d1"}, "p1"),
        record(2, same, "response", 5, {"etag": '"2"', "cache-control": "a", "x": "kept"}, "p2"),
        record(3, u, "revisit", 5.5, {"etag": 'W/"2"', "Cache-Control": "b", "Set-Cookie": "n"}),
        record(4, u, "revisit", 30, {"etag": '"1"'}),
        record(5, u, "revisit", -1, {"etag": '"1"'}),
        record(6, u, "revisit", 4, {"etag": '"1"', "vary": None}),
        record(7, u, "revisit", 31, None, "p2"),
        record(7, u, "revisit", 31, None, "p2"),
        record(8, None, "revisit", 3, {"etag": '"1"'}),
        record(9, u, "revisit", None),
        record(10, u, "revisit", 32, {}),
        record(11, u, None, 1),
    ]
    got = warc_revisit.resolve_revisits(spark.createDataFrame(rows, RECORD)).collect()
    by = {r["record_id"]: r for r in got}
    assert len(got) == 9
    assert {i: r["status"] for i, r in by.items()} == {
        3: "resolved", 4: "validator_mismatch", 5: "no_original", 6: "resolved", 7: "resolved",
        8: "no_original", 9: "no_original", 10: "unconfirmed"}
    assert (by[3]["response_id"], by[3]["digest"], by[3]["canonical_url"]) == (2, "p2", same)
    assert by[3]["headers"] == {"etag": 'W/"2"', "cache-control": "b", "x": "kept"}
    assert by[6]["headers"] == {"etag": '"1"', "x": "old", "date": "d1", "vary": ""}
    assert by[4]["headers"] == {"etag": '"1"'} and by[4]["digest"] is None


def test_buckets_change_nothing(spark):
    rng = random.Random(1)
    rows = [record(i, f"http://h/{rng.randrange(3)}", rng.choice(["response", "revisit"]),
                   rng.randrange(200) / 7, {"etag": str(rng.randrange(2))}, str(i))
            for i in range(400)]
    df = spark.createDataFrame(rows, RECORD)
    results = [sorted(map(str, warc_revisit.resolve_revisits(df, s).collect()))
               for s in (60, 3600, 10 ** 7)]
    assert results[0] == results[1] == results[2]
    want = {}
    for r in rows:
        if r[2] == "revisit":
            before = [x for x in rows if x[2] == "response" and x[1] == r[1]
                      and (x[3], x[0]) < (r[3], r[0])]
            want[r[0]] = max(before, key=lambda x: (x[3], x[0]))[0] if before else None
    got = {r["record_id"]: r["response_id"] for r in warc_revisit.resolve_revisits(df).collect()}
    assert got == want


def test_no_records(spark):
    assert warc_revisit.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0


# ------------------------------------------------------------------ URLs

PAGE = "page_id long, url string, html string, host int, template string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", 3, "t") for i, u in enumerate(urls)], PAGE)


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no-scheme/x", "http://A.Example.ORG/es/1", "x://example.org/en/12?q#f",
            "http://example.org", "http://org/", "http://notexample.org/es/", "http://a.com/fr/",
            "http://a.com/de/1", "http://com/de/", "http://a.net/p?x://y.com/de/",
            "http://Ä.com#/fr/", "http://x.com?/de/", "http://borg/"]
    got = [tuple(r)[:4] + (r["verdict"],) for r in url_filter.judge_urls(pages(spark, urls))
           .orderBy("page_id").select("page_id", "host", "path", "rule", "verdict").collect()]
    want = [("", "", None), ("", "", None), ("", "", None),
            ("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
            ("example.org", "", None), ("org", "/", "org/"), ("notexample.org", "/es/", "org/"),
            ("a.com", "/fr/", "com/fr/"), ("a.com", "/de/1", "com/de/"), ("com", "/de/", "com/de/"),
            ("a.net", "/p", None), ("Ä.com", "", None), ("x.com", "", None), ("borg", "/", None)]
    assert [g[1:4] for g in got] == want
    verdicts = {r.text: r.verdict for r in url_filter.RULES}
    assert all(g[4] == verdicts[g[3]] for g in got if g[3])


def test_crowded_places_are_wildcards_and_purity_decides(spark):
    urls = [f"http://h/shop/item{i}/buy" for i in range(40)] + [f"http://h/blog/{i}" for i in range(9)]
    labelled = pages(spark, urls).withColumn("label", F.when(
        F.col("page_id") < 30, 1).when(F.col("page_id") >= 42, 0))
    got = url_filter.judge_urls(labelled, label_col="label").collect()
    by = {r["page_id"]: r for r in got}
    assert by[39]["template"] == "/shop/*/buy" and by[39]["verdict"] == "block"
    assert by[40]["verdict"] == "allow" and by[40]["template"].startswith("/blog/")
    repeated = url_filter.judge_urls(labelled.unionByName(labelled), label_col="label")
    assert repeated.count() == 2 * len(got)


@pytest.mark.parametrize("others", [14, 15, 40])
def test_labelled_sections_of_crowded_hosts_are_judged_apart(spark, others):
    urls = ([f"http://a.com/de/{i}" for i in range(60)] + [f"http://a.com/fr/{i}" for i in range(10)]
            + [f"http://a.com/s{k}/{i}" for k in range(others) for i in range(3)]
            + [f"http://b.net/bad/{i}" for i in range(6)]
            + [f"http://b.net/u{k}/{i}" for k in range(others + 2) for i in range(3)])
    labelled = pages(spark, urls).withColumn("label", F.when(
        F.col("url").rlike("/de/[1-5]|/bad/[1-5]"), 1).when(F.col("url").rlike("/fr/[1-9]|/u[0-9]+/1"), 0))
    got = {u: r for r in url_filter.judge_urls(labelled, label_col="label").collect()
           for u in [r["host"] + r["path"]]}
    verdicts = {u: got[u]["verdict"] for u in ("a.com/de/0", "a.com/fr/0", "a.com/s1/0", "b.net/bad/0",
                                               "b.net/u1/0")}
    assert verdicts == {"a.com/de/0": "block", "a.com/fr/0": "allow", "a.com/s1/0": "allow",
                        "b.net/bad/0": "block", "b.net/u1/0": "allow"}


def test_all_levels_without_a_depth(spark):
    urls = [f"http://h/a/b/c/d/{x}/{i}" for x in ("good", "bad") for i in range(8)]
    labelled = pages(spark, urls).withColumn(
        "label", F.when(F.col("page_id") % 8 > 0, F.col("url").contains("bad").cast("int")))
    got = {r["path"]: r for r in url_filter.judge_urls(labelled, label_col="label",
                                                       depth=None).collect()}
    assert [got[f"/a/b/c/d/{x}/0"]["verdict"] for x in ("good", "bad")] == ["allow", "block"]
    assert got["/a/b/c/d/bad/0"]["template"] == "/a/b/c/d/bad/{n}"
    assert url_filter.judge_urls(pages(spark, []), depth=None).count() == 0


def test_deep_paths_and_no_pages(spark):
    got = url_filter.judge_urls(pages(spark, ["http://h/a/b/c/d/e/f", "http://h/a/b/c/d"]),
                                depth=4).collect()
    assert sorted(r["template"].endswith("/**") for r in got) == [False, True]
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


# ------------------------------------------------------------------ tool calls

CALL = ("conv_id long, turn long, call_id string, parent_id string, name string, "
        "arguments string, status string, level int")
RESULT = "conv_id long, turn long, call_id string, content string, up string"


def linked(spark, calls, results):
    out = chat_tools.link_tool_calls(
        spark.createDataFrame([(*c, "x", 1) for c in calls], CALL),
        spark.createDataFrame([(*r, "x") for r in results], RESULT)).collect()
    return {(r["conv_id"], r["call_id"], r["turn"]): r for r in out}


def test_calls_are_linked_ordered_and_checked(spark):
    ok = '{ "query" : "a\\"\\u00e9\\n", "limit":1.0e0 }'
    calls = [
        (1, 0, "a", None, "search", '{"limit":3, "query":"q"}'),
        (1, 2, "b", "a", "lookup", '{"id": 7}'),
        (1, 1, "c", "b", "lookup", '{"id": "7", "exact": null}'),
        (1, 3, "d", "gone", "summarise", '{"ratio":2,"text":"t","z":{"b":1,"a":[]}}'),
        (1, 4, "e", "f", "search", '{"query":"q"}'), (1, 5, "f", "e", "search", '{"query":"q"}'),
        (1, 6, "g", "f", "search", '{"query":"q"}'),
        (1, 7, "h", None, "search", "{oops"), (1, 8, "i", None, None, None),
        (1, 9, "j", None, "search", "[1]"), (1, 9, None, None, "search", ok),
        (1, 0, "a", None, "search", '{"limit":3, "query":"q"}'), (2, 0, "a", "a", "fly", "{}"),
        (None, 0, "n", None, "lookup", '{"id":1}'),
    ]
    results = [(1, 1, "a", "ra"), (1, 5, "b", None), (1, 5, "b", "later"), (1, 6, "zz", "stray"),
               (1, 7, None, "stray"), (1, 8, "d", "rd")]
    got = linked(spark, calls, results)
    status = {k: (r["status"], r["level"]) for k, r in got.items()}
    assert status == {
        (1, "a", 0): ("linked", 0), (1, "b", 2): ("linked", 1), (1, "c", 1): ("invalid", 2),
        (1, "d", 3): ("missing_parent", 0), (1, "e", 4): ("cycle", -1), (1, "f", 5): ("cycle", -1),
        (1, "g", 6): ("cycle", -1), (1, "h", 7): ("invalid", 0), (1, "i", 8): ("invalid", 0),
        (1, "j", 9): ("invalid", 0), (1, None, 9): ("invalid", 0),
        (2, "a", 0): ("cycle", -1), (1, "zz", None): ("stray_result", None),
        (1, None, None): ("stray_result", None), (None, "n", 0): ("no_result", 0)}
    assert got[1, "a", 0]["repeats"] == 1 and got[1, "b", 2]["repeats"] == 1
    assert got[1, "c", 1]["errors"] == "id: not integer"
    assert got[1, "h", 7]["errors"] == "arguments: not JSON"
    assert got[1, "j", 9]["errors"] == "arguments: not an object; query: missing"
    assert got[1, "d", 3]["line"] == (
        '{"arguments":{"ratio":2,"text":"t","z":{"a":[],"b":1}},"call_id":"d","name":"summarise",'
        '"parent_id":"gone","result":"rd","status":"missing_parent"}')
    for r in got.values():
        assert json.loads(r["line"])["call_id"] == r["call_id"]


def test_long_chains_take_few_rounds(spark):
    n = 300
    calls = [(1, i, f"c{i}", f"c{i - 1}" if i else None, "lookup", '{"id":1}') for i in range(n)]
    got = linked(spark, calls, [])
    assert {k[2]: r["level"] for k, r in got.items()} == {i: i for i in range(n)}


def test_no_traffic(spark):
    assert linked(spark, [], []) == {}


@pytest.mark.parametrize("turns", [[], [(1, 0, "user", None), (1, 1, "assistant", None),
                                        (1, 2, "user", ""), (None, 0, None, "x"),
                                        (2, None, "assistant", "t")]])
def test_traffic_of_awkward_turns(spark, turns):
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert chat_tools.link_tool_calls(*chat_tools.tool_traffic(table)).count() == len(
        [t for t in turns if t[2] == "assistant"])


def sql_verdicts(tmp_path, urls):
    """The registered SQL over these pages."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from netcap.llm.oracle import ORACLE_SQL
    pq.write_table(pa.table({"page_id": list(range(len(urls))), "url": urls,
                             "html": ["h"] * len(urls)}), tmp_path / "pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet')")
    res = con.execute(ORACLE_SQL["op9_url_templates"])
    return sorted(dict(zip([d[0] for d in res.description], r, strict=True)).items().__str__()
                  for r in res.fetchall())


@pytest.mark.parametrize("sections", [2, 17, 40])
def test_templates_are_the_sql_s_on_crowded_and_deep_hosts(spark, tmp_path, sections):
    """Many sections, seven levels, labels of all shares: code and SQL state one rule."""
    rng = random.Random(sections)
    urls = [f"http://www.a.com/{rng.choice(['de', 'fr'])}/{k % 60}" for k in range(90)]
    urls += [f"http://www.a.com/s{k % sections}/{rng.choice('xy')}/{k}" for k in range(300)]
    urls += [f"http://h{k % 3}.com/{rng.choice(['de', 'fr', 'up'])}/" + "/".join(
        rng.choice(["a", "b", "c", "17", "deadbeef01"]) for _ in range(rng.randrange(7)))
        for k in range(400)]
    urls += [None, "", "x", "http://h0.com", "http://h0.com/de", "http://only.net/a/b/c/d/e/f/g/h/i/j"]
    got = url_filter.judge_urls(pages(spark, urls)).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")
    assert sorted(r.asDict().items().__str__() for r in got.collect()) == sql_verdicts(tmp_path, urls)


def test_similar_branches_merge_by_their_counts(spark):
    """0.20 and 0.22 of many labels differ, of few they don't; one section more changes nothing."""
    def templates(labels, more=0):
        urls, marks = [], []
        for s, (bad, n) in labels.items():
            urls += [f"http://h/{s}/p/{k}" for k in range(n)]
            marks += [int(k < bad) for k in range(n)]
        urls += [f"http://h/other{k}/p/1" for k in range(more)]
        marks += [None] * more
        df = spark.createDataFrame(list(zip(range(len(urls)), urls, marks, strict=True)),
                                   "page_id long, url string, label int")
        return {r["path"].split("/")[1]: r["template"] for r in url_filter.judge_urls(
            df, label_col="label").collect()}
    few = templates({"a": (2, 10), "b": (3, 10), "c": (2, 10)})
    assert {t.split("/")[1] for t in few.values()} == {"~"}
    many = templates({"a": (0, 300), "b": (150, 300), "c": (300, 300)})
    assert [many[s].split("/")[1] for s in "abc"] == ["a", "b", "c"]
    crowded = templates({"a": (0, 300), "b": (150, 300), "c": (300, 300)}, more=30)
    assert {s: crowded[s] for s in "abc"} == many and {
        t.split("/")[1] for s, t in crowded.items() if s.startswith("other")} == {"*"}


def test_rows_that_share_an_id_are_dealt_over_blocks(spark):
    """A third of all rows have one id: no block gets them all."""
    rows = [(7 if k % 3 else k, [k % 11, 1]) for k in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    most = (df.withColumn("h", F.xxhash64("vec_id", F.monotonically_increasing_id()))
            .groupBy(F.pmod("h", F.lit(30))).count().agg(F.max("count")).first()[0])
    got = topk_search.top_k(df, F.col("vec_id") == 0, 20, candidates_per_block=100).collect()
    assert most < 200 and len(got) == 20
