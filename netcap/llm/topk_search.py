"""Operator 1 - exact top-k search by inner product, coarse to fine.

A vector is cut into equal segments; per segment its mean and its deviation
bound the distance of two vectors from below:

    |x - y|^2 >= sum over segments of L * ((mx - my)^2 + (sx - sy)^2)

and with x.y = (|x|^2 + |y|^2 - |x - y|^2) / 2 the inner product from above,
by sum L * (mx * my + sx * sy). For each query, all candidates of a block are
bounded with few segments, what can still reach the query's k-th best with
more of them, and survivors are computed exactly. Nothing is dropped that could
be a result: the search is exact.

Vectors and queries are dealt into blocks of bounded size by a hash of id and row;
a task gets one block of candidates and one block of queries (co-grouped),
and returns at most k rows for a query. The first threshold of a query is its
k-th best among ``PIVOTS`` vectors (those with the smallest hashes), a bound
only: it saves work and never decides. The pivots are the only rows that
pass the driver.

Defined results: null ids and null vectors, and vectors holding null or
non-finite components, take no part; empty vectors neither. Vectors of
another length than the query's aren't its candidates. Every row counts: rows that share
an id are candidates each (but not for a query of that id), and several rows of one query id
are ranked together. Ties go to the smaller id; fewer candidates than k: all of
them; an empty table gives no rows. Components and scores have to fit a long. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
LEVELS = (4, 16)          # segments, coarse to fine
CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
PIVOTS = 1024
QUERIES_AT_ONCE = 32

RESULT = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of every component as an array of longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    big = F.lit(float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)), F.lit(False))


def features(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(L) * mean and the norm of what deviates from it: the
    inner product of two vectors is at most that of their features."""
    out = []
    for part in np.array_split(x, min(segments, x.shape[1]), axis=1):
        mean = part.mean(axis=1)
        out.append(mean * np.sqrt(part.shape[1]))
        out.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(out, axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _exact(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether floats hold all products of ``x`` and ``q`` exactly."""
    return float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2 ** 53


def search_block(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray,
                 p_ids: np.ndarray, p: np.ndarray, k: int,
                 levels: tuple[int, ...] = LEVELS) -> tuple[list, list, list]:
    """Results of the queries ``q`` in one block of candidates ``x``; ``p``: pivots."""
    xs, qs = ([features(v.astype(np.float64), n) for n in levels] for v in (x, q))
    slack = 1e-9 * (1.0 + np.sqrt((xs[0] ** 2).sum(axis=1).max(initial=0)))
    give = slack * (1.0 + np.sqrt((qs[0] ** 2).sum(axis=1)))
    if _exact(x, q) and _exact(p, q):
        x, q, p = (v.astype(np.float64) for v in (x, q, p))
    at_least = np.full(len(q_ids), -np.inf)
    if len(p_ids) > k:
        known = (p @ q.T).astype(np.float64)
        known[p_ids[:, None] == q_ids] = -np.inf
        at_least = np.partition(known, len(known) - k, axis=0)[len(known) - k]
    out_q, out_v, out_s = [], [], []
    for lo in range(0, len(q_ids), QUERIES_AT_ONCE):
        at = slice(lo, lo + QUERIES_AT_ONCE)
        rows = np.arange(len(ids))
        alive = ids[:, None] != q_ids[at]
        for level_x, level_q in zip(xs, qs, strict=True):
            # Rows that no query of these needs any more leave after each level.
            alive &= level_x[rows] @ level_q[at].T + give[at] >= at_least[at]
            left = alive.any(axis=1)
            rows, alive = rows[left], alive[left]
        scores = x[rows] @ q[at].T
        alive &= scores >= at_least[at]
        for j, query in enumerate(q_ids[at]):
            of = np.flatnonzero(alive[:, j])
            best = of[_best(scores[of, j], ids[rows[of]], k)]
            out_q.append(np.full(len(best), query))
            out_v.append(ids[rows[best]])
            out_s.append(scores[best, j].astype(np.int64))
    return out_q, out_v, out_s


def _matrix(t: pa.Table) -> np.ndarray:
    column = t.column("vec").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)


def top_k(vectors: DataFrame, is_query: Column, k: int = K,
          candidates_per_block: int = CANDIDATES_PER_BLOCK,
          queries_per_block: int = QUERIES_PER_BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``vectors``: vec_id long, vec array<long>; ``is_query``: of vec_id.
    query_id, rank (from 1), vec_id, score."""
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vec")
            .filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
            .withColumn("dim", F.size("vec"))
            # By row, not by id: rows that share an id are dealt over all blocks.
            .withColumn("h", F.xxhash64("vec_id", F.monotonically_increasing_id())))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    n_c = max(1, -(-sizes["n"] // candidates_per_block))
    n_q = max(1, -(-sizes["q"] // queries_per_block))
    by_dim: dict[int, list] = {}
    for r in rows.orderBy("h").limit(pivots).collect():  # bounded by ``pivots``
        by_dim.setdefault(r["dim"], []).append((r["vec_id"], r["vec"]))
    known = {d: (np.array([i for i, _ in v], np.int64), np.array([x for _, x in v], np.int64))
             for d, v in by_dim.items()}

    block, q_block = F.pmod("h", F.lit(n_c)), F.pmod(F.xxhash64("h"), F.lit(n_q))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    candidates = rows.select("dim", block.alias("c_block"), every(n_q).alias("q_block"),
                             "vec_id", "vec")
    queries = rows.filter(is_query).select("dim", q_block.alias("q_block"),
                                           every(n_c).alias("c_block"), "vec_id", "vec")

    def search(key: tuple, c: pa.Table, q: pa.Table) -> pa.Table:
        if not len(c) or not len(q):
            empty = np.empty(0, np.int64)
            found = ([empty], [empty], [empty])
        else:
            dim = key[0].as_py()
            p_ids, p = known.get(dim, (np.empty(0, np.int64), np.empty((0, dim), np.int64)))
            found = search_block(c.column("vec_id").to_numpy(), _matrix(c),
                                 q.column("vec_id").to_numpy(), _matrix(q), p_ids, p, k)
        names = ["query_id", "vec_id", "score"]
        return pa.table({n: np.concatenate(v).astype(np.int64)
                         for n, v in zip(names, found, strict=True)})

    keys = ["dim", "c_block", "q_block"]
    partial = (candidates.groupBy(*keys).cogroup(queries.groupBy(*keys))
               .applyInArrow(search, RESULT))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
