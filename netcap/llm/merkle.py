"""Operator 11 - Merkle dataset manifest with proofs by pointer jumping.

A row's leaf is H (lowercase hex sha256) of its columns, each as byte count, ``:``
and value, null as ``-``. Per source, leaves in the order of doc_id are the lowest
level of a tree; every 16 consecutive nodes (a run) become the H of their digests,
until one is left, the subroot. The subroots, by source, make the top tree, whose
last node is the root.

1. Leaves are hashed once and written, without texts. A range partitioning by
   (source, doc_id) and a place within each partition give every leaf its place in its
   source: the places before it are counted per (partition, source) only, so a source may
   hold any share of all rows.
2. Levels are built by grouping 16 nodes; each is a sixteenth of the one below. The
   subroots are placed in the same way.
3. Proofs: the nodes of a run have the same ancestors, so a run is one row: its 16
   digests, the run that its parent lies in, and the parent's place there. Repeated
   self-joins double the distance: to its path a run adds the run that it points to and
   that one's path, and points where that one pointed. After the logarithm of the depth
   all point beyond the root.
4. A leaf joins its run's path and folds it: siblings left and right of its place at
   every level. ``proof_sha256`` is H of all siblings; ``folded_root`` starts with the leaf of
   what is held against the manifest (``check``), else with the leaf itself.

Everything is a DataFrame function; the driver sees the depths only. A run near the root,
to which many point, is a hot key of a join of two written tables, which Spark can split.

Defined results: a null doc_id sorts first and is never tampered with. Rows that share
source and doc_id are ordered by their leaves; equal rows are interchangeable. Columns
that ``docs`` lacks count as null. A source with one row has its leaf as subroot; with one source
the subroot is the root; without siblings the proof is H of nothing. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netcap.llm.common import written
from netcap.llm.url_filter import LOWER, UPPER

ARITY = 16
HEX = 64             # characters of a digest
TAMPERED = 5         # one of so many documents, by the crc32 of its id
TOP = -1             # the top tree's number; a source's is its first leaf's (below)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 33       # monotonically_increasing_id holds the partition above these

RUNS = "tree long, level int, run long, many long, kids string, digest string"
PATH = "array<struct<place: int, kids: string, top: boolean>>"


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf(*values: Column) -> Column:
    """H of the values, each with its length, so that no two rows read alike."""
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"),
                                v.cast("string")), F.lit("-")) for v in values]
    return digest(F.concat(*said))


def tampered_text() -> Column:
    """The text that is held against the manifest."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def leaves(docs: DataFrame, check: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, held (the leaf of what is checked), tie (tells equal rows apart)."""
    there = {c.lower() for c in docs.columns}
    base = docs.select(*[(F.col(c) if c in there else F.lit(None).cast("string")).alias(c)
                         for c in FIELDS])
    values = {c: F.col(c) for c in FIELDS}
    text = F.col("text") if check is None else check
    return base.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        leaf(*values.values()).alias("leaf"),
        leaf(*(values | {"text": text}).values()).alias("held"),
        F.monotonically_increasing_id().alias("tie"))


def placed(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Adds ``tree`` (a number per group, rising with it), ``at`` (the place in the group's
    order, from 0) and ``many`` (the group's rows)."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = (rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
              .withColumn("own", F.monotonically_increasing_id())
              .withColumn("part", F.shiftright("own", PART_BITS)))
    spread = written(spark, spread, f"{name}-spread")
    each = Window.partitionBy("group")   # a row per partition at most
    before = F.sum("n").over(each.orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1))
    spans = (spread.groupBy(F.col("part").alias("in_part"), F.col(group).alias("group"))
             .agg(F.count("*").alias("n"), F.min("own").alias("first"))
             .select("in_part", "group", "first", F.coalesce(before, F.lit(0)).alias("before"),
                     F.sum("n").over(each).alias("many"), F.min("first").over(each).alias("tree")))
    met = (F.col("part") == F.col("in_part")) & F.col(group).eqNullSafe(F.col("group"))
    at = F.col("before") + F.col("own") - F.col("first")
    return spread.join(spans, met).select(*rows.columns, "tree", at.alias("at"), "many")


def runs_of(nodes: DataFrame, level: int) -> DataFrame:
    """``nodes``: tree, at, many, digest. One row per run: its digests, and its own digest."""
    run = F.floor(F.col("at") / ARITY).cast("long")
    held = F.sort_array(F.collect_list(F.struct("at", "digest")))  # 16 at most
    return (nodes.groupBy("tree", run.alias("run"), "many").agg(held.alias("held"))
            .select("tree", F.lit(level).alias("level"), "run", "many",
                    F.array_join(F.transform("held", lambda x: x["digest"]), "").alias("kids"))
            .withColumn("digest", digest(F.col("kids"))))


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The runs of every level. A tree is done when a level has one node."""
    out = []
    most = nodes.agg(F.max("many")).first()[0] or 0
    while most > 1:
        made = runs_of(nodes.filter(F.col("many") > 1), len(out))
        out.append(written(nodes.sparkSession, made, f"{name}-level"))
        nodes = out[-1].select("tree", F.col("run").alias("at"), F.ceil(
            F.col("many") / ARITY).cast("long").alias("many"), "digest")
        most = -(-most // ARITY)
    return out


def together(spark: SparkSession, runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs) if runs else spark.createDataFrame([], RUNS)


def run_key(tree: Column, level: Column, node: Column) -> Column:
    """Of the run that a node of a level lies in."""
    run = F.floor(node / ARITY).cast("long")
    return F.concat_ws(":", *(c.cast("string") for c in (tree, level, run)))


def place(at: Column) -> Column:
    return F.pmod(at, F.lit(ARITY)).cast("int")


def segment(at: Column, kids: Column, top: Column) -> Column:
    """One level of a path: a place in a run, and the run's digests."""
    return F.struct(at.alias("place"), kids.alias("kids"), top.alias("top"))


def jump(runs: DataFrame, depth: int) -> DataFrame:
    """``runs``: key, kids, top, up (the key of the run above, or null), up_place. Adds ``path``:
    the segments of all runs above."""
    spark = runs.sparkSession
    columns = ["key", "kids", "top", "up", "up_place", "path"]
    table = runs.withColumn("path", F.array().cast(PATH)).select(*columns)
    table, reached = written(spark, table, "op11-jump"), 1
    while reached < depth:
        # ``path`` is what lies between a run and the one that it points to.
        above = table.select(F.col("key").alias("up"), *(
            F.col(c).alias(f"a_{c}") for c in columns if c != "key"))
        step = F.array(segment(F.col("up_place"), F.col("a_kids"), F.col("a_top")))
        path = F.when(F.col("up").isNull(), F.col("path")).otherwise(
            F.concat("path", step, "a_path"))
        table = (table.join(above, "up", "left")
                 .select("key", "kids", "top", F.col("a_up").alias("up"),
                         F.col("a_up_place").alias("up_place"), path.alias("path")))
        table, reached = written(spark, table, "op11-jump"), 2 * reached
    return table


def all_runs(below: DataFrame, above: DataFrame, hung: DataFrame) -> DataFrame:
    """Every run and where it points. A run's digest is the node (tree, level + 1, run): it lies
    in a run of its own tree or, if it is a subroot, of the top tree; the root lies in none."""
    at, run = F.col("level"), F.col("run")
    key = run_key(F.col("tree"), at, run * ARITY).alias("key")
    inside = [key, "kids", (F.col("tree") == TOP).alias("top"),
              run_key(F.col("tree"), at + 1, run).alias("up"), place(run).alias("up_place")]
    runs = below.unionByName(above)
    last = F.col("many") <= ARITY
    none = [F.lit(None).cast("string").alias("up"), F.lit(None).cast("int").alias("up_place")]
    return (runs.filter(~last).select(*inside)
            .unionByName(below.filter(last).join(hung, "tree").select(*inside[:3], "up", "up_place"))
            .unionByName(above.filter(last).select(*inside[:3], *none)))


def sides(x: Column) -> tuple[Column, Column]:
    """Digests to the left and to the right of a segment's place."""
    at = x["place"] * HEX
    return (F.substring(x["kids"], F.lit(1), at),
            F.substring(x["kids"], at + HEX + 1, F.lit(ARITY * HEX)))


def folded(path: Column, start: Column) -> Column:
    def up(node: Column, x: Column) -> Column:
        left, right = sides(x)
        return digest(F.concat(left, node, right))

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, check: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.
    ``check``: the text held against the manifest, an expression of ``FIELDS``."""
    spark = docs.sparkSession
    base = written(spark, leaves(docs, tampered_text() if check is None else check), "op11-leaves")
    rows = written(spark, placed(base, "source", ["doc_id", "leaf", "tie"], "op11-docs"),
                   "op11-docs")
    lower = levels(rows.select("tree", "at", "many", F.col("leaf").alias("digest")), "op11-docs")
    below = together(spark, lower)
    # Of each source: the last run's digest, or the lone leaf.
    subroots = (below.filter(F.col("many") <= ARITY).select("tree", "digest").unionByName(
        rows.filter(F.col("many") == 1).select("tree", F.col("leaf").alias("digest"))))
    tops = placed(subroots.select(F.col("tree").alias("source_tree"), "digest",
                                  F.lit(TOP).cast("long").alias("all")),
                  "all", ["source_tree"], "op11-top")
    tops = written(spark, tops.withColumn("tree", F.col("all")), "op11-top")
    upper = levels(tops.select("tree", "at", "many", "digest"), "op11-top")
    above = together(spark, upper)

    alone = F.col("many") == 1
    hung = tops.select(
        F.col("source_tree").alias("tree"),
        F.when(~alone, run_key(F.col("tree"), F.lit(0), F.col("at"))).alias("up"),
        F.when(~alone, place(F.col("at"))).alias("up_place"))
    paths = jump(all_runs(below, above, hung), len(lower) + len(upper))

    # A leaf's first run is one of its own tree or, of a lone leaf, where its source hangs.
    first = (rows.filter(~alone).select("doc_id", "leaf", "held", run_key(
        F.col("tree"), F.lit(0), F.col("at")).alias("key"), place(F.col("at")).alias("own"))
        .unionByName(rows.filter(alone).join(hung, "tree").select(
            "doc_id", "leaf", "held", F.col("up").alias("key"), F.col("up_place").alias("own"))))
    own = segment(F.col("own"), F.col("kids"), F.col("top"))
    ends = paths.select(
        "key", "kids", "top", "path",
        digest(F.coalesce(F.get("path", F.size("path") - 1)["kids"], F.col("kids"))).alias("root"),
        F.when(~F.col("top"), digest(F.coalesce(F.try_element_at(F.filter(
            "path", lambda x: ~x["top"]), F.lit(-1))["kids"], F.col("kids")))).alias("subroot"))
    whole = F.when(F.col("kids").isNull(), F.array().cast(PATH)).otherwise(
        F.concat(F.array(own), "path"))
    proof = digest(F.array_join(F.transform("whole", lambda x: F.concat(*sides(x))), ""))
    return (first.join(ends, "key", "left").withColumn("whole", whole)
            .select("doc_id", "leaf", F.coalesce("subroot", "leaf").alias("subroot"),
                    F.coalesce("root", "leaf").alias("root"), proof.alias("proof_sha256"),
                    folded(F.col("whole"), F.col("held")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
