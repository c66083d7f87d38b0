"""Operator 9 - URL filters: fixed host rules, then a path-template tree.

``judge_urls`` parses every url into host and path, applies the rules
(longest fitting rule wins), and judges the urls that no rule fits by the
method: per host, paths become templates, level by level.

* Variable segments become wildcards: numbers and hex ids by their form; at any place, what
  is rare there, with fewer than ``SMOOTHING`` labels and less than a ``RARE``-th of
  the place's pages. A segment's own evidence decides, not how many others there are.
* Statistically similar branches merge. A branch is tested against its place: labels b of l
  blocked, where the place's rate is p, differ if (b - l p)^2 > ``CRITICAL`` l p (1 - p)
  (one degree of freedom, 5 %), so ten thousand labels tell 0.20 from 0.22 and four don't.
  Those that don't differ are one branch, ``~``. Those above, and those below, are tested
  again, against their own side's rate: alike ones merge to ``~+`` and ``~-``, the others stay
  as they are.

A template is rejected when its smoothed labelled purity (share of blocked among labelled
urls, backed off to the same lexical path over all hosts) reaches ``block_at``. Labels come
from the rules, or from a label column (1 block, 0 allow) if one is given.

Only DataFrame functions run here. Pages are aggregated to (host, lexical
path) before anything else is shuffled, so a hot host arrives at the tree as
a few counted rows. No window runs over a node's children, of which there
may be many with labels: rates are sums per place and side.

Levels are built until no two paths of a host share a place, so a long path takes a level
only while others go with it. ``depth`` levels are literal if it is given, what lies deeper is
one ``**``.

Defined results: null url, or one without ``://``: host and path empty, no
rule; a null id is kept; repeated rows are all judged, each counts as a
label; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netcap.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "allow" or "block"

    @property
    def text(self) -> str:
        return self.host + self.path


# --- Fixed rules of the registered query ---
RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]
# --- end of fixed values ---

RARE = 16           # a segment with less than one of so many pages of its place is rare
CRITICAL = 3.84     # of a squared deviation: 5 % of chi-square with one degree of freedom
SMOOTHING = 4.0     # weight, in labels, of the value that a rate is smoothed to
PRIOR = 0.1         # block rate where nothing is labelled
BLOCK_AT = 0.5      # purity from which a template is rejected


def host_of(url: Column) -> Column:
    after = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return (((host == rule.host) | host.endswith("." + rule.host))
            & path.startswith(rule.path))


def first_fit(rules: list[Rule], host: Column, path: Column, field: str) -> Column:
    """``field`` of the longest fitting rule; ties go to the earlier rule."""
    out = F.lit(None).cast("string")
    for r in sorted(enumerate(rules), key=lambda x: (len(x[1].text), -x[0])):
        out = F.when(fits(r[1], host, path), F.lit(getattr(r[1], field))).otherwise(out)
    return out


def lexical(segment: Column) -> Column:
    """Numbers and hex ids as wildcards, anything else as it is."""
    return (F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"),
                   F.regexp_replace(segment, r"^[0-9]+", "{n}"))
            .when(segment.rlike(r"^[0-9A-Fa-f-]{8,}$"), F.lit("{h}"))
            .otherwise(segment))


def smoothed(bad: Column, labelled: Column, towards: Column) -> Column:
    a = F.lit(SMOOTHING)
    return (bad + a * towards) / (labelled + a)


def differs(bad: Column, labelled: Column, of_bad: Column, of_labelled: Column) -> tuple:
    """Whether a branch's labels differ from a rate, and whether they lie above it."""
    rate = smoothed(of_bad, of_labelled, F.lit(PRIOR))
    off = bad - labelled * rate
    return off * off > F.lit(CRITICAL) * (labelled * (rate * (F.lit(1.0) - rate))), off > 0


def branch_names(nodes: DataFrame) -> DataFrame:
    """``nodes``: host, template, seg, lab, bad, pages. The name of each that isn't rare."""
    spark = nodes.sparkSession
    place, own = ["host", "template"], ["lab", "bad"]
    whole = nodes.groupBy(*place).agg(F.sum("lab").alias("p_lab"), F.sum("bad").alias("p_bad"),
                                      F.sum("pages").alias("p_pages"))
    differ, above = differs(F.col("bad"), F.col("lab"), F.col("p_bad"), F.col("p_lab"))
    side = F.when(~differ, F.lit("~")).when(above, F.lit("~+")).otherwise(F.lit("~-"))
    rated = written(spark, nodes.join(whole, place)
                    .filter((F.col("lab") >= SMOOTHING) | (F.col("pages") * RARE >= F.col("p_pages")))
                    .select(*place, "seg", *own, side.alias("side")), "op9-rated")
    sides = rated.groupBy(*place, "side").agg(F.sum("lab").alias("g_lab"), F.sum("bad").alias("g_bad"))
    again, _ = differs(F.col("bad"), F.col("lab"), F.col("g_bad"), F.col("g_lab"))
    judged = written(spark, rated.join(sides, [*place, "side"]).select(
        *place, "seg", "side", ((F.col("side") == "~") | ~again).alias("alike")), "op9-sides")
    many = judged.groupBy(*place, "side", "alike").agg(F.count("*").alias("many"))
    return judged.join(many, [*place, "side", "alike"]).select(
        *place, "seg", F.when(F.col("alike") & (F.col("many") > 1), F.col("side"))
        .otherwise(F.col("seg")).alias("name"))


def template_tree(paths: DataFrame) -> DataFrame:
    """``paths``: host, lex, segs, pages, labelled, bad, one row per (host, lex).
    Adds ``template``, built one level of the tree at a time."""
    spark, i = paths.sparkSession, 0
    tree = written(spark, paths.withColumn("template", F.lit("")), "op9-tree")
    while True:
        at = tree.withColumn("seg", F.get(F.col("segs"), F.lit(i)))
        deeper = at.filter(F.col("seg").isNotNull())
        shared = deeper.groupBy("host", "template").agg(F.count("*").alias("n"))
        if (shared.agg(F.max("n")).first()[0] or 0) < 2:  # all paths are alone at their places
            break
        nodes = deeper.groupBy("host", "template", "seg").agg(
            *[F.sum(c).cast("double").alias(n) for c, n in (
                ("labelled", "lab"), ("bad", "bad"), ("pages", "pages"))])
        named = at.join(branch_names(nodes), ["host", "template", "seg"], "left")
        # A level uses the tree often: written, it is planned and computed once.
        tree, i = written(spark, named.withColumn("template", F.when(
            F.col("seg").isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), F.coalesce("name", F.lit("*")))))
            .drop("seg", "name"), "op9-tree"), i + 1
    rest = F.slice("segs", F.lit(i + 1), F.greatest(F.size("segs") - i, F.lit(0)))
    return tree.withColumn("template", F.concat(
        "template", F.array_join(F.transform(rest, lambda s: F.concat(F.lit("/"), s)), ""),
        F.when(F.col("lex").endswith("/**"), "/**").otherwise("")))


def judge_urls(pages: DataFrame, rules: list[Rule] = RULES, id_col: str = "page_id",
               url_col: str = "url", label_col: str | None = None,
               depth: int | None = None, block_at: float = BLOCK_AT) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, purity."""
    url = F.col(url_col).cast("string")
    label = F.col(label_col).cast("int") if label_col else F.lit(None).cast("int")
    base = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"), label.alias("given"))
    parts = F.split("path", "/")
    levels = F.size(parts) if depth is None else F.lit(depth)
    base = (base
            .withColumn("rule", first_fit(rules, F.col("host"), F.col("path"), "text"))
            .withColumn("ruled", first_fit(rules, F.col("host"), F.col("path"), "verdict"))
            .withColumn("label", F.coalesce(
                F.col("given"),
                F.when(F.col("ruled").isNotNull(), (F.col("ruled") == "block").cast("int"))))
            .withColumn("segs", F.transform(F.slice(parts, F.lit(2), levels), lexical))
            .withColumn("lex", F.concat(
                F.array_join(F.transform("segs", lambda s: F.concat(F.lit("/"), s)), ""),
                F.when(F.size(parts) > levels + 1, "/**").otherwise(""))))
    paths = (base.groupBy("host", "lex")
             .agg(F.first("segs").alias("segs"), F.count("*").alias("pages"),
                  F.count("label").alias("labelled"),
                  F.coalesce(F.sum("label"), F.lit(0)).alias("bad")))
    tree = template_tree(paths)
    by_template = tree.groupBy("host", "template").agg(
        F.sum("labelled").alias("t_lab"), F.sum("bad").alias("t_bad"))
    anywhere = tree.groupBy("lex").agg(F.sum("labelled").alias("g_lab"),
                                       F.sum("bad").alias("g_bad"))
    judged = (tree.select("host", "lex", "template")
              .join(by_template, ["host", "template"]).join(anywhere, "lex")
              .select("host", "lex", "template", smoothed(
                  F.col("t_bad"), F.col("t_lab"),
                  smoothed(F.col("g_bad"), F.col("g_lab"), F.lit(PRIOR))).alias("purity")))
    return (base.join(judged, ["host", "lex"])
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("purity") >= block_at, "block")
                               .otherwise("allow")).alias("verdict"),
                    "template", "purity"))
