"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from netcap.llm import (
    chat_tools, fingerprint, langid, line_dedup, merkle, mixing, ngram_join, packing, quality,
    topk_search, url_filter, warc_revisit, whitening,
)
from netcap.llm.common import for_workers, read_table


def q_topk(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").filter(topk_search.usable(F.col("embedding")))
    vectors = e.select("vec_id", topk_search.quantised(F.col("embedding")).alias("vec"))
    return topk_search.top_k(vectors, F.col("vec_id") % 20 == 0)


def q_warc(spark, sf_dir):
    records = warc_revisit.crawl_records(read_table(spark, sf_dir, "pages"))
    return warc_revisit.resolve_revisits(records).withColumn(
        "headers", warc_revisit.header_text(F.col("headers")))


def q_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def q_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup_report(read_table(spark, sf_dir, "documents"))


def q_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


def q_fingerprint(spark, sf_dir):
    return fingerprint.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def q_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents")).drop("class_id")


def q_langid(spark, sf_dir):
    return langid.identify(read_table(spark, sf_dir, "documents"))


def q_url_filter(spark, sf_dir):
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def q_chat_tools(spark, sf_dir):
    return chat_tools.link_tool_calls(
        *chat_tools.tool_traffic(read_table(spark, sf_dir, "conversations")))


def q_merkle(spark, sf_dir):
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def q_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def q_quality(spark, sf_dir):
    return quality.quality_scores(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "labels"))


QUERIES = {name: for_workers(query) for name, query in {
    "op1_exact_topk": q_topk,
    "op2_warc_revisits": q_warc,
    "op3_poisson_mix": q_mixing,
    "op4_line_dedup": q_line_dedup,
    "op5_config_packing": q_packing,
    "op6_iblt_fingerprints": q_fingerprint,
    "op7_ngram_join": q_ngram_join,
    "op8_hd_language": q_langid,
    "op9_url_templates": q_url_filter,
    "op10_tool_calls": q_chat_tools,
    "op11_merkle_manifest": q_merkle,
    "op12_whitening": q_whitening,
    "op13_byte_quality": q_quality,
}.items()}
