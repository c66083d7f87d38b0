"""Operator 2 - WARC: not-modified revisit resolution.

``resolve_revisits`` finds, for every revisit record, the latest earlier full
response of the same canonical url (as-of join), checks the validators and
merges those headers that a not-modified answer may update into the stored
response's.

Records: record_id, url, kind ("response" or "revisit"), captured
(timestamp), headers (map, any case), digest (of the payload). The payload
itself stays where it is: the result names the record that holds it.

The as-of join is a running ``last`` in two levels, so that a url with a
third of all records is not one group: inside (url, time bucket) first, then
over the last responses of buckets. A record without a response in its bucket
takes the one carried from the buckets before. Frames run, they hold one row.

Validators: if both sides have an etag, weak equality of the etags decides; else
if both have last-modified, its equality; else if both have a digest, that;
else the revisit is unconfirmed. Only the latest earlier response is tried.

Defined results: earlier means (captured, record_id) smaller; repeated rows
are equal, so any one stands for all; null url or captured: status
``no_original``; null headers are empty ones, of names that differ in case the
smallest value counts; null kind is neither, and not returned; null digests
don't confirm. Extra columns are ignored; empty frames give an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netcap.llm.common import text_or_empty

# --- Fixed values: header fields that a 304 answer may update (RFC 9110),
# and query parameters that only track the visitor ---
UPDATABLE = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref"]
# --- end of fixed values ---
BUCKET_SECONDS = 3600


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, no fragment, no tracking
    parameters, the others in order, no closing slash; http counts as https."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    rest = F.regexp_replace(bare, r"(?is)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.split(
        p, "=")[0].isin(TRACKING)))
    return F.concat(F.lit("https://"), host, path, F.when(F.size(kept) > 0, F.concat(
        F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _headers(h: Column) -> Column:
    """Names in lower case and once each, sorted."""
    pairs = F.array_sort(F.transform(F.map_entries(F.coalesce(h, F.create_map().cast(
        "map<string,string>"))), lambda e: F.struct(
            F.lower(e["key"]).alias("key"), text_or_empty(e["value"]).alias("value"))))
    first = F.filter(pairs, lambda e, i: (i == 0) | (F.get(pairs, i - 1)["key"] != e["key"]))
    return F.map_from_entries(first)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per revisit: record_id, canonical_url, status (resolved,
    validator_mismatch, unconfirmed, no_original), response_id, digest (of the
    response, if resolved), headers (merged, if resolved, else the revisit's)."""
    at = F.col("captured").cast("timestamp")
    r = records.select(
        "record_id", canonical_url(F.col("url").cast("string")).alias("canonical_url"), "kind",
        at.alias("captured"), F.floor(F.unix_micros(at) / (bucket_seconds * 1_000_000)).alias(
            "bucket"),
        _headers(F.col("headers")).alias("headers"), "digest")
    r = r.filter(F.col("kind").isin("response", "revisit"))
    usable = F.col("canonical_url").isNotNull() & F.col("bucket").isNotNull()
    stored = F.when(F.col("kind") == "response", F.struct("record_id", "headers", "digest"))
    dated = r.filter(usable)
    within = Window.partitionBy("canonical_url", "bucket").orderBy("captured", "record_id", "kind")
    near = dated.withColumn("near", F.last(stored, ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, -1)))
    lasts = (dated.groupBy("canonical_url", "bucket")
             .agg(F.max(F.when(F.col("kind") == "response", F.struct(
                 "captured", "record_id"))).alias("m")))
    # The last response of each bucket, by its id, then of all buckets before.
    over = Window.partitionBy("canonical_url").orderBy("bucket")
    carried = lasts.select("canonical_url", "bucket", F.last(
        F.col("m.record_id"), ignorenulls=True).over(
            over.rowsBetween(Window.unboundedPreceding, -1)).alias("far_id"))
    originals = dated.filter(F.col("kind") == "response").select(
        "canonical_url", F.col("record_id").alias("far_id"), F.struct(
            "record_id", "headers", "digest").alias("far")).dropDuplicates(
                ["canonical_url", "far_id"])
    revisits = (near.filter(F.col("kind") == "revisit")
                .join(carried, ["canonical_url", "bucket"], "left")
                .withColumn("far_id", F.when(F.col("near").isNull(), F.col("far_id")))
                .join(originals, ["canonical_url", "far_id"], "left"))
    found = revisits.withColumn("original", F.coalesce("near", "far")).select(
        "record_id", "canonical_url", "headers", "digest", "original")
    lost = r.filter(~usable & (F.col("kind") == "revisit")).select(
        "record_id", "canonical_url", "headers", "digest",
        F.lit(None).cast(found.schema["original"].dataType).alias("original"))
    all_of_them = found.unionByName(lost)
    old, new = F.col("original.headers"), F.col("headers")
    confirmed = F.coalesce(
        _weak(new["etag"]) == _weak(old["etag"]), new["last-modified"] == old["last-modified"],
        F.col("digest") == F.col("original.digest"))
    status = (F.when(F.col("original").isNull(), "no_original")
              .when(confirmed.isNull(), "unconfirmed")
              .when(confirmed, "resolved").otherwise("validator_mismatch"))
    merged = F.map_concat(
        F.map_filter(old, lambda k, v: ~(k.isin(UPDATABLE) & F.map_contains_key(new, k))),
        F.map_filter(new, lambda k, v: k.isin(UPDATABLE)))
    resolved = F.col("status") == "resolved"
    return all_of_them.withColumn("status", status).select(
        "record_id", "canonical_url", "status", F.col("original.record_id").alias("response_id"),
        F.when(resolved, F.col("original.digest")).alias("digest"),
        F.when(resolved, merged).otherwise(new).alias("headers"))


def header_text(headers: Column) -> Column:
    """Header lines in order of their names."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(
        e["key"], F.lit(": "), e["value"])), "\n")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Capture records that the ``pages`` table stands for. Each page is a full
    response, captured a minute after the page before it; the payload's digest
    and the etag come from its whole html. Two thirds of the pages were visited again
    7 hours later, those divisible by 4 under a changed etag; those divisible by 5
    an hour before their first response."""
    p = pages.select("page_id", F.col("url").cast("string").alias("url"),
                     F.md5(text_or_empty(F.col("html"))).alias("digest"))
    seconds = F.lit(1_700_000_000) + F.col("page_id") * 60
    when = lambda s: F.timestamp_seconds(s)
    stamp = lambda s: s.cast("string")
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    first = p.select(
        (F.col("page_id") * 4).alias("record_id"), "url", F.lit("response").alias("kind"),
        when(seconds).alias("captured"), F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), etag,
            F.lit("Date"), stamp(seconds), F.lit("Cache-Control"), F.lit("max-age=60"),
            F.lit("Set-Cookie"), F.concat(F.lit("s="), F.col("page_id").cast("string"))
        ).alias("headers"), "digest")
    again = p.filter(F.col("page_id") % 3 != 0)
    later = F.when(F.col("page_id") % 5 == 0, seconds - 3600).otherwise(seconds + 25_200)
    tag = F.when(F.col("page_id") % 4 == 0, F.lit('"changed"')).otherwise(
        F.concat(F.lit("W/"), etag))
    second = again.select(
        (F.col("page_id") * 4 + 1).alias("record_id"), "url", F.lit("revisit").alias("kind"),
        when(later).alias("captured"), F.create_map(
            F.lit("etag"), tag, F.lit("date"), stamp(later), F.lit("cache-control"),
            F.lit("max-age=600"), F.lit("set-cookie"), F.lit("s=other")).alias("headers"),
        F.lit(None).cast("string").alias("digest"))
    return first.unionByName(second)
