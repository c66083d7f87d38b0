"""Feed sources and payload decoding.

``read_feed`` reads the four topics (Kafka, or the file twin with the same
columns); ``decode`` parses the JSON payload; ``decode_rows`` unnests items into one
frame of capital events and of what is wrong, each with its ``reason``, instead of
failing; ``events_of`` and ``dead_letter`` are filters on it. All of it is narrow,
per-record work on the JVM (variants, ``posexplode``), usable on batch and streaming
frames alike; the payload is parsed once, whatever is made of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from netcap.functions.columns import money, utc_wall_clock
from netcap.schemas import (
    ARRAY_FIELD_ORDER, RECORD_SCHEMA, SHARE, TOPICS, UNKNOWN_FSP,
)

TOPIC_TO_SOURCE = {t: s for s, t in TOPICS.items()}


# --- S1 / S2: sources -------------------------------------------------------

def kafka_options(bootstrap_servers: str, topics=None, starting_offsets: str = "earliest",
                  **extra) -> dict:
    """Options of the Kafka source for the four feeds. The consumer group
    of the reference becomes the query checkpoint; ``earliest`` rebuilds
    from the start when there is no checkpoint yet. Offsets that expired unread fail
    the query (Spark's default): a position without them would be wrong for ever."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics or TOPICS.values()),
        "startingOffsets": starting_offsets,
        "includeHeaders": "true",
    }
    opts.update(extra)
    return opts


def admission(fmt: str = "kafka", per_batch: int | None = None, max_bytes: int | None = None,
              min_partitions: int | None = None) -> dict:
    """Source options that bound a micro-batch, so that a first read from the earliest
    offset (or a rebuild) is many bounded batches and not one of all there is; the drain
    trigger (``availableNow``) keeps to them. For topics ``per_batch`` is a number of
    records, split over the topics' partitions by their backlog, and ``min_partitions``
    cuts large offset ranges into more tasks than there are topic partitions. For the file
    twin ``per_batch`` is a number of files; ``max_bytes`` bounds their size instead."""
    if fmt == "kafka":
        if max_bytes is not None:
            raise ValueError("topics are bounded by records, not by bytes")
        bounds = {"maxOffsetsPerTrigger": per_batch, "minPartitions": min_partitions}
    else:
        if min_partitions is not None or None not in (per_batch, max_bytes):
            raise ValueError("files are bounded by their number or by bytes")
        bounds = {"maxFilesPerTrigger": per_batch, "maxBytesPerTrigger": max_bytes}
    return {name: str(int(n)) for name, n in bounds.items() if n is not None}


def read_feed(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
              options: dict | None = None, streaming: bool = True) -> DataFrame:
    """Records of the four feeds as (key, value, topic, partition, offset,
    timestamp, headers); ``timestamp`` is the record time (UTC, NTZ).

    ``fmt="kafka"`` subscribes to all four topics in one scan (one source,
    so the feeds share one micro-batch). ``fmt="parquet"`` or ``"json"``
    reads the file twin at ``path`` with the same columns. ``admission`` gives the
    options that bound a micro-batch.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        df = reader.format("kafka").options(**(options or {})).load()
        return df.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset",
            utc_wall_clock("timestamp").alias("timestamp"), "headers")
    if path is None:
        raise ValueError("path is required for file feeds")
    r = reader.schema(RECORD_SCHEMA).options(**(options or {}))
    return r.format(fmt).load(path)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Concatenate per-feed record frames (no dedup), for sources read one
    topic at a time; a single ``subscribe`` of all four topics needs none."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out


# --- N1 / N2: decode --------------------------------------------------------

def decode(records: DataFrame) -> DataFrame:
    """Parse ``value``; ``items`` = the first candidate array that is an
    array (an empty array counts), whatever the topic. Text that is no JSON
    leaves ``payload`` NULL. Payload and items are variants: an item is read on
    its own, whatever its neighbours are, and numbers keep all their digits. Of a name
    that comes twice in an object the last value counts."""
    # A session setting of Spark: without it a repeated name would make the text no JSON.
    records.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    out = records.withColumn("payload", F.try_parse_json("value"))
    items = F.coalesce(*[F.try_variant_get("payload", f"$.{a}", "array<variant>")
                         for a in ARRAY_FIELD_ORDER])
    source = None
    for t, s in TOPIC_TO_SOURCE.items():
        source = (F.when(F.col("topic") == t, F.lit(s)) if source is None
                  else source.when(F.col("topic") == t, F.lit(s)))
    return out.withColumn("items", items).withColumn("source_type", source)


def message_fault() -> F.Column:
    """N4, message level: why a message has no items; NULL where it has an array. A
    message is bad when its topic is none of the four feeds', or when no candidate is
    an array: NULL value, malformed or truncated JSON, a root array, or no array."""
    return (F.when(F.col("source_type").isNull(), F.lit("unknown_topic"))
            .when(F.col("value").isNull(), F.lit("null_value"))
            .when(F.col("payload").isNull(), F.lit("malformed"))
            .when(F.col("items").isNull(), F.lit("no_array")))


# --- N3, N5-N7, N10, N13, N14, N17: one frame of events and faults -----------

ITEM_FIELDS = ("reportingDate", "transactionDate", "tzsAmount", "orgAmount", "currency",
               "sectorSnaClassification", "sector")
_ITEM = "struct<" + ", ".join(f"{f}: string" for f in ITEM_FIELDS) + ">"

#: Reasons of what is wrong. Those of the second line lose the message or item; a bad
#: transaction date is reported only: the event stays, with its reporting date.
REPORTED = ("bad_transaction_date",)
LOST = ("unknown_topic", "null_value", "malformed", "no_array", "bad_item", "bad_date",
        "amount_overflow")
REASONS = (*LOST, *REPORTED)

EVENT_COLUMNS = ["event_id", "source_type", "fsp_id", "sector", "reporting_date",
                 "transaction_date", "amount", "ingestion_time", "org_amount", "currency",
                 "raw_payload", "topic", "partition", "offset", "item_index"]


def _number(text):
    """A JSON amount's text as a decimal with six places; junk and NULL are NULL."""
    return text.try_cast("decimal(38,6)")


def _too_large(text):
    """A number, but one that no decimal of 38 digits holds."""
    wide = text.try_cast("double")
    return wide.isNotNull() & ~F.isnan(wide) & _number(text).isNull()


def decode_rows(records: DataFrame, missing_fsp: str = "unknown") -> DataFrame:
    """One row per item, and one per message without items: the event's columns,
    ``raw`` and ``reason`` (NULL where nothing is wrong).

    An empty array gives no row; an item that is no object is ``bad_item``, its
    neighbours stay. FSP missing -> ``UNKNOWN`` (or the row is dropped with
    ``missing_fsp="drop"``); transaction date missing or blank -> reporting date, not a
    date -> reporting date and ``bad_transaction_date``; amount missing or junk -> 0, a
    number too large for DECIMAL(20,4) -> ``amount_overflow``; reporting date not a date
    -> ``bad_date``. ``sector`` is the submitted one (``sectorSnaClassification`` for
    shares, ``sector`` otherwise); the sector rule is applied by the position fold.
    ``org_amount`` and ``currency`` are the original ones, if sent.

    (topic, partition, offset, item_index) identify an event; ``event_id`` is
    their hash. ``raw_payload`` is the item's own JSON, not the message's.
    """
    if missing_fsp not in ("unknown", "drop"):
        raise ValueError("missing_fsp must be 'unknown' or 'drop'")
    d = decode(records).withColumn("_fault", message_fault())
    # An item's fields are read in one go, below the generator: what is computed of them above
    # (filters too, wherever they are pushed) is plain columns.
    entries = F.transform("items", lambda x: F.struct(
        x.alias("item"), F.try_variant_get(x, "$", _ITEM).alias("f")))
    # posexplode_outer + a filter on its own output: the inner explode would
    # make Spark infer ``items IS NOT NULL`` and push it below the parse.
    x = d.select("topic", "partition", "offset", "timestamp", "source_type", "_fault", "value",
                 F.try_variant_get("payload", "$.fspInformationId", "string").alias("_fsp"),
                 F.posexplode_outer(F.when(F.col("_fault").isNull(), entries))
                 .alias("item_index", "entry"))
    x = x.filter(F.col("item_index").isNotNull() | F.col("_fault").isNotNull())
    field = {name: F.col(f"entry.f.{name}") for name in ITEM_FIELDS}
    fsp = F.col("_fsp")
    if missing_fsp == "unknown":
        fsp = F.coalesce(fsp, F.lit(UNKNOWN_FSP))
    reporting = field["reportingDate"].try_cast("date")
    said = F.nullif(F.trim(field["transactionDate"]), F.lit(""))
    transaction = said.try_cast("date")
    sent = field["tzsAmount"]
    amount = F.when(_too_large(sent), F.lit(None)).otherwise(
        money(F.coalesce(_number(sent), F.lit(0).cast("decimal(38,6)"))))
    sector = F.when(F.col("source_type") == SHARE, field["sectorSnaClassification"]) \
        .otherwise(field["sector"])
    reason = (F.when(F.col("item_index").isNull(), F.col("_fault"))
              .when(F.col("entry.f").isNull(), F.lit("bad_item"))
              .when(reporting.isNull(), F.lit("bad_date"))
              .when(amount.isNull(), F.lit("amount_overflow"))
              .when(said.isNotNull() & transaction.isNull(), F.lit("bad_transaction_date")))
    item = F.to_json("entry.item")
    rows = x.select(
        F.xxhash64("topic", "partition", "offset", "item_index").alias("event_id"),
        "source_type", fsp.alias("fsp_id"), sector.alias("sector"),
        reporting.alias("reporting_date"),
        F.coalesce(transaction, reporting).alias("transaction_date"),
        amount.alias("amount"),
        F.col("timestamp").alias("ingestion_time"),
        money(_number(field["orgAmount"])).alias("org_amount"),
        field["currency"].alias("currency"),
        item.alias("raw_payload"), "topic", "partition", "offset", "item_index",
        F.when(reason.isNotNull(), F.coalesce(item, "value")).alias("raw"),
        reason.alias("reason"))
    if missing_fsp == "drop":
        rows = rows.filter(F.col("fsp_id").isNotNull() | F.col("item_index").isNull())
    return rows


def events_of(rows: DataFrame) -> DataFrame:
    """The capital events among decoded rows."""
    return rows.filter(F.col("reason").isNull() | F.col("reason").isin(*REPORTED)).select(
        *EVENT_COLUMNS)


def dead_letter(rows: DataFrame) -> DataFrame:
    """raw, topic, reason of all that is wrong."""
    return rows.filter(F.col("reason").isNotNull()).select("raw", "topic", "reason")


def decode_feed(records: DataFrame, missing_fsp: str = "unknown") -> tuple[DataFrame, DataFrame]:
    """Records -> (capital events, dead letter), never failing on input. Both come
    from one frame; keep ``decode_rows`` where both are used."""
    rows = decode_rows(records, missing_fsp)
    return events_of(rows), dead_letter(rows)


def observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Decoded rows that are counted by reason while they are computed: no job of its
    own. ``events`` counts the capital events, ``rows`` all rows."""
    seen = Observation()
    fine = F.col("reason").isNull() | F.col("reason").isin(*REPORTED)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(fine).alias("events"),
                        *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS]), seen
