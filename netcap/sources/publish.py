"""Publish capital events as feed messages (the inverse of decoding).

One message per event, as the feeds send them: a nested JSON payload with
the feed's array name holding one item, key ``fsp:sector:date``, topic of
the feed, record timestamp = ingestion time and four headers. A narrow
projection: no shuffle and no grouping, so a hot key costs nothing extra.
Events of an unknown source type have no feed and are not published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netcap.functions.columns import composite_key, keyed_partition
from netcap.schemas import ARRAY_FIELDS, SHARE, SOURCE_TYPES, TOPICS


def _item(source_type: str, with_currency: bool):
    fields = [F.date_format("reporting_date", "yyyy-MM-dd").alias("reportingDate"),
              F.date_format("transaction_date", "yyyy-MM-dd").alias("transactionDate")]
    if with_currency:  # both amounts, as the feeds send them
        fields += [F.col("currency").alias("currency"), F.col("org_amount").alias("orgAmount")]
    fields.append(F.col("amount").alias("tzsAmount"))
    sector_field = "sectorSnaClassification" if source_type == SHARE else "sector"
    fields.append(F.col("sector").alias(sector_field))
    return F.struct(*fields)


def to_messages(events: DataFrame, with_currency: bool = False,
                num_partitions: int = 4) -> DataFrame:
    """Kafka-record-shaped rows: key, value, topic, partition, timestamp,
    headers. ``with_currency`` sends ``org_amount`` and ``currency`` beside the
    converted amount. ``partition`` is what a keyed producer chooses for the key in topics
    of ``num_partitions``, so the messages of a key keep their order; ``offset`` carries the
    event id, so the file twin of a topic identifies each record (the Kafka sink ignores it; the broker assigns offsets)."""
    ev = events.filter(F.col("source_type").isin(*SOURCE_TYPES))
    value = None
    topic = None
    for s in SOURCE_TYPES:
        payload = F.to_json(F.struct(
            F.array(_item(s, with_currency)).alias(ARRAY_FIELDS[s]),
            F.col("fsp_id").alias("fspInformationId"),
            F.concat(F.col("fsp_id"), F.lit("_SYSTEM")).alias("sender"),
        ))
        cond = F.col("source_type") == s
        value = F.when(cond, payload) if value is None else value.when(cond, payload)
        topic = F.when(cond, F.lit(TOPICS[s])) if topic is None else topic.when(cond, F.lit(TOPICS[s]))
    key = composite_key()
    headers = F.array(*[
        F.struct(F.lit(name).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
        for name, c in (("sourceType", "source_type"), ("fspId", "fsp_id"),
                        ("sector", "sector"), ("reportingDate", "reporting_date"))])
    return ev.select(
        key.alias("key"), value.alias("value"), topic.alias("topic"),
        keyed_partition(key, num_partitions).alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ingestion_time").alias("timestamp"),
        headers.alias("headers"),
    )


def write_messages_to_kafka(messages: DataFrame, bootstrap_servers: str, **options) -> None:
    """Publish with the Kafka sink (needs the spark-sql-kafka package).
    The sink routes each row by its ``topic`` column."""
    (messages.select("key", "value", "topic", "headers")
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
     .options(**options).save())
