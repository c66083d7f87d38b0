"""Stored tables: the keyed position state, the event log, snapshots,
and the JDBC target.

The state is an upsert target without a transactional table format. Each
micro-batch writes one delta folder ``batch_id=<n>`` in overwrite mode, so
a retried batch replaces its own output (idempotent, exactly once with the
query checkpoint); readers fold the deltas. Two layouts, never mixed in
one path (the mode is part of the folder name):

* ``stateful``: deltas hold absolute totals of the keys a batch changed;
  the newest batch per key wins.
* ``partials``: deltas hold the batch's own partial sums; readers sum
  totals and counts and take the maximum times.

A reader of the deltas lists and folds every batch there was. ``read_state_store``
reads the position out of the streaming query's own state store instead: one row per key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.operators.eventlog import LOG_COLUMNS
from netcap.operators.position import net_core_capital
from netcap.operators.reports import table_counts
from netcap.operators.snapshot import SNAPSHOT_COLUMNS
from netcap.schemas import KEY, SOURCE_TYPES, STATE_COLUMNS, TOTAL_COLUMNS, UPDATE_COLUMNS

MODES = ("stateful", "partials")


def state_path(root: str, mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return f"{root.rstrip('/')}/state_{mode}"


# --- S3: delta upsert -------------------------------------------------------

def write_delta(batch_df: DataFrame, batch_id: int, path: str) -> None:
    """Overwrite the delta folder of one batch (a retry replaces it)."""
    batch_df.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def upsert_state(batch_df: DataFrame, batch_id: int, path: str) -> None:
    """foreachBatch sink of the updated state rows (absolute totals)."""
    write_delta(batch_df.select(*STATE_COLUMNS), batch_id, path)


def _fold(df: DataFrame, mode: str) -> DataFrame:
    if mode == "stateful":
        rest = [c for c in STATE_COLUMNS if c not in KEY]
        newest = df.groupBy(*KEY).agg(F.max(F.struct("batch_id", *rest)).alias("_n"))
        return newest.select(*KEY, *[F.col(f"_n.{c}").alias(c) for c in rest])
    agg = df.groupBy(*KEY).agg(
        *[F.sum(TOTAL_COLUMNS[s]).alias(TOTAL_COLUMNS[s]) for s in SOURCE_TYPES],
        *[F.max(UPDATE_COLUMNS[s]).alias(UPDATE_COLUMNS[s]) for s in SOURCE_TYPES],
        F.max("last_computed_at").alias("last_computed_at"),
        F.sum("event_count").cast("long").alias("event_count"))
    return agg.withColumn("net_core_capital", net_core_capital()).select(*STATE_COLUMNS)


def read_deltas(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """All delta rows with their ``batch_id``; those of earlier batches only with
    ``before_batch`` (a literal, so other batches' folders aren't listed)."""
    try:
        deltas = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no state at {path}") from e
        raise
    if before_batch is not None:
        deltas = deltas.filter(F.col("batch_id") < F.lit(int(before_batch)))
    return deltas.select(F.col("batch_id").cast("long"), *STATE_COLUMNS)


def read_state(spark: SparkSession, path: str, mode: str = "stateful",
               before_batch: int | None = None) -> DataFrame:
    """Current state, folded from the deltas; one row per key.

    Both folds are aggregations with map-side combine: a key changed in
    every batch still never sits in one task as a whole.
    """
    return _fold(read_deltas(spark, path, before_batch), mode)


# --- S3 / T1: the keyed state itself ----------------------------------------

# The fold's buffer as the state store holds it, in the order of its aggregates.
_BUFFER = ("struct<" + ", ".join(
    [f"{TOTAL_COLUMNS[s]}: decimal(38,4), {s}_empty: boolean" for s in SOURCE_TYPES]
    + [f"{UPDATE_COLUMNS[s]}: timestamp_ntz" for s in SOURCE_TYPES]
    + ["last_computed_at: timestamp_ntz", "event_count: bigint"]) + ">")


def keep_in_store(batch_df: DataFrame, batch_id: int) -> None:
    """foreachBatch sink that computes the batch and writes nothing: the position
    stays in the query's state store."""
    batch_df.write.format("noop").mode("overwrite").save()


def state_store(spark: SparkSession, checkpoint: str, batch_id: int | None = None,
                **options) -> DataFrame:
    """Keys and values that a streaming query's checkpoint holds after a batch
    (the newest one unless ``batch_id`` is given)."""
    reader = spark.read.format("statestore").options(**options)
    if batch_id is not None:
        reader = reader.option("batchId", str(int(batch_id)))
    return reader.load(checkpoint)


def read_state_store(spark: SparkSession, checkpoint: str,
                     batch_id: int | None = None) -> DataFrame:
    """The position out of the state store of a ``stateful`` position stream: one row
    per key is read, however many batches there were. No shuffle, no folding."""
    held = state_store(spark, checkpoint, batch_id).select(
        "key.*", F.col("value").cast(_BUFFER).alias("v"))
    return (held.select(*KEY, "v.*").withColumn("net_core_capital", net_core_capital())
            .select(*STATE_COLUMNS))


# --- S5: event log ----------------------------------------------------------

def append_event_log(log_rows: DataFrame, batch_id: int, path: str) -> None:
    """One folder per batch, overwritten on retry: a replayed batch does not
    duplicate the log, and topic, partition, offset and item of each row tell a
    replay from a resend. Inside, a folder per reporting date, its rows sorted; Spark
    sizes the files by the rows there are (large dates get several), not by the number of
    shuffle partitions."""
    (log_rows.hint("rebalance", "reporting_date")
     .sortWithinPartitions("reporting_date", "fsp_id", "sector", "received_at")
     .write.mode("overwrite").partitionBy("reporting_date")
     .parquet(f"{path}/batch_id={int(batch_id)}"))


def read_event_log(spark: SparkSession, path: str, reporting_dates=None) -> DataFrame:
    """The log, or that of some reporting dates: other dates' folders aren't read."""
    log = spark.read.parquet(path)
    if reporting_dates is not None:
        log = log.filter(F.col("reporting_date").isin(
            *[F.lit(str(d)).cast("date") for d in reporting_dates]))
    return log.select("batch_id", *LOG_COLUMNS)


# --- N4: how much was wrong -------------------------------------------------

def write_feed_quality(spark: SparkSession, counts: dict, batch_id: int, path: str) -> None:
    """The counts of a batch, a row for each."""
    rows = [(name, int(n)) for name, n in counts.items()]
    write_delta(spark.createDataFrame(rows, "counted string, n long").coalesce(1), batch_id, path)


def read_feed_quality(spark: SparkSession, path: str) -> DataFrame:
    """All batches' counts together."""
    return spark.read.parquet(path).groupBy("counted").agg(F.sum("n").alias("n"))


# --- S8 / S9: state table, snapshots ----------------------------------------

def write_state_table(state: DataFrame, path: str) -> None:
    """Batch write of the state, partitioned by reporting date, in ranges of (date,
    fsp_id, sector) and sorted inside files, so a point lookup prunes folders, files and
    row groups (what the database indexes did). A large date takes many tasks."""
    (state.repartitionByRange("reporting_date", "fsp_id", "sector")
     .sortWithinPartitions("reporting_date", "fsp_id", "sector")
     .write.mode("overwrite").partitionBy("reporting_date").parquet(path))


def read_state_table(spark: SparkSession, path: str, reporting_date=None) -> DataFrame:
    df = spark.read.parquet(path)
    if reporting_date is not None:
        df = df.filter(F.col("reporting_date") == F.lit(str(reporting_date)).cast("date"))
    return df.select(*STATE_COLUMNS)


# The folders of each stored table, outermost first.
STATE_FOLDERS = ("reporting_date",)
LOG_FOLDERS = ("batch_id", "reporting_date")
SNAPSHOT_FOLDERS = ("snapshot_reporting_date", "cut_off")


def from_footers(spark: SparkSession, path: str) -> DataFrame:
    """A stored table through Spark's newer Parquet reader, which answers counts (also per
    folder) out of the files' footers: a row a file is read, none of the table's."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # the older reader ignores it
    v1 = "spark.sql.sources.useV1SourceList"
    listed = spark.conf.get(v1)
    spark.conf.set(v1, ",".join(x for x in listed.split(",") if x.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(v1, listed)


def stored_counts(spark: SparkSession, **paths: str) -> DataFrame:
    """R12: rows of each named stored table, from its files' footers."""
    return table_counts(**{name: from_footers(spark, path) for name, path in paths.items()})


def stored_dates(spark: SparkSession, path: str, folders=STATE_FOLDERS,
                 date: str = "reporting_date") -> DataFrame:
    """R13: the distinct dates of a stored table, newest first, from folder names and
    footers. A folder whose files hold no row doesn't count."""
    rows = from_footers(spark, path).groupBy(*folders).agg(F.count(F.lit(1)).alias("n"))
    return (rows.filter("n > 0").select(F.col(date).alias("reporting_date")).distinct()
            .orderBy(F.col("reporting_date").desc()))


def write_state_buckets(state: DataFrame, table: str, path: str, buckets: int) -> None:
    """A copy of the state for joins by key: a catalog table in ``buckets`` hash buckets of the
    key, sorted inside. Two such copies with the same number join bucket by bucket, without
    a shuffle. Choose the number so that a bucket is some 256 MB; a key has one row, so
    there is no hot bucket. One file a bucket: the rows are brought together before they are
    written."""
    (state.select(*STATE_COLUMNS).repartition(buckets, *KEY)
     .write.mode("overwrite").option("path", path).bucketBy(buckets, *KEY).sortBy(*KEY)
     .saveAsTable(table))


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """One folder per reporting date and cut-off. A run that is repeated replaces the
    folders that it writes and leaves all others: no row doubles."""
    cut_off = F.date_format("snapshot_taken_at", "yyyyMMdd'T'HHmmss.SSSSSS")
    (snapshot.select(*SNAPSHOT_COLUMNS, cut_off.alias("cut_off"))
     .hint("rebalance", "snapshot_reporting_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_reporting_date", "cut_off").parquet(path))


def append_snapshot(snapshot: DataFrame, path: str) -> None:
    """The same layout, append-only: a run that is repeated adds its rows again."""
    cut_off = F.date_format("snapshot_taken_at", "yyyyMMdd'T'HHmmss.SSSSSS")
    (snapshot.select(*SNAPSHOT_COLUMNS, cut_off.alias("cut_off"))
     .hint("rebalance", "snapshot_reporting_date").write.mode("append")
     .partitionBy("snapshot_reporting_date", "cut_off").parquet(path))


def read_snapshots(spark: SparkSession, path: str, reporting_date=None) -> DataFrame:
    df = spark.read.parquet(path)
    if reporting_date is not None:
        df = df.filter(F.col("snapshot_reporting_date") == F.lit(str(reporting_date)).cast("date"))
    return df.select(*SNAPSHOT_COLUMNS)


# --- S4: JDBC target --------------------------------------------------------

def postgres_upsert_sql(table: str, staging: str) -> str:
    """Server-side upsert of the staging rows into the keyed state table
    (PostgreSQL dialect; ``net_core_capital`` is generated there)."""
    cols = [c for c in STATE_COLUMNS if c != "net_core_capital"]
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in cols if c not in KEY)
    return (f"INSERT INTO {table} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {staging} "
            f"ON CONFLICT ({', '.join(KEY)}) DO UPDATE SET {sets}")


def merge_upsert_sql(table: str, staging: str) -> str:
    """The same upsert as a standard SQL MERGE (Derby, newer PostgreSQL)."""
    cols = [c for c in STATE_COLUMNS if c != "net_core_capital"] + ["net_core_capital"]
    on = " AND ".join(f"t.{k} = s.{k}" for k in KEY)
    sets = ", ".join(f"{c} = s.{c}" for c in cols if c not in KEY)
    return (f"MERGE INTO {table} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) "
            f"VALUES ({', '.join('s.' + c for c in cols)})")


def jdbc_state_writer(url: str, table: str, run_statement, properties: dict | None = None,
                      upsert_sql=postgres_upsert_sql):
    """A foreachBatch function that writes each batch's state rows (absolute
    totals) to ``<table>_staging`` in parallel from the executors and then
    runs one server-side upsert for the whole batch (not one per row).

    ``run_statement(sql)`` executes a statement on the target (e.g. with a
    DB-API connection). It is required: the next batch replaces the staging rows. Create
    the target's money columns as wide as the totals may get.
    """
    props = dict(properties or {})
    staging = f"{table}_staging"

    def write(batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.select(*STATE_COLUMNS).write.mode("overwrite").option("truncate", "true")
         .jdbc(url, staging, properties=props))
        run_statement(upsert_sql(table, staging))
    return write


# --- S4 in the feed job: partial sums, fenced by batch id --------------------

FENCE = "last_batch_id"
_ADDED = [*TOTAL_COLUMNS.values(), "event_count"]
_LATEST = [*UPDATE_COLUMNS.values(), "last_computed_at"]


def postgres_add_sql(table: str, staging: str) -> str:
    """Adds the staged partial sums to the keyed table; a row that has already taken in
    this batch, or a later one, stays as it is (``net_core_capital`` is generated there)."""
    cols = [*KEY, *_ADDED, *_LATEST, FENCE]
    sets = ([f"{c} = {table}.{c} + EXCLUDED.{c}" for c in _ADDED]
            + [f"{c} = GREATEST({table}.{c}, EXCLUDED.{c})" for c in _LATEST]
            + [f"{FENCE} = EXCLUDED.{FENCE}"])
    return (f"INSERT INTO {table} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {staging} "
            f"ON CONFLICT ({', '.join(KEY)}) DO UPDATE SET {', '.join(sets)} "
            f"WHERE {table}.{FENCE} < EXCLUDED.{FENCE}")


def merge_add_sql(table: str, staging: str) -> str:
    """The same as a standard SQL MERGE; it keeps ``net_core_capital`` itself."""
    cols = [*KEY, *_ADDED, "net_core_capital", *_LATEST, FENCE]
    later = lambda c: (f"CASE WHEN t.{c} IS NULL OR s.{c} > t.{c} THEN s.{c} "  # noqa: E731
                       f"ELSE t.{c} END")
    sets = ([f"{c} = t.{c} + s.{c}" for c in [*_ADDED, "net_core_capital"]]
            + [f"{c} = {later(c)}" for c in _LATEST] + [f"{FENCE} = s.{FENCE}"])
    return (f"MERGE INTO {table} t USING {staging} s ON "
            + " AND ".join(f"t.{k} = s.{k}" for k in KEY)
            + f" WHEN MATCHED AND t.{FENCE} < s.{FENCE} THEN UPDATE SET {', '.join(sets)}"
            + f" WHEN NOT MATCHED THEN INSERT ({', '.join(cols)}) "
            + f"VALUES ({', '.join('s.' + c for c in cols)})")


def jdbc_partials_writer(url: str, table: str, run_statement, properties: dict | None = None,
                         add_sql=postgres_add_sql):
    """A sink of the feed job: each batch's partial sums go to ``<table>_staging`` in
    parallel from the executors, with the batch's id, and one server-side statement adds
    them. Each target row keeps the id of the last batch that it took in
    (``last_batch_id``), so a batch that is replayed, wherever the job was cut off (before,
    between or after staging and statement), counts once.

    ``run_statement(sql)`` executes one statement, as a transaction, on the target."""
    props = dict(properties or {})
    staging = f"{table}_staging"

    def write(partials: DataFrame, batch_id: int) -> None:
        (partials.select(*STATE_COLUMNS, F.lit(int(batch_id)).cast("long").alias(FENCE))
         .write.mode("overwrite").option("truncate", "true")
         .jdbc(url, staging, properties=props))
        run_statement(add_sql(table, staging))
    return write
