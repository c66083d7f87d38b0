"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import netcap
from netcap.session import work_dir
from netcap.sources.adapters import read_table

__all__ = ["for_workers", "fresh", "hex_long", "hex_unit", "json_string", "read_table",
           "text_or_empty", "with_fields", "written"]

#: Rows of an Arrow batch: with texts of some kilobytes a worker then holds a few megabytes at once.
BATCH_ROWS = 1000


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared ``spark.checkpoint.dir`` and read
    it back: cuts the lineage, and a lost executor re-reads files instead
    of recomputing the stages before."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def hex_long(digest: Column, digits: int = 15) -> Column:
    """The first ``digits`` hexadecimal digits of a digest as a long."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def hex_unit(digest: Column) -> Column:
    """The first 52 bits of a hexadecimal digest as a double in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def json_string(c: Column) -> Column:
    """A string as a JSON value; null as ``null``."""
    listed = F.to_json(F.array(c), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def with_fields(df: DataFrame, **kinds: object) -> StructType:
    """The schema of ``df`` and more fields."""
    return StructType([*df.schema.fields, *(StructField(n, k) for n, k in kinds.items())])


def for_workers(query: Callable) -> Callable:
    """A query whose Python workers find this package where the driver has it
    (one machine or a shared path; elsewhere it comes with ``--py-files``) and get
    Arrow batches of at most ``BATCH_ROWS`` rows."""

    @wraps(query)
    def run(spark: SparkSession, *args):
        root = str(Path(netcap.__file__).resolve().parent.parent)
        env = spark.sparkContext.environment
        paths = env.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
        rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
        spark.conf.set(rows, str(min(BATCH_ROWS, int(spark.conf.get(rows)) or BATCH_ROWS)))
        return query(spark, *args)

    return run
