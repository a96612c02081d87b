"""Session helpers: a local session for tests and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Rows of a table, and their bytes, that every executor may hold.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("roundscope")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="roundscope-")
        sc.setCheckpointDir(configured)
    return configured


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, partition_by: Sequence[str] = (), options: Mapping[str, int] | None = None) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it back; ``options`` are the Parquet writer's.

    Later passes read only the columns and partitions they need, see the true size, and do not
    depend on executors that may be lost. The table stays until the folder is cleared.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.options(**options or {}).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Size(NamedTuple):
    """Rows of a table and about the bytes they take in memory."""

    rows: int
    bytes: int


def row_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """About the bytes of a row of these columns: a fixed part for each, and what texts and nested values hold."""
    total = F.lit(64).cast("bigint")
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        value = F.col(f"`{field.name}`")
        total = total + 16
        if isinstance(field.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            # Each element takes at least two letters as text and a word or two in memory.
            total = total + 8 * F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    return total


def measured(df: DataFrame) -> Size:
    """Count a small table and its bytes: one row comes to the driver."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")).first()
    return Size(found["rows"], found["bytes"] or 0)


def fits(size, limit: int = BROADCAST_ROWS) -> bool:
    """Whether every executor may hold a side: ``size`` has its rows and bytes, or is its rows if no text is in it."""
    if isinstance(size, int):
        return size <= limit
    return size.rows <= limit and size.bytes <= BROADCAST_BYTES


def broadcast_within(df: DataFrame, size, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast if its counted rows and bytes allow it; else Spark picks the join."""
    return F.broadcast(df) if fits(size, limit) else df
