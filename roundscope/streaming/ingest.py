"""Incremental merge of arriving match files into the warehouse."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schemas import WAREHOUSE
from ..sources.damage import READ_ERRORS, damaged
from ..sources.warehouse import merge_into, record_rejected, stem

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(
    spark: SparkSession,
    source: str,
    root: str,
    table: str,
    schema: StructType,
    checkpoint: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Merge the new files of ``source`` into a warehouse table and stop when none is left.

    Run again, it takes up only files that arrived since. A batch repeated after a failure changes
    nothing: unique tables ignore known keys, the others replace what that batch had written. The
    stream carries names of files only. A file that cannot be read is left out and noted beside the
    tables with the reason (``warehouse.read_rejected``); the rest of its batch is merged. Progress is
    kept in the warehouse unless ``checkpoint`` names another folder.
    """
    if table not in WAREHOUSE:
        raise ValueError(f"unknown warehouse table {table!r}")
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(source)
        .select("path")
    )
    feed = hashlib.sha1(source.encode()).hexdigest()[:8]

    def take(session: SparkSession, paths: list[str], label: str) -> None:
        rows = session.read.schema(schema).parquet(*paths)
        rows = rows.select("*", stem(F.col("_metadata.file_path")).alias("_source"))
        if "match_id" not in schema.names:
            rows = rows.withColumn("match_id", F.col("_source"))
        ready = transform(rows) if transform else rows
        merge_into(session, root, table, ready, order=("match_id",), batch=label, incremental=True)

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # At most files_per_batch names. The label follows from them, so it outlives lost progress.
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        label = f"{feed}-{hashlib.sha1(chr(10).join(paths).encode()).hexdigest()[:16]}"
        try:
            take(session, paths, label)
        except READ_ERRORS as e:
            rejected = [(r["path"], r["reason"]) for r in damaged(session, paths, schema).collect()]
            if not rejected:
                raise e
            record_rejected(session, root, table, rejected)
            broken = {path for path, _ in rejected}
            good = [p for p in paths if p not in broken]
            if good:
                take(session, good, label)

    place = checkpoint or f"{root.rstrip('/')}/_progress/{table}-{feed}"
    return (
        arriving.writeStream.foreachBatch(merge).option("checkpointLocation", place).trigger(availableNow=True).start()
    )

