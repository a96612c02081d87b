"""What several operators share: typed text rows, label folds, checkpoints, bounded samples."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundscope.session import shared_folder

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty); other columns, whatever their names, stay behind."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_column.cast("string")) % folds


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; later plans start from those files."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def label_counts(labels: DataFrame, label: str, learn: Column) -> dict[int, int]:
    """How many documents to learn from carry each label."""
    return {r["label"]: r["n"] for r in _marks(labels, label, learn).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}


def _marks(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """(doc_id, label 0/1); a document labelled twice has its greatest label."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
    marks = marks.groupBy("doc_id").agg(F.max(F.col(label)).alias("label"))
    return marks.select("doc_id", F.when(F.col("label") > 0, 1).otherwise(0).alias("label"))


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int, max_bytes: int) -> pd.DataFrame:
    """(text, label) of labelled documents to fit a model on, at most ``max_rows`` and ``max_bytes`` of text a label.

    ``learn`` is a condition on the label rows. Documents are taken in the order of a hash of their id, so the sample
    does not depend on the layout of the files. Only its ids, never more than two times ``max_rows``, are broadcast.
    Texts over a hundredth of the byte bound are not learned from; of texts that share an id the least one is.
    """
    marks = _marks(labels, label, learn).withColumn("at", F.xxhash64("doc_id"))
    ids = [marks.where(F.col("label") == v).orderBy("at", "doc_id").limit(max_rows) for v in (0, 1)]
    rows = text_rows(docs).where(F.octet_length("text") <= max_bytes // 100)
    rows = rows.join(F.broadcast(ids[0].union(ids[1])), "doc_id").groupBy("at", "doc_id", "label").agg(F.min("text").alias("text"))
    found = rows.select("at", "doc_id", "text", "label").toPandas().sort_values(["at", "doc_id"], kind="stable")
    used = found["text"].map(lambda t: len(t.encode())).astype("int64").groupby(found["label"]).cumsum()
    return found[used <= max_bytes][["text", "label"]].reset_index(drop=True)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task and from query to query."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def given_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames of a task; freed memory is returned before and after them."""
    give_back()
    yield from batches
    give_back()


def frames_by_bytes(batches: Iterator[pd.DataFrame], limit: int = 8 << 20, column: str = "text") -> Iterator[pd.DataFrame]:
    """Cut frames so that each holds about ``limit`` characters of text at most, or a single row."""
    for frame in given_back(batches):
        sizes = frame[column].str.len().to_numpy()
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > limit:
                yield frame.iloc[begin:i]
                begin, total = i, 0
            total += size
        if begin < len(frame):
            yield frame.iloc[begin:]
