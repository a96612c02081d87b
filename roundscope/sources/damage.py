"""Finding files that cannot be read to their end, in one distributed pass."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How a failed read arrives: most errors as Spark's own, those of uniting schemas as the JVM's.
READ_ERRORS = (PySparkException, Py4JJavaError)

# Footers that are asked for at a time.
FOOTERS = 16


def reason(error: Exception) -> str:
    """What a failed read reports, in a line."""
    text = str(error.java_exception) if isinstance(error, Py4JJavaError) else str(error)
    return text.split("\n")[0][:500]


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, file) of the Parquet files below the paths, at any depth; ``file`` is the name that ``_metadata`` gives.

    No content is read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(list(paths)).select("path", F.col("_metadata.file_path").alias("file"))


def footers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, StructType | None, str | None]]:
    """(path, schema, reason) of each file: its schema, or why its footer cannot be read."""

    def ask(path: str) -> tuple[str, StructType | None, str | None]:
        try:
            return path, spark.read.parquet(path).schema, None
        except READ_ERRORS as e:
            return path, None, reason(e)

    with ThreadPoolExecutor(FOOTERS) as pool:
        return list(pool.map(ask, paths))


def damaged(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """(path, file, reason) of the Parquet files below ``paths`` that cannot be read to their end.

    Every column of ``schema`` is decoded by tasks that pass over errors; a file is damaged if fewer rows come out than
    its footer promises. Large files are split among tasks as in any read. A file without a row has nothing to lose
    and counts as sound if its footer can be read.
    """
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    rows = reader.option("pathGlobFilter", "*.parquet").parquet(*paths)
    file = F.col("_metadata.file_path").alias("file")
    # Without columns only footers are read.
    promised = rows.groupBy(file).agg(F.count(F.lit(1)).alias("promised"))
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") if "map" in t else F.col(f"`{c}`") for c, t in rows.dtypes])
    # The hash stays in the condition, else nothing would be decoded.
    decoded = rows.select(file, content.alias("content")).groupBy("file").agg(F.count(F.lit(1)).alias("decoded"), F.max("content").alias("content"))
    counted = listed_files(spark, paths).join(promised, "file", "left").join(decoded, "file", "left")
    short = counted.filter(F.col("promised").isNull() | F.col("content").isNull() | (F.col("decoded") < F.col("promised")))
    told = F.format_string("%d of %d rows can be read", F.coalesce("decoded", F.lit(0)), "promised")
    found = short.select("path", "file", F.when(F.col("promised").isNotNull(), told).alias("reason")).collect()
    # Only files without a single promised row are asked for their footer.
    asked = {path: why for path, _, why in footers(spark, [r["path"] for r in found if r["reason"] is None])}
    lost = [(r["path"], r["file"], r["reason"] or asked[r["path"]]) for r in found if r["reason"] or asked[r["path"]]]
    return spark.createDataFrame(lost, "path string, file string, reason string")
