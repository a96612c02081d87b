"""Decoded match bundles: one folder of tables, each of them optional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .damage import READ_ERRORS, damaged

# Tick rates assumed where the header has none.
INGEST_TICKRATE = 128.0
ANALYSIS_TICKRATE = 64.0

# Header spellings, in order of preference.
TICKRATE_KEYS = ["tickrate", "tickRate", "ticks_per_second", "ticksPerSecond"]
MAP_KEYS = ["map_name", "mapName"]

# Spellings of the rate in a header table, in order of preference.
RATE_COLUMNS = ["tickrate", "tick_rate", "tick_rate_hz"]

PLAYER_PROPERTIES = ["name", "steamid", "team_num", "health", "armor", "has_helmet", "inventory"]


def read_bundle(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    lenient: bool = False,
) -> DataFrame:
    """A table of the bundle; one that is absent or empty of files is an empty frame.

    An unreadable file fails the job. A ``lenient`` read takes a Parquet table that cannot be read to its end as empty;
    for that its files are read once before.
    """
    path = f"{root.rstrip('/')}/{table}"
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
        if lenient and fmt == "parquet" and not damaged(spark, [path], df.schema).isEmpty():
            df = df.limit(0)
    except READ_ERRORS as e:
        absent = isinstance(e, AnalysisException) and e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if not (absent or lenient):
            raise
        df = spark.createDataFrame([], schema or StructType([]))
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def header_map(header, keys: Sequence[str]) -> Column:
    """First of the keys whose header text is neither missing nor empty."""
    h = F.col(header) if isinstance(header, str) else header
    return F.coalesce(*[F.nullif(F.try_element_at(h, F.lit(k)), F.lit("")) for k in keys])


def tickrate(header, default: float = INGEST_TICKRATE) -> Column:
    """First usable tick rate of a header map; zero, blank and unreadable ones are passed over."""
    h = F.col(header) if isinstance(header, str) else header
    rates = [F.nullif(F.try_element_at(h, F.lit(k)).try_cast("double"), F.lit(0.0)) for k in TICKRATE_KEYS]
    return F.coalesce(*rates, F.lit(float(default)))


def header_rows(df: DataFrame, header: str = "header", default: float = INGEST_TICKRATE) -> DataFrame:
    """One row per source: demo_file, map_name, header_json, tickrate."""
    return df.select(
        *[c for c in df.columns if c not in (header, "map_name", "header_json", "tickrate")],
        header_map(header, MAP_KEYS).alias("map_name"),
        F.to_json(header).alias("header_json"),
        tickrate(header, default).alias("tickrate"),
    )


def default_tickrate(headers: DataFrame, rate: str | None = None, order: Sequence[str] = ()) -> Column:
    """Whole tick rate of the first header, or the analysis default; a scalar subquery.

    The rate is the named column, or the first of the known spellings that the table has.
    """
    rate = rate or next((c for c in RATE_COLUMNS if c in headers.columns), None)
    if rate is None:
        return F.lit(ANALYSIS_TICKRATE)
    value = F.col(rate).try_cast("double")
    first = F.min(F.struct(*order, value.alias("_rate")))["_rate"]
    usable = F.when(~F.isnan("r") & (F.col("r") != 0), F.floor("r").cast("double"))
    row = headers.agg(first.alias("r")).select(F.coalesce(usable, F.lit(ANALYSIS_TICKRATE)).alias("rate"))
    return row.scalar()
