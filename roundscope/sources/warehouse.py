"""The warehouse: reading sources, merging them with or without unique keys, and its inventory."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.columns import unite
from ..operators.snapshots import keep_first
from ..schemas import CATALOG, UNIQUE_KEYS, WAREHOUSE
from ..session import Size, fits, measured, stored
from .bundles import read_bundle
from .damage import READ_ERRORS, damaged, footers, listed_files

# What Spark reports where a table has no path or no files.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

# Folders that the rows of a table with a unique key are dealt to, by the first part of the key.
KEY_BUCKETS = 64

REJECTED = StructType([StructField(c, StringType()) for c in ("table", "path", "reason")])


def stem(path: Column) -> Column:
    """File name without folder and last suffix."""
    # Cut at slashes: a pattern for the segment would be tried from every character of a long path, for every row.
    name = F.substring_index(F.when(F.endswith(path, F.lit("/")), F.substring(path, F.lit(1), F.length(path) - 1)).otherwise(path), "/", -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def match_folder(path: Column, table: Column) -> Column:
    """The folder that holds the folder of a table, from the path of a file below; cut at slashes like ``stem``."""
    above = F.split_part(path, F.concat(F.lit("/"), table, F.lit("/")), F.lit(1))
    return F.substring_index(above, "/", -1)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in their types: undeclared ones go, absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def _sources(spark: SparkSession, paths: Sequence[str], lost: list[tuple[str, str]]) -> list[tuple[list[str], StructType]]:
    """(paths, schema) of each read that takes the files in: one for all, or one for each schema where they clash.

    Files whose footer cannot be read go to ``lost`` with the reason.
    """
    try:
        united = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths)
        return [(list(paths), united.schema)]
    except READ_ERRORS as e:
        if isinstance(e, PySparkException) and e.getCondition() in ABSENT:
            raise
    groups: dict[str, tuple[list[str], StructType]] = {}
    for path, schema, why in footers(spark, sorted(r["path"] for r in listed_files(spark, paths).collect())):
        if schema is None:
            lost.append((path, why))
        else:
            groups.setdefault(schema.json(), ([], schema))[0].append(path)
    return list(groups.values())


def read_sources(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, match: Column | None = None,
    rejected: list[tuple[str, str]] | None = None, probe: bool = False,
) -> DataFrame:
    """All files of one table, with the match id of each row taken from its path.

    The columns of all files are united; a declared column that none has is NULL, an undeclared one
    is never read, and values are cast to the declared types where they can be. Files are found at
    any depth. ``match`` defaults to the stem of the file.

    One scan serves unless the types of a column clash, be it declared or not, or a footer is unreadable: then
    there is one scan for each distinct schema. (path, reason) of unreadable files are added to ``rejected``; without
    that list they fail the job. With ``probe`` files are read to their end first, and those that cannot be are left
    out as well.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lost: list[tuple[str, str]] = []
    sources = _sources(spark, paths, lost)
    if lost and rejected is None:
        raise ValueError(f"{lost[0][0]}: {lost[0][1]}")
    match = stem(F.col("_metadata.file_path")) if match is None else match
    frames = []
    for files, found in sources:
        frame = spark.read.schema(found).option("recursiveFileLookup", "true").parquet(*files)
        if probe:
            declared = StructType([f for f in found.fields if f.name in schema.names])
            broken = damaged(spark, files, declared).collect()
            lost += [(r["path"], r["reason"]) for r in broken]
            if broken:  # by name: Spark leaves such files out of its scan
                frame = frame.filter(~F.col("_metadata.file_path").isin([r["file"] for r in broken]))
        frames.append(conform(frame.withColumn("match_id", match), schema))
    if rejected is not None:
        rejected += lost
    return unite(frames) if frames else spark.createDataFrame([], schema)


def merge_append(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of both; a second merge of the same source doubles its rows."""
    return target.unionByName(source, allowMissingColumns=True).select(*target.columns)


def _keyed(key: Sequence[str]) -> Column:
    """Whether a row has all parts of the key."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return whole


def new_rows(
    target: DataFrame | None,
    source: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = (),
    source_rows: int | Size | None = None,
) -> DataFrame:
    """Source rows that insert-or-ignore would add: the first per key, unless the target has the key.

    A key with a NULL in it equals no other key, so such rows always pass. The source is read once. If its keys are
    measured and small, they go to the target as well, so that a large target is scanned but not shuffled.
    """
    key = list(key)
    # Rows without a whole key stay apart by a number of their own, which also spreads them.
    apart = F.when(_keyed(key), F.lit(-1)).otherwise(F.monotonically_increasing_id())
    firsts = keep_first(source.withColumn("_apart", apart), [*key, "_apart"], list(order))
    if target is not None:
        taken = target.select(*key)
        if source_rows is not None and fits(source_rows):
            taken = taken.join(F.broadcast(source.select(*key)), key, "left_semi")
        # Distinct before the shuffle: a key the target repeats very often travels once per task.
        firsts = firsts.join(taken.distinct().withColumn("_apart", F.lit(-1).cast("bigint")), [*key, "_apart"], "left_anti")
    return firsts.select(*source.columns)


def merge_ignore(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Target plus the new rows of the source."""
    return merge_append(target, new_rows(target, source, key, order))


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def typed(df: DataFrame, table: str) -> DataFrame:
    """Columns the warehouse declares in its types, so that the files of all sources agree; the
    others as they are."""
    declared = {f.name: f.dataType for f in WAREHOUSE[table].fields} if table in WAREHOUSE else {}
    return df.select(*[F.col(c).try_cast(declared[c]).alias(c) if c in declared else F.col(c) for c in df.columns])


def key_bucket(key: Sequence[str]) -> Column:
    """The folder of a row by the first part of its key; -1 without it."""
    first = F.col(key[0])
    return F.when(first.isNotNull(), F.pmod(F.xxhash64(first.cast("string")), F.lit(KEY_BUCKETS)).cast("int")).otherwise(-1)


def append(df: DataFrame, root: str, table: str, batch: str | None = None, key: Sequence[str] = ()) -> None:
    """Append a frame to a table of the folder, partitioned by load.

    The number of files follows the size of the load, not the number of matches: small matches share
    a file and a large one is split. Rows of a match stand together in a file, so its statistics tell
    readers which files to skip. A named batch replaces what an earlier attempt of it has written.
    With a ``key`` rows are also dealt to folders by its first part and stand in its order, so that a merge reads only
    the folders, and of their files only the stretches, that its keys may be in.
    """
    labelled = df.withColumn("ingest_batch", F.lit(batch or "bulk"))
    folders = ["ingest_batch"]
    if key:
        labelled = labelled.withColumn("key_bucket", key_bucket(key))
        folders.append("key_bucket")
    order = folders + list(dict.fromkeys([*key, *[c for c in ("match_id",) if c in df.columns]]))
    writer = labelled.hint("rebalance").sortWithinPartitions(*order).write.partitionBy(*folders)
    if batch:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(table_path(root, table))


def _stored_as(schema: StructType, table: str = "") -> StructType:
    """Columns of a stored table with the name of the load, which is text whatever it looks like, and the folder."""
    folders = [StructField("key_bucket", IntegerType())] if table in UNIQUE_KEYS else []
    return StructType([*schema.fields, StructField("ingest_batch", StringType()), *folders])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A warehouse table in its declared types; empty where it was never written."""
    return conform(read_bundle(spark, root, table, _stored_as(WAREHOUSE[table], table)), WAREHOUSE[table])


def near_keys(spark: SparkSession, root: str, table: str, source: DataFrame) -> DataFrame:
    """Keys of the stored table in the folders, and between the least and the greatest key, of the source.

    The folders are a filter on partitions and the ends one on the files' statistics. Files without folders, as an
    earlier version wrote them, are all read.
    """
    key = UNIQUE_KEYS[table]
    first = F.col(key[0])
    buckets, low, high = source.filter(_keyed(key)).agg(F.collect_set(key_bucket(key)), F.min(first), F.max(first)).first()
    kept = read_bundle(spark, root, table, _stored_as(WAREHOUSE[table], table))
    within = F.col("key_bucket").isNull() | F.col("key_bucket").isin(sorted(buckets))
    return kept.filter(within & first.between(F.lit(low), F.lit(high)) if buckets else F.lit(False)).select(*key)


def record_rejected(spark: SparkSession, root: str, table: str, rejected: Sequence[tuple[str, str]]) -> None:
    """Note unreadable inputs beside the tables; noted again, the same inputs replace themselves."""
    if rejected:
        rows = spark.createDataFrame([(table, p, reason) for p, reason in rejected], REJECTED)
        label = hashlib.sha1("\n".join([table, *sorted(p for p, _ in rejected)]).encode()).hexdigest()[:16]
        append(rows, root, "rejected", label)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Inputs that could not be read: table, path, reason."""
    return read_bundle(spark, root, "rejected", _stored_as(REJECTED)).drop("ingest_batch").distinct()


def register_views(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Make the stored tables known to ``spark.sql`` under their names."""
    for table in WAREHOUSE:
        read_table(spark, root, table).createOrReplaceTempView(prefix + table)


def one(spark: SparkSession, sql: str, **args) -> int:
    """First value of a query as a whole number; 0 where the query cannot be answered."""
    try:
        row = spark.sql(sql, args=args).first()
    except AnalysisException:
        return 0
    return int(row[0]) if row and row[0] is not None else 0


def merge_into(
    spark: SparkSession, root: str, table: str, source: DataFrame, order: Sequence[str] = (), batch: str | None = None,
    incremental: bool = False,
) -> None:
    """Merge a source into a stored table.

    Tables with a unique key ignore known keys, which makes a repeated merge harmless; the others
    append, and only a named batch may be repeated. An ``incremental`` source is small beside the
    table: it is computed once and counted before it is merged.
    """
    rows = conform(source, WAREHOUSE[table])
    if table not in UNIQUE_KEYS:
        append(rows, root, table, batch)
        return
    key, size = UNIQUE_KEYS[table], None
    if incremental:
        rows = stored(rows)
        size = measured(rows.select(*key))
    if batch:
        # Rows without a key are told apart by nothing but the batch that brought them.
        append(rows.filter(~_keyed(key)), root, table, batch, key)
        rows = rows.filter(_keyed(key))
    # Only now, as the append above may have replaced files.
    target = near_keys(spark, root, table, rows) if incremental else read_table(spark, root, table)
    append(new_rows(target, rows, key, order, size), root, table, key=key)


def build(spark: SparkSession, matches: str, root: str, batch: str | None = None) -> list[str]:
    """Merge all match folders ``matches/<match>/<table>`` into the warehouse, one scan per table.

    Returns the merged tables; those no match has are passed over. Unreadable files are passed over
    too, and noted (``read_rejected``): those without a readable footer at once, those with damaged pages when the
    merge meets one, which adds nothing; then all files are read to their end and the sound ones are merged.
    """
    merged = []
    for table, schema in WAREHOUSE.items():
        folder = match_folder(F.col("_metadata.file_path"), F.lit(table))
        path = f"{matches.rstrip('/')}/*/{table}"

        def merge(probe: bool) -> bool:
            rejected: list[tuple[str, str]] = []
            rows = read_sources(spark, path, schema, folder, rejected, probe)
            record_rejected(spark, root, table, rejected)
            if not probe or rejected:
                merge_into(spark, root, table, rows, order=("match_id",), batch=batch)
            return bool(rejected)

        try:
            merge(False)
        except READ_ERRORS as e:
            if isinstance(e, PySparkException) and e.getCondition() in ABSENT:
                continue
            if not merge(True):
                raise
        merged.append(table)
    return merged


def manifest(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per table; NULL for a table that is absent."""
    rows = []
    spark = next(t for t in tables.values() if t is not None).sparkSession
    for name, df in tables.items():
        if df is None:
            rows.append(spark.range(1).select(F.lit(name).alias("table"), F.lit(None).cast("bigint").alias("rows")))
        else:
            rows.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"))
    return unite(rows)


def catalog(tables: Mapping[str, DataFrame | None], texts: Mapping[str, tuple[str, str, str]] = CATALOG) -> DataFrame:
    """Tables by size with what they hold."""
    counted = manifest(tables)
    spark = counted.sparkSession
    described = spark.createDataFrame([(t, *texts[t]) for t in tables], "table string, contains string, keys string, notables string")
    return (
        described.join(counted, "table", "left")
        .select("table", "rows", "contains", "keys", "notables")
        .orderBy(F.col("rows").desc_nulls_last(), "table")
    )


def entities(wanted: Mapping[str, tuple[DataFrame | None, str | None]]) -> DataFrame:
    """Totals (entity, count): distinct values of a column, or rows where no column is named.

    An absent table counts zero.
    """
    rows = []
    spark = next(df for df, _ in wanted.values() if df is not None).sparkSession
    for name, (df, column) in wanted.items():
        if df is None:
            rows.append(spark.range(1).select(F.lit(name).alias("entity"), F.lit(0).cast("bigint").alias("count")))
            continue
        n = F.count_distinct(F.col(column)) if column else F.count(F.lit(1))
        rows.append(df.agg(n.alias("count")).select(F.lit(name).alias("entity"), "count"))
    return unite(rows)
