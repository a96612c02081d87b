"""Queries about files, bundles and stored tables: what is written is read back and compared by value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import contingency as ct
from ..operators.columns import unite
from ..session import new_folder
from ..sources import bundles, feed, warehouse
from . import bindings as b
from . import ingest as ing
from .oracle import DEMO, ORACLE, r6
from .queries import query, rounded


# Bytes that are written over at a time.
BLOCK = 1 << 20


def damage(spark: SparkSession, folder: str) -> None:
    """Overwrite the pages of the Parquet files of a folder; their footers stay. Only these come to the driver."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(place):
        path = status.getPath()
        if not path.getName().endswith(".parquet"):
            continue
        stream = files.open(path)
        stream.seek(status.getLen() - 8)
        footer = int.from_bytes(stream.readInt().to_bytes(4, "big", signed=True), "little")
        pages = status.getLen() - 8 - footer
        stream.seek(pages)
        tail = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        stream.close()
        out = files.create(path, True)
        out.write(bytearray(b"PAR1"))
        for at in range(4, pages, BLOCK):
            out.write(bytearray(b"\xa5" * min(BLOCK, pages - at)))
        out.write(bytearray(tail))
        out.close()


def _shots(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.lit("d").alias("demo_file"), F.col("l_linenumber").alias("round"), F.col("l_returnflag").alias("weapon"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_returnflag").alias("event_id"),
    )


@query
def damaged_build(spark, d):
    """Three matches are merged, one of them with broken pages behind a sound footer."""
    root = new_folder(spark, "damaged-build")
    lines = b.table(spark, d, "lineitem")
    for match, flag in (("first", "A"), ("broken", "N"), ("last", "R")):
        _shots(lines.filter(F.col("l_returnflag") == flag)).write.parquet(f"{root}/matches/{match}/events_shots")
    damage(spark, f"{root}/matches/broken/events_shots")
    warehouse.build(spark, f"{root}/matches", f"{root}/warehouse")
    merged = warehouse.read_table(spark, f"{root}/warehouse", "events_shots").groupBy(F.col("match_id").alias("name"))
    # A match may have many files; it is rejected once.
    match = warehouse.match_folder(F.col("path"), F.col("table"))
    rejected = warehouse.read_rejected(spark, f"{root}/warehouse").select(F.col("table").alias("name"), match).distinct().groupBy("name")
    counted = F.count(F.lit(1)).alias("n")
    return merged.agg(counted).withColumn("kind", F.lit("merged")).unionByName(rejected.agg(counted).withColumn("kind", F.lit("rejected")))


ORACLE["damaged_build"] = """
SELECT 'merged' AS kind, CASE l_returnflag WHEN 'A' THEN 'first' ELSE 'last' END AS name,
       count(DISTINCT l_orderkey || '-' || l_linenumber) AS n
FROM lineitem WHERE l_returnflag IN ('A','R') GROUP BY l_returnflag
UNION ALL SELECT 'rejected', 'events_shots', 1
"""


@query
def found_files(spark, d):
    """Customers are written into folders by segment and nation, under suffixes in either case."""
    root = new_folder(spark, "found-files")
    customers = b.table(spark, d, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    for rest, suffix in enumerate(("dem", "DEM", "txt")):
        part = customers.filter(F.col("c_nationkey") % 3 == rest).coalesce(1)
        part.write.partitionBy("c_mktsegment", "c_nationkey").option("extension", suffix).csv(f"{root}/{suffix}")
    found = feed.find_files(spark, root)
    return found.select(
        F.regexp_extract("path", "c_mktsegment=([^/]*)", 1).alias("segment"),
        F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("bigint").alias("nation"),
        (F.col("length") > 0).alias("filled"),
    )


ORACLE["found_files"] = """
SELECT DISTINCT c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation, true AS filled FROM customer WHERE c_nationkey % 3 IN (0, 1)
"""


@query
def bundle_tables(spark, d):
    """Tables of a bundle read back: two columns of one, one as JSON, one that is absent and one that is damaged."""
    root = new_folder(spark, "bundle")
    made = b.demo_bundle(spark, d)
    made["kills"].write.parquet(f"{root}/kills")
    made["chat"].write.json(f"{root}/chat")
    made["damages"].coalesce(1).write.parquet(f"{root}/damages")
    damage(spark, f"{root}/damages")
    schema = "tick bigint, player string"
    read = {
        "kills": bundles.read_bundle(spark, root, "kills", columns=["tick", "victim_steamid", "no such column"]),
        "chat": bundles.read_bundle(spark, root, "chat", schema, "json"),
        "bomb": bundles.read_bundle(spark, root, "bomb", schema),
        "damages": bundles.read_bundle(spark, root, "damages", made["damages"].schema, lenient=True),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("tick") % 1009).alias("ticks")).select(
            F.lit(name).alias("table"), F.lit(len(df.columns)).cast("bigint").alias("columns"), "n", "ticks"
        )
        for name, df in read.items()
    ]
    return unite(parts)


ORACLE["bundle_tables"] = f"""
WITH {DEMO}
SELECT 'kills' AS "table", 2 AS columns, count(*) AS n, CAST(sum(tick % 1009) AS BIGINT) AS ticks FROM demo WHERE event_type='purchase'
UNION ALL SELECT 'chat', 2, count(*), CAST(sum(tick % 1009) AS BIGINT) FROM demo WHERE event_type='signup'
UNION ALL SELECT 'bomb', 2, 0, NULL
UNION ALL SELECT 'damages', 5, 0, NULL
"""


@query
def written_match(spark, d):
    """The two bomb tables of a written match, read back."""
    root = new_folder(spark, "written-match")
    ing.write(b.demo_bundle(spark, d), b.demo_header(spark, d), root, ["rounds", "bomb", "events_bomb"], batch="one")
    parts = [bundles.read_bundle(spark, root, t).drop("ingest_batch").withColumn("table", F.lit(t)) for t in ("bomb", "events_bomb")]
    return rounded(unite(parts))


ORACLE["written_match"] = " UNION ALL ".join(f"SELECT *, '{t}' AS \"table\" FROM ({ORACLE['ingest_bomb']})" for t in ("bomb", "events_bomb"))


@query
def sql_views(spark, d):
    """Questions in SQL, with arguments, to the views of a warehouse."""
    root = new_folder(spark, "views")
    rows = _shots(b.table(spark, d, "lineitem")).withColumn("match_id", F.lit("m"))
    warehouse.merge_into(spark, root, "events_shots", rows)
    warehouse.register_views(spark, root, "sv_")
    total = warehouse.one(spark, "SELECT count(*) FROM sv_events_shots WHERE round < :below", below=4)
    absent = warehouse.one(spark, "SELECT count(*) FROM sv_no_such_table")
    counted = spark.sql("SELECT weapon, count(*) AS n FROM sv_events_shots WHERE round >= :least GROUP BY weapon", args={"least": 3})
    return counted.select("weapon", "n", F.lit(total).cast("bigint").alias("total"), F.lit(absent).cast("bigint").alias("absent"))


ORACLE["sql_views"] = """
WITH shots AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)
SELECT l_returnflag AS weapon, count(*) AS n, (SELECT count(*) FROM shots WHERE l_linenumber < 4) AS total, 0 AS absent
FROM shots WHERE l_linenumber >= 3 GROUP BY l_returnflag
"""


# --- slim tables by value ------------------------------------------------------------------------


def _ingested(spark, d, name: str) -> DataFrame:
    return rounded(ing.ingest(b.demo_bundle(spark, d), b.demo_header(spark, d), [name])[name])


@query
def ingest_damages(spark, d):
    return _ingested(spark, d, "damages_slim")


@query
def ingest_players(spark, d):
    return _ingested(spark, d, "players_slim")


@query
def ingest_chat(spark, d):
    return _ingested(spark, d, "chat")


@query
def ingest_shots_slim(spark, d):
    return _ingested(spark, d, "shots_slim")


@query
def loadouts_without_equipment(spark, d):
    """Player states that lack the optional columns."""
    made = b.demo_bundle(spark, d)
    made["ticks"] = made["ticks"].drop("health", "armor", "has_helmet")
    return rounded(ing.ingest(made, b.demo_header(spark, d), ["round_loadouts"])["round_loadouts"])


ORACLE["ingest_damages"] = f"""
WITH {DEMO}
SELECT demo_file, map_name, round, tick, CAST(user_id AS VARCHAR) AS "attackerSteamID", {r6(hpDamage='value').replace('hpDamage', '"hpDamage"')}, props AS weapon
FROM placed WHERE event_type='error'
"""
ORACLE["ingest_players"] = f"""
WITH {DEMO}
SELECT DISTINCT demo_file, map_name, day AS round, CAST(user_id AS VARCHAR) AS "steamID", event_type AS name FROM demo
"""
ORACLE["ingest_chat"] = f"""
WITH {DEMO}
SELECT demo_file, map_name, day AS round, tick, CAST(user_id AS VARCHAR) AS player, props AS message FROM demo WHERE event_type='signup'
"""
ORACLE["ingest_shots_slim"] = f"""
WITH {DEMO}
SELECT demo_file, map_name, round, tick, CAST(user_id AS VARCHAR) AS "shooterSteamID", props AS weapon, {r6(x='value')}
FROM placed, (VALUES (1), (2)) AS twice(k) WHERE event_type='click'
"""
ORACLE["loadouts_without_equipment"] = f"""
SELECT demo_file, map_name, round, steamid, name, team_num, team, CAST(NULL AS DOUBLE) AS health, CAST(NULL AS BIGINT) AS armor,
       CAST(NULL AS BIGINT) AS has_helmet, inventory_json, row_id FROM ({ORACLE['snapshot_first_value']})
"""


@query
def small_strata(spark, d):
    """Independence tests within parts: tables with empty cells, and with empty margins, which cannot be tested."""
    lines = b.table(spark, d, "lineitem")
    cells = ct.cells(lines, F.col("l_quantity") > 40, F.col("l_returnflag") == "R", ["l_partkey"])
    return rounded(cells.select("*", *stats.independence("a", "b", "c", "d", floor=0.5)))


ORACLE["small_strata"] = f"""
WITH cells AS (
  SELECT l_partkey, count(*) FILTER (WHERE q AND r) AS a, count(*) FILTER (WHERE q AND NOT r) AS b,
         count(*) FILTER (WHERE NOT q AND r) AS c, count(*) FILTER (WHERE NOT q AND NOT r) AS d
  FROM (SELECT l_partkey, l_quantity > 40 AS q, l_returnflag = 'R' AS r FROM lineitem) GROUP BY l_partkey),
raised AS (SELECT *, greatest(a,0.5)::DOUBLE AS fa, greatest(b,0.5)::DOUBLE AS fb, greatest(c,0.5)::DOUBLE AS fc, greatest(d,0.5)::DOUBLE AS fd FROM cells),
summed AS (SELECT *, fa+fb+fc+fd AS fn, (a+b+c+d)::DOUBLE AS n, least(a+b, c+d, a+c, b+d) > 0 AS testable FROM raised),
expected AS (SELECT *, (fa+fb)*(fa+fc)/fn AS xa, (fa+fb)*(fb+fd)/fn AS xb, (fc+fd)*(fa+fc)/fn AS xc, (fc+fd)*(fb+fd)/fn AS xd FROM summed)
SELECT l_partkey, a, b, c, d,
  {r6(chi2=' + '.join(f'pow(abs(f{k}-x{k}) - least(0.5, abs(f{k}-x{k})), 2)/x{k}' for k in 'abcd'))},
  CASE WHEN testable THEN 1 END AS dof,
  {r6(expected_a='CASE WHEN testable THEN (a+b)*(a+c)/n END', expected_b='CASE WHEN testable THEN (a+b)*(b+d)/n END',
      expected_c='CASE WHEN testable THEN (c+d)*(a+c)/n END', expected_d='CASE WHEN testable THEN (c+d)*(b+d)/n END')}
FROM expected
"""
