"""The given tables in the roles of match telemetry.

An order is a round won by a side, its lines are the kills and the equipment, its customer is the
match; the event stream gives intervals, player states, projectiles and bundle tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import event_label
from ..operators.asof import asof_backward
from ..operators.columns import unite

ROUND = ["round"]
MATCH_ROUND = ["match_id", "round"]
MATCH = ["match_id"]

# Item fragments of the part names in the role of equipment.
PART_CATEGORIES = {"awp": ["widget"], "rifles": ["ring"], "smgs": ["bolt"], "heavy": [], "pistols": []}

EVENT_LABELS = [("planted", ("purchase",)), ("defused", ("signup",)), ("explode", ("error",))]

# Inventory spellings of all categories and of none.
WEAPONS = [
    "AWP", "AK-47", "M4A1-S", "Galil AR", "MP9", "P90", "Nova", "Sawed-Off", "Negev", "Glock-18", "Desert Eagle",
    "Dual Berettas", "R8 Revolver", "Knife", "Smoke Grenade",
]

HOUR = 3_600_000_000
DAY = 24 * HOUR


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days(c: str) -> Column:
    return F.datediff(F.col(c).cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")


def micros(c: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', {c})")


def side(c: str) -> Column:
    return F.when(F.col(c) == "F", "ct").when(F.col(c) == "O", "t")


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("round"),
        F.col("o_custkey").alias("match_id"),
        side("o_orderstatus").alias("winner"),
        days("o_orderdate").alias("start"),
    )


def finished_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds with their end, the last ship date."""
    ends = kills(spark, sf_dir).groupBy("round").agg(F.max("tick").alias("end"))
    return rounds(spark, sf_dir).join(ends, "round")


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = F.when(F.col("c_nationkey") % 3 == 0, 64.0).when(F.col("c_nationkey") % 3 == 1, 128.0)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("match_id"), F.col("c_mktsegment").alias("map_name"), rate.alias("tickrate")
    )


def mapped_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = header(spark, sf_dir).select("match_id", "map_name")
    return rounds(spark, sf_dir).join(maps, "match_id")


def kills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("round"), days("l_shipdate").alias("tick"), side("l_linestatus").alias("killerSide")
    )


def branch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return lines.select(F.col("l_orderkey").alias("round"), F.lit("Planted").alias("event"))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("round"),
        "l_partkey",
        F.upper(side("l_linestatus")).alias("team"),
        (F.col("l_quantity") > 25).cast("int").alias("has_helmet"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.to_json(F.array("p_name", "p_type")).alias("inventory_json")
    )
    return lines.join(parts, "l_partkey").drop("l_partkey")


def with_match(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Rows of a round with the match it belongs to."""
    return df.join(rounds(spark, sf_dir).select("round", "match_id"), "round")


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as plants, their quantity as the second of the plant."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    found = lines.select(F.col("l_orderkey").alias("round"), F.lit("PLANTED").alias("event"), F.col("l_quantity").alias("t_sec"))
    return with_match(spark, sf_dir, found)


# --- events ------------------------------------------------------------------------------------


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("tick", micros("ts"))


def signup_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, each signup opens an interval that the first error before the next signup closes."""
    events = timed_events(spark, sf_dir)
    starts = events.filter(F.col("event_type") == "signup").select(
        "user_id", F.col("event_id").alias("round"), F.col("tick").alias("start")
    )
    errors = events.filter(F.col("event_type") == "error").select("user_id", "tick")
    ends = (
        asof_backward(errors, starts, ["user_id"], "tick", "start")
        .filter(F.col("round").isNotNull())
        .groupBy("user_id", "round")
        .agg(F.min("tick").alias("end"))
    )
    return starts.join(ends, ["user_id", "round"], "left")


def demo_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a source file and a day as the round."""
    return timed_events(spark, sf_dir).select(
        F.concat(F.lit("demo"), F.col("user_id") % 5, F.lit(".dem")).alias("demo_file"),
        F.floor(F.col("tick") / DAY).cast("int").alias("day"),
        "tick", "event_id", "user_id", "event_type", "value", "props",
    )


def demo_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    demos = demo_events(spark, sf_dir).select("demo_file").distinct()
    return demos.select(
        "demo_file",
        F.concat(F.lit("map_"), F.substring("demo_file", 5, 1)).alias("map_name"),
        F.when(F.col("demo_file") != "demo0.dem", 64.0).otherwise(128.0).alias("tickrate"),
    )


def demo_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = demo_events(spark, sf_dir).select("demo_file", F.col("day").alias("round_num")).distinct()
    begin = F.col("round_num").cast("bigint") * DAY
    return found.select(
        "demo_file",
        "round_num",
        F.when(F.col("round_num") % 2 == 0, "ct").otherwise("t").alias("winner"),
        (begin + HOUR).alias("start"),
        F.when(F.col("round_num") % 4 != 0, begin + 23 * HOUR).alias("end"),
        F.when(F.col("round_num") % 5 != 0, begin + 3 * HOUR).alias("freeze_end"),
    )


def demo_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player states; the health is unknown where the value is small."""
    return demo_events(spark, sf_dir).select(
        "demo_file",
        F.col("day").alias("round_num"),
        "tick",
        F.col("user_id").cast("string").alias("steamid"),
        F.col("event_type").alias("name"),
        (F.col("user_id") % 3 + 2).cast("int").alias("team_num"),
        F.when(F.col("value") >= 5, F.col("value")).alias("health"),
        F.floor("value").cast("int").alias("armor"),
        (F.col("value") > 20).alias("has_helmet"),
        F.array("event_type", "props").alias("inventory"),
    )


def demo_grenades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projectile rows; one source has no projectile ids at all."""
    known = F.when(F.col("value") >= 5, F.col("value"))
    return demo_events(spark, sf_dir).select(
        "demo_file",
        F.col("day").alias("round_num"),
        "tick",
        F.concat(F.col("event_type"), F.when(F.col("event_type") != "view", "Projectile").otherwise("")).alias("grenade_type"),
        F.col("user_id").cast("string").alias("thrower_steamid"),
        F.when(F.col("demo_file") != "demo1.dem", F.col("user_id")).alias("entity_id"),
        known.alias("X"), (known * 2).alias("Y"), F.col("value").alias("Z"),
    )


def demo_bundle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Decoded tables with the spellings a decoder may use; most rows carry no round."""
    events = demo_events(spark, sf_dir)
    user, value = F.col("user_id").cast("string"), F.col("value")
    shots = events.filter(F.col("event_type") == "click").select(
        "demo_file", "tick", user.alias("shooterSteamID"), F.col("props").alias("weapon"), value.alias("x")
    )
    return {
        "rounds": demo_rounds(spark, sf_dir),
        "ticks": demo_ticks(spark, sf_dir),
        "kills": events.filter(F.col("event_type") == "purchase").select(
            "demo_file", "tick", user.alias("attacker_steamid"),
            F.when(F.col("user_id") % 2 == 0, "ct").otherwise("t").alias("attacker_side"),
            F.col("event_id").cast("string").alias("victim_steamid"), (value > 20).alias("is_headshot"),
            F.col("props").alias("weapon_name"),
            value.alias("victim_X"), (value * 2).alias("victim_Y"), F.lit("n/a").alias("victim_Z"),
        ),
        "damages": events.filter(F.col("event_type") == "error").select(
            "demo_file", "tick", user.alias("attackerSteamID"), value.alias("hpDamage"), F.col("props").alias("weapon")
        ),
        # Every shot is reported twice.
        "shots": unite([shots, shots]),
        "bomb": events.select(
            "demo_file", "tick", event_label("event_type", EVENT_LABELS).alias("bombEvent"),
            F.col("props").alias("bombsite"), user.alias("planterSteamID"), F.col("event_type").alias("planter"),
        ),
        "players": events.select("demo_file", F.col("day").alias("round_num"), user.alias("steamID"), F.col("event_type").alias("name")).distinct(),
        "grenades": demo_grenades(spark, sf_dir),
        "chat": events.filter(F.col("event_type") == "signup").select(
            "demo_file", F.col("day").alias("round_num"), "tick", user.alias("player"), F.col("props").alias("message")
        ),
    }
