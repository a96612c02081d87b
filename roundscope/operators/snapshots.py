"""First rows, trajectory summaries and keep-first deduplication.

All of them are aggregates that combine on the map side, so a group with very many rows never
sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number, whole
from ..session import Size, broadcast_within


def _known(c: str, order: Sequence[str]) -> Column:
    """The order and the value where the value is known."""
    pair = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(c).alias("v"))
    return F.when(F.col(c).isNotNull(), pair)


def first_value(c: str, *order: str) -> Column:
    """First non-null value by order; the least value where the order ties."""
    return F.min(_known(c, order))["v"]


def last_value(c: str, *order: str) -> Column:
    """Last non-null value by order; the greatest value where the order ties."""
    return F.max(_known(c, order))["v"]


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], skip_nulls: bool = True
) -> DataFrame:
    """One row per group: the first non-null value of each column, or the first whole row.

    Groups with a NULL key are dropped in the first form, as grouping there ignores them.
    """
    if skip_nulls:
        grouped = df.dropna(subset=list(keys)).groupBy(*keys)
        return grouped.agg(*[first_value(c, *order).alias(c) for c in columns])
    rest = [c for c in columns if c not in order]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key, the least by ``order`` and then by all other columns. NULL keys are alike."""
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def snapshot_after(
    ticks: DataFrame, rounds: DataFrame, by: Sequence[str], tick: str = "tick", freeze_end: str = "freeze_end",
    strict: bool = False, size=None,
) -> DataFrame:
    """Rows at or after the end of the freeze time of their round.

    A round without that time passes all its rows, or none when ``strict``. ``size`` has the counted rows and
    bytes of the rounds, which decide whether they may be broadcast to the far larger ticks.
    """
    begin = rounds.select(*by, F.col(freeze_end).try_cast("double").alias("_freeze"))
    if size is not None:
        begin = broadcast_within(begin, size)
    joined = ticks.join(begin, list(by), "inner" if strict else "left")
    after = F.col(tick).try_cast("double") >= F.col("_freeze")
    return joined.filter(after if strict else after | F.col("_freeze").isNull()).drop("_freeze")


# Spellings of the trajectory columns, in order of preference.
TRAJECTORY_NAMES: dict[str, list[str]] = {
    "round": ["round", "round_num", "roundNumber", "r", "Round"],
    "tick": ["tick", "frame", "time", "t"],
    "grenadeType": [
        "grenadeType", "grenade_type", "nadeType", "projectileType", "projectile", "grenade", "type", "weapon", "name",
    ],
    "throwerSteamID": [
        "throwerSteamID", "thrower_steamid", "attackerSteamID", "playerSteamID", "ownerSteamID", "owner", "thrower",
    ],
    "grenadeId": ["grenadeId", "projectileId", "entity_id", "entityId", "id", "entId"],
    "x": ["x", "X", "posX", "position_x"],
    "y": ["y", "Y", "posY", "position_y"],
    "z": ["z", "Z", "posZ", "position_z"],
    "event": ["event", "action", "state", "Event"],
}


def trajectory_summary(
    df: DataFrame, scope: Sequence[str] = (), names=TRAJECTORY_NAMES, scope_rows: int | Size | None = None
) -> DataFrame:
    """One row per projectile: first and last tick, first and last known position, type, thrower.

    Rows are grouped by projectile id where the scope (one source) has any id, otherwise by
    thrower and type; the choice is made per scope by a small aggregate, not on the driver.
    ``scope_rows`` is the counted number of scopes, if known.
    """
    columns = {target: next((c for c in spellings if c in df.columns), None) for target, spellings in names.items()}
    if not columns["round"] or not columns["tick"]:
        raise ValueError("trajectories need a round and a tick column")
    chosen = [F.col(c) for c in scope]
    for target, source in columns.items():
        if target == "tick":
            chosen.append(whole(source).alias("tick"))
        elif target in ("x", "y", "z"):
            if source:
                chosen.append(number(source).alias(target))
        elif target == "event":
            if source:
                chosen.append(F.lower(F.col(source).cast("string")).alias("event"))
        elif target == "grenadeType":
            chosen.append((F.col(source).cast("string") if source else F.lit("UNK")).alias(target))
        elif source:
            chosen.append(F.col(source).alias(target))
    points = df.select(*chosen)
    have = points.columns
    if "throwerSteamID" not in have:
        points = points.withColumn("throwerSteamID", F.lit(None).cast("string"))

    if "grenadeId" in have:
        any_id = F.max(F.col("grenadeId").isNotNull())
        if scope:
            by_id = points.groupBy(*scope).agg(any_id.alias("_by_id"))
            if scope_rows is not None:
                by_id = broadcast_within(by_id, scope_rows)
            points = points.join(by_id, list(scope), "left")
        else:
            points = points.withColumn("_by_id", points.agg(any_id).scalar())
    else:
        points = points.withColumn("grenadeId", F.lit(None).cast("string")).withColumn("_by_id", F.lit(False))

    points = points.dropna(subset=["round", "tick"])
    key = F.struct(
        F.when(F.col("_by_id"), F.col("grenadeId")).alias("grenadeId"),
        F.when(~F.col("_by_id"), F.col("throwerSteamID").cast("string")).alias("thrower"),
        F.when(~F.col("_by_id"), F.col("grenadeType")).alias("type"),
    )
    aggregates = [
        F.min("tick").alias("start_tick"),
        F.max("tick").alias("end_tick"),
        first_value("grenadeType", "tick").alias("grenadeType"),
        first_value("throwerSteamID", "tick").alias("throwerSteamID"),
    ]
    for c in ("x", "y", "z"):
        if c in have:
            aggregates += [first_value(c, "tick").alias(f"start_{c}"), last_value(c, "tick").alias(f"end_{c}")]
    if "event" in have:
        aggregates.append(last_value("event", "tick").alias("end_event"))
    out = points.groupBy(*scope, "round", key.alias("_key")).agg(*aggregates)
    rest = [c for c in out.columns if c not in (*scope, "round", "_key")]
    ids = [F.col("_key.grenadeId").alias("grenadeId")] if "grenadeId" in have else []
    return out.select(*scope, "round", *ids, *rest)
