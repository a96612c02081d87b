"""Fixed warehouse schemas, keys and catalog texts."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

K2 = ["match_id", "demo_file"]
K3 = [*K2, "round"]

_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()


def _table(*fields, keys=("match_id", "map_name", "demo_file")) -> StructType:
    columns = [(k, _S) for k in keys] + list(fields)
    return StructType([StructField(n, t, True) for n, t in columns])


_XYZ = [("x", _D), ("y", _D), ("z", _D)]
_THROW = [
    ("round", _I), ("grenadeType", _S), ("throwerSteamID", _S), ("grenadeId", _S),
    ("start_tick", _L), ("end_tick", _L), ("event_id", _S),
]

# The merged tables and their columns, in order.
WAREHOUSE: dict[str, StructType] = {
    "rounds": _table(("round", _I), ("winner", _S), ("start", _L), ("end", _L)),
    "kills_slim": _table(
        ("round", _I), ("tick", _L), ("killerSteamID", _S), ("victimSteamID", _S),
        ("killerSide", _S), ("weapon", _S), ("headshot", _I), *_XYZ,
    ),
    "events_shots": _table(
        ("round", _I), ("tick", _L), ("t_round", _D), ("t_sec", _D), ("event_id", _S),
        ("shooterSteamID", _S), ("weapon", _S), *_XYZ,
    ),
    "events_grenades": _table(*_THROW),
    "events_bomb": _table(
        ("round", _I), ("event", _S), ("site", _S), ("playerSteamID", _S), ("playerName", _S),
        ("t_round", _D), ("t_sec", _D), ("event_id", _S),
    ),
    "grenades_summary": _table(*_THROW),
    "header": _table(("map_name", _S), ("header_json", _S), ("tickrate", _D), keys=("match_id", "demo_file")),
    "round_loadouts": _table(
        ("round", _I), ("steamid", _S), ("name", _S), ("team_num", _I), ("team", _S), ("health", _D),
        ("armor", _I), ("has_helmet", _I), ("inventory_json", _S), ("row_id", _S),
    ),
}

# Tables merged with insert-or-ignore, and the key that must stay unique.
UNIQUE_KEYS: dict[str, list[str]] = {
    "events_shots": ["event_id"],
    "events_grenades": ["event_id"],
    "events_bomb": ["event_id"],
    "round_loadouts": ["match_id", "demo_file", "round", "steamid"],
}

# Catalog texts (contains, keys, notable fields).
CATALOG: dict[str, tuple[str, str, str]] = {
    "header": ("1 row per demo header / map", "match_id, demo_file", "map_name, tickrate, header_json"),
    "rounds": ("1 row per round with tick bounds", "match_id, demo_file, round", "winner, start, end"),
    "kills_slim": (
        "1 row per kill", "match_id, demo_file, round",
        "killerSteamID, victimSteamID, weapon, headshot, tick, x/y/z",
    ),
    "events_shots": (
        "1 row per shot (unique event_id)", "event_id; match_id, demo_file, round",
        "shooterSteamID, weapon, tick, t_round, t_sec, x/y/z",
    ),
    "events_grenades": (
        "1 row per projectile instance (unique event_id)", "event_id; match_id, demo_file, round",
        "grenadeType, throwerSteamID, grenadeId",
    ),
    "grenades_summary": (
        "1 row per thrown grenade (start→end)", "match_id, demo_file, round",
        "grenadeType, throwerSteamID, start_tick, end_tick",
    ),
    "events_bomb": (
        "1 row per bomb event", "event_id; match_id, demo_file, round",
        "event(planted/defused/explode), site, playerName/SteamID, t_sec",
    ),
    "round_loadouts": (
        "1 snapshot per player per round (post-freeze)", "match_id, demo_file, round, steamid",
        "team, name, health, armor, has_helmet, inventory_json",
    ),
}
