"""One decoded match, or many at once, to the normalised per-match tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import inventory_json
from ..functions.text import BOMB_EVENTS, TEAM_OF_NUMBER, event_label, flag, lookup, stable_id
from ..operators import columns as cols
from ..operators.asof import IntervalSize, attach_round, measure, relative_time
from ..operators.snapshots import TRAJECTORY_NAMES, first_per_group, keep_first, snapshot_after, trajectory_summary
from ..schemas import K2, WAREHOUSE
from ..session import Size, broadcast_within, measured, stored
from ..sources import warehouse
from ..sources.bundles import INGEST_TICKRATE, read_bundle

# Alternative spellings by table, in order of preference.
ROUND = {"round": ["round_num"]}
PLAYER_NAMES = {"round": ["round_num"], "steamid": ["steamID"]}
EQUIPMENT_NAMES = {
    "armor": ["kevlar", "armorValue", "armor_value"],
    "has_helmet": ["hasHelmet", "helmet"],
    "health": ["hp", "healthValue"],
}
KILL_NAMES = {
    "round": ["round_num"],
    "killerSide": ["attacker_side"],
    "killerSteamID": ["killer_steamid", "attacker_steamid"],
    "victimSteamID": ["victim_steamid"],
    "headshot": ["is_headshot"],
    "weapon": ["weapon_name"],
}
BOMB_NAMES = {
    "event": ["event", "action", "state", "Event", "bombEvent"],
    "site": ["site", "bombsite", "BombSite", "bomb_site"],
    "playerSteamID": ["playerSteamID", "defuserSteamID", "planterSteamID", "steamID"],
    "playerName": ["player", "defuser", "planter", "name"],
}

# Columns kept per table.
ROUND_COLUMNS = ["round", "winner", "start", "end", "freeze_end", "bomb_planted", "score_ct", "score_t"]
KILL_COLUMNS = [
    "round", "tick", "killerSteamID", "victimSteamID", "killerSide", "weapon", "headshot", "x", "y", "z",
]
DAMAGE_COLUMNS = [
    "round", "tick", "attackerSteamID", "victimSteamID", "hpDamage", "armorDamage", "weapon", "hitgroup",
]
SHOT_COLUMNS = ["round", "tick", "shooterSteamID", "weapon", "x", "y", "z"]
PLAYER_COLUMNS = ["round", "steamID", "name", "team", "side"]
CHAT_COLUMNS = ["round", "tick", "player", "message"]

SOURCE = ["map_name", "demo_file"]


class Scope:
    """Columns that tell one source from another: the demo file, and the match if there are many."""

    def __init__(self, header: DataFrame):
        self.keys = [c for c in K2 if c in header.columns]
        self.header = header
        self._size: IntervalSize | None = None
        self._sources: Size | None = None

    def sources(self) -> Size:
        """The sources counted, once for all tables."""
        if self._sources is None:
            self._sources = measured(cols.keep(self.header, [*self.keys, "map_name", "tickrate"]))
        return self._sources

    def _headers(self, column: str) -> DataFrame:
        """One row per source, beside tables that may be very much larger."""
        return broadcast_within(self.header.select(*self.keys, column), self.sources())

    def size(self, rounds: DataFrame) -> IntervalSize:
        """The rounds counted, once for all tables."""
        if self._size is None:
            start = "start" if "start" in rounds.columns else "round"
            self._size = measure(rounds, self.keys, start, ["round", "start", "end", "freeze_end"])
        return self._size

    def attach(self, events: DataFrame, rounds: DataFrame) -> DataFrame:
        """Give events their round by tick unless they have one."""
        if "round" in events.columns or "start" not in rounds.columns:
            return events
        return attach_round(events, rounds, self.keys, size=self.size(rounds))

    def time(self, events: DataFrame, rounds: DataFrame) -> DataFrame:
        """Add the time since the start of the round."""
        by = [*self.keys, "round"]
        begin = keep_first(rounds.select(*by, "start"), by, ["start"])
        return relative_time(self.rate(events), begin, by, size=self.size(rounds)).drop("tickrate")

    def keep(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return cols.keep(df, [*self.keys, *columns])

    def stamp(self, df: DataFrame) -> DataFrame:
        """Add the map of each source; there is one header row per source."""
        if "map_name" in df.columns:
            return df
        return df.join(self._headers("map_name"), self.keys, "left")

    def rate(self, df: DataFrame) -> DataFrame:
        return df.join(self._headers("tickrate"), self.keys, "left").fillna(INGEST_TICKRATE, ["tickrate"])


def rounds(df: DataFrame, scope: Scope) -> DataFrame:
    return scope.stamp(scope.keep(cols.resolve(df, ROUND), ROUND_COLUMNS))


def _team_number(df: DataFrame) -> DataFrame:
    if "team_num" in df.columns:
        return df
    source = cols.pick(df, ["side", "team"])
    if source is None:
        return df
    return df.withColumn("team_num", lookup(F.upper(F.col(source).cast("string")), {"CT": 3, "T": 2}))


def round_loadouts(ticks: DataFrame, rounds: DataFrame, scope: Scope) -> DataFrame | None:
    """The first state of each player after the freeze time of each round."""
    players = _team_number(cols.resolve(ticks, PLAYER_NAMES))
    if not {"round", "tick", "steamid", "team_num", "name", "inventory"} <= set(players.columns):
        return None
    players = cols.resolve(players, EQUIPMENT_NAMES)
    players = cols.add_missing(players, {"health": "double", "armor": "int", "has_helmet": "int"})
    state = ["name", "team_num", "health", "armor", "has_helmet", "inventory"]
    slim = players.select(*scope.keys, "round", "steamid", F.col("tick").try_cast("bigint").alias("tick"), *state)

    by = [*scope.keys, "round"]
    freeze = "freeze_end" if "freeze_end" in rounds.columns else "start"
    # A repeated round row must not repeat its players' rows.
    begin = keep_first(rounds.select(*by, freeze), by, [freeze])
    after = snapshot_after(slim, begin, by, "tick", freeze, size=scope.size(rounds))
    first = first_per_group(after, [*by, "steamid"], ["tick"], state)
    live = first.filter(F.col("team_num").isin(list(TEAM_OF_NUMBER)))
    is_array = dict(live.dtypes)["inventory"].startswith("array")
    out = live.withColumns(
        {
            "team": lookup(F.col("team_num"), TEAM_OF_NUMBER),
            "has_helmet": flag("has_helmet"),
            "inventory_json": inventory_json("inventory", is_array),
            "row_id": stable_id("demo_file", "round", "steamid"),
        }
    ).drop("inventory")
    return scope.stamp(out)


def kills_slim(kills: DataFrame, rounds: DataFrame, scope: Scope) -> DataFrame:
    named = cols.resolve(kills, KILL_NAMES)
    placed = cols.coordinates(scope.attach(named, rounds))
    if "headshot" in placed.columns:
        placed = placed.withColumn("headshot", flag("headshot"))
    return scope.stamp(scope.keep(placed, KILL_COLUMNS))


def damages_slim(damages: DataFrame, rounds: DataFrame, scope: Scope) -> DataFrame:
    named = cols.resolve(damages, ROUND)
    return scope.stamp(scope.keep(scope.attach(named, rounds), DAMAGE_COLUMNS))


def shots_slim(shots: DataFrame, rounds: DataFrame, scope: Scope) -> DataFrame:
    named = cols.resolve(shots, ROUND)
    return scope.stamp(scope.keep(scope.attach(named, rounds), SHOT_COLUMNS))


def _part(df: DataFrame, column: str) -> Column:
    """A column as an id part; an absent column reads as empty text."""
    return F.col(column) if column in df.columns else F.lit("")


def events_shots(slim: DataFrame, rounds: DataFrame, scope: Scope) -> DataFrame:
    """One row per shot: the strongest available key decides what counts as the same shot.

    The event id is made of the columns of that key, so it needs no deduplication of its own.
    """
    key = [*scope.keys, "map_name", "round", "tick"]
    for c in ("shooterSteamID", "weapon"):
        if c not in slim.columns:
            break
        key.append(c)
    distinct = keep_first(slim.dropna(subset=["round", "tick"]), key)
    timed = scope.time(distinct, rounds)
    named = timed.withColumn(
        "event_id",
        stable_id("demo_file", "round", "tick", _part(timed, "shooterSteamID"), _part(timed, "weapon")),
    )
    return scope.keep(named, ["map_name", "round", "tick", "t_round", "t_sec", "event_id", *SHOT_COLUMNS[2:]])


def events_bomb(bomb: DataFrame, rounds: DataFrame, scope: Scope, keep_explode: bool = True) -> DataFrame:
    """Plants, defuses and explosions with their time in the round."""
    named = cols.resolve(bomb, ROUND)
    found = {target: cols.pick(named, spellings) for target, spellings in BOMB_NAMES.items()}
    event = F.col(found["event"]).cast("string") if found["event"] else F.lit("")
    label = event_label(event, BOMB_EVENTS, skip=() if keep_explode else ("explode",))
    labelled = named.withColumn("_event", label).filter(F.col("_event").isNotNull())
    placed = scope.attach(labelled, rounds)
    chosen = [F.col(c) for c in (*scope.keys, "round", "tick") if c in placed.columns]
    chosen += [F.col(found[t]).alias(t) for t in ("site", "playerSteamID", "playerName") if found[t]]
    out = scope.stamp(placed.select(*chosen, F.col("_event").alias("event")))
    if "tick" in out.columns:
        out = scope.time(out, rounds)
    parts = ["tick", "site", "playerSteamID", "playerName", "event"]
    return out.withColumn("event_id", stable_id("demo_file", "round", *[_part(out, p) for p in parts]))


def players_slim(players: DataFrame, scope: Scope) -> DataFrame:
    return scope.stamp(scope.keep(cols.resolve(players, ROUND), PLAYER_COLUMNS))


def chat_slim(chat: DataFrame, scope: Scope) -> DataFrame:
    return scope.stamp(scope.keep(cols.resolve(chat, ROUND), CHAT_COLUMNS))


def projectiles(grenades: DataFrame) -> DataFrame:
    """Rows of thrown projectiles; all rows where the type is not given."""
    kind = cols.pick(grenades, ["grenade_type", "grenadeType"])
    if kind is None:
        return grenades
    return grenades.filter(F.coalesce(F.col(kind).cast("string").contains("Projectile"), F.lit(False)))


def grenades_summary(grenades: DataFrame, scope: Scope) -> DataFrame | None:
    """One row per thrown projectile; none where the source tells neither round nor tick."""
    if not all(cols.pick(grenades, TRAJECTORY_NAMES[c]) for c in ("round", "tick")):
        return None
    return scope.stamp(trajectory_summary(grenades, scope.keys, scope_rows=scope.sources()))


def events_grenades(grenades: DataFrame, scope: Scope) -> DataFrame:
    """One row per projectile; the id is that of its first row."""
    kind = cols.pick(grenades, ["grenade_type", "grenadeType"])
    thrower = cols.pick(grenades, ["thrower_steamid", "throwerSteamID"])
    event_id = stable_id(
        "demo_file",
        _part(grenades, "entity_id"),
        _part(grenades, "round_num"),
        _part(grenades, "tick"),
        F.col(kind) if kind else F.lit(""),
        F.col(thrower) if thrower else F.lit(""),
    )
    listed = ["round_num", "tick", "grenade_type", "thrower_steamid", "X", "Y", "Z", "entity_id", "event_id"]
    slim = scope.keep(grenades.withColumn("event_id", event_id), listed)
    slim = slim.withColumnsRenamed(
        {"round_num": "round", "grenade_type": "grenadeType", "thrower_steamid": "throwerSteamID"}
    )
    if "entity_id" in slim.columns:
        key = [*scope.keys, "round", "entity_id"]
    else:
        key = [*scope.keys, "round", "tick", "grenadeType", "throwerSteamID"]
    key = [c for c in key if c in slim.columns]
    return scope.stamp(keep_first(slim, key, [c for c in ("tick",) if c in slim.columns]))


def ingest(
    bundle: Mapping[str, DataFrame], header: DataFrame, tables: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The tables (all, or those named) that the decoded tables of one or many sources give.

    Every decoded table carries ``demo_file`` (and ``match_id`` for many matches); ``header`` has one
    row per source with ``map_name`` and ``tickrate``. Absent decoded tables yield no table.
    """
    scope = Scope(header)
    found = {name: df for name, df in bundle.items() if df is not None and df.columns}
    if "rounds" not in found:
        raise ValueError("a bundle needs its rounds")
    base = rounds(found["rounds"], scope)

    def thrown() -> DataFrame:
        return projectiles(found["grenades"])

    def shots() -> DataFrame:
        return shots_slim(found["shots"], base, scope)

    def bomb() -> DataFrame:
        return events_bomb(found["bomb"], base, scope)

    makers: dict[str, tuple[str, Callable[[], DataFrame | None]]] = {
        "header": ("rounds", lambda: header),
        "rounds": ("rounds", lambda: base),
        "round_loadouts": ("ticks", lambda: round_loadouts(found["ticks"], base, scope)),
        "kills_slim": ("kills", lambda: kills_slim(found["kills"], base, scope)),
        "damages_slim": ("damages", lambda: damages_slim(found["damages"], base, scope)),
        "shots_slim": ("shots", shots),
        "events_shots": ("shots", lambda: events_shots(shots(), base, scope)),
        "bomb": ("bomb", bomb),
        "events_bomb": ("bomb", bomb),
        "players_slim": ("players", lambda: players_slim(found["players"], scope)),
        "grenades_summary": ("grenades", lambda: grenades_summary(thrown(), scope)),
        "events_grenades": ("grenades", lambda: events_grenades(thrown(), scope)),
        "chat": ("chat", lambda: chat_slim(found["chat"], scope)),
    }
    out = {}
    for name in tables or makers:
        source, make = makers[name]
        df = make() if source in found else None
        if df is not None:
            out[name] = df
    return out


def inspector(ticks: DataFrame, rounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Loadout of every player at the first row after the freeze time, by round and side."""
    cols.require(rounds, ["round_num", "freeze_end"], "rounds")
    cols.require(ticks, ["round_num", "tick", "steamid", "name", "team_num", "inventory"], "ticks")
    by = [*keys, "round_num"]
    shown = [c for c in ("name", "team_num", "health", "armor", "has_helmet", "inventory") if c in ticks.columns]
    after = snapshot_after(ticks.select(*by, "tick", "steamid", *shown), rounds, by, "tick", "freeze_end", strict=True)
    first = first_per_group(after, [*by, "steamid"], ["tick"], shown, skip_nulls=False)
    side = lookup(F.col("team_num"), TEAM_OF_NUMBER)
    rest = [c for c in shown if c not in ("team_num", "name")]
    return first.withColumn("side", side).filter(F.col("side").isNotNull()).select(*by, "side", "name", "steamid", *rest)


def write(
    bundle: Mapping[str, DataFrame], header: DataFrame, root: str, tables: Sequence[str] | None = None, batch: str | None = None
) -> DataFrame:
    """Append the normalised tables of a bundle to a folder and return its manifest (table, rows).

    A named batch may be repeated. The two bomb tables are alike and computed once.
    """
    made = ingest(bundle, header, tables)
    if {"bomb", "events_bomb"} <= made.keys():
        made["bomb"] = made["events_bomb"] = stored(made["events_bomb"])
    for name, df in made.items():
        warehouse.append(warehouse.typed(df, name), root, name, batch)
    spark = header.sparkSession
    return warehouse.manifest({name: read_bundle(spark, root, name) for name in made})


def load(
    bundle: Mapping[str, DataFrame], header: DataFrame, root: str, batch: str | None = None
) -> list[str]:
    """Normalise the decoded tables of many matches (``match_id`` in all of them) and merge them
    straight into the warehouse; returns the merged tables."""
    made = ingest(bundle, header)
    merged = [name for name in WAREHOUSE if name in made]
    for name in merged:
        warehouse.merge_into(header.sparkSession, root, name, made[name], order=("match_id",), batch=batch)
    return merged
