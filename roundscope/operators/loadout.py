"""Team equipment per round and its comparison between the sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import items as it
from ..functions.text import OTHER_TEAM_OF_SIDE, TEAM_OF_SIDE, lookup, number


def explode_items(df: DataFrame, inventory: str, keep: Sequence[str]) -> DataFrame:
    """One row per inventory element, spelled as stored."""
    text = F.btrim(F.col(inventory))
    parsed = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    return df.select(*keep, F.explode(parsed).alias("item"))


def team_loadout(
    players: DataFrame,
    keys: Sequence[str],
    team: str = "team",
    inventory: str = "inventory_json",
    helmet: str = "has_helmet",
    categories: Mapping[str, Sequence[str]] = it.CATEGORIES,
    weights: Mapping[str, float] = it.WEIGHTS,
    flags: Sequence[str] = ("awp",),
) -> DataFrame:
    """One row per team and round: category counts, helmets, players, helmet share and score.

    Categories in ``flags`` are 0/1 (present at all), the others count elements. Each player row is
    reduced to numbers before the shuffle.
    """
    texts = players.select(
        *keys, team, F.coalesce(number(helmet), F.lit(0.0)).alias("_helmet"),
        F.col(inventory).alias("_text"), it.is_plain(inventory).alias("_plain"), F.lower(inventory).alias("_lower"),
    )
    per_player = texts.select(
        *keys, team, "_helmet",
        *[it.count_in(t, "_text", F.col("_plain"), F.col("_lower"), c in flags).alias(c) for c, t in categories.items()],
    )
    sums = [(F.max(c) if c in flags else F.sum(c)).cast("bigint").alias(c) for c in categories]
    teams = per_player.groupBy(*keys, team).agg(
        *sums, F.sum("_helmet").alias("helmets"), F.count(F.lit(1)).alias("players")
    )
    return teams.withColumns({"helmet_share": F.col("helmets") / F.col("players"), "score": it.score(dict(weights))})


def opening_teams(first: DataFrame, side: str) -> DataFrame:
    """Add the team that opened and the other one."""
    return first.withColumns(
        {"open_team": lookup(F.col(side), TEAM_OF_SIDE), "other_team": lookup(F.col(side), OTHER_TEAM_OF_SIDE)}
    )


def pair_sides(
    first: DataFrame, teams: DataFrame, keys: Sequence[str], side: str, columns: Sequence[str], team: str = "team"
) -> DataFrame:
    """Add the loadout columns of both teams as ``*_open`` and ``*_other`` and their differences ``d_*``.

    The two team rows of a round are put on one row first, so that the openings join once.
    """
    names = [t for t in TEAM_OF_SIDE.values()]
    wide = teams.filter(F.col(team).isin(names)).groupBy(*keys).agg(
        *[F.max(F.when(F.col(team) == t, F.col(c))).alias(f"_{t}_{c}") for t in names for c in columns]
    )
    joined = opening_teams(first, side).join(wide, list(keys), "left")

    def of(which: str, column: str) -> Column:
        return F.coalesce(*[F.when(F.col(which) == t, F.col(f"_{t}_{column}")) for t in names])

    out = joined.withColumns({f"{c}_open": of("open_team", c) for c in columns} | {f"{c}_other": of("other_team", c) for c in columns})
    out = out.withColumns({f"d_{c}": F.col(f"{c}_open") - F.col(f"{c}_other") for c in columns})
    return out.drop(*[f"_{t}_{c}" for t in names for c in columns])


def strength(delta: Column, threshold: float = 0.0) -> Column:
    """underdog, favorite or even by the sign of a score difference; NULL when it is unknown."""
    return (
        F.when(delta < -threshold, "underdog")
        .when(delta > threshold, "favorite")
        .when(delta.isNotNull(), "even")
    )
