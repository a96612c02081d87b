"""The analyses over warehouse tables. Keys default to match, demo file and round."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import items as it
from ..functions import stats
from ..functions.text import is_true, number
from ..operators import contingency as ct
from ..operators import distribution as dist
from ..operators import loadout as lo
from ..operators.columns import null_safe_join
from ..operators.first_event import first_counts, next_opposite, response_curve
from ..operators.snapshots import first_value
from ..schemas import K2, K3
from ..sources.bundles import ANALYSIS_TICKRATE

SIDES = ["ct", "t"]


def _fold(c: str, fold_case: bool = True) -> Column:
    return F.lower(F.col(c)) if fold_case else F.col(c)


# --- opening and round result --------------------------------------------------------------


def opening_counts(
    rounds: DataFrame, kills: DataFrame, keys: Sequence[str] = K3, by: Sequence[str] = (), fold_case: bool = True
) -> DataFrame:
    """Rounds with their winner and how many of the tied first kills each side made."""
    sides = kills.select(*keys, "tick", _fold("killerSide", fold_case).alias("side"))
    first = first_counts(sides, keys, "tick", "side", SIDES)
    played = rounds.select(*dict.fromkeys([*keys, *by, "winner"])).distinct()
    return played.withColumn("winner", _fold("winner", fold_case)).join(first, list(keys))


def opening_cells(
    rounds: DataFrame, kills: DataFrame, keys: Sequence[str] = K3, by: Sequence[str] = (), fold_case: bool = True
) -> DataFrame:
    """a: ct won, ct opened; b: ct won, t opened; c: t won, ct opened; d: t won, t opened."""
    joined = opening_counts(rounds, kills, keys, by, fold_case)
    sums = {
        name: F.coalesce(F.sum(F.when(F.col("winner") == w, F.col(f"n_{s}"))), F.lit(0)).cast("bigint")
        for name, w, s in (("a", "ct", "ct"), ("b", "ct", "t"), ("c", "t", "ct"), ("d", "t", "t"))
    }
    return joined.groupBy(*by).agg(*[c.alias(name) for name, c in sums.items()])


def opening_win(rounds: DataFrame, kills: DataFrame, keys: Sequence[str] = K3) -> DataFrame:
    """Does the side of the first kill win the round?"""
    out = ct.with_tests(opening_cells(rounds, kills, keys))
    wins = F.col("a") + F.col("d")
    out = out.withColumns({"opening_wins": wins, "share": F.try_divide(wins.cast("double"), F.col("n"))})
    return out.withColumn("rejected", stats.rejects("p_chi2"))


def opening_win_by_map(
    rounds: DataFrame, kills: DataFrame, keys: Sequence[str] = K3, by: str = "map_name", fold_case: bool = True
) -> DataFrame:
    """The same per map, p-values adjusted over the maps, with the extents of the error bars."""
    cells = opening_cells(rounds, kills, keys, [by], fold_case)
    out = ct.with_tests(cells, floor=0.5, fisher=False)
    wins = F.col("a") + F.col("d")
    out = out.withColumns({"opening_wins": wins, "share": F.try_divide(wins.cast("double"), F.col("n"))})
    out = ct.holm(out, "p_chi2")
    return out.withColumns(
        {
            "sig": stats.stars("p_holm"),
            "err_lo": F.col("odds_ratio") - F.col("or_lo"),
            "err_hi": F.col("or_hi") - F.col("odds_ratio"),
            "or_text": F.format_string("%.2f [%.2f–%.2f]", "odds_ratio", "or_lo", "or_hi"),
        }
    ).orderBy(by)


# --- first kill and equipment ----------------------------------------------------------------


def _first_sides(kills: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per round and opening side, weighted by the tied first kills; the side is NULL where it
    is neither of the two."""
    known = kills.dropna(subset=list(keys)).select(*keys, "tick", "killerSide")
    counted = first_counts(known, keys, "tick", "killerSide", SIDES)
    sides = [F.struct(F.lit(s).alias("opening_side"), F.col(f"n_{s}").alias("weight")) for s in SIDES]
    sides.append(F.struct(F.lit(None).cast("string").alias("opening_side"), F.col("n_other").alias("weight")))
    return counted.select(*keys, F.inline(F.array(*sides))).filter(F.col("weight") > 0)


def team_loadouts(players: DataFrame, keys: Sequence[str] = K3, **options) -> DataFrame:
    """Equipment of the two teams of each round."""
    return lo.team_loadout(players.filter(F.col("team").isin("CT", "T")), keys, **options)


def category_opening(
    rounds: DataFrame, kills: DataFrame, teams: DataFrame, flag: str = "awp", keys: Sequence[str] = K3
) -> DataFrame:
    """Is a team with the category more often the opening side? Both teams of a round count."""
    both = (
        teams.select(*keys, "team", flag)
        .join(_first_sides(kills, keys), list(keys))
        .join(rounds.select(*keys), list(keys))
    )
    opened = is_true(F.col("team") == F.upper("opening_side"))
    return ct.with_tests(ct.cells(both, F.col(flag) > 0, opened, weight=F.col("weight")))


def category_conversion(
    rounds: DataFrame,
    kills: DataFrame,
    teams: DataFrame,
    flag: str = "awp",
    keys: Sequence[str] = K3,
    null_flag: str = "true",
) -> DataFrame:
    """Does an opening side with the category win more often? ``null_flag`` rules on rounds without
    a known loadout: they count as having it unless told otherwise."""
    opened = rounds.select(*keys, "winner").join(_first_sides(kills, keys), list(keys))
    opened = lo.opening_teams(opened, "opening_side")
    loadout = teams.select(*keys, F.col("team").alias("open_team"), (F.col(flag) > 0).alias("_has"))
    joined = opened.join(loadout, [*keys, "open_team"], "left")
    won = is_true(F.lower("winner") == F.col("opening_side"))
    return ct.with_tests(ct.cells(joined, ct.present(F.col("_has"), null_flag), won, weight=F.col("weight")))


def underdog_conversion(
    rounds: DataFrame, kills: DataFrame, teams: DataFrame, keys: Sequence[str] = K3, threshold: float = 0.0
) -> DataFrame:
    """Does the weaker equipped opening side win as often as the stronger one?

    a, b: underdog won, lost; c, d: favorite won, lost. Even rounds are left out.
    """
    first = _first_sides(kills, keys).join(rounds.select(*keys, "winner"), list(keys))
    paired = lo.pair_sides(first, teams, keys, "opening_side", ["score"])
    state = lo.strength(F.col("d_score"), threshold)
    contrast = paired.withColumn("state", state).filter(F.col("state") != "even")
    won = is_true(F.lower("winner") == F.col("opening_side"))
    table = ct.cells(contrast, F.col("state") == "underdog", won, weight=F.col("weight"))
    out = ct.with_tests(table, one_sided=True)
    for name, k, n in (
        ("underdog", F.col("a"), F.col("a") + F.col("b")),
        ("favorite", F.col("c"), F.col("c") + F.col("d")),
    ):
        rate = stats.wilson(k, n)
        out = out.withColumns({f"{name}_n": n} | {f"{name}_{part}": c for part, c in rate.items()})
    return out


# --- helmets and headshots -------------------------------------------------------------------


def flag_test(
    events: DataFrame, holders: DataFrame, keys: Sequence[str], flag: str, outcome: str
) -> DataFrame:
    """Rate of an outcome with and without a flag that comes from a second table.

    a, b: flag not set, outcome no and yes; c, d: flag set, outcome no and yes.
    """


    def tally(df: DataFrame, column: str, name: str) -> DataFrame:
        """One row per key: how often the column is 0 and 1. Repeated keys never form pairs."""
        value = F.coalesce(number(column), F.lit(0.0)).cast("int")
        return df.groupBy(*keys).agg(*[F.count_if(value == v).alias(f"{name}{v}") for v in (0, 1)])

    joined = null_safe_join(tally(events, outcome, "_y"), tally(holders, flag, "_x"), keys, "inner")
    pairs = {"a": (0, 0), "b": (0, 1), "c": (1, 0), "d": (1, 1)}
    table = joined.agg(
        *[F.coalesce(F.sum(F.col(f"_x{x}") * F.col(f"_y{y}")), F.lit(0)).alias(name) for name, (x, y) in pairs.items()]
    )
    out = ct.with_tests(table, zero="floor1")
    n0, n1 = F.col("a") + F.col("b"), F.col("c") + F.col("d")
    without, with_flag = stats.wilson("b", n0), stats.wilson("d", n1)
    out = out.withColumns(
        {"n0": n0, "n1": n1}
        | {f"{part}_0": c for part, c in without.items()}
        | {f"{part}_1": c for part, c in with_flag.items()}
    )
    return out.withColumns({"reject_chi2": stats.rejects("p_chi2"), "reject_fisher": stats.rejects("p_fisher")})


# --- round duration --------------------------------------------------------------------------


def round_durations(
    rounds: DataFrame,
    header: DataFrame,
    bomb: DataFrame,
    keys: Sequence[str] = K3,
    header_keys: Sequence[str] = K2,
    branch: str = "planted",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Seconds each round lasted and whether the branch event happened in it."""
    marked = bomb.filter(F.lower("event") == branch).select(*keys).distinct().withColumn("planted", F.lit(True))
    bounds = rounds.select(*dict.fromkeys([*keys, *header_keys, "start", "end"]))
    rated = null_safe_join(bounds, header.select(*header_keys, *extra, "tickrate"), header_keys, "left")
    joined = null_safe_join(rated, marked, keys, "left").dropna(subset=["start", "end", "tickrate", *extra])
    length = F.try_divide((F.col("end") - F.col("start")).cast("double"), F.col("tickrate").cast("double"))
    return joined.select(*keys, *extra, F.coalesce("planted", F.lit(False)).alias("planted"), length.alias("dur_s"))


def duration_test(durations: DataFrame) -> DataFrame:
    """Rounds with the branch event against those without: sizes, medians, U, p-values, effects."""
    table = dist.two_samples(durations, "dur_s", F.col("planted"))
    return _with_medians(table, [])


def _with_medians(table: DataFrame, by: Sequence[str]) -> DataFrame:
    medians = [dist.quantile("dur_s", s, 0.5).alias(f"median_{s[1]}") for s in ("n1", "n0")]
    return dist.mann_whitney(table, "dur_s", by, medians).withColumns(
        {"median_diff": F.col("median_1") - F.col("median_0"), "rejected": stats.rejects("p_two")}
    )


def duration_summary(durations: DataFrame) -> DataFrame:
    """Size, mean, deviation and quartiles of both branches."""
    table = dist.two_samples(durations, "dur_s", F.col("planted"))
    return dist.summary(table, "dur_s", {"no": "n0", "yes": "n1"}).withColumnRenamed("sample", "planted")


def duration_by(durations: DataFrame, by: str = "map_name") -> DataFrame:
    """The duration test per stratum; strata without one of the branches are left out."""
    table = dist.two_samples(durations, "dur_s", F.col("planted"), [by])
    out = _with_medians(table, [by])
    return out.withColumn("sig", stats.stars("p_two")).orderBy(F.col("median_diff").desc())


# --- sides -----------------------------------------------------------------------------------


def with_map(rounds: DataFrame, header: DataFrame, header_keys: Sequence[str] = K2) -> DataFrame:
    """Rounds with the map their header names."""
    return null_safe_join(rounds.drop("map_name"), header.select(*header_keys, "map_name"), header_keys, "left")


def side_rate(rounds: DataFrame, by: Sequence[str] = (), p0: float = 0.5) -> DataFrame:
    """Share of rounds won by t, against even odds; strata by share, from the highest. Rounds without a stratum are
    left out."""
    won = F.upper(F.coalesce("winner", F.lit("")))
    decided = rounds.withColumn("_winner", won).filter(F.col("_winner").isin("CT", "T")).dropna(subset=list(by))
    out = ct.binomial_rates(decided, F.col("_winner") == "T", by, p0)
    if by:
        out = out.orderBy((F.col("k") / F.col("n")).desc(), *by)
    return out.withColumns(
        {"ct_wins": F.col("n") - F.col("k"), "sig": stats.stars("p_binom"), "rejected": stats.rejects("p_binom")}
    ).withColumnRenamed("k", "t_wins")


# --- timing ----------------------------------------------------------------------------------


def opening_seconds(
    rounds: DataFrame,
    kills: DataFrame,
    header: DataFrame,
    keys: Sequence[str] = K3,
    header_keys: Sequence[str] = K2,
    default_rate=ANALYSIS_TICKRATE,
) -> DataFrame:
    """Seconds from the start of each round to its first kill."""
    default = default_rate if isinstance(default_rate, Column) else F.lit(float(default_rate))
    first = kills.groupBy(*keys).agg(F.min("tick").alias("first_tick"))
    named = [c for c in ("map_name",) if c in rounds.columns]
    started = rounds.select(*dict.fromkeys([*keys, *header_keys, *named, "start"])).distinct()
    joined = started.join(first, list(keys)).join(header.select(*header_keys, "tickrate"), list(header_keys), "left")
    rate = F.coalesce(number("tickrate"), default)
    seconds = F.try_divide((F.col("first_tick") - F.col("start")).cast("double"), rate)
    return joined.select(*keys, seconds.alias("sec"))


def opening_timing(seconds: DataFrame) -> DataFrame:
    """Quartiles over the rounds with a known time; n counts all rounds."""
    values = dist.collapse(seconds, "sec", (), {"n": F.lit(1)})
    n = values.agg(F.sum("n")).first()[0] or 0
    table = dist.prefix_counts(values, "sec", (), ["n"])
    wanted = [dist.quantile("sec", "n", q).alias(name) for name, q in dist.QUARTILES.items()]
    return table.agg(F.lit(n).cast("bigint").alias("n"), F.sum("n").alias("count"), *wanted)


def timing_histogram(seconds: DataFrame, bins: int = 20) -> DataFrame:
    return dist.histogram(seconds, "sec", bins)


def trade_delays(
    kills: DataFrame,
    header: DataFrame | None = None,
    keys: Sequence[str] = K3,
    header_keys: Sequence[str] = K2,
    default_rate=ANALYSIS_TICKRATE,
) -> DataFrame:
    """Per round the first kill and the seconds until the other side answers it."""
    default = default_rate if isinstance(default_rate, Column) else F.lit(float(default_rate))
    folded = kills.select(*keys, "tick", F.lower("killerSide").alias("side"))
    found = next_opposite(folded, keys, "tick", "side")
    if header is None:
        rated = found.withColumn("rate", default)
    else:
        rates = header.select(*header_keys, number("tickrate").alias("_rate"))
        rated = found.join(rates, list(header_keys), "left")
        rated = rated.withColumn("rate", F.coalesce("_rate", default)).drop("_rate")
    delay = F.try_divide((F.col("t1") - F.col("t0")).cast("double"), F.col("rate"))
    return rated.withColumn("dt_s", delay)


def trade_curve(delays: DataFrame, horizon: int = 12, points: Sequence[int] | None = None) -> DataFrame:
    return response_curve(delays, "dt_s", horizon, points)


# --- features --------------------------------------------------------------------------------

# Per-round features, in order.
FEATURES = [
    "open_won",
    "time_to_ok_s", "trade_3s", "trade_5s", "trade_10s",
    "plant", "time_to_plant_s", "round_dur_s",
    "d_score", "d_awp", "d_rifles", "d_smgs", "d_heavy", "d_pistols", "d_helmets",
    "score_open", "score_other",
]


def round_features(
    rounds: DataFrame,
    kills: DataFrame,
    header: DataFrame,
    bomb: DataFrame,
    teams: DataFrame,
    keys: Sequence[str] = K3,
    header_keys: Sequence[str] = K2,
    default_rate=ANALYSIS_TICKRATE,
    loadout_columns: Sequence[str] = (*it.CATEGORIES, "helmets", "score"),
) -> DataFrame:
    """One row per round with a first kill: the features of the correlation matrix."""
    default = default_rate if isinstance(default_rate, Column) else F.lit(float(default_rate))
    delays = trade_delays(kills, header, keys, header_keys, default_rate)
    plants = (
        bomb.dropna(subset=list(keys))
        .filter(F.lower("event") == "planted")
        .groupBy(*keys)
        .agg(first_value("t_sec", "t_sec").alias("time_to_plant_s"))
    )
    rates = header.select(*header_keys, number("tickrate").alias("_round_rate"))
    played = rounds.select(*dict.fromkeys([*keys, *header_keys, "start", "end", "winner"]))
    played = played.withColumn("winner", F.lower("winner")).join(rates, list(header_keys), "left")
    length = F.try_divide(
        (F.col("end") - F.col("start")).cast("double"), F.coalesce("_round_rate", default)
    )
    played = played.select(*keys, "winner", "start", length.alias("round_dur_s"))
    table = delays.join(plants, list(keys), "left").join(played, list(keys), "left")
    paired = lo.pair_sides(table, teams, keys, "side0", list(loadout_columns))

    def within(seconds: int) -> Column:
        return is_true(F.col("dt_s") <= seconds).cast("double")

    return paired.withColumns(
        {
            "open_won": is_true(F.col("winner") == F.col("side0")).cast("double"),
            "time_to_ok_s": F.try_divide((F.col("t0") - F.col("start")).cast("double"), F.col("rate")),
            "trade_3s": within(3),
            "trade_5s": within(5),
            "trade_10s": within(10),
            "plant": F.col("time_to_plant_s").isNotNull().cast("double"),
        }
    )
