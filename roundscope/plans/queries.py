"""Every operator and analysis bound to the given tables: name → (spark, folder) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import items as it
from ..functions import text as tx
from ..operators import columns as cols
from ..operators import contingency as ct
from ..operators import distribution as dist
from ..operators import loadout as lo
from ..operators import snapshots as snap
from ..operators.asof import asof_backward, attach_round, relative_time
from ..operators.first_event import first_with_ties, next_opposite
from ..operators.spearman import spearman_matrix
from ..schemas import WAREHOUSE
from ..session import new_folder
from ..sources import bundles, feed, warehouse
from ..streaming.ingest import ingest_stream
from . import analysis as an
from . import bindings as b
from . import ingest as ing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, integers as LONG."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


# --- openings ------------------------------------------------------------------------------------


@query
def opening_win(spark, d):
    return rounded(an.opening_win(b.rounds(spark, d), b.kills(spark, d), b.ROUND))


@query
def opening_win_by_map(spark, d):
    return rounded(an.opening_win_by_map(b.mapped_rounds(spark, d), b.kills(spark, d), b.ROUND))


def _opening_rows(spark, d) -> DataFrame:
    """One row per tied first kill with the winner of its round."""
    first = first_with_ties(b.kills(spark, d), b.ROUND, "tick")
    winners = b.rounds(spark, d).select("round", "winner")
    return first.join(winners, "round").select("round", "winner", F.col("killerSide").alias("opening_side"))


@query
def first_kills(spark, d):
    return rounded(first_with_ties(b.kills(spark, d), b.ROUND, "tick"))


@query
def opening_margins(spark, d):
    return ct.with_margins(_opening_rows(spark, d), "winner", "opening_side")


@query
def opening_row_pct(spark, d):
    return rounded(ct.row_pct(_opening_rows(spark, d), "winner", "opening_side"))


@query
def opening_outcomes(spark, d):
    rows = _opening_rows(spark, d).filter(F.col("winner").isNotNull())
    named = rows.select(F.when(F.col("winner") == F.col("opening_side"), "won").otherwise("lost").alias("outcome"))
    return ct.value_counts(named, "outcome", ["won", "lost", "drawn"])


# --- flags and rates -----------------------------------------------------------------------------


@query
def flag_test(spark, d):
    lines = b.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("part"), (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    parts = b.table(spark, d, "part").select(
        F.col("p_partkey").alias("part"), (F.col("p_size") > 25).cast("int").alias("large")
    )
    return rounded(an.flag_test(lines, parts, ["part"], "large", "returned"))


@query
def label_cells(spark, d):
    labels = b.table(spark, d, "labels")
    return rounded(ct.with_tests(ct.cells(labels, F.col("quality") == 1, F.col("toxic") == 1), one_sided=True))


@query
def side_rate(spark, d):
    return rounded(an.side_rate(b.rounds(spark, d)))


@query
def side_rate_by_map(spark, d):
    return rounded(an.side_rate(b.mapped_rounds(spark, d), ["map_name"]))


# --- durations -----------------------------------------------------------------------------------


def _durations(spark, d, extra=()) -> DataFrame:
    return an.round_durations(
        b.finished_rounds(spark, d), b.header(spark, d), b.branch_events(spark, d), b.ROUND, b.MATCH, extra=extra
    )


@query
def branch_duration(spark, d):
    return rounded(an.duration_test(_durations(spark, d)))


@query
def branch_summary(spark, d):
    return rounded(an.duration_summary(_durations(spark, d)))


@query
def branch_duration_by_map(spark, d):
    return rounded(an.duration_by(_durations(spark, d, ["map_name"])))


@query
def value_quantiles(spark, d):
    events = b.table(spark, d, "events")
    return rounded(dist.quantiles(events, "value", {"p10": 0.1, "q1": 0.25, "median": 0.5, "p99": 0.99}, ["event_type"]))


@query
def value_quantiles_ranged(spark, d):
    """The same through value ranges, as large strata take it."""
    events = b.table(spark, d, "events")
    collapsed = dist.collapse(events, "value", ["event_type"], {"n": F.lit(1)})
    table = dist.prefix_counts(collapsed, "value", ["event_type"], ["n"], rows_per_range=500)
    wanted = {"p10": 0.1, "q1": 0.25, "median": 0.5, "p99": 0.99}
    return rounded(
        table.groupBy("event_type").agg(
            F.sum("n").alias("count"), *[dist.quantile("value", "n", q).alias(name) for name, q in wanted.items()]
        )
    )


# --- equipment -----------------------------------------------------------------------------------


def _teams(spark, d) -> DataFrame:
    return an.team_loadouts(b.players(spark, d), b.ROUND, categories=b.PART_CATEGORIES)


@query
def team_loadout(spark, d):
    return rounded(_teams(spark, d))


@query
def token_open(spark, d):
    return rounded(an.category_opening(b.rounds(spark, d), b.kills(spark, d), _teams(spark, d), "awp", b.ROUND))


@query
def token_conversion(spark, d):
    """Every round counts; an opening side whose loadout is unknown reads as having the item."""
    return rounded(an.category_conversion(b.rounds(spark, d), b.kills(spark, d), _teams(spark, d), "awp", b.ROUND))


@query
def token_conversion_known(spark, d):
    """The same with openings that have no known loadout left out."""
    return rounded(
        an.category_conversion(b.rounds(spark, d), b.kills(spark, d), _teams(spark, d), "rifles", b.ROUND, null_flag="drop")
    )


@query
def underdog_conversion(spark, d):
    decided = b.rounds(spark, d).filter(F.col("winner").isNotNull())
    return rounded(an.underdog_conversion(decided, b.kills(spark, d), _teams(spark, d), b.ROUND))


@query
def paired_sides(spark, d):
    first = snap.first_per_group(b.kills(spark, d), b.ROUND, ["tick", "killerSide"], ["killerSide"], skip_nulls=False)
    paired = lo.pair_sides(first, _teams(spark, d), b.ROUND, "killerSide", ["awp", "helmets", "score"])
    return rounded(paired.withColumn("state", lo.strength(F.col("d_score"))))


@query
def inventory_json(spark, d):
    parts = b.table(spark, d, "part")
    bare = F.concat(F.lit(" "), F.col("p_name"))
    broken = F.concat(F.lit("["), F.col("p_name"), F.lit("]"))
    listed = F.concat(F.lit(' ["'), F.col("p_name"), F.lit('","'), F.col("p_type"), F.lit('"] '))
    return parts.select(
        "p_partkey",
        it.inventory_json(F.array("p_name", "p_type"), is_array=True).alias("from_array"),
        it.inventory_json(listed).alias("from_text"),
        it.inventory_json(bare).alias("from_bare"),
        it.inventory_json(broken).alias("from_broken"),
        it.inventory_json(F.nullif("p_name", "p_name")).alias("from_null"),
    )


@query
def explode_items(spark, d):
    players = b.players(spark, d).withColumn("row_id", tx.stable_id("round", "team"))
    return lo.explode_items(players, "inventory_json", ["round", "team", "row_id"])


@query
def item_flags(spark, d):
    listed = it.items(F.to_json(F.array("p_name", "p_type", "p_brand")))
    return rounded(
        b.table(spark, d, "part").select(
            "p_partkey",
            it.any_of(["widget", "economy"], listed).cast("int").alias("any_token"),
            it.count_of(["ring", "brand#1", "small"], listed).alias("token_count"),
            F.array_join(listed, "/").alias("items"),
        )
    )


@query
def weapon_categories(spark, d):
    """Counts per category, with the real lists, of inventories that parts are dealt."""
    names = F.array(*[F.lit(x) for x in b.WEAPONS])
    dealt = [F.get(names, (F.col(c) % len(b.WEAPONS)).cast("int")) for c in ("p_partkey", "p_size")]
    listed = it.items(F.to_json(F.array(*dealt, "p_brand")))
    counts = [it.count_of(words, listed).alias(category) for category, words in it.CATEGORIES.items()]
    return rounded(b.table(spark, d, "part").select("p_partkey", *counts))


# --- timing --------------------------------------------------------------------------------------


def _opening_seconds(spark, d) -> DataFrame:
    header = b.header(spark, d)
    default = bundles.default_tickrate(header, order=["match_id"])
    return an.opening_seconds(b.rounds(spark, d), b.kills(spark, d), header, b.ROUND, b.MATCH, default)


@query
def opening_timing(spark, d):
    return rounded(an.opening_timing(_opening_seconds(spark, d)))


@query
def timing_hist(spark, d):
    return rounded(an.timing_histogram(_opening_seconds(spark, d)))


def _delays(spark, d) -> DataFrame:
    return an.trade_delays(b.kills(spark, d), None, b.ROUND, default_rate=30.0)


@query
def next_opposite_kill(spark, d):
    return rounded(next_opposite(b.kills(spark, d), b.ROUND, "tick", "killerSide"))


@query
def trade_curve(spark, d):
    return rounded(an.trade_curve(_delays(spark, d)))


@query
def trade_curve_points(spark, d):
    return rounded(an.trade_curve(_delays(spark, d), points=[1, 3, 5, 10]))


# --- features ------------------------------------------------------------------------------------

FEATURES = [
    "o_totalprice", "c_acctbal", "lines", "first_delay", "dt_s", "trade_3s", "trade_5s", "trade_10s", "open_won",
    "d_score", "score_open", "score_other",
]


def _features(spark, d) -> DataFrame:
    orders = b.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("round"), F.col("o_custkey").alias("match_id"), "o_totalprice"
    )
    customers = b.table(spark, d, "customer").select(F.col("c_custkey").alias("match_id"), "c_acctbal")
    lines = b.kills(spark, d).groupBy("round").agg(F.count(F.lit(1)).alias("lines"))
    delays = _delays(spark, d)
    started = b.rounds(spark, d).select("round", "start", "winner")
    wide = (
        orders.join(customers, "match_id", "left")
        .join(lines, "round", "left")
        .join(delays, "round", "left")
        .join(started, "round", "left")
    )
    wide = lo.pair_sides(wide, _teams(spark, d), b.ROUND, "side0", ["score"])

    def within(seconds: int) -> Column:
        return F.when(F.col("t0").isNotNull(), tx.is_true(F.col("dt_s") <= seconds).cast("int"))

    return wide.withColumns(
        {
            "first_delay": F.col("t0") - F.col("start"),
            "trade_3s": within(3),
            "trade_5s": within(5),
            "trade_10s": within(10),
            "open_won": tx.is_true(F.col("winner") == F.col("side0")).cast("int"),
        }
    ).select("round", *FEATURES)


@query
def round_features(spark, d):
    return rounded(cols.finite_or_null(_features(spark, d), FEATURES))


@query
def spearman(spark, d):
    return rounded(spearman_matrix(_features(spark, d), FEATURES))


@query
def spearman_ranged(spark, d):
    """The same with values ranked range by range, as large tables take it."""
    return rounded(spearman_matrix(_features(spark, d), FEATURES, rows_per_range=5000))


def _match_features(spark, d) -> DataFrame:
    """The features of the analysis, by match and round."""
    teams = an.team_loadouts(b.with_match(spark, d, b.players(spark, d)), b.MATCH_ROUND, categories=b.PART_CATEGORIES)
    kills = b.with_match(spark, d, b.kills(spark, d))
    return an.round_features(
        b.finished_rounds(spark, d), kills, b.header(spark, d), b.plants(spark, d), teams, b.MATCH_ROUND, b.MATCH
    )


@query
def match_features(spark, d):
    return rounded(_match_features(spark, d).select("match_id", "round", *an.FEATURES))


@query
def feature_correlations(spark, d):
    return rounded(spearman_matrix(_match_features(spark, d), an.FEATURES))


@query
def trade_curve_rated(spark, d):
    """Seconds by the tick rate of the match."""
    kills = b.with_match(spark, d, b.kills(spark, d))
    return rounded(an.trade_curve(an.trade_delays(kills, b.header(spark, d), b.MATCH_ROUND, b.MATCH)))


# --- intervals and snapshots ---------------------------------------------------------------------


@query
def asof_rounds(spark, d):
    events, rounds = b.timed_events(spark, d), b.signup_rounds(spark, d)
    found = attach_round(events.select("event_id", "user_id", "tick"), rounds, ["user_id"])
    return rounded(found)


@query
def asof_rounds_blocked(spark, d):
    """The same through blocks of intervals, as keys with very many of them take it."""
    events, rounds = b.timed_events(spark, d), b.signup_rounds(spark, d)
    found = asof_backward(
        events.select("event_id", "user_id", "tick"), rounds, ["user_id"], "tick", "start", "end", array_limit=4
    )
    return rounded(found)


@query
def relative_times(spark, d):
    events, rounds = b.timed_events(spark, d), b.signup_rounds(spark, d)
    found = attach_round(events.select("event_id", "user_id", "tick"), rounds, ["user_id"])
    timed = relative_time(found, rounds, ["user_id", "round"], tickrate=1e6)
    return rounded(timed.select("event_id", "round", "t_round", "t_sec"))


@query
def snapshot_first_row(spark, d):
    found = ing.inspector(b.demo_ticks(spark, d), b.demo_rounds(spark, d), ["demo_file"])
    return rounded(found.withColumn("inventory", F.array_join("inventory", "/")).withColumn("has_helmet", F.col("has_helmet").cast("int")))


@query
def snapshot_first_value(spark, d):
    return rounded(_ingested(spark, d, "round_loadouts"))


@query
def trajectories(spark, d):
    thrown = ing.projectiles(b.demo_grenades(spark, d))
    return rounded(snap.trajectory_summary(thrown, ["demo_file"]).withColumn("grenadeId", F.col("grenadeId").cast("string")))


@query
def dedup_first(spark, d):
    lines = b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return rounded(snap.keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_partkey"]))


@query
def event_ids(spark, d):
    lines = b.table(spark, d, "lineitem")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return lines.select(
        tx.stable_id(F.lit("demo1.dem"), "l_orderkey", "l_linenumber", flag, F.lit("")).alias("event_id"),
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey",
    )


@query
def normalize_events(spark, d):
    events = b.table(spark, d, "events")
    label = tx.event_label("event_type", b.EVENT_LABELS)
    level = F.get_json_object("props", "$.k")
    out = events.select(
        "event_id",
        label.alias("event"),
        tx.event_label(F.upper("event_type"), b.EVENT_LABELS, skip=["explode"]).alias("event_no_explode"),
        tx.number(level).alias("level"),
        tx.number("event_type").alias("not_a_number"),
        tx.lookup(F.col("user_id") % 4, tx.TEAM_OF_NUMBER).alias("team"),
        tx.flag(F.col("value") > 20).alias("big"),
        tx.is_true(F.nullif("event_type", F.lit("view")).contains("ic")).cast("int").alias("has_ic"),
        F.floor(F.try_divide(F.col("value"), F.nullif(F.col("user_id"), F.lit(7)).cast("double"))).alias("per_user"),
    )
    return rounded(out.filter(F.col("event").isNotNull()))


# --- varying sources -----------------------------------------------------------------------------


@query
def variant_union(spark, d):
    events = b.table(spark, d, "events")
    names = {"event": ["action", "state", "Event"], "playerSteamID": ["steamID", "owner"], "t_sec": ["seconds"]}
    first = events.filter(F.col("event_type").isin("click", "view")).select(
        "event_id", F.col("event_type").alias("action"), F.col("user_id").alias("steamID")
    )
    second = events.filter(F.col("event_type").isin("error", "purchase")).select(
        "event_id", F.col("event_type").alias("Event"), F.col("value").alias("seconds"), F.col("props").alias("undeclared")
    )
    third = events.filter(F.col("event_type") == "signup").select(
        "event_id", F.col("event_type").alias("event"), F.col("props").alias("site"), F.col("user_id").alias("owner")
    )
    frames = [
        warehouse.conform(
            cols.stamp(cols.resolve(f, names), match_id=match, map_name="m", demo_file=f"{match}.dem"),
            WAREHOUSE["events_bomb"],
        )
        for match, f in (("one", first), ("two", second), ("three", third))
    ]
    return rounded(cols.unite(frames))


@query
def header_tickrate(spark, d):
    customers = b.table(spark, d, "customer")
    key = F.when(F.col("c_nationkey") % 4 == 0, "tickrate").when(F.col("c_nationkey") % 4 == 1, "tickRate").when(
        F.col("c_nationkey") % 4 == 2, "ticksPerSecond").otherwise("other")
    rate = F.when(F.col("c_nationkey") % 3 == 0, "64").when(F.col("c_nationkey") % 3 == 1, "0").otherwise("fast")
    name = F.when(F.col("c_nationkey") % 2 == 0, "map_name").otherwise("mapName")
    header = F.map_from_arrays(F.array(name, key), F.array(F.col("c_mktsegment"), rate))
    rows = customers.select(F.col("c_name").alias("demo_file"), header.alias("header"))
    return rounded(bundles.header_rows(rows))


@query
def default_tickrate(spark, d):
    rate = bundles.default_tickrate(b.header(spark, d), order=["match_id"])
    return spark.range(1).select(rate.alias("tickrate"))


# --- feed ----------------------------------------------------------------------------------------


@query
def url_slugs(spark, d):
    return b.table(spark, d, "pages").select(
        "page_id", tx.url_slug("url").alias("slug"), tx.slugify("url").alias("tight_slug")
    )


@query
def url_manifest(spark, d):
    """The urls of the pages as a list of links in a text file, read back with their slugs."""
    path = new_folder(spark, "links")
    b.table(spark, d, "pages").select("url").filter("url is not null").write.text(path)
    return feed.url_manifest(spark, path)


@query
def page_triage(spark, d):
    found = feed.triage(b.table(spark, d, "pages"), "html", min_bytes=1000)
    return found.select(
        "page_id", "length", "kind", F.col("is_text").cast("bigint").alias("is_text"),
        F.col("accepted").cast("bigint").alias("accepted"),
    )


@query
def document_triage(spark, d):
    found = feed.triage(b.table(spark, d, "documents"), "text", min_bytes=1000)
    return found.groupBy("kind", F.col("is_text").cast("bigint").alias("is_text"), F.col("accepted").cast("bigint").alias("accepted")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")
    )


@query
def match_slugs(spark, d):
    """The host stands for the archive, the first path segment for its top folder."""
    pages = b.table(spark, d, "pages")
    host = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    top = F.nullif(F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)/", 1), F.lit(""))
    return feed.match_slug(pages.select(host.alias("url"), top.alias("top_dir")))


# --- warehouse -----------------------------------------------------------------------------------

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query
def catalog(spark, d):
    texts = {t: (f"rows of {t}", f"{t} key", "all columns") for t in (*TABLES, "absent")}
    frames = {t: b.table(spark, d, t) for t in TABLES} | {"absent": None}
    return warehouse.catalog(frames, texts)


@query
def manifest(spark, d):
    return warehouse.manifest({t: b.table(spark, d, t) for t in TABLES} | {"absent": None})


@query
def entities(spark, d):
    rounds, header = b.mapped_rounds(spark, d), b.header(spark, d)
    return warehouse.entities(
        {
            "matches": (rounds, "match_id"),
            "demos": (header, "match_id"),
            "maps": (rounds, "map_name"),
            "rounds": (rounds, None),
            "players": (b.kills(spark, d), "killerSide"),
            "absent": (None, None),
        }
    )


def _lines(spark, d) -> DataFrame:
    """Lines with an event id; those of quantity one have none."""
    event_id = F.when(F.col("l_quantity") != 1, tx.stable_id("l_orderkey", "l_linenumber"))
    return b.table(spark, d, "lineitem").select(
        event_id.alias("event_id"), "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
    )


@query
def merge_append(spark, d):
    lines = _lines(spark, d)
    first = lines.filter(F.col("l_returnflag") == "R")
    merged = warehouse.merge_append(first, lines.drop("l_suppkey"))
    return merged.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_suppkey").alias("with_supplier"), F.sum("l_partkey").alias("parts")
    )


@query
def merge_ignore(spark, d):
    """Returned lines are in the target; the whole table arrives."""
    lines = _lines(spark, d)
    order = ["l_suppkey", "l_partkey"]
    empty = lines.filter(F.lit(False))
    target = warehouse.merge_ignore(empty, lines.filter(F.col("l_returnflag") == "R"), ["event_id"], order)
    return rounded(warehouse.merge_ignore(target, lines, ["event_id"], order))


@query
def merge_new_rows(spark, d):
    """What a merge by a key of several columns would add."""
    lines = _lines(spark, d)
    target = lines.filter(F.col("l_returnflag") == "N").select("l_orderkey", "l_suppkey")
    return rounded(warehouse.new_rows(target, lines, ["l_orderkey", "l_suppkey"], ["l_linenumber"]))


# --- match ingest --------------------------------------------------------------------------------


def _ingested(spark, d, name: str) -> DataFrame:
    return ing.ingest(b.demo_bundle(spark, d), b.demo_header(spark, d), [name])[name]


@query
def ingest_kills(spark, d):
    return rounded(_ingested(spark, d, "kills_slim"))


@query
def ingest_shots(spark, d):
    return rounded(_ingested(spark, d, "events_shots"))


@query
def ingest_bomb(spark, d):
    return rounded(_ingested(spark, d, "events_bomb"))


@query
def ingest_grenades(spark, d):
    return rounded(_ingested(spark, d, "events_grenades"))


@query
def slim_tables(spark, d):
    """Rows per table, source and round of all ingested tables."""
    tables = ing.ingest(b.demo_bundle(spark, d), b.demo_header(spark, d))
    parts = []
    for name, df in tables.items():
        by_round = df if "round" in df.columns else df.withColumn("round", F.lit(None))
        counted = by_round.groupBy("demo_file", "map_name", F.col("round").cast("bigint").alias("round"))
        parts.append(counted.agg(F.count(F.lit(1)).alias("n")).withColumn("table", F.lit(name)))
    return cols.unite(parts)


@query
def warehouse_merge(spark, d):
    """Match folders, some of them named like numbers and with a clashing column, are merged twice."""
    root = new_folder(spark, "warehouse-merge")
    lines = b.table(spark, d, "lineitem")
    matches = {"007": "l_returnflag = 'A'", "1e3": "l_returnflag = 'N'", "1.10": "l_returnflag = 'R'", "m1": "l_linenumber = 1"}
    for match, chosen in matches.items():
        extra = F.col("l_linenumber").cast("int" if match == "m1" else "string")
        event_id = F.when(F.col("l_linenumber") < 7, F.concat_ws("-", F.col("l_orderkey") % 500, "l_linenumber"))
        rows = lines.filter(chosen).select(
            F.lit("d").alias("demo_file"), F.col("l_linenumber").alias("round"), event_id.alias("event_id"), extra.alias("extra")
        )
        rows.write.parquet(f"{root}/matches/{match}/events_shots")
    for _ in range(2):
        warehouse.build(spark, f"{root}/matches", f"{root}/warehouse", batch="one")
    merged = warehouse.read_table(spark, f"{root}/warehouse", "events_shots")
    return merged.select("match_id", "event_id", F.col("round").cast("bigint").alias("round"))


@query
def ingest_stream_merge(spark, d):
    """All events arrive as a stream and are merged into the bomb events of a warehouse, twice."""
    root = new_folder(spark, "stream")
    source = f"{d}/events.parquet"
    schema = spark.read.parquet(source).schema

    def ready(batch: DataFrame) -> DataFrame:
        named = batch.select(
            F.lit("stream").alias("match_id"), tx.event_label("event_type", b.EVENT_LABELS).alias("event"),
            F.col("value").alias("t_sec"), tx.stable_id("event_id").alias("event_id"),
            F.col("user_id").cast("string").alias("playerSteamID"),
        )
        return named.filter(F.col("event").isNotNull())

    for attempt in ("first", "again"):
        done = ingest_stream(
            spark, source, f"{root}/warehouse", "events_bomb", schema, f"{root}/progress-{attempt}", transform=ready
        )
        done.awaitTermination()
    merged = warehouse.read_table(spark, f"{root}/warehouse", "events_bomb")
    return rounded(merged.select("match_id", "event", "event_id", "playerSteamID", "t_sec"))
