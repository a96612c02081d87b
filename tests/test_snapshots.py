"""First rows, deduplication, trajectories and the match ingest."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from roundscope.functions import text as tx
from roundscope.operators import columns as cols
from roundscope.operators import snapshots as snap
from roundscope.plans import ingest as ing
from roundscope.schemas import WAREHOUSE
from roundscope.sources import warehouse


def _hash(*parts):
    return hashlib.sha1("".join(f"{p}|" for p in parts).encode()).hexdigest()[:16]


def test_first_value_and_first_row(spark, rows):
    df = spark.createDataFrame([("p", 1, None, "x"), ("p", 2, 5, "y"), (None, 1, 9, "z")], "k string, t int, a int, b string")
    assert rows(snap.first_per_group(df, ["k"], ["t"], ["a", "b"])) == [("p", 5, "x")]
    assert rows(snap.first_per_group(df, ["k"], ["t"], ["a", "b"], skip_nulls=False)) == [(None, 9, "z"), ("p", None, "x")]


def test_keep_first_takes_missing_keys_as_alike(spark, rows):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 1, "d"), ("k", 1, "c")], "k string, o int, v string")
    out = snap.keep_first(df, ["k"], ["o"])
    assert out.columns == df.columns and rows(out) == [(None, 1, "a"), ("k", 1, "c")]


def test_snapshot_after(spark, rows):
    ticks = spark.createDataFrame([(1, 5), (1, 10), (2, 1), (3, 1)], "round int, tick int")
    rounds = spark.createDataFrame([(1, 10), (2, None)], "round int, freeze_end int")
    assert rows(snap.snapshot_after(ticks, rounds, ["round"])) == [(1, 10), (2, 1), (3, 1)]
    assert rows(snap.snapshot_after(ticks, rounds, ["round"], strict=True)) == [(1, 10)]


def test_trajectory_by_id_and_fallback(spark):
    points = [
        ("d", 1, 10, "HE", "s1", 7, None, 1.0, "Fly"), ("d", 1, 12, "HE", "s1", 7, 2.0, 2.0, "BOOM"), ("d", 1, 11, "HE", "s2", None, 5.0, 5.0, None),
        ("d", 1, None, "HE", "s1", 7, 9.0, 9.0, None),
        ("e", 1, 1, "HE", "s1", None, 1.0, 1.0, None), ("e", 1, 3, "HE", "s1", None, None, 1.5, None), ("e", 1, 2, "SM", "s1", None, 1.0, 1.0, None),
    ]
    df = spark.createDataFrame(
        points, "demo_file string, round_num int, tick int, grenade_type string, thrower_steamid string, entity_id int, X double, Y double, Event string"
    )
    out = {(r.demo_file, r.grenadeId, r.grenadeType): r for r in snap.trajectory_summary(df, ["demo_file"]).collect()}
    assert len(out) == 4
    he = out["d", 7, "HE"]
    assert (he.start_tick, he.end_tick, he.start_x, he.end_x, he.start_y, he.end_y, he.end_event) == (10, 12, 2.0, 2.0, 1.0, 2.0, "boom")
    assert out["d", None, "HE"].throwerSteamID == "s2"  # the missing id is a group of its own
    assert (out["e", None, "HE"].start_tick, out["e", None, "HE"].end_tick, out["e", None, "HE"].end_x) == (1, 3, 1.0)
    one = snap.trajectory_summary(df.drop("entity_id", "demo_file"))
    assert one.count() == 3 and "grenadeId" not in one.columns
    with pytest.raises(ValueError):
        snap.trajectory_summary(df.drop("tick"))


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "round_num int, kevlar int, armorValue int")
    out = cols.resolve(df, {"round": ["round_num"], "armor": ["kevlar", "armorValue"]})
    assert out.columns == ["round", "armor", "armorValue"]
    assert cols.resolve(out, {"armor": ["armorValue"]}).columns == out.columns
    assert cols.stamp(df, map_name="m", kevlar=9).columns == ["map_name", "round_num", "kevlar", "armorValue"]
    assert cols.keep(df, ["kevlar", "no", "round_num"]).columns == ["kevlar", "round_num"]
    assert dict(cols.add_missing(df, {"x": "double"}).dtypes)["x"] == "double"
    with pytest.raises(ValueError):
        cols.require(df, ["no"], "t")


def test_coordinates_need_a_whole_triple(spark):
    df = spark.createDataFrame([("1", "2", "3", "4", "bad")], "victim_X string, victim_Y string, X string, Y string, Z string")
    r = cols.coordinates(df).first()
    assert (r.x, r.y, r.z) == (3.0, 4.0, None)


def test_text_rules(spark):
    df = spark.createDataFrame([("Bomb_Planted",), ("begin_DEFUSE",), ("Detonated",), ("drop",), (None,)], "e string")
    assert [r.l for r in df.select(tx.event_label("e").alias("l")).collect()] == ["planted", "defused", "explode", None, None]
    assert [r.l for r in df.select(tx.event_label("e", skip=["explode"]).alias("l")).collect()][2] is None
    r = spark.createDataFrame([("a", None, 3)], "a string, b string, c int").select(tx.stable_id("a", "b", "c", F.lit("")).alias("h")).first()
    assert r.h == _hash("a", None, 3, "")
    s = spark.createDataFrame([("http://a//b?x=1",)], "u string").select(tx.url_slug("u").alias("u"), tx.slugify("u").alias("s")).first()
    assert (s.u, s.s) == ("http___a__b_x_1", "http_a_b_x_1")
    n = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "v string").select(tx.number("v").alias("n")).collect()
    assert [x.n for x in n] == [1.5, None, None, None]


@pytest.fixture
def match(spark):
    rounds = spark.createDataFrame(
        [("d1.dem", 1, "ct", 0, 100, 10), ("d1.dem", 2, "t", 200, None, None), ("d2.dem", 1, "t", 0, 50, 5)],
        "demo_file string, round_num int, winner string, start long, end long, freeze_end long",
    )
    header = spark.createDataFrame([("d1.dem", "m1", 64.0), ("d2.dem", "m2", 128.0)], "demo_file string, map_name string, tickrate double")
    ticks = spark.createDataFrame(
        [
            ("d1.dem", 1, 5, "s1", "x", "ct", 100, 50, True, ["Knife"]), ("d1.dem", 1, 10, "s1", "x", "ct", None, 50, True, ["AWP"]),
            ("d1.dem", 1, 11, "s1", "y", "ct", 90, 40, False, ["AK-47"]), ("d1.dem", 1, 12, "s2", "z", "spectator", 90, 40, False, []),
            ("d1.dem", 2, 201, "s1", "x", "t", 80, 0, None, None), ("d2.dem", 1, 4, "s1", "x", "t", 80, 0, None, None),
        ],
        "demo_file string, round_num int, tick int, steamID string, name string, side string, hp int, kevlar int, helmet boolean, inventory array<string>",
    )
    shots = spark.createDataFrame(
        [("d1.dem", 64, "s1", "ak"), ("d1.dem", 64, "s1", "ak"), ("d1.dem", 64, "s2", "ak"), ("d1.dem", 150, "s1", "ak"), ("d2.dem", 32, "s1", "ak")],
        "demo_file string, tick long, shooterSteamID string, weapon string",
    )
    bomb = spark.createDataFrame(
        [("d1.dem", 210, "plant", "A", "s1"), ("d1.dem", 220, "pickup", None, "s1"), ("d2.dem", 30, "bomb_exploded", None, None)],
        "demo_file string, tick long, event string, bombsite string, steamID string",
    )
    grenades = spark.createDataFrame(
        [("d1.dem", 1, 5, "HEProjectile", "s1", 1.0, 1.0, 1.0, 4), ("d1.dem", 1, 3, "HEProjectile", "s1", 2.0, 1.0, 1.0, 4), ("d1.dem", 1, 5, "HE", "s1", 1.0, 1.0, 1.0, 5)],
        "demo_file string, round_num int, tick int, grenade_type string, thrower_steamid string, X double, Y double, Z double, entity_id int",
    )
    kills = spark.createDataFrame(
        [("d1.dem", 1, 20, "ct", True, "9")], "demo_file string, round_num int, tick int, attacker_side string, is_headshot boolean, killer_X string"
    )
    return {"rounds": rounds, "ticks": ticks, "shots": shots, "bomb": bomb, "grenades": grenades, "kills": kills}, header


def test_ingest(match, rows):
    tables = ing.ingest(*match)
    assert set(tables) == {
        "header", "rounds", "round_loadouts", "kills_slim", "shots_slim", "events_shots", "bomb", "events_bomb", "grenades_summary", "events_grenades",
    }
    load = {(r.demo_file, r["round"], r.steamid): r for r in tables["round_loadouts"].collect()}
    assert set(load) == {("d1.dem", 1, "s1"), ("d1.dem", 2, "s1")}
    first = load["d1.dem", 1, "s1"]
    assert (first.name, first.health, first.armor, first.has_helmet, first.inventory_json, first.team) == ("x", 90, 50, 1, '["AWP"]', "CT")
    assert first.row_id == _hash("d1.dem", 1, "s1") and first.map_name == "m1"
    assert load["d1.dem", 2, "s1"].inventory_json == "[]"

    shots = {(r.demo_file, r.shooterSteamID): r for r in tables["events_shots"].collect()}
    assert set(shots) == {("d1.dem", "s1"), ("d1.dem", "s2"), ("d2.dem", "s1")}
    assert shots["d1.dem", "s1"].t_sec == 1.0 and shots["d2.dem", "s1"].t_sec == 0.25
    assert shots["d1.dem", "s1"].event_id == _hash("d1.dem", 1, 64, "s1", "ak")
    assert tables["shots_slim"].count() == 4  # the shot past the end of round 1 is dropped

    bomb = {r.event: r for r in tables["events_bomb"].collect()}
    assert set(bomb) == {"planted", "explode"}
    assert bomb["planted"].event_id == _hash("d1.dem", 2, 210, "A", "s1", "", "planted")
    assert (bomb["planted"].t_round, bomb["planted"].site) == (10.0, "A")

    thrown = tables["events_grenades"].collect()
    assert len(thrown) == 1 and thrown[0].tick == 3 and thrown[0].event_id == _hash("d1.dem", 4, 1, 3, "HEProjectile", "s1")
    kill = tables["kills_slim"].first()
    assert (kill.killerSide, kill.headshot, kill.map_name) == ("ct", 1, "m1")
    assert list(ing.ingest(*match, tables=["rounds", "chat"])) == ["rounds"]
    with pytest.raises(ValueError):
        ing.ingest({"kills": match[0]["kills"]}, match[1])


def test_match_folders_to_warehouse(spark, match, rows, tmp_path):
    bundle, header = match
    matches, root = str(tmp_path / "matches"), str(tmp_path / "warehouse")
    for name in ("m1", "m2"):
        manifest = {r["table"]: r["rows"] for r in ing.write(bundle, header, f"{matches}/{name}", batch="b").collect()}
        assert manifest["events_shots"] == 3 and manifest["bomb"] == manifest["events_bomb"] == 2 and manifest["rounds"] == 3
    ing.write(bundle, header, f"{matches}/m2", ["rounds"], batch="b")  # a repeated batch replaces itself
    assert "events_shots" in warehouse.build(spark, matches, root)
    found = {t: warehouse.read_table(spark, root, t).count() for t in WAREHOUSE}
    # Equal file names give equal event ids, so the second match adds none; loadouts are unique per match.
    assert found == {
        "rounds": 6, "kills_slim": 2, "events_shots": 3, "events_grenades": 1, "events_bomb": 2, "grenades_summary": 2, "header": 4, "round_loadouts": 4,
    }
    straight = str(tmp_path / "straight")
    named = {n: df.withColumn("match_id", F.lit("m1")) for n, df in bundle.items()}
    for _ in range(2):
        ing.load(named, header.withColumn("match_id", F.lit("m1")), straight, batch="b")
    for t in WAREHOUSE:
        one = warehouse.read_table(spark, root, t).filter("match_id = 'm1'")
        assert rows(warehouse.read_table(spark, straight, t)) == rows(one), t


def test_inspector(spark, match):
    ticks = match[0]["ticks"].withColumnsRenamed({"steamID": "steamid"}).withColumn("team_num", F.when(F.col("side") == "ct", 3).when(F.col("side") == "t", 2).otherwise(1))
    out = ing.inspector(ticks, match[0]["rounds"], ["demo_file"]).collect()
    assert [(r.demo_file, r.round_num, r.side, r.name, r.inventory) for r in out] == [("d1.dem", 1, "CT", "x", ["AWP"])]
    with pytest.raises(ValueError):
        ing.inspector(ticks.drop("inventory"), match[0]["rounds"])
