"""Inventories, team equipment and its use in the tests."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roundscope.functions import items as it
from roundscope.operators import loadout as lo
from roundscope.plans import analysis as an


def test_inventory_json(spark):
    cases = {
        '["AK-47", "Knife"]': '["AK-47", "Knife"]',
        ' ["a"] ': '["a"]',
        '["a", ': '[" "]',
        "[broken]": "[]",
        " AWP ": '[" AWP "]',
        "": '[""]',
        None: "[]",
        "[]": "[]",
    }
    cases['["a", '] = '["[\\"a\\", "]'  # no closing bracket: bare text
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    found = {r.v: r.j for r in df.select("v", it.inventory_json("v").alias("j")).collect()}
    assert found == cases
    arrays = spark.createDataFrame([(["AWP", 'a"b'],), ([],), (None,)], "v array<string>")
    assert [r.j for r in arrays.select(it.inventory_json("v", is_array=True).alias("j")).collect()] == ['["AWP", "a\\"b"]', "[]", "[]"]


def test_items(spark):
    cases = {'["AK-47", null, "AWP"]': ["ak-47", None, "awp"], "[broken": [], "AWP": [], "[oops]": [], None: [], "[]": []}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.i for r in df.select("v", it.items("v").alias("i")).collect()} == cases


def test_categories_match_by_substring(spark):
    inventory = '["M4A1-S", "Snakebite Kit", "Glock-18", "AWP", "USP-S", "Dual Berettas"]'
    listed = it.items("v")
    r = spark.createDataFrame([(inventory,)], "v string").select(
        it.any_of(it.AWP, listed).alias("awp"),
        it.count_of(it.RIFLES, listed).alias("rifles"),
        it.count_of(it.PISTOLS, listed).alias("pistols"),
        it.count_of(it.HEAVY, listed).alias("heavy"),
    ).first()
    assert tuple(r) == (True, 2, 3, 0)  # "Snakebite" holds "ak"


def test_counting_in_the_text_equals_parsing(spark):
    texts = [
        '["AK-47", "Knife", "ak ak"]', '["AK-47","MP9"]', ' [ "ak" , "x" ] ', '["a\\"k", "ak"]', '["\\u0041K"]', "[]", "ak", '["ak", 3]',
        '["ak" "b"]', '["ak",]', '["a,ak", ", ak"]', '["ak\nx"]', '[["ak"]]', "", None, '["É", "BREAK"]', '["ak"', '[""]', '["x"]["ak"]',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for tokens in (["ak"], ["ak", "mp9"], ["x", "é"], [], [","], ["-"]):
        both = df.select(
            "v", it.count_of(tokens, it.items("v")).alias("a"), it.count_in(tokens, "v", it.is_plain("v"), F.lower("v")).alias("b")
        )
        found = both.collect()
        assert [(r.v, r.a) for r in found] == [(r.v, r.b) for r in found], tokens
        flags = df.select(
            it.any_of(tokens, it.items("v")).cast("int").alias("a"),
            it.count_in(tokens, "v", it.is_plain("v"), F.lower("v"), present=True).alias("b"),
        ).collect()
        assert [r.a for r in flags] == [r.b for r in flags], tokens


PLAYERS = [
    ("m", "d", 1, "CT", 1, '["AWP", "Knife"]'), ("m", "d", 1, "CT", None, '["AK-47", "AWP"]'), ("m", "d", 1, "T", 0, '["Glock-18"]'),
    ("m", "d", 2, "CT", 1, '["MP9"]'), ("m", "d", 2, "T", 1, '["Nova"]'), ("m", "d", 3, "T", 1, "[]"), ("m", "d", 4, "SPEC", 1, '["AWP"]'),
]
K3 = "match_id string, demo_file string, round int, "


@pytest.fixture
def teams(spark):
    return an.team_loadouts(spark.createDataFrame(PLAYERS, K3 + "team string, has_helmet int, inventory_json string"))


def test_team_loadout(teams):
    found = {(r["round"], r.team): r for r in teams.collect()}
    ct = found[1, "CT"]
    assert (ct.awp, ct.rifles, ct.pistols, ct.helmets, ct.players, ct.helmet_share) == (1, 1, 0, 1.0, 2, 0.5)
    assert ct.score == 6 + 3 + 0.75
    assert found[2, "CT"].score == found[2, "T"].score == 1.5 + 0.75
    assert (4, "SPEC") not in found


@pytest.fixture
def games(spark):
    rounds = spark.createDataFrame(
        [("m", "d", 1, "CT"), ("m", "d", 2, "t"), ("m", "d", 3, "t"), ("m", "d", 4, "ct"), ("m", "d", 5, "ct")], K3 + "winner string"
    )
    kills = spark.createDataFrame(
        [
            ("m", "d", 1, 9, "ct"), ("m", "d", 1, 9, "ct"), ("m", "d", 2, 3, "t"), ("m", "d", 3, 1, "t"), ("m", "d", 4, 1, "ct"),
            ("m", "d", 5, 1, None),
        ],
        K3 + "tick long, killerSide string",
    )
    return rounds, kills


def test_missing_loadout_policies(games, teams):
    rounds, kills = games
    counted = an.category_conversion(rounds, kills, teams).first()
    # Round 1 twice (tie), 2 and 3 without, 4 has no loadout, 5 has no known side.
    assert (counted.a, counted.b, counted.c, counted.d) == (3, 1, 2, 0)
    dropped = an.category_conversion(rounds, kills, teams, null_flag="drop").first()
    assert (dropped.a, dropped.b, dropped.c, dropped.d) == (2, 0, 2, 0)


def test_category_opening(games, teams):
    r = an.category_opening(*games, teams).first()
    # Round 1 counts twice for both teams, rounds 2 and 3 once per known team.
    assert (r.a, r.b, r.c, r.d) == (2, 0, 2, 3)


def test_underdogs_leave_out_even_and_unknown(games, teams):
    r = an.underdog_conversion(*games, teams).first()
    assert (r.a, r.b, r.c, r.d) == (0, 0, 2, 0)  # only round 1 has two different scores
    assert r.favorite_n == 2 and r.underdog_rate is None


def test_pairing(spark, teams):
    first = spark.createDataFrame([("m", "d", 1, "t"), ("m", "d", 3, "t"), ("m", "d", 1, None)], K3 + "side string")
    out = {(r["round"], r.side): r for r in lo.pair_sides(first, teams, ["match_id", "demo_file", "round"], "side", ["score"]).collect()}
    assert out[1, "t"].d_score == 0.5 - 9.75
    assert (out[3, "t"].score_open, out[3, "t"].score_other, out[3, "t"].d_score) == (0.75, None, None)
    assert out[1, None].score_open is None


def test_strength(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,)], "d double").select(lo.strength(F.col("d")).alias("s"))
    assert [r.s for r in df.collect()] == ["underdog", "even", "favorite", None]


def test_flag_test_matches_missing_keys_and_fans_out(spark):
    kills = spark.createDataFrame([("a", "1"), ("a", "x"), (None, "1"), ("zz", "1")], "k string, headshot string")
    load = spark.createDataFrame([("a", "1"), ("a", "0"), (None, None)], "k string, helmet string")
    r = an.flag_test(kills, load, ["k"], "helmet", "headshot").first()
    assert (r.a, r.b, r.c, r.d) == (1, 2, 1, 1)
    assert r.odds_ratio == pytest.approx(1 * 1 / 2)


def test_explode(spark, rows):
    df = spark.createDataFrame([(1, '["AWP", "Knife"]'), (2, "[]"), (3, "broken"), (4, None)], "id int, inventory_json string")
    assert rows(lo.explode_items(df, "inventory_json", ["id"])) == [(1, "AWP"), (1, "Knife")]
