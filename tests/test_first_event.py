"""First kills, ties, answers and the curve."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from roundscope.operators.first_event import first_counts, first_with_ties, next_opposite, response_curve
from roundscope.plans import analysis as an

KILLS = [
    (1, 10, "ct"), (1, 10, "t"), (1, 12, "t"), (1, 15, "ct"),  # tie of both sides
    (2, 5, None), (2, 6, "t"), (2, 9, "ct"),  # first side unknown
    (3, 7, "t"), (3, 8, None),  # unknown side answers
    (4, 3, "ct"), (4, 4, "ct"),  # no answer
    (5, 2, "ct"), (5, 2, "ct"), (5, 9, "t"),  # tie of one side
    (None, 1, "ct"),
]
SCHEMA = "round int, tick long, side string"


def test_ties_all_stay(spark, rows):
    df = spark.createDataFrame(KILLS, SCHEMA)
    first = rows(first_with_ties(df, ["round"], "tick"))
    assert [r for r in first if r[0] in (1, 5)] == [(1, 10, "ct"), (1, 10, "t"), (5, 2, "ct"), (5, 2, "ct")]
    counted = {r["round"]: (r.n_ct, r.n_t, r.n_other) for r in first_counts(df, ["round"], "tick", "side", ["ct", "t"]).collect()}
    assert counted[1] == (1, 1, 0) and counted[5] == (2, 0, 0) and counted[2] == (0, 0, 1)


def test_next_opposite(spark, rows):
    out = next_opposite(spark.createDataFrame(KILLS, SCHEMA), ["round"], "tick", "side")
    assert rows(out, "round", "t0", "side0", "t1") == [
        (1, 10, "ct", 12), (2, 5, "t", 9), (3, 7, "t", 8), (4, 3, "ct", None), (5, 2, "ct", 9),
    ]


def test_next_opposite_brute_force(spark):
    rng = random.Random(3)
    kills = [(rng.randrange(40), rng.randrange(12), rng.choice(["ct", "t", None])) for _ in range(400)]
    expected = {}
    for r in {k[0] for k in kills}:
        mine = [k for k in kills if k[0] == r]
        t0 = min(k[1] for k in mine)
        sides = sorted((k[1], k[2]) for k in mine if k[2] is not None)
        side0 = sides[0][1] if sides else None
        later = [k[1] for k in mine if k[1] > t0 and (k[2] is None or side0 is None or k[2] != side0)]
        expected[r] = (t0, side0, min(later) if later else None)
    out = next_opposite(spark.createDataFrame(kills, SCHEMA), ["round"], "tick", "side")
    assert {r["round"]: (r.t0, r.side0, r.t1) for r in out.collect()} == expected


def test_curve_counts_unanswered_rounds(spark, rows):
    delays = spark.createDataFrame([(0.0,), (1.0,), (1.01,), (12.0,), (12.5,), (None,)], "dt double")
    curve = rows(response_curve(delays, "dt"), "T", "n_within", "ret_rate")
    assert curve[0] == (1, 2, 2 / 6) and curve[1] == (2, 3, 3 / 6) and curve[11] == (12, 4, 4 / 6)
    assert all(a[1] <= b[1] for a, b in zip(curve, curve[1:])) and len(curve) == 12
    assert [r[0] for r in rows(response_curve(delays, "dt", points=[1, 5]), "T")] == [1, 5]


def _frames(spark):
    rounds = spark.createDataFrame(
        [("m", "d", 1, "CT"), ("m", "d", 1, "CT"), ("m", "d", 2, "t"), ("m", "d", 3, "ct"), ("m", "d", 4, None)],
        "match_id string, demo_file string, round int, winner string",
    )
    kills = spark.createDataFrame(
        [
            ("m", "d", 1, 10, "CT"), ("m", "d", 1, 10, "t"), ("m", "d", 2, 4, "T"), ("m", "d", 3, 1, None),
            ("m", "d", 4, 1, "ct"), ("m", None, 2, 1, "ct"),
        ],
        "match_id string, demo_file string, round int, tick long, killerSide string",
    )
    return rounds, kills


def test_opening_cells_fold_case_and_collapse_repeated_rounds(spark):
    rounds, kills = _frames(spark)
    r = an.opening_cells(rounds, kills).first()
    assert (r.a, r.b, r.c, r.d) == (1, 1, 0, 1)
    raw = an.opening_cells(rounds, kills, fold_case=False).first()
    assert (raw.a, raw.b, raw.c, raw.d) == (0, 0, 0, 0)


def test_timing_and_trade(spark):
    kills = spark.createDataFrame(
        [("m", "d", 1, 128, "ct"), ("m", "d", 1, 256, "t"), ("m", "d", 2, 64, "t")],
        "match_id string, demo_file string, round int, tick long, killerSide string",
    )
    rounds = spark.createDataFrame([("m", "d", 1, 0), ("m", "d", 2, 0)], "match_id string, demo_file string, round int, start long")
    header = spark.createDataFrame([("m", "d", "128")], "match_id string, demo_file string, tickrate string")
    none = header.withColumn("tickrate", F.lit("bad"))
    seconds = {r["round"]: r.sec for r in an.opening_seconds(rounds, kills, header).collect()}
    assert seconds == {1: 1.0, 2: 0.5}
    assert {r["round"]: r.sec for r in an.opening_seconds(rounds, kills, none).collect()} == {1: 2.0, 2: 1.0}
    assert {r["round"]: r.dt_s for r in an.trade_delays(kills, header).collect()} == {1: 1.0, 2: None}
