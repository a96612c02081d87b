"""Events to intervals: the edge rules, brute force, and the plan."""

from __future__ import annotations

import random

import pytest

from roundscope.operators.asof import asof_backward, attach_round, measure, relative_time

ROUNDS = [("m", 1, 100, 200), ("m", 2, 300, None), ("m", 9, 300, None), ("m", 3, 500, 600), ("n", 1, 50, None)]


@pytest.fixture
def rounds(spark):
    return spark.createDataFrame(ROUNDS, "match string, round int, start long, end long")


@pytest.mark.parametrize("limit", [128, 2])
def test_edges(spark, rows, rounds, limit):
    events = [
        ("m", 1, "50"),  # before the first start: kept without a round
        ("m", 2, "100"),  # at a start
        ("m", 3, "200"),  # at an end
        ("m", 4, "201"),  # past an end: dropped
        ("m", 5, "450"),  # open end, repeated start: the least round
        ("m", 6, None),  # no time: dropped
        ("m", 7, "x"),  # no number: dropped
        ("m", 8, "601"),
        ("n", 9, "50"),
        ("o", 10, "70"),  # no intervals at all
    ]
    df = spark.createDataFrame(events, "match string, id int, tick string")
    out = asof_backward(df, rounds, ["match"], "tick", "start", "end", array_limit=limit)
    assert rows(out, "id", "round") == [(1, None), (2, 1), (3, 1), (5, 2), (9, 1), (10, None)]
    assert out.columns == ["match", "id", "tick", "round"]


def test_events_with_a_round_pass(spark, rounds):
    df = spark.createDataFrame([("m", 7, 100)], "match string, round int, tick long")
    assert attach_round(df, rounds, ["match"]) is df
    other = df.drop("round").withColumnRenamed("tick", "time")
    assert attach_round(other, rounds, ["match"]) is other
    assert attach_round(df.drop("round"), rounds.drop("start"), ["match"]).columns == ["match", "tick"]


@pytest.mark.parametrize("limit", [2, 3, 128])
def test_against_brute_force(spark, limit):
    """A key with a third of all rows and many intervals, searched in blocks of blocks."""
    rng = random.Random(7)
    spans, events = {}, []
    for key in range(6):
        n = 60 if key == 0 else rng.randint(0, 8)
        spans[key] = sorted(rng.sample(range(0, 2000), n))
    intervals = [
        (k, i, s, s + rng.randint(0, 60) if rng.random() < 0.7 else None) for k, starts in spans.items() for i, s in enumerate(starts)
    ]
    for i in range(1500):
        events.append((0 if rng.random() < 0.4 else rng.randrange(6), i, rng.randint(-50, 2100)))
    expected = set()
    for key, i, t in events:
        before = [x for x in intervals if x[0] == key and x[2] <= t]
        hit = max(before, key=lambda x: x[2]) if before else None
        if hit is None or hit[3] is None or t <= hit[3]:
            expected.add((i, hit[1] if hit else None))
    out = asof_backward(
        spark.createDataFrame(events, "k int, id int, t long"),
        spark.createDataFrame(intervals, "k int, round int, s long, e long"),
        ["k"], "t", "s", "e", array_limit=limit,
    )
    assert {(r.id, r.round) for r in out.collect()} == expected


def test_plan_has_no_pairing_join(spark, rounds, capsys):
    events = spark.createDataFrame([("m", 1, 100)], "match string, id int, tick long")
    asof_backward(events, rounds, ["match"], "tick", "start", "end", array_limit=2).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_measure(rounds):
    assert measure(rounds, ["match"], "start")[:3] == (5, 4, 2)


def test_relative_time(spark, rows, rounds):
    events = spark.createDataFrame([("m", 1, 164), ("m", None, 10)], "match string, round int, tick long")
    once = rounds.filter("round <> 9")
    out = relative_time(events, once, ["match", "round"], tickrate=64)
    assert rows(out, "t_round", "t_sec") == [(None, None), (64.0, 1.0)]
