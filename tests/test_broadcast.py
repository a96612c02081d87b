"""Sides are broadcast only while their counted rows and bytes are small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roundscope import session
from roundscope.operators.asof import asof_backward, measure, relative_time
from roundscope.operators.snapshots import snapshot_after
from roundscope.session import Size, broadcast_within, fits, measured
from roundscope.sources.warehouse import new_rows


@pytest.fixture
def no_own_broadcast(spark):
    """Only marked sides are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bytes_follow_the_content(spark):
    narrow = spark.createDataFrame([(1, 2.0), (2, None)], "a int, b double")
    assert measured(narrow) == Size(2, 2 * (64 + 32))
    texts = spark.createDataFrame([("x" * 1000, [1] * 500), (None, None)], "a string, b array<int>")
    size = measured(texts)
    assert size.rows == 2 and size.bytes >= 1000 + 8 * 2 * 500
    assert measured(texts.select("a")).bytes == 2 * 80 + 1000
    assert measured(texts.limit(0)) == Size(0, 0)
    odd = spark.createDataFrame([("k", b"\x00\xff", {"m": 1}, (1, "t"))], "`a.b` string, c binary, d map<string,int>, e struct<f:int,g:string>")
    assert measured(odd).bytes > 64 + 4 * 16 + 3


def test_limits(spark, monkeypatch):
    assert fits(session.BROADCAST_ROWS) and not fits(session.BROADCAST_ROWS + 1)
    assert fits(Size(10, session.BROADCAST_BYTES)) and not fits(Size(10, session.BROADCAST_BYTES + 1))
    assert not fits(Size(session.BROADCAST_ROWS + 1, 0)) and fits(Size(5, 5), limit=5) and not fits(Size(6, 5), limit=5)


def test_rows_without_a_start_count(spark):
    rounds = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, 9), ("b", 1, None)], "m string, round int, start int")
    size = measure(rounds, ["m"], "start", ["round", "no such column"])
    assert size[:3] == (4, 2, 2)
    assert size.bytes == 4 * (64 + 3 * 16 + 1)
    assert measure(rounds.limit(0), ["m"], "start") == (0, 0, 0, 0)


def test_a_wide_side_is_not_broadcast(spark, monkeypatch, no_own_broadcast, rows):
    rounds = spark.createDataFrame([("a" * 100, r, 10 * r, 10 * r + 9) for r in range(5)], "m string, round int, start int, end int")
    events = spark.createDataFrame([("a" * 100, t) for t in (-1, 0, 12, 49, 50)], "m string, tick int")
    ticks = events.withColumn("round", F.floor(F.col("tick") / 10).cast("int"))
    size = measure(rounds, ["m"], "start", ["round", "end"])
    assert size.bytes == 5 * (64 + 4 * 16 + 100)

    def frames():
        return [
            asof_backward(events, rounds, ["m"], "tick", "start", "end"),
            relative_time(ticks, rounds, ["m", "round"], tickrate=64, size=size),
            snapshot_after(ticks, rounds, ["m", "round"], "tick", "start", size=size),
        ]

    small = frames()
    assert all("BroadcastHashJoin" in plan(df) for df in small)
    expected = [rows(df) for df in small]
    monkeypatch.setattr(session, "BROADCAST_BYTES", size.bytes - 1)
    wide = frames()
    assert all("BroadcastHashJoin" not in plan(df) and "hashpartitioning" in plan(df) for df in wide)
    assert [rows(df) for df in wide] == expected


def test_blocks_of_many_short_keys_are_counted(spark, rows):
    # One key with several blocks beside many keys with one: each of them has a block of its own.
    starts = [("hot", 2 * i) for i in range(9)] + [(f"k{i}", i) for i in range(20)]
    rounds = spark.createDataFrame([(m, s, i) for i, (m, s) in enumerate(starts)], "m string, start int, round int")
    events = spark.createDataFrame([(m, s + 1) for m, s in starts], "m string, tick int")
    found = asof_backward(events, rounds, ["m"], "tick", "start", array_limit=2)
    assert rows(found) == sorted((m, s + 1, i) for i, (m, s) in enumerate(starts))


def test_new_rows_with_long_keys(spark, monkeypatch, no_own_broadcast, rows):
    target = spark.createDataFrame([("k" * 50, 1), ("l" * 50, 2)], "k string, v int")
    source = spark.createDataFrame([("k" * 50, 3), ("m" * 50, 4), (None, 5)], "k string, v int")
    size = measured(source.select("k"))
    small = new_rows(target, source, ["k"], source_rows=size)
    assert "BroadcastHashJoin" in plan(small)
    monkeypatch.setattr(session, "BROADCAST_BYTES", size.bytes - 1)
    wide = new_rows(target, source, ["k"], source_rows=size)
    assert "BroadcastHashJoin" not in plan(wide)
    assert rows(small) == rows(wide) == [(None, 5), ("m" * 50, 4)]


def test_marking_changes_no_rows(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(broadcast_within(df, Size(2, 10))) == rows(broadcast_within(df, session.BROADCAST_ROWS + 1)) == [(1,), (2,)]
