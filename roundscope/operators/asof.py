"""Assign events to intervals by the last interval that starts at or before them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import number, whole
from ..session import broadcast_within, row_bytes, stored
from .distribution import prefix_counts

# Intervals searched in one array; a key with more gets arrays of arrays.
ARRAY_LIMIT = 1024


class IntervalSize(NamedTuple):
    """All rows of an interval table, those of its busiest key that have a start, its keys, and about its bytes."""

    rows: int
    busiest: int
    keys: int
    bytes: int


def measure(intervals: DataFrame, by: Sequence[str], start: str, columns: Sequence[str] = ()) -> IntervalSize:
    """Count an interval table: one row comes to the driver and decides how it is searched.

    Rows without a start count too, as they are joined to events that have a round. The bytes are those of the key, the
    start and the further ``columns``.
    """
    width = row_bytes(intervals, [*by, start, *columns])
    per_key = intervals.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(start).isNotNull()).alias("starts"), F.sum(width).alias("bytes")
    )
    top = per_key.agg(
        F.sum("n").alias("rows"), F.max("starts").alias("busiest"), F.count(F.lit(1)).alias("keys"), F.sum("bytes").alias("bytes")
    ).first()
    return IntervalSize(top["rows"] or 0, top["busiest"] or 0, top["keys"], top["bytes"] or 0)


def asof_backward(
    events: DataFrame,
    intervals: DataFrame,
    by: Sequence[str],
    event_time: str,
    start: str,
    end: str | None = None,
    payload: Sequence[str] = ("round",),
    size: IntervalSize | None = None,
    array_limit: int = ARRAY_LIMIT,
) -> DataFrame:
    """Events with the payload of the interval they fall in.

    An event at the start belongs to the interval; one past a known end is dropped; one before
    the first start keeps a NULL payload; one without a time is dropped. Of intervals with the
    same start the one with the least payload counts. ``size`` is the result of ``measure`` where
    the caller has it already.

    Events are only ever joined to a side with one row per join key, so the join never multiplies
    rows, and Spark may broadcast that side or split a key with very many events.
    """
    if array_limit < 2:
        raise ValueError("a block holds at least two intervals")
    by, payload = list(by), list(payload)
    size = size or measure(intervals, by, start, [*payload, *([end] if end else [])])
    bounds = [F.col(start).alias("_from"), *payload, (F.col(end) if end else F.lit(None)).alias("_to")]
    spans = (
        intervals.select(*by, *bounds)
        .withColumns({"_from": whole("_from"), "_to": whole("_to")})
        .dropna(subset=["_from", *by])
        .groupBy(*by, "_from")
        .agg(F.min(F.struct(*payload, "_to")).alias("_hit"))
        .select(*by, "_from", F.struct("_from", "_hit.*").alias("_hit"))
    )
    timed = events.withColumn("_time", whole(event_time)).filter(F.col("_time").isNotNull())
    matched = _last_started(timed, spans, by, size, array_limit, ["_from", *payload, "_to"])
    inside = F.coalesce(F.col("_to") >= F.col("_time"), F.lit(True))
    return matched.filter(inside).select(*events.columns, *payload)


def _last_started(
    timed: DataFrame, spans: DataFrame, by: list[str], size: IntervalSize, limit: int, fields: list[str], level: int = 0
) -> DataFrame:
    """Add the fields of the last span with ``_from`` at or before ``_time``.

    The spans of a key are cut into blocks of ``limit``. If a key has several blocks, the block of an
    event is found first, by the same search among the starts of the blocks.
    """
    keys = by
    if size.busiest > limit:
        block = f"_block{level}"
        ranked = prefix_counts(stored(spans.withColumn("_one", F.lit(1))), "_from", by, ["_one"])
        spans = ranked.withColumn(block, F.floor(F.col("_one_below") / limit)).select(*by, block, "_from", "_hit")
        blocks = spans.groupBy(*by, block).agg(F.min("_from").alias("_from"))
        blocks = blocks.select(*by, "_from", F.struct("_from", block).alias("_hit"))
        # A key's last block need not be full.
        fewer = IntervalSize(size.rows // limit + size.keys, -(-size.busiest // limit), size.keys, size.bytes)
        timed = _last_started(timed, blocks, by, fewer, limit, ["_from", block], level + 1).drop("_from")
        keys = [*by, block]
    arrays = spans.groupBy(*keys).agg(F.array_sort(F.collect_list("_hit")).alias("_spans"))
    arrays = arrays.withColumn("_starts", F.col("_spans._from"))
    found = timed.join(broadcast_within(arrays, size), keys, "left")
    # Halving steps over the sorted array: the count of spans known to start in time grows by a step
    # where the span it would reach does; past the end of the array the comparison is NULL.
    steps = F.array(*[F.lit(2**k) for k in reversed(range(min(size.busiest, limit).bit_length()))])
    count = F.aggregate(
        steps.cast("array<int>"),
        F.lit(0),
        lambda n, step: F.when(F.get("_starts", n + step - 1) <= F.col("_time"), n + step).otherwise(n),
    )
    # A generator keeps later filters from repeating the search.
    kept = [F.col(c) for c in timed.columns if c not in keys[len(by):]]
    return found.select(*kept, F.inline(F.array(F.get("_spans", count - 1)))).select(*kept, *fields)


def attach_round(
    events: DataFrame, rounds: DataFrame, by: Sequence[str], tick: str = "tick", size: IntervalSize | None = None
) -> DataFrame:
    """Give events their round by tick; unchanged when they have one or a needed column is absent."""
    if "round" in events.columns or tick not in events.columns or "start" not in rounds.columns:
        return events
    end = "end" if "end" in rounds.columns else None
    return asof_backward(events, rounds, by, tick, "start", end, ("round",), size)


def relative_time(
    events: DataFrame,
    rounds: DataFrame,
    by: Sequence[str],
    tick: str = "tick",
    start: str = "start",
    tickrate="tickrate",
    size: IntervalSize | None = None,
) -> DataFrame:
    """Add t_round (ticks since the round began) and t_sec; NULL for events without a round.

    ``rounds`` holds one row per ``by``; ``size`` tells whether it may be broadcast.
    """
    begin = rounds.select(*by, F.col(start).alias("_start"))
    if size:
        begin = broadcast_within(begin, size)
    rate = F.col(tickrate) if isinstance(tickrate, str) else F.lit(float(tickrate))
    return (
        events.join(begin, list(by), "left")
        .withColumn("t_round", number(tick) - number("_start"))
        .withColumn("t_sec", F.try_divide(F.col("t_round"), rate))
        .drop("_start")
    )
