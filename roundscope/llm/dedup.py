"""Removal of repeated byte strings by suffix arrays, spread over shards.

A byte goes if some string of ``width`` bytes that covers it also starts at another place of the corpus.

1. Every ``width``-byte window is named by the least hash among its 16-byte grams; a section is a run of windows of
   one name. Equal windows have equal names wherever they stand. Grams that are frequent in the corpus come last in
   the order, so a line that many documents share does not gather all that surrounds it.
2. Sections are grouped by name. A name met once holds no repeats and is done. Where all sections of a name are
   copies of each other, all their windows repeat. Only sections that differ from others of their name, or hold
   their name's gram twice, go on, one copy of each. Of these, a section shares no window with a differing one unless
   they agree on half a window before or after the gram that names them: a window that holds the gram has as much on
   one of its sides. Hashes of both sides are counted, and sections alone on both sides go no further; if they hold
   the gram once they repeat wholly or, met once, not at all.
3. Those are dealt to shards by name; each shard sorts its suffixes by external induced sorting (``suffixes``), and
   windows whose common prefix with a neighbour reaches the width repeat.
4. A name whose sections are too many for that, as when many documents hold one passage between different
   surroundings, is dealt by content instead: its windows are hashed whole, and Spark counts the hashes.
5. Repeating windows are joined back to all sections they stand for, and each document is cut.
"""

from __future__ import annotations

import hashlib
import sys
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundscope.llm import suffixes
from roundscope.llm.common import give_back, given_back, text_rows, type_of
from roundscope.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 400
GRAM = 16
#: One gram in so many may name a window in the first place; only these are counted.
ANCHORS = 8
#: A gram is frequent if it is more than this many times, and one in this many of all anchors, in the corpus.
FREQUENT, FREQUENT_SHARE = 256, 1_000_000
#: Bytes of text that are cut into sections in one step, windows of a section, and bytes of sections in a shard.
SLAB = 1 << 20
SECTION = 1024
SHARD_BYTES = 3_000_000
#: A name whose sections hold over one in this many of a shard's bytes is not sorted in one shard.
NAME_SHARE = 4


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for every 16-byte gram of a byte array."""
    n = len(data) - GRAM + 1
    words = np.empty(n + 8, dtype=np.uint64)
    for shift in range(8):
        part = data[shift : shift + (len(data) - shift) // 8 * 8].view("<u8")
        own = words[shift::8]
        own[: len(part)] = part[: len(own)]
    a, b = words[:n], words[8 : n + 8]
    h = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(32)


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of every run of ``size`` neighbours."""
    span, low = 1, values
    while span * 2 <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = size - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def slabs(frame: pd.DataFrame, width: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs of texts to work on together: (row, first byte, bytes) of each part, and the parts' joined bytes.

    A longer text is cut so that every window lies in one part; texts below the width have no window.
    """
    parts, data, size = [], [], 0
    for row, text in enumerate(frame["text"]):
        raw = text.encode()
        for a in range(0, max(0, len(raw) - width + 1), SLAB):
            piece = raw[a : a + SLAB + width - 1]
            if size + len(piece) > SLAB and parts:
                yield parts, b"".join(data)
                parts, data, size = [], [], 0
            parts.append((row, a, len(piece)))
            data.append(piece)
            size += len(piece)
    if parts:
        yield parts, b"".join(data)


def frequent_grams(rows: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the grams that are frequent in the corpus.

    Tasks count the anchors they read and hand on those met four times or more; their sums decide. The result is
    bounded: no more grams than ``FREQUENT_SHARE`` can each have that share. It only steers how windows are named.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values, counts, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        for frame in given_back(batches):
            for _, data in slabs(frame, width):
                h = gram_hashes(np.frombuffer(data, dtype=np.uint8))
                v, n = np.unique(h[h % np.uint64(ANCHORS) == 0], return_counts=True)
                total += int(n.sum())
                values, at = np.unique(np.r_[values, v], return_inverse=True)
                counts = np.bincount(at, np.r_[counts, n], len(values)).astype(np.int64)
                if len(values) > 1_000_000:  # the rare ones start anew
                    values, counts = values[counts > 1], counts[counts > 1]
        kept = counts >= 4
        yield pd.DataFrame({"gram": np.r_[values[kept].view(np.int64), np.int64(0)], "n": np.r_[counts[kept], 0], "total": np.r_[np.zeros(kept.sum(), np.int64), total]})

    counted = stored(rows.mapInPandas(step, "gram long, n long, total long"))
    total = counted.agg(F.sum("total")).first()[0] or 0
    least = max(FREQUENT, total // FREQUENT_SHARE)
    found = counted.where("n > 0").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("gram").toPandas()
    return np.sort(found["gram"].to_numpy(dtype=np.int64).view(np.uint64))


def _side(data: bytes) -> int:
    """A hash of one side of a gram, never 0."""
    return xxhash.xxh3_64_intdigest(data) & 0x7FFFFFFF | 1


def sections(rows: DataFrame, frequent: np.ndarray, width: int = WIDTH) -> DataFrame:
    """(text_key, start, n, name, c1, c2, inner, before, after): sections of n windows from byte ``start``, and their
    content's hash.

    ``inner`` marks sections that hold their name's gram twice: only these can repeat a window within themselves.
    ``before`` and ``after`` are hashes of the gram with half a window's other bytes on that side, 0 where the section
    has not as many; of a gram that is held twice, the first counts.
    """
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    grams = width - GRAM + 1
    half = grams // 2

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for frame in given_back(batches):
            keys = frame["text_key"].to_numpy()
            for parts, data in slabs(frame, width):
                raw = np.frombuffer(data, dtype=np.uint8)
                h = gram_hashes(raw)
                anchor = h % np.uint64(ANCHORS) == 0
                rank = np.where(anchor, np.uint64(0), np.uint64(1))
                if len(known):
                    at = np.flatnonzero(anchor)
                    place = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
                    rank[at[known[place] == h[at]]] = 2
                value = h >> np.uint64(2) | rank << np.uint64(62)
                name = window_minima(value, grams)
                lengths = np.array([n for _, _, n in parts])
                begins = np.cumsum(np.r_[0, lengths])[:-1]
                inside = np.zeros(len(name) + 1, dtype=np.int8)
                np.add.at(inside, begins, 1)
                np.add.at(inside, np.minimum(begins + lengths - width + 1, len(name)), -1)
                inside = np.cumsum(inside[:-1]) > 0
                first = np.r_[True, name[1:] != name[:-1]]
                first[begins] = True
                first &= inside
                starts = np.flatnonzero(first)
                part = np.searchsorted(begins, starts, side="right") - 1
                ends = np.minimum(np.r_[starts[1:], len(name)], (begins + lengths - width + 1)[part])
                # Long runs of one name are cut.
                pieces = -(-(ends - starts) // SECTION)
                step_in = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                ends = np.minimum(np.repeat(ends, pieces), np.repeat(starts, pieces) + (step_in + 1) * SECTION)
                starts, part = np.repeat(starts, pieces) + step_in * SECTION, np.repeat(part, pieces)
                names = name[starts]
                content = [xxhash.xxh3_128_digest(data[a : b + width - 1]) for a, b in zip(starts.tolist(), ends.tolist())]
                content = np.frombuffer(b"".join(content), dtype="<i8").reshape(-1, 2)
                inner, before, after = [], [], []
                for a, b, x in zip(starts.tolist(), ends.tolist(), names):
                    held = (value[a : b + grams - 1] == x).nonzero()[0]
                    at = a + int(held[0])
                    inner.append(len(held) > 1)
                    before.append(_side(data[at - half : at + GRAM]) if at - half >= a else 0)
                    after.append(_side(data[at : at + GRAM + half]) if at + GRAM + half <= b + width - 1 else 0)
                row = np.array([r for r, _, _ in parts])[part]
                offset = np.array([a for _, a, _ in parts])[part] - begins[part]
                yield pd.DataFrame(
                    {
                        "text_key": keys[row],
                        "start": starts + offset,
                        "n": (ends - starts).astype(np.int32),
                        "name": names.view(np.int64),
                        "c1": content[:, 0],
                        "c2": content[:, 1],
                        "inner": inner,
                        "before": np.array(before, dtype=np.int32),
                        "after": np.array(after, dtype=np.int32),
                    }
                )

    schema = "text_key binary, start long, n int, name long, c1 long, c2 long, inner boolean, before int, after int"
    return stored(rows.mapInPandas(step, schema))


def _runs(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[np.int8(0), hits.astype(np.int8), np.int8(0)]))
    return edges[::2], edges[1::2] - edges[::2]


RUNS = "name long, c1 long, c2 long, run int, run_n int"


def _run_frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=["name", "c1", "c2", "run", "run_n"]).astype({"name": "int64", "c1": "int64", "c2": "int64", "run": "int32", "run_n": "int32"})


def _sort_shard(width: int, memory: int):
    def step(frame: pd.DataFrame) -> pd.DataFrame:
        give_back()
        out = []
        # Scratch of this task alone, removed with it: queue files never outlive or leave the task.
        with tempfile.TemporaryDirectory() as folder:
            hits = suffixes.repeated_starts([bytes(x) for x in frame["data"]], width, folder, memory)
        for name, c1, c2, copies, hit in zip(frame["name"], frame["c1"], frame["c2"], frame["copies"], hits):
            begin, n = _runs(np.ones(len(hit), dtype=bool) if copies > 1 else hit)
            out += [(name, c1, c2, int(a), int(k)) for a, k in zip(begin, n)]
        return _run_frame(out)

    return step


def _window_hashes(data: bytes, n: int, width: int) -> np.ndarray:
    """128-bit hashes of the first n windows, as (n, 2) numbers."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[a : a + width]) for a in range(n)]), dtype="<i8").reshape(-1, 2)


def _as_keys(hashes: np.ndarray) -> np.ndarray:
    """Pairs of numbers as single values that sort and compare as a whole."""
    return np.ascontiguousarray(hashes, dtype="<i8").view([("w1", "<i8"), ("w2", "<i8")]).ravel()


def _count_windows(width: int):
    def step(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([_window_hashes(data, n, width) for data, n in zip(frame["data"], frame["n"])])
        found, met = np.unique(_as_keys(hashes), return_counts=True)
        return pd.DataFrame({"shard": frame["shard"].iloc[0], "w1": found["w1"], "w2": found["w2"], "met": met})

    return step


def _find_windows(width: int):
    def step(key, frame: pd.DataFrame, repeated: pd.DataFrame) -> pd.DataFrame:
        known, out = np.sort(_as_keys(repeated[["w1", "w2"]].to_numpy())), []
        for name, c1, c2, copies, n, data in zip(frame["name"], frame["c1"], frame["c2"], frame["copies"], frame["n"], frame["data"]):
            hit = np.ones(n, dtype=bool)
            if copies == 1:
                own = _as_keys(_window_hashes(data, n, width))
                hit = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own if len(known) else ~hit
            out += [(name, c1, c2, int(a), int(k)) for a, k in zip(*_runs(hit))]
        return _run_frame(out)

    return step


def counted_runs(hot: DataFrame, width: int) -> DataFrame:
    """(name, c1, c2, run, run_n): runs of repeating windows in sections dealt to shards by their content.

    A shard hands on each of its windows once, with its count, so one that all sections share is a row per shard.
    """
    hot = stored(hot)
    windows = stored(hot.select("shard", "n", "data").groupBy("shard").applyInPandas(_count_windows(width), "shard long, w1 long, w2 long, met long"))
    again = windows.groupBy("w1", "w2").agg(F.sum("met").alias("met")).where("met > 1")
    repeated = windows.select("shard", "w1", "w2").join(again, ["w1", "w2"], "leftsemi")
    return hot.groupBy("shard").cogroup(repeated.groupBy("shard")).applyInPandas(_find_windows(width), RUNS)


def with_mates(compared: DataFrame) -> DataFrame:
    """Differing sections with ``mates``: whether another of their name may hold one of their windows.

    Sections of a name whose gram some section holds twice may always have mates.
    """
    for side in ("before", "after"):
        shared = compared.where(F.col(side) != 0).groupBy("name", side).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        compared = compared.join(shared.select("name", side, F.lit(True).alias(f"_{side}")), ["name", side], "left")
    mates = F.col("twice") | F.coalesce("_before", F.lit(False)) | F.coalesce("_after", F.lit(False))
    return compared.withColumn("mates", mates).drop("before", "after", "twice", "_before", "_after")


def repeated_windows(rows: DataFrame, width: int = WIDTH, memory: int = suffixes.MEMORY) -> DataFrame:
    """(text_key, start, n): runs of n windows that repeat, from byte ``start``; rows of (text_key, text)."""
    found = sections(rows, frequent_grams(rows, width), width)
    names = found.groupBy("name").agg(
        F.count(F.lit(1)).alias("met"),
        ((F.min("c1") == F.max("c1")) & (F.min("c2") == F.max("c2"))).alias("alike"),
        F.max("inner").alias("inner"),
    )
    names = names.where("met > 1 or inner").select("name", (F.col("alike") & ~F.col("inner")).alias("copied"), F.col("inner").alias("twice"))
    met = stored(found.drop("inner").join(names, "name"))
    # One copy of each section that must be compared, taken from any text that holds it.
    compared = met.where("not copied").groupBy("name", "c1", "c2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("text_key", "start", "n", "before", "after", "twice")).alias("one")
    )
    compared = stored(with_mates(stored(compared.select("name", "c1", "c2", "copies", "one.*"))).where("mates or copies > 1"))
    # All windows of copies repeat; without mates there is nothing else to say of them.
    alone = compared.where("not mates").select("name", "c1", "c2", F.lit(0).alias("run"), F.col("n").alias("run_n"))
    compared = compared.where("mates").drop("mates")
    sizes = stored(compared.groupBy("name").agg(F.sum(F.col("n") + width).alias("size")))
    hot = F.col("size") > SHARD_BYTES // NAME_SHARE
    size, large = sizes.agg(F.sum(F.when(~hot, F.col("size"))), F.sum(F.when(hot, F.col("size")))).first()
    shards, spread = (max(1, -(-(x or 0) // SHARD_BYTES)) for x in (size, large))
    compared = compared.join(sizes.where(hot).select("name", F.lit(True).alias("hot")), "name", "left").fillna(False, ["hot"])
    holders = rows.join(compared.select("text_key").distinct(), "text_key", "leftsemi").groupBy("text_key").agg(F.first("text").alias("text"))
    texts = compared.join(holders, "text_key").select(
        "hot",
        F.when(F.col("hot"), F.pmod(F.xxhash64("c1", "c2"), F.lit(spread))).otherwise(F.pmod(F.xxhash64("name"), F.lit(shards))).alias("shard"),
        "name",
        "c1",
        "c2",
        "copies",
        "n",
        F.substring(F.col("text").cast("binary"), F.col("start").cast("int") + 1, F.col("n") + (width - 1)).alias("data"),
    )
    found_runs = texts.where("not hot").drop("hot", "n").groupBy("shard").applyInPandas(_sort_shard(width, memory), RUNS)
    if large:
        found_runs = found_runs.union(counted_runs(texts.where("hot").drop("hot"), width))
    found_runs = found_runs.union(alone)
    runs = met.where("not copied").join(found_runs, ["name", "c1", "c2"]).select("text_key", (F.col("start") + F.col("run")).alias("start"), F.col("run_n").alias("n"))
    return met.where("copied").select("text_key", "start", "n").union(runs)


CUT = "n_bytes long, n_removed long, n_spans long, kept binary"


def _cut_text(text: str, packed: np.ndarray | None, width: int) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed spans and what is left; ``packed`` has the runs in order of their start."""
    raw = text.encode()
    if packed is None or not len(packed):
        return len(raw), 0, 0, raw
    packed = np.asarray(packed, dtype=np.int64)
    begin = packed >> 12
    end = np.maximum.accumulate(begin + (packed & 4095) + width - 1)
    # Runs that overlap or touch are one span.
    new = np.r_[True, begin[1:] > end[:-1]]
    begin, end = begin[new], end[np.r_[new[1:], True]]
    kept = b"".join([raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)])])
    return len(raw), len(raw) - len(kept), len(begin), kept


def _cut(texts: pd.Series, runs: pd.Series, width: pd.Series) -> pd.DataFrame:
    out = [_cut_text(*row) for row in zip(texts, runs, width)]
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])


def _remaining(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """What is left of the texts, as text: one pass of one worker, which hands on about ``SLAB`` characters at a time."""
    for frame in given_back(batches):
        left, size = [], 0
        for row in zip(*frame):
            left.append(_cut_text(*row)[3].decode("utf-8", errors="ignore"))
            size += len(left[-1])
            if size > SLAB:
                yield pd.Series(left, dtype=object)
                left, size = [], 0
        if left:
            yield pd.Series(left, dtype=object)


def _with_runs(docs: DataFrame, text_col: str, width: int, memory: int) -> tuple[DataFrame, Column]:
    """(row, text_key, runs) of every row of ``docs``, and its text, null as empty; ``row`` has all columns of ``docs``."""
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("text_key", F.unhex(F.md5(text.cast("binary"))))
    runs = repeated_windows(rows.select("text_key", text.alias("text")), width, memory).distinct()
    packed = F.shiftleft(F.col("start"), 12).bitwiseOR(F.col("n").cast("long"))
    lists = runs.groupBy("text_key").agg(F.sort_array(F.collect_list(packed)).alias("runs"))
    return rows.join(lists, "text_key", "left"), text


def cut_documents(docs: DataFrame, text_col: str = "text", width: int = WIDTH, memory: int = suffixes.MEMORY) -> DataFrame:
    """(row, cut): one row per row of ``docs``; ``row`` has all its columns, ``cut`` has n_bytes, n_removed, n_spans
    and the bytes that are kept.

    Null and empty texts, and texts below the width, lose nothing. Rows with equal texts, whatever their ids, are
    copies and lose alike. An empty table gives no rows.
    """
    joined, text = _with_runs(docs, text_col, width, memory)
    cut = F.pandas_udf(_cut, CUT)
    return joined.select("row", cut(text, F.col("runs"), F.lit(width)).alias("cut"))


def kept_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, memory: int = suffixes.MEMORY) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    cut = cut_documents(docs.select(id_col, text_col), text_col, width, memory)
    return cut.select(F.col("row")[id_col].alias("doc_id"), "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


def with_repeats_cut(docs: DataFrame, text_col: str = "text", width: int = WIDTH, memory: int = suffixes.MEMORY) -> DataFrame:
    """``docs`` with the remaining text in place of the text; a null text stays null.

    A character of which a byte went goes whole. Other columns stay as they are.
    """
    joined, text = _with_runs(docs, text_col, width, memory)
    left = joined.select("row", F.pandas_udf(_remaining, "string")(text, F.col("runs"), F.lit(width)).alias("left"))
    kept = F.when(F.col("row")[text_col].isNotNull(), F.col("left"))
    return left.select(*[(kept if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
