"""Packing pieces of documents into sequences: dominance reduction, then best fit.

The instance is its histogram of piece lengths, which has at most as many entries as a sequence has tokens, whatever
the corpus. On it, Martello and Toth's reduction fixes sets that dominate every other set with the same largest
piece, all copies of a set at once; best fit decreasing packs what remains, again whole classes at once. The plan is
a short list of runs; every piece finds its place from its length and its rank among the pieces of that length, so
neither pieces nor sequences pass through the driver.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roundscope.llm.common import give_back, given_back, text_rows, type_of
from roundscope.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
END_ID = 1
#: Words whose ids a task keeps; beyond them it starts anew.
CACHE_WORDS = 300_000
#: Pieces of one length that are ranked in one window; there are as many buckets as shuffle partitions at least.
RANKED_ROWS = 100_000


#: Letters that are one character each in lower case and in normal form, then ASCII marks but for the apostrophe: the
#: tokenizer takes the letters and the marks as one word each.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Ids of the words of a byte-level tokenizer that folds case and drops white space, as little-endian bytes.

    Words of letters and marks go straight to the tokenizer's model, others through the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.letters, self.parts = byte_letters(), {}

    def __missing__(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        if plain:
            self[word] = ids = b"".join([self._part(p) for p in plain.groups() if p])
        else:
            self[word] = ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return ids

    def _part(self, part: str) -> bytes:
        part = part.lower()
        ids = self.parts.get(part)
        if ids is None:
            spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            self.parts[part] = ids = np.array([t.id for t in self.merge(spelled)], dtype="<u4").tobytes()
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a text, cut at blanks and line ends only, which no token of the tokenizer crosses."""
        if len(self) > CACHE_WORDS or len(self.parts) > CACHE_WORDS:
            self.clear()
            self.parts.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def pieces(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end id, cut at every ``capacity`` ids.

    Null and empty texts are one piece of the end id. Repeated rows are repeated pieces; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    end = np.array([end_id], dtype="<u4").tobytes()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, size = WordIds(shared.value), 4 * capacity  # the words go with the task
        for frame in given_back(batches):
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = words.ids(text) + end
                for n, a in enumerate(range(0, len(ids), size)):
                    part = ids[a : a + size]
                    out.append((doc_id, n, a // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        del words
        give_back()

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInPandas(step, f"doc_id {type_of(rows, 'doc_id')}, piece int, start long, length long, ids_crc32 long")


# --- the plan, on counts per length ---------------------------------------------------------

# A run is (length, copies per sequence); a group of equal sequences is (number of them, their runs).


def _take(counts: dict[int, int], lengths: list[int], order: list[int]) -> int:
    """How many sequences of these lengths the counts allow; takes them out."""
    need = {x: lengths.count(x) for x in lengths}
    n = min(counts[x] // k for x, k in need.items())
    for x, k in need.items():
        counts[x] -= n * k
        if not counts[x]:
            del counts[x]
            del order[bisect_left(order, x)]
    return n


def _dominating(x: int, counts: dict[int, int], order: list[int], capacity: int) -> list[int] | None:
    """Lengths of a set with ``x`` that dominates every other feasible set with ``x``; None where none is proven."""
    rest = capacity - x
    # The three smallest pieces beside this one.
    small = [y for y in order[:4] for _ in range(min(3, counts[y] - (y == x)))][:3]
    if not small or small[0] > rest:
        return [x]
    at = bisect_left(order, rest + 1) - 1
    if order[at] == x and counts[x] < 2:
        at -= 1
    best = order[at]
    if best == rest or len(small) < 2 or small[0] + small[1] > rest:
        return [x, best]
    if len(small) < 3 or sum(small) > rest:
        # At most two more fit: one piece as large as any pair that fits dominates them all.
        pair, low, high = 0, 0, at
        while low <= high:
            if order[low] + order[high] > rest:
                high -= 1
            else:
                pair = max(pair, order[low] + order[high])
                low += 1
        if best >= pair:
            return [x, best]
    return None


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Take sets out of ``counts`` that some optimal packing holds; returns them as groups of sequences."""
    groups, changed = [], True
    order = sorted(counts)
    while changed:
        changed = False
        for x in sorted(counts, reverse=True):
            while x in counts and (found := _dominating(x, counts, order, capacity)):
                n = _take(counts, found, order)
                if not n:
                    break
                groups.append((n, [(x, found.count(x))] + [(y, 1) for y in found if y != x]))
                changed = True
    return groups


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit decreasing on whole classes: each piece goes where it leaves the least room."""
    rooms: list[int] = []
    open_groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(room: int, group) -> None:
        if room not in open_groups:
            insort(rooms, room)
            open_groups[room] = []
        open_groups[room].append(group)

    for x in sorted(counts, reverse=True):
        left = counts[x]
        while left:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                room, n, runs = capacity, left, []
            else:
                room = rooms[at]
                n, runs = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room], rooms[at]
            each = room // x
            full = min(n, left // each)
            if full:
                put(room - each * x, (full, [*runs, (x, each)]))
                left, n = left - full * each, n - full
            if n and left:
                put(room - left * x, (1, [*runs, (x, left)]))
                left, n = 0, n - 1
            if n and runs:
                put(room, (n, runs))
    return [g for groups in open_groups.values() for g in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Runs of the packing: length, first rank, copies per sequence, first sequence, offset of the first copy."""
    left = {x: n for x, n in counts.items() if n > 0}
    groups = reduce_by_dominance(left, capacity)
    groups += best_fit(left, capacity)
    rank, sequence, rows = dict.fromkeys(counts, 0), 0, []
    for n, runs in groups:
        offset = 0
        for length, copies in runs:
            rows.append((length, rank[length], copies, sequence, offset))
            rank[length] += n * copies
            offset += length * copies
        sequence += n
    return pd.DataFrame(rows, columns=["length", "rank", "copies", "sequence", "offset"], dtype="int64").sort_values(["length", "rank"], ignore_index=True)


# --- placing --------------------------------------------------------------------------------


def ranked(cut: DataFrame, rows: int) -> DataFrame:
    """``cut`` with each piece's rank (from 0) among those of its length.

    Pieces of a length are spread over buckets by their ids; each bucket is ranked by itself and starts where the
    buckets before it end, so a length that most pieces share stays spread.
    """
    buckets = max(-(-rows // RANKED_ROWS), int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    sizes = sizes.select("length", "bucket", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    return spread.withColumn("own", own).join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own") - 1).drop("bucket", "own", "before")


def pack(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece and its place.

    Each sequence holds at most ``capacity`` ids without a gap. An empty table gives no rows.
    """
    cut = stored(pieces(docs, tokenizer_json, capacity, end_id, id_col, text_col))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(counts, capacity)
    span = 1 << 44
    keys = runs["length"].to_numpy() * span + runs["rank"].to_numpy()
    first, copies, sequence, offset = (runs[c].to_numpy() for c in ("rank", "copies", "sequence", "offset"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            length, rank = frame["length"].to_numpy(), frame.pop("rank").to_numpy()
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            step, copy = np.divmod(rank - first[at], copies[at])
            yield frame.assign(sequence_id=sequence[at] + step, offset=offset[at] + copy * length)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"doc_id {type_of(cut, 'doc_id')}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(cut, sum(counts.values())).select(*names, "rank").mapInPandas(place, schema)
