"""Ranked lexical search over K2-treaps of the term-document grid.

1. One pass counts the documents and terms of the corpus; a term's impact in a document follows from its occurrences, the
   document's length and these two.
2. The documents of a block (a range of one task's documents, in the order of their ids) and their terms (the most
   frequent first) span a grid. It is cut into square bands of rows, and each band is a K2-treap: a quadtree whose cells
   hold which quadrants are filled, level by level, and by how much the greatest impact inside falls short of the
   parent's. Leaves hold occurrences. The blocks are stored, packed, a few to a row group, and unpacked one at a time;
   every document and every term is indexed.
3. Document frequencies of the items' terms are summed over the blocks.
4. In each block, the paths of an item's rows descend together, best first: a range of documents is worth the sum of its
   cells' maxima times the terms' weights, and ranges worth less than the item's last place so far are left alone. Leaves
   give exact scores. A task carries the last places from block to block and hands on its best documents only, which
   are ranked by salted windows, then one window an item.

Null and empty texts and those without a term are no documents of the corpus; an item without a known term has no rows.
Repeated rows are documents (or items) of their own; a missing id ranks behind other ids of its score. Empty tables give
no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roundscope.llm.common import frames_by_bytes, given_back, text_rows, type_of
from roundscope.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
#: Characters of a block of the index; a longer text is a block by itself.
BLOCK_CHARS = 4_000_000
#: Bytes of packed blocks that a task gathers before it writes them; readers take as many at once.
GROUP_BYTES = 8 << 20
#: Items that one pass over the index takes along, and characters of them.
ITEMS, ITEM_CHARS = 2_000, 4_000_000
#: Cells store impacts in these units, rounded up; an impact is below a million, so two bytes hold it.
UNIT = 16
#: Document ranges that are opened at a time.
WAVE = 256
SALTS = 64

#: Upper case A-Z to lower case; ASCII characters other than letters and digits to blanks. Other bytes belong to terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BITS = np.array([bin(m).count("1") for m in range(16)], dtype=np.int64)


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_TERM_BYTES).split()


def mass(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The length's share of a document's impacts."""
    return 100 - 25 + (25 * n * documents) // total


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# --- one block of the index -----------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x, below 2 ** 21, at every other place."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(keep)
    return x


def build_block(texts: list[str], documents: int, total: int) -> dict:
    """The treaps of these documents: sizes, terms with document frequencies, and the quadtree level by level."""
    numbers: dict[bytes, int] = {}
    own = []
    for text in texts:
        own.append(np.array([numbers.setdefault(t, len(numbers)) for t in terms(text)], dtype=np.int64))
    sizes = np.array([len(o) for o in own], dtype=np.int64)
    depth = max(1, int(len(texts) - 1).bit_length())
    cells, tf = np.unique(np.concatenate(own) << depth | np.repeat(np.arange(len(texts)), sizes), return_counts=True)
    term, col = cells >> depth, cells & (1 << depth) - 1
    df = np.bincount(term, minlength=len(numbers))
    order = np.argsort(-df, kind="stable")
    row = np.empty(len(order), dtype=np.int64)
    row[order] = np.arange(len(order))
    row = row[term]
    code = (row >> depth).astype(np.uint64) << np.uint64(2 * depth) | _spread(row & (1 << depth) - 1) << np.uint64(1) | _spread(col)
    at = np.argsort(code)
    code, tf, col = code[at], tf[at], col[at]
    top = -(-impacts(tf, mass(sizes[col], documents, total)) // UNIT)
    masks, falls = [], []
    for _ in range(depth):
        parent = code >> np.uint64(2)
        begins = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if len(code) else np.zeros(0, dtype=int)
        greatest = np.maximum.reduceat(top, begins) if len(code) else top
        filled = np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.int64)), begins) if len(code) else top
        masks.append(filled.astype(np.uint8))
        falls.append((np.repeat(greatest, np.diff(np.r_[begins, len(code)])) - top).astype("<u2"))
        code, top = parent[begins], greatest
    falls.append(top.astype("<u2"))
    words = list(numbers)
    return {
        "sizes": sizes.astype("<i8").tobytes(),
        "terms": b"\n".join([words[t] for t in order.tolist()]),
        "dfs": df[order].astype("<u4").tobytes(),
        "bands": code.astype("<u4").tobytes(),
        "masks": [m.tobytes() for m in reversed(masks)],
        # The leaves' maxima are not stored: their impacts follow from the occurrences.
        "falls": [f.tobytes() for f in reversed(falls[1:])],
        "tf": tf.astype("<u4").tobytes(),
    }


class Block:
    """A stored block, ready for descents."""

    def __init__(self, stored_block: dict, documents: int, total: int):
        self.sizes = np.frombuffer(stored_block["sizes"], dtype="<i8")
        self.mass = mass(self.sizes, documents, total)
        self.masks = [np.frombuffer(m, dtype=np.uint8) for m in stored_block["masks"]]
        self.depth = len(self.masks)
        self.first = [np.cumsum(_BITS[m]) - _BITS[m] for m in self.masks]
        self.tops = [np.frombuffer(stored_block["falls"][0], dtype="<u2").astype(np.int64)]
        for mask, fall in zip(self.masks, stored_block["falls"][1:]):
            self.tops.append(np.repeat(self.tops[-1], _BITS[mask]) - np.frombuffer(fall, dtype="<u2"))
        self.tf = np.frombuffer(stored_block["tf"], dtype="<u4").astype(np.int64)
        bands = np.frombuffer(stored_block["bands"], dtype="<u4")
        self.root = {int(b): i for i, b in enumerate(bands)}

    def search(self, rows: np.ndarray, weights: np.ndarray, count: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with the ``count`` highest scores of at least ``least``, by score and then place: (places, scores)."""
        depth = self.depth
        low = rows & (1 << depth) - 1
        roots = np.array([self.root[int(b)] for b in rows >> depth], dtype=np.int64)
        # Open ranges of each level: their number, worth, and the node of every row (-1: none).
        ranges = {0: (np.zeros(1, dtype=np.int64), UNIT * (self.tops[0][roots] @ weights)[None], roots[None])}
        places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        while ranges:
            level = max(ranges, key=lambda x: (ranges[x][1].max(), x))
            number, worth, node = ranges.pop(level)
            alive = worth >= least
            if not alive.all():
                number, worth, node = number[alive], worth[alive], node[alive]
            if not len(number):
                continue
            if len(number) > WAVE:
                best = np.argpartition(-worth, WAVE)
                ranges[level] = tuple(x[best[WAVE:]] for x in (number, worth, node))
                best = best[:WAVE]
                number, node = number[best], node[best]
            mask = np.where(node >= 0, self.masks[level][node], 0)
            quadrant = 2 * (low >> depth - 1 - level & 1)
            halves = []
            for side in (0, 1):
                filled = mask >> quadrant + side & 1
                child = self.first[level][node] + _BITS[mask & (1 << quadrant + side) - 1]
                halves.append((2 * number + side, np.where(filled > 0, child, -1)))
            number, node = (np.concatenate(x) for x in zip(*halves))
            if level + 1 < depth:
                worth = UNIT * (np.where(node >= 0, self.tops[level + 1][node], 0) @ weights)
                keep = (worth >= least) & (worth > 0)
                if keep.any():
                    found = (number[keep], worth[keep], node[keep])
                    ranges[level + 1] = tuple(map(np.concatenate, zip(ranges[level + 1], found))) if level + 1 in ranges else found
                continue
            met = (node >= 0).any(axis=1)
            number, node = number[met], node[met]
            own = np.where(node >= 0, impacts(self.tf[node], self.mass[number][:, None]), 0) @ weights
            keep = (own >= least) & (own > 0)
            places, scores = np.r_[places, number[keep]], np.r_[scores, own[keep]]
            if len(places) > count:
                best = np.lexsort((places, -scores))[:count]
                places, scores = places[best], scores[best]
                least = max(least, int(scores[-1]))
        best = np.lexsort((places, -scores))
        return places[best], scores[best]


# --- the index ------------------------------------------------------------------------------


def packed(block: dict) -> dict:
    """The block with its bytes compressed, so that the JVM holds and copies a quarter of them."""
    return {k: [zstandard.compress(x, 1) for x in v] if isinstance(v, list) else zstandard.compress(v, 1) for k, v in block.items()}


def unpacked(batch: pa.RecordBatch) -> Iterator[dict]:
    """The stored rows one after the other; no more than one of them is unpacked at a time."""
    for i in range(batch.num_rows):
        row = batch.slice(i, 1).to_pylist()[0]
        ids = {"ids": row.pop("ids")} if "ids" in row else {}
        yield ids | {k: [zstandard.decompress(x) for x in v] if isinstance(v, list) else zstandard.decompress(v) for k, v in row.items()}


def plain(ids: pd.Series) -> list:
    """Ids as Python values; missing ones, which turn whole numbers into floats, as None."""
    if ids.dtype.kind == "f":
        return [None if x != x else int(x) for x in ids.tolist()]
    return [None if x is pd.NA or x is None else x for x in ids.tolist()]


class Index:
    """Stored blocks with the corpus counts their impacts rest on."""

    def __init__(self, blocks: DataFrame, documents: int, total: int, id_type: str):
        self.blocks, self.documents, self.total, self.id_type = blocks, documents, total, id_type


def corpus_counts(rows: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and all their terms with repeats."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_by_bytes(batches, BLOCK_CHARS):
            sizes = [len(terms(t)) for t in frame["text"]]
            yield pd.DataFrame({"documents": [sum(map(bool, sizes))], "total": [sum(sizes)]})

    found = rows.select("text").mapInPandas(step, "documents long, total long").agg(F.sum("documents"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every document. What comes to the driver is two numbers."""
    rows = text_rows(docs, id_col, text_col)
    documents, total = corpus_counts(rows)
    kind = type_of(rows, "doc_id")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_by_bytes(batches, BLOCK_CHARS):
            frame = frame.sort_values("doc_id", kind="stable", na_position="last")
            block = build_block(list(frame["text"]), documents, total)
            if block["tf"]:
                yield pd.DataFrame({"ids": [frame["doc_id"].astype(object).where(frame["doc_id"].notna(), None).tolist()]} | {k: [v] for k, v in packed(block).items()})

    schema = f"ids array<{kind}>, sizes binary, terms binary, dfs binary, bands binary, masks array<binary>, falls array<binary>, tf binary"
    # Blocks are few and large: without these options a hundred of them wait in memory before the writer looks at their size.
    options = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    return Index(stored(rows.mapInPandas(step, schema), options=options), documents, total, kind)


def document_frequencies(index: Index, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of these terms stands; they are as few as the items' terms."""
    shared = index.blocks.sparkSession.sparkContext.broadcast(wanted)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            kind = batch.schema.field("terms").type
            for block in unpacked(batch):
                found = [(t, n) for t, n in zip(block["terms"].split(b"\n"), np.frombuffer(block["dfs"], dtype="<u4").tolist()) if t in shared.value]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], kind), pa.array([n for _, n in found], pa.int64())], ["term", "df"])

    sums = index.blocks.select("terms", "dfs").mapInArrow(step, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in sums.collect()}


def _slices(items: DataFrame) -> Iterator[list[tuple]]:
    """(id, text) of the items, some at a time."""
    part, chars = [], 0
    for row in items.toLocalIterator():
        part.append((row["doc_id"], row["text"]))
        chars += len(row["text"])
        if len(part) == ITEMS or chars > ITEM_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _found(index: Index, queries: list[tuple[int, Counter]], weights: dict[bytes, int], top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each task for each item."""
    shared = index.blocks.sparkSession.sparkContext.broadcast((queries, weights))
    documents, total = index.documents, index.total

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best: dict[int, list[tuple]] = {}
        kind = None
        for batch in given_back(batches):
            kind = batch.schema.field("ids").type.value_type
            for stored_block in unpacked(batch):
                block, ids = Block(stored_block, documents, total), stored_block["ids"]
                row_of = {t: r for r, t in enumerate(stored_block["terms"].split(b"\n")) if t in weights}
                for item, counts in queries:
                    met = [(row_of[t], n * weights[t]) for t, n in counts.items() if t in row_of]
                    if not met:
                        continue
                    own = best.get(item, [])
                    rows, factors = np.array(met, dtype=np.int64).T
                    places, scores = block.search(rows, factors, top, own[-1][0] if len(own) == top else 1)
                    own = own + [(s, ids[p]) for p, s in zip(places.tolist(), scores.tolist())]
                    best[item] = sorted(own, key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))[:top]
        found = [(item, doc_id, score) for item, own in best.items() for score, doc_id in own]
        if found:
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), kind, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return index.blocks.mapInArrow(step, f"item int, doc_id {index.id_type}, score long")


def search(index: Index, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents, equal scores by ascending id.

    The items are a stated query set: they are taken along to all blocks, a bounded slice of them in each pass.
    """
    spark = items.sparkSession
    rows = text_rows(items, id_col, text_col)
    kind = type_of(rows, "doc_id")
    results = []
    for part in _slices(rows):
        queries = [(i, Counter(terms(text))) for i, (_, text) in enumerate(part)]
        queries = [(i, counts) for i, counts in queries if counts]
        dfs = document_frequencies(index, {t for _, counts in queries for t in counts}) if queries and index.total else {}
        weights = {t: weight(index.documents, df) for t, df in dfs.items()}
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(part)], f"item int, item_id {kind}")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        found = _found(index, queries, weights, top).withColumn("salt", F.spark_partition_id() % SALTS)
        for keys in (["item", "salt"], ["item"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
        results.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {index.id_type}, score long")
    out = results[0]
    for other in results[1:]:
        out = out.unionAll(other)
    return out
