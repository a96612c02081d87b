"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints link at three or fewer differing bits. Every distinct fingerprint emits variants of itself within
half the radius, rounded down or up by the parity of its bits:

- odd parity: all 64 variants at one bit;
- even parity: itself, the 64 variants at one bit, and the variants at two bits of the same 32-bit half.

These balls meet for every pair within the radius. Pairs at one or three bits have different parity: of three
bits some two lie in the same half, which the even side flips, and the odd side flips the third. Pairs at two bits
either differ in one half (one is a two-bit variant of the other) or meet at a one-bit variant of both. An even
fingerprint emits 1057 variants, an odd one 64: 560 on average, whatever the corpus.

Fingerprints that share a variant form no pairs among themselves: all are linked to one of them that lies within
one bit of the variant, so every link is within the radius, and the links of a variant connect all that meet there.
A variant is shared by at most 1121 distinct fingerprints, so no group grows with the corpus.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roundscope.llm.common import checkpointed, frames_by_bytes, given_back, text_rows, type_of
from roundscope.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints that one emitting step handles, and variants that one meeting step sorts.
EMIT_ROWS = 1024
MEET_ROWS = 2_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def simhash(text: str, words: int = SHINGLE_WORDS) -> int:
    """Majority of the shingle hashes' bits as an unsigned number; 0 for a text without words.

    A-Z are lower-cased and words are split at ASCII white space, both as bytes.
    """
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    shingles = zip(*(tokens[i:] for i in range(words))) if len(tokens) >= words else iter([tokens])
    digest = xxhash.xxh64_intdigest
    while part := [digest(s, SEED) for s in map(b" ".join, itertools.islice(shingles, 1 << 15))]:
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, simhash): one row per row of ``docs``; a null text counts as empty."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_by_bytes(batches):
            values = np.array([simhash(t, words) for t in frame["text"]], dtype=np.uint64)
            yield frame[["doc_id", "text_hash"]].assign(simhash=values.view(np.int64))

    rows = text_rows(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInPandas(score, f"doc_id {type_of(rows, 'doc_id')}, text_hash long, simhash long")


def flip_masks() -> tuple[np.ndarray, int]:
    """Masks of flipped bits: first the empty one, then 64 of one bit, then those of two bits of one half."""
    one = [1 << b for b in range(BITS)]
    half = BITS // 2
    two = [1 << a | 1 << b for h in (0, half) for a, b in itertools.combinations(range(h, h + half), 2)]
    return np.array([0, *one, *two], dtype=np.uint64), 1 + BITS


def _emit(buckets: int):
    masks, ones = flip_masks()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in given_back(batches):
            for begin in range(0, len(frame), EMIT_ROWS):
                prints = frame["simhash"].to_numpy(dtype=np.int64)[begin : begin + EMIT_ROWS].view(np.uint64)
                odd = np.bitwise_count(prints) % 2 == 1
                sides = ((prints[~odd], np.arange(len(masks))), (prints[odd], np.arange(1, ones)))
                owner = np.concatenate([np.repeat(p, len(f)) for p, f in sides])
                flip = np.concatenate([np.tile(f, len(p)) for p, f in sides]).astype(np.uint16)
                bucket = (((owner ^ masks[flip]) * _SPREAD) >> np.uint64(24)) % np.uint64(buckets)
                order = np.argsort(bucket.astype(np.int32), kind="stable")
                owner, flip, bucket = owner[order], flip[order], bucket[order]
                starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                ends = np.r_[starts[1:], len(bucket)]
                yield pd.DataFrame(
                    {
                        "bucket": bucket[starts].astype(np.int64),
                        "owners": [owner[a:b].tobytes() for a, b in zip(starts, ends)],
                        "flips": [flip[a:b].tobytes() for a, b in zip(starts, ends)],
                    }
                )

    return step


def _meet(radius: int):
    masks, _ = flip_masks()

    def step(frame: pd.DataFrame) -> pd.DataFrame:
        owner = np.frombuffer(b"".join(frame["owners"]), dtype=np.uint64)
        flip = np.frombuffer(b"".join(frame["flips"]), dtype=np.uint16)
        variant = owner ^ masks[flip]
        order = np.argsort(variant)
        variant = variant[order]
        same = variant[1:] == variant[:-1]
        shared = order[np.r_[False, same] | np.r_[same, False]]
        owner, flip = owner[shared], flip[shared]
        variant, away = owner ^ masks[flip], np.bitwise_count(masks[flip])
        order = np.lexsort((owner, away, variant))
        owner, variant, away = owner[order], variant[order], away[order]
        if not len(owner):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        first = np.r_[True, variant[1:] != variant[:-1]]
        centre = np.flatnonzero(first)[np.cumsum(first) - 1]
        linked = ~first & (away[centre] <= 1) & (np.bitwise_count(owner ^ owner[centre]) <= radius)
        pairs = np.unique(np.stack([owner[linked], owner[centre[linked]]], axis=1), axis=0)
        return pd.DataFrame({"u": pairs[:, 0].view(np.int64), "v": np.ascontiguousarray(pairs[:, 1]).view(np.int64)})

    return step


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) links between distinct fingerprints of ``prints`` (a column ``simhash``).

    Every link is within ``radius`` bits, and all fingerprints that a chain of such links joins are joined. The
    balls above are those of radius 3, the greatest one served. Repeated and null fingerprints give nothing more.
    """
    if radius > RADIUS:
        raise ValueError(f"the balls meet up to {RADIUS} bits")
    distinct = checkpointed(prints.select("simhash").where("simhash is not null").distinct())
    count = distinct.count()
    masks, ones = flip_masks()
    buckets = max(1, -(-count * (len(masks) + ones) // 2 // MEET_ROWS))
    dealt = distinct.repartition(max(1, -(-count // (2 * EMIT_ROWS))), "simhash")
    emitted = dealt.mapInPandas(_emit(buckets), "bucket long, owners binary, flips binary")
    return emitted.groupBy("bucket").applyInPandas(_meet(radius), "u long, v long").distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int) -> DataFrame:
    """(doc_id, text_hash, simhash, root, component_id); root is the least fingerprint of the component."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, words))
    roots = connected_components(links(prints, radius))
    own = prints.groupBy("simhash").agg(F.min("doc_id").alias("low"))
    own = own.join(roots, F.col("simhash") == F.col("node"), "left")
    own = own.select("simhash", "low", F.coalesce("root", "simhash").alias("root"))
    least = own.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(own.join(least, "root").select("simhash", "root", "component_id"), "simhash")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, simhash, component_id): one row per row of ``docs``.

    component_id is the least id of all rows that links within ``radius`` bits reach, equal fingerprints included.
    Empty and null texts share fingerprint zero and link like any other. Rows with a null id take part and get the
    component's id, which is null where no row of the component has one. Repeated rows stay. An empty table gives
    no rows. Other columns of ``docs`` are not read.
    """
    return _grouped(docs, id_col, text_col, words, radius).select("doc_id", "simhash", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component stays, with all columns as they were.

    It is the row of the least id; rows without an id come last, and rows that repeat an id go by a hash of their
    text. Of rows alike in id and text any one stays.
    """
    groups = _grouped(docs, id_col, text_col, words, radius)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    heads = groups.groupBy("root").agg(F.min(order).alias("head")).select("head.doc_id", "head.text_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("row_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("row_hash"),
    )
    alike = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
    rows = rows.join(heads, alike, "leftsemi")
    place = F.row_number().over(Window.partitionBy("row_hash", "row_id").orderBy("row_hash"))
    return rows.withColumn("place", place).where("place = 1").select("row.*")
