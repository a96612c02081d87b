"""Alignment of two tokenizers over a corpus: which tokens cover the same bytes, and how often corpus-wide.

1. Texts are cut into chunks at single blanks between other characters. Both tokenizers start a token there, so a
   distinct chunk is encoded once a task and carries its groups and its linked id pairs wherever it stands.
2. Documents are numbered within blocks of one task. For each id pair a block holds compressed bitmaps of its documents,
   one for each binary digit of the pair's count in a document (multiplicity planes): a list of numbers, or plain bits
   where those are shorter.
3. A pair's bitmaps of different blocks cover different documents, so their union is their list: popcounts of the
   planes, weighted by the digit, add up to the pair's links, and popcounts of the planes' union to its documents.
   Spark sums them; a second aggregate finds the highest count of each right-hand id.
4. The postings carry their pair's count back: joined by pair, gathered by block, decoded into the sums of each document.

A pair appears at most once a plane in a block, so even the most frequent pair stays a small share of the rows; what
gathers by block is no larger than the block's text. Null, empty and unfaithfully encoded texts have no tokens and zero
sums; repeated rows are documents of their own, equal or missing ids stay; an empty table gives no rows; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import frames_by_bytes, text_rows, type_of
from roundscope.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a block (a longer text is a block by itself) and its most documents, whose numbers take two bytes.
BLOCK_CHARS, BLOCK_DOCS = 8_000_000, 1 << 16
#: Distinct chunks, and characters of them, that a task keeps from block to block.
CACHE_CHUNKS, CACHE_CHARS = 400_000, 16_000_000
#: Right-hand ids take the low bits of a pair.
ID_BITS = 20

BORDER = re.compile(r"(?<=\S) (?=\S)")
WIDE = re.compile(r"\s | \s|^ | $")


def chunks(text: str) -> list[str]:
    """The text cut at each blank between two characters that are no white space."""
    return BORDER.split(text) if WIDE.search(text) else text.split(" ")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Chunks(dict):
    """Numbers of distinct chunks in order of arrival."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


class Pairs:
    """Encodes distinct chunks by both tokenizers: sizes, linked id pairs, and the groups as text."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(map(alphabet.__getitem__, t)) for t, i in json.loads(a_json)["model"]["vocab"].items() if alphabet.keys() >= set(t)}
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_text, self.b_text = ([str(i) for i in range(n)] for n in (self.a.get_vocab_size(), len(self.b_bytes)))
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.numbers, self.chars = Chunks(), 0
        self.sizes = array("q")  # for each chunk: tokens of A, of B, groups, links; links are negative where bytes differ
        self.links, self.ends = array("q"), array("q", [0])
        self.groups: list[str] = []

    def tidy(self) -> None:
        """Before a block: start anew where the cache is full."""
        if len(self.numbers) > CACHE_CHUNKS or self.chars > CACHE_CHARS:
            self.forget()

    def learn(self) -> None:
        """Encode the chunks that were numbered since the last call."""
        done = len(self.groups)
        fresh = list(self.numbers)[done:] if done else list(self.numbers)
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            a_all = self.a.encode_batch([" " + c for c in part], add_special_tokens=False)
            b_all = self.b.encode(part, num_threads=1)
            for chunk, a_ids, b_ids in zip(part, a_all, b_all):
                self._add(chunk, a_ids.ids, b_ids)
        self.chars += sum(map(len, fresh))

    def _add(self, chunk: str, a_ids: list[int], b_ids: list[int]) -> None:
        a = [self.a_bytes[i] for i in a_ids]
        b = [self.b_bytes[i] for i in b_ids]
        target = b" " + chunk.encode()
        if b"".join(a) != target or b"".join(b) != target:
            self.sizes.extend((0, 0, 0, -1))
            self.ends.append(self.ends[-1])
            self.groups.append("")
            return
        a_text, b_text = [self.a_text[i] for i in a_ids], [self.b_text[i] for i in b_ids]
        links, groups = [], []
        i = j = first_i = first_j = 0
        gap = len(a[0]) - len(b[0])  # how far A's token ends behind B's
        while True:
            links.append(a_ids[i] << ID_BITS | b_ids[j])
            if not gap:
                groups.append(f"{','.join(a_text[first_i : i + 1])}|{','.join(b_text[first_j : j + 1])}")
                i, j = i + 1, j + 1
                if i == len(a):
                    break
                first_i, first_j, gap = i, j, len(a[i]) - len(b[j])
            elif gap < 0:
                i += 1
                gap += len(a[i])
            else:
                j += 1
                gap -= len(b[j])
        self.links.extend(links)
        self.sizes.extend((len(a), len(b), len(groups), len(links)))
        self.ends.append(len(self.links))
        self.groups.append(";".join(groups))


def expanded(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions begin, begin + 1, … of each stretch, one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - length - begin, length)


# --- compressed bitmaps ---------------------------------------------------------------------


def containers(pair: np.ndarray, member: np.ndarray, n: int) -> Iterator[tuple[int, int, bytes]]:
    """(pair, popcount, bits) of each pair's members among 0 … n - 1; both sorted by pair, then member.

    Bits are a list of two-byte numbers, or n plain bits where those are shorter.
    """
    width = -(-n // 8)
    begins = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, dtype=int)
    ends = np.r_[begins[1:], len(pair)]
    listed = member.astype("<u2").tobytes()
    for p, begin, end in zip(pair[begins].tolist(), begins.tolist(), ends.tolist()):
        if 2 * (end - begin) < width:
            yield p, end - begin, listed[2 * begin : 2 * end]
        else:
            marks = np.zeros(8 * width, dtype=bool)
            marks[member[begin:end]] = True
            yield p, end - begin, np.packbits(marks, bitorder="little").tobytes()


def members(bits: list[bytes], counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, member) of all containers in ``bits``, whose popcounts are ``counts``."""
    width = -(-n // 8)
    dense = 2 * counts >= width
    rows, found = [], []
    short = np.flatnonzero(~dense)
    rows.append(np.repeat(short, counts[short]))
    found.append(np.frombuffer(b"".join([bits[r] for r in short.tolist()]), dtype="<u2").astype(np.int64))
    full = np.flatnonzero(dense)
    step = max(1, (1 << 22) // max(1, width))
    for at in range(0, len(full), step):
        part = full[at : at + step]
        marks = np.unpackbits(np.frombuffer(b"".join([bits[r] for r in part.tolist()]), dtype=np.uint8).reshape(len(part), width), axis=1, bitorder="little")
        row, member = np.nonzero(marks)
        rows.append(part[row])
        found.append(member)
    return np.concatenate(rows), np.concatenate(found)


# --- the tables -----------------------------------------------------------------------------

DOC_COLUMNS = ["block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
POSTING_COLUMNS = ["block", "pair", "plane", "n", "n_docs", "bits"]


def block_rows(pairs: Pairs, ids: pd.Series, texts: list[str]) -> Iterator[pd.DataFrame]:
    """The document rows of a block, then its postings."""
    block = int.from_bytes(os.urandom(8), "little") >> 1
    pairs.tidy()
    number = pairs.numbers.__getitem__
    cut = [np.fromiter(map(number, chunks(t)), dtype=np.int64) if t else np.zeros(0, dtype=np.int64) for t in texts]
    pairs.learn()
    n = len(texts)
    held = np.concatenate(cut)
    doc = np.repeat(np.arange(n), [len(c) for c in cut])
    sizes = np.frombuffer(pairs.sizes, dtype=np.int64).reshape(-1, 4)[held]
    faithful = np.ones(n, dtype=bool)
    faithful[doc[sizes[:, 3] < 0]] = False
    totals = np.zeros((n, 4), dtype=np.int64)
    np.add.at(totals, doc, sizes)
    totals[~faithful] = 0
    shown = [hashlib.sha256(";".join([pairs.groups[c] for c in own.tolist()]).encode()).hexdigest() if ok and len(own) else "" for own, ok in zip(cut, faithful)]
    yield pd.DataFrame(
        {"block": block, "at": np.arange(n), "doc_id": ids.to_numpy()} | {c: totals[:, k] for k, c in enumerate(DOC_COLUMNS[3:7])} | {"groups_sha256": shown}
    )

    own = faithful[doc]
    held, doc = held[own], doc[own]
    ends = np.frombuffer(pairs.ends, dtype=np.int64)
    length = ends[held + 1] - ends[held]
    keys = np.frombuffer(pairs.links, dtype=np.int64)[expanded(ends[held], length)] << 16 | np.repeat(doc, length)
    keys, counts = np.unique(keys, return_counts=True)
    pair, member = keys >> 16, keys & 0xFFFF
    pairs_met, docs_met = np.unique(pair, return_counts=True)  # the union of a pair's planes: all its documents
    plane, counted = 0, np.zeros(len(pairs_met), dtype=bool)
    while (counts >> plane).any():
        marked = (counts >> plane & 1).astype(bool)
        frame = pd.DataFrame(containers(pair[marked], member[marked], n), columns=["pair", "n", "bits"])
        at = np.searchsorted(pairs_met, frame["pair"].to_numpy(dtype=np.int64))
        yield frame.assign(n_docs=np.where(counted[at], 0, docs_met[at]), block=block, plane=plane)
        counted[at] = True
        plane += 1


def tables(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with their own sums, and the postings: a row for each pair, block and plane, stored."""
    rows = text_rows(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((a_json, b_model))

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = Pairs(*shared.value)
        absent = {c: 0 for c in dict.fromkeys(DOC_COLUMNS + POSTING_COLUMNS)} | dict.fromkeys(["doc_id", "groups_sha256", "bits"])
        for frame in frames_by_bytes(batches, BLOCK_CHARS):
            for at in range(0, len(frame), BLOCK_DOCS):
                part = frame.iloc[at : at + BLOCK_DOCS]
                for kind, out in enumerate(block_rows(pairs, part["doc_id"], list(part["text"]))):
                    yield out.assign(kind=min(kind, 1), **{c: v for c, v in absent.items() if c not in out.columns})

    kind = type_of(rows, "doc_id")
    schema = f"kind int, block long, at int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair long, plane int, n long, n_docs long, bits binary"
    both = stored(rows.mapInPandas(step, schema), ["kind"])
    return both.where("kind = 0").select(*DOC_COLUMNS), both.where("kind = 1").select(*POSTING_COLUMNS)


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, n_docs, n_links, best) of each linked id pair of the corpus.

    ``best``: no other pair of this right-hand id has more links.
    """
    merged = postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum(F.expr("n * shiftleft(1L, plane)")).alias("n_links"))
    merged = merged.withColumns({"a_id": F.shiftright("pair", ID_BITS).cast("int"), "b_id": F.col("pair").bitwiseAND((1 << ID_BITS) - 1).cast("int")})
    most = merged.groupBy("b_id").agg(F.max("n_links").alias("most"))
    found = merged.join(most, "b_id").withColumn("best", F.col("n_links") == F.col("most"))
    return found.select("pair", "a_id", "b_id", "n_docs", "n_links", "best")


def align(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    ``n_best`` counts the links whose pair has the most links among those of its right-hand id, ``count_sum`` adds up the
    pairs' corpus-wide links over the document's own.
    """
    own, postings = tables(docs, a_json, b_model, id_col, text_col)
    counts = pair_counts(postings).select("pair", F.col("n_links").alias("links"), "best")
    scored = postings.drop("n_docs").join(counts, "pair").select(F.col("block").alias("scored_block"), "plane", "n", "bits", "links", "best")

    def add(documents: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
        n = len(documents)
        best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        if len(scores):
            row, member = members(list(scores["bits"]), scores["n"].to_numpy(), n)
            weight = np.int64(1) << scores["plane"].to_numpy().astype(np.int64)
            np.add.at(best, member, (weight * scores["best"].to_numpy())[row])
            np.add.at(total, member, (weight * scores["links"].to_numpy())[row])
        at = documents["at"].to_numpy()
        return documents.drop(columns=["block", "at"]).assign(n_best=best[at], count_sum=total[at])

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = f"doc_id {type_of(own, 'doc_id')}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return own.groupBy("block").cogroup(scored.groupBy("scored_block")).applyInPandas(add, schema).select(*names)
