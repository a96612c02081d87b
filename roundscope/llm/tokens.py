"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

1. Texts are cut into pre-tokens (words) block by block. A document keeps the places of its words as numbers within
   its block; a block hands on each of its distinct words once, packed by a hash of the word.
2. The words of all blocks are shuffled by that hash, so that equal words meet; each distinct word is encoded once,
   by joining pairs of least rank, and its ids go back to every block that holds it.
3. Blocks and ids are joined, and each document is put together by its places. Blocks are stored in buckets, so
   only the ids move.
4. Decoding takes a document's whole sequence of ids, looks each id up in the table of token bytes, which every task has
   by broadcast, and puts the bytes together in the order of the ids. ``decode`` does the same for a table of ids.

A frequent word is handed on once per block, whatever its count, and a block is bounded by its characters of text (a
single longer text is a block by itself), so no step gathers what grows with the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundscope.llm.common import frames_by_bytes, text_rows, type_of
from roundscope.session import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of text in a block.
BLOCK_CHARS = 12_000_000
#: Ids that are written out and decoded in one step.
STEP_IDS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank is joined until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        least, at = min(((ranks.get(a + b, sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
        if least == sys.maxsize:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def encode_long_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``encode_word``, in time that grows with n log n: candidates wait in a heap, joined parts in a linked list."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else n
            if b < n and (r := ranks.get(word[a : end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative int32 numbers as compressed bytes, low bytes first of all, then the higher ones."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


class WordNumbers:
    """Numbers the pre-tokens of a block as they are met.

    Before a single blank in front of a visible character a pre-token always ends, whatever stands around it, so the
    pieces between such blanks are looked up whole.
    """

    def __init__(self, find):
        self.find, self.numbers, self.pieces = find, {}, {}

    def _number(self, text: str) -> list[int]:
        numbers = self.numbers
        return [numbers.setdefault(w, len(numbers)) for w in self.find(text)]

    def places(self, text: str) -> list[int]:
        if _UNCUT.search(text):
            return self._number(text)
        first, *rest = text.split(" ")
        at, known = self._number(first), self.pieces
        for piece in rest:
            found = known.get(piece)
            if found is None:
                found = known[piece] = self._number(" " + piece)
            at += found
        return at


#: A blank that white space or nothing follows: such texts are cut as a whole.
_UNCUT = regex.compile(r" (?:\s|$)")


def pack_lists(parts: list[bytes]) -> bytes:
    """Byte strings, each after its length, compressed."""
    lengths = np.array([len(p) for p in parts], dtype="<u4")
    return zstandard.compress(np.array([len(parts)], dtype="<u4").tobytes() + lengths.tobytes() + b"".join(parts), 3)


def unpack_lists(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(data, "<u4", n, 4)) + 4 * (n + 1)).tolist()
    return [data[a:b] for a, b in zip([4 * (n + 1), *ends], ends)]


def word_places(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored table, in buckets of whole blocks, of two kinds of rows.

    Documents: block, doc_id, places (``pack``). Words: block, part (a hash of the words), first (number of the first
    one), words (``pack_lists``). Blocks have random names, which the stored table settles once for all that reads it.
    """
    spark, rows = docs.sparkSession, text_rows(docs, id_col, text_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(frame: pd.DataFrame, find) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The rows of a block: its documents and its words."""
        block, met = uuid.uuid4().int >> 65, WordNumbers(find)
        places = [np.array(met.places(text), dtype=np.int32) for text in frame["text"]]
        words = [w.encode() for w in met.numbers]
        part = np.array([zlib.crc32(w) % parts for w in words], dtype=np.int64)
        order = np.argsort(part, kind="stable")
        number = np.empty(len(words), dtype=np.int32)
        number[order] = np.arange(len(words), dtype=np.int32)
        packed = [pack(number[p]) for p in places]
        part = part[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
        lists = [pack_lists([words[i] for i in order[a:b]]) for a, b in zip(starts, np.r_[starts[1:], len(part)])]
        documents = {"block": block, "doc_id": frame["doc_id"], "places": packed, "part": None, "first": None, "words": None}
        spelled = {"block": block, "doc_id": None, "places": None, "part": part[starts], "first": starts, "words": lists}
        return pd.DataFrame(documents), pd.DataFrame(spelled)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = regex.compile(pattern).findall
        for frame in frames_by_bytes(batches, BLOCK_CHARS):
            yield from cut(frame, find)

    schema = f"block long, doc_id {type_of(rows, 'doc_id')}, places binary, part int, first int, words binary"
    name = f"blocks_{uuid.uuid4().hex}"
    writer = rows.mapInPandas(step, schema).write.bucketBy(parts, "block").option("path", new_folder(spark, "blocks"))
    writer.saveAsTable(name)
    return spark.table(name)


def encode_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(owner, first, ids): rows of (block, part, first, words) with the words' ids as little-endian int32.

    Equal words have one part and meet in one task, where the first one is encoded.
    """
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, known = shared.value, {}
        for frame in batches:
            out = []
            for data in frame["words"]:
                listed = unpack_lists(data)
                for word in listed:
                    if word not in known:
                        ids = (encode_word if len(word) < 64 else encode_long_word)(word, table)
                        known[word] = np.array(ids, dtype="<i4").tobytes()
                out.append(pack_lists([known[word] for word in listed]))
            yield pd.DataFrame({"owner": frame["block"], "first": frame["first"], "ids": out})

    dealt = words.select("block", "part", "first", "words").repartition("part")
    return dealt.mapInPandas(step, "owner long, first int, ids binary")


def token_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """(id, token): the table of token bytes. Its size is that of the vocabulary."""
    frame = pd.DataFrame({"id": list(ranks.values()), "token": list(ranks)})
    return spark.createDataFrame(frame, "id int, token binary")


def decode(rows: DataFrame, tokens: DataFrame, key: str, ids: str = "ids") -> DataFrame:
    """(key, decoded): bytes of each row's array of ids, joined in the order of the ids; keys must be unique.

    Rows without ids give empty bytes. ``tokens`` is broadcast: it has a row per entry of the vocabulary.
    """
    one = rows.select(F.col(key), F.posexplode(ids).alias("at", "id")).join(F.broadcast(tokens), "id", "left")
    parts = F.sort_array(F.collect_list(F.struct("at", F.hex("token").alias("bytes"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda p: p["bytes"]), ""))
    found = one.groupBy(key).agg(joined.alias("decoded"))
    return rows.select(key).join(found, key, "left").select(key, F.coalesce("decoded", F.unhex(F.lit(""))).alias("decoded"))


def document_ids(numbers: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The ids of a document with these word numbers; word k of the block has ``ids[bounds[k] : bounds[k + 1]]``."""
    begin = bounds[numbers]
    count = bounds[numbers + 1] - begin
    return ids[np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())]


def spelled(ids: list[int], token: dict[int, bytes]) -> bytes:
    """The bytes of a sequence of ids."""
    return b"".join([token[i] for i in ids])


def coded_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, reader, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode whole texts: doc_id and the ``schema`` columns, one row per row of ``docs``.

    ``reader(token)`` gets the bytes of each id and returns a function from the ids of a document, in order, to the
    tuple of its ``schema`` columns. Null and empty texts have no ids; repeated rows are coded alike and all stay;
    other columns are not read; an empty table gives no rows.
    """
    table = word_places(docs, pattern, id_col, text_col)
    coded = encode_words(table.where("words is not null"), ranks)
    texts = table.where("places is not null").select("block", "doc_id", "places")
    # The table of token bytes: as large as the vocabulary, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast({i: token for token, i in ranks.items()})
    names = ["doc_id", *[c.split()[0] for c in schema.split(",")]]

    def assemble(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        packed = right["ids"].to_numpy()[np.argsort(right["first"].to_numpy(dtype=np.int64))]
        flat, counts = [np.empty(0, dtype="<i4")], [np.zeros(1, dtype=np.int64)]
        for data in packed:
            words = unpack_lists(data)
            flat.append(np.frombuffer(b"".join(words), dtype="<i4"))
            counts.append(np.array([len(w) // 4 for w in words], dtype=np.int64))
        ids, bounds, finish = np.concatenate(flat), np.cumsum(np.concatenate(counts)), reader(shared.value)
        rows = [(doc_id, *finish(document_ids(unpack(places), ids, bounds))) for doc_id, places in zip(left["doc_id"], left["places"])]
        return pd.DataFrame(rows, columns=names)

    return texts.groupBy("block").cogroup(coded.groupBy("owner")).applyInPandas(assemble, f"doc_id {type_of(texts, 'doc_id')}, {schema}")


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of whole texts."""

    def reader(token):
        def finish(ids: np.ndarray) -> tuple:
            listed = ids.tolist()
            return listed, spelled(listed, token)

        return finish

    return coded_documents(docs, ranks, pattern, reader, "ids array<int>, decoded binary", id_col, text_col)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts; ids are hashed as decimals joined by a space."""

    def reader(token):
        shown = {i: b" %d" % i for i in token}

        def finish(ids: np.ndarray) -> tuple:
            listed, decoded = hashlib.sha256(), hashlib.sha256()
            for a in range(0, len(ids), STEP_IDS):
                part = ids[a : a + STEP_IDS].tolist()
                listed.update(b"".join([shown[i] for i in part])[0 if a else 1 :])
                decoded.update(spelled(part, token))
            return len(ids), listed.hexdigest(), decoded.hexdigest()

        return finish

    return coded_documents(docs, ranks, pattern, reader, "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)
