"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from roundscope.llm import lexical

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def expected(docs, items, top=20):
    """(item, rank, doc, score) by scoring every document."""
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts, n in held:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = 0
            for term, repeats in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if tf := counts.get(term):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += repeats * w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc))
        out += [(item, rank + 1, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out)


def found(spark, docs, items, parts=4, top=20):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item string, rank int").repartition(parts)
    return sorted(map(tuple, lexical.search(lexical.build(frame), spark.createDataFrame(items, "item_id long, text string"), top).collect()))


def test_terms():
    for text in ["Hello, Wörld_x 12 ÀB\x7f\x80", "", "日本 ١٢ a-b", "A" * 5 + "\n\tb\x1fc", "’s"]:
        assert [t.decode() for t in lexical.terms(text)] == TERM.findall(text.translate(LOWER))


def test_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found(spark, docs, items) == expected(docs, items)


@pytest.mark.parametrize("block_chars, wave", [(300, 256), (5_000, 1), (10**6, 3)])
def test_ties_copies_and_blocks(spark, monkeypatch, block_chars, wave):
    """Many equal scores across blocks and tasks; small blocks and waves."""
    monkeypatch.setattr(lexical, "BLOCK_CHARS", block_chars)
    monkeypatch.setattr(lexical, "WAVE", wave)
    rng = random.Random(block_chars)
    words = [f"w{i}" for i in range(40)]
    docs = [(1000 - i, " ".join(rng.choices(words, weights=range(1, 41), k=rng.randint(0, 30)))) for i in range(300)]
    docs += [(2000 + i, "w1 w2 W3, w3") for i in range(60)] + [(5000, None), (5001, "... !!"), (5002, "w0 " * 5000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)] + [(50, "w1 w2 w3"), (51, "unheard of"), (52, None), (53, "w1 w1 w1 w39")]
    assert found(spark, docs, items) == expected(docs, items)
    assert found(spark, docs, items, parts=1, top=3) == expected(docs, items, top=3)


def test_bounds_hold():
    """A cell's maximum covers all impacts inside, at every level."""
    rng = random.Random(9)
    texts = [" ".join(f"t{min(rng.randint(0, 60), rng.randint(0, 60))}" for _ in range(rng.randint(0, 40))) for _ in range(50)]
    sizes = [len(t.split()) for t in texts]
    block = lexical.Block(lexical.build_block(texts, 50, sum(sizes)), 50, sum(sizes))
    best = lexical.impacts(block.tf, np.ones(len(block.tf), dtype=np.int64) * block.mass.min())
    assert all((tops >= 0).all() for tops in block.tops) and lexical.UNIT * block.tops[0].max() <= best.max() + lexical.UNIT
    for upper, mask, lower in zip(block.tops, block.masks, block.tops[1:]):
        parent = np.repeat(np.arange(len(mask)), lexical._BITS[mask])
        assert (np.maximum.reduceat(lower, np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])) == upper).all()


def test_few_blocks_in_memory(spark, monkeypatch):
    """A task writes its blocks in small row groups, however many it has, and they are stored packed."""
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(lexical, "GROUP_BYTES", 100_000, raising=False)
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{min(rng.randint(0, 3000), rng.randint(0, 3000))}" for _ in range(200))) for i in range(1000)]
    index = lexical.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    (file,) = index.blocks.inputFiles()
    groups = pq.ParquetFile(file.removeprefix("file://")).metadata
    groups = [groups.row_group(i) for i in range(groups.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 40 and len(groups) > 4
    assert max(g.total_byte_size for g in groups) <= 120_000
    plain = [lexical.build_block([t for _, t in docs[i : i + 20]], index.documents, index.total) for i in range(0, 1000, 20)]
    assert sum(g.total_byte_size for g in groups) < 0.6 * sum(len(b"".join([*b.pop("masks"), *b.pop("falls"), *b.values()])) for b in plain)


def test_packed_blocks():
    """Rows come back one by one as they were, missing ids and empty parts too."""
    blocks = [lexical.build_block(texts, 5, 9) for texts in (["a b a", "b"], ["", "c d", "d"], ["e e e"])]
    ids = [[3, None], [1, 2, None], [7]]
    rows = lexical.unpacked(pa.RecordBatch.from_pylist([{"ids": i} | lexical.packed(b) for i, b in zip(ids, blocks)]))
    assert next(rows) == {"ids": ids[0]} | blocks[0]
    assert list(rows) == [{"ids": i} | b for i, b in zip(ids[1:], blocks[1:])]


def test_slices_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2)
    docs = [(i, f"alpha beta{i % 3}") for i in range(30)]
    items = [(7, "alpha"), (7, "beta1"), (None, "beta2"), (8, "beta0 alpha"), (9, "")]
    rows = found(spark, docs, [i for i in items if i[0] in (8, 9)])
    assert rows == expected(docs, [(8, "beta0 alpha")])
    rows = lexical.search(lexical.build(spark.createDataFrame(docs, "doc_id long, text string")), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(Counter(r.item_id for r in rows).items(), key=str) == sorted([(7, 20 + 10), (8, 20), (None, 10)], key=str)


def test_edges(spark):
    docs, items = "doc_id long, text string, score string", "item_id long, text string, doc_id string"
    some = spark.createDataFrame([(None, "cat", "x"), (None, "cat", "x"), (3, "cat", "x"), (4, "", None), (5, None, None)], docs)
    query = spark.createDataFrame([(1, "cat", None)], items)
    empty_docs, empty_items = spark.createDataFrame([], docs), spark.createDataFrame([], items)
    assert [(r["rank"], r["doc_id"]) for r in lexical.search(lexical.build(some), query).orderBy("rank").collect()] == [(1, 3), (2, None), (3, None)]
    assert lexical.search(lexical.build(empty_docs), query).collect() == []
    assert lexical.search(lexical.build(some), empty_items).collect() == []
    assert lexical.search(lexical.build(empty_docs), empty_items).collect() == []
