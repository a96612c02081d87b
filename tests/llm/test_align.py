"""Alignment of tokenizers against whole-text encoding and all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from roundscope.llm import align

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def expected(models, texts):
    """For each text: sizes, links as a count of pairs, the groups' hash; by spans of whole texts."""
    a_tok, b_tok = Tokenizer.from_str(models[0]), sentencepiece.SentencePieceProcessor(model_proto=models[1])
    a_tok.encode_special_tokens = True
    alphabet, vocabulary = align.byte_alphabet(), {i: t for t, i in a_tok.get_vocab().items()}
    out = []
    for text in texts:
        target = (" " + (text or "")).encode()
        a_ids, b_ids = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids, b_tok.encode(text or "")
        a = [bytes(alphabet[c] for c in vocabulary[i]) for i in a_ids]
        pieces = [b_tok.id_to_piece(i) for i in b_ids]
        b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
        if not text or b"".join(a) != target or b"".join(b) != target:
            out.append((0, 0, 0, Counter(), ""))
            continue
        a_ends, b_ends = np.cumsum([*map(len, a)]), np.cumsum([*map(len, b)])
        group_a, group_b = defaultdict(list), defaultdict(list)
        common = np.intersect1d(a_ends, b_ends)
        for ids, ends, groups in ((a_ids, a_ends, group_a), (b_ids, b_ends, group_b)):
            for i, end in zip(ids, ends):
                groups[int(np.searchsorted(common, end))].append(i)
        links = Counter()
        for i in range(len(a)):
            first, last = np.searchsorted(b_ends, a_ends[i] - len(a[i]), side="right"), np.searchsorted(b_ends, a_ends[i], side="left")
            links.update((a_ids[i], b_ids[j]) for j in range(first, last + 1))
        shown = ";".join(",".join(map(str, group_a[g])) + "|" + ",".join(map(str, group_b[g])) for g in range(len(common)))
        out.append((len(a), len(b), len(common), links, hashlib.sha256(shown.encode()).hexdigest()))
    counts, most = Counter(), Counter()
    for *_, links, _ in out:
        counts.update(links)
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = [
        (n_a, n_b, groups, sum(links.values()), sum(n for p, n in links.items() if counts[p] == most[p[1]]), sum(n * counts[p] for p, n in links.items()), shown)
        for n_a, n_b, groups, links, shown in out
    ]
    docs_of = Counter(p for *_, links, _ in out for p in links)
    return rows, {p: (docs_of[p], n, n == most[p[1]]) for p, n in counts.items()}


ODD = ["", None, "a▁b", " lead  two\n\n x ", "tab\tq 　z <|endoftext|> <s>", "x\0y", "  ", "é" * 300, "日本語 テキスト", "don't we're 12345 ... !!", "a b  c", "word " * 3000, "👩‍👩‍👧 ok"]


def values(row):
    return (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256)


def test_against_whole_texts(spark, models, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()] + ODD + ODD[-2:]
    rows, pairs = expected(models, texts)
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(texts)], "doc_id long, text string, block string, pair int").repartition(5)
    found = {r.doc_id: values(r) for r in align.align(docs, *models).collect()}
    assert found == dict(enumerate(rows))
    _, postings = align.tables(docs, *models)
    counted = {(r.a_id, r.b_id): (r.n_docs, r.n_links, r.best) for r in align.pair_counts(postings).collect()}
    assert counted == pairs


def test_blocks_and_cache(models, monkeypatch):
    """A cache that starts anew and blocks of a few documents change nothing."""
    texts = ["one two  three", "one one one", "", "two\nthree four"] * 3
    monkeypatch.setattr(align, "CACHE_CHUNKS", 2)
    small, large = align.Pairs(*models), align.Pairs(*models)
    import pandas as pd

    parts = [next(align.block_rows(small, pd.Series(range(2)), texts[k : k + 2])) for k in range(0, 12, 2)]
    whole = next(align.block_rows(large, pd.Series(range(12)), texts))
    columns = align.DOC_COLUMNS[3:]
    assert [r for p in parts for r in p[columns].to_records(index=False).tolist()] == whole[columns].to_records(index=False).tolist()


def test_containers():
    rng = np.random.default_rng(5)
    for n in (1, 7, 8, 100, 70_000 % 65_536):
        sets = {p: np.sort(rng.choice(n, size=rng.integers(1, n + 1), replace=False)) for p in range(30)}
        pair, member = np.concatenate([np.full(len(s), p) for p, s in sets.items()]), np.concatenate(list(sets.values()))
        packed = list(align.containers(pair, member, n))
        assert all(len(bits) <= max(2 * count, -(-n // 8)) for _, count, bits in packed)
        row, found = align.members([b for *_, b in packed], np.array([c for _, c, _ in packed]), n)
        assert {p: sorted(found[row == k]) for k, (p, *_) in enumerate(packed)} == {p: s.tolist() for p, s in sets.items()}


def test_chunks():
    assert align.chunks("a b\nc") == ["a", "b\nc"]
    assert align.chunks(" a  b \n c d") == [" a  b \n c", "d"]


def test_edges(spark, models):
    schema = "doc_id long, text string, at string"
    rows = [(None, "same text", "x"), (1, "same text", None), (1, "same text", None), (2, None, None)]
    found = sorted((r.doc_id or 0, *values(r)) for r in align.align(spark.createDataFrame(rows, schema), *models).collect())
    assert [f[0] for f in found] == [0, 1, 1, 2] and len({f[1:] for f in found[:3]}) == 1
    assert found[3][1:] == (0, 0, 0, 0, 0, 0, "")
    assert align.align(spark.createDataFrame([], schema), *models).collect() == []
