"""Repeated strings, tokens, packing, fingerprints and line rules against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from roundscope.llm import dedup, fingerprints, packing, quality, queries, suffixes, tokens
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, start string, n int, row int, packed int"


def table(spark, rows):
    """Documents with further columns whose names an operator could use itself."""
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], SCHEMA).repartition(3)


# --- suffixes -------------------------------------------------------------------------------


@pytest.mark.parametrize("memory", [4, 12, 10**6])
def test_sorted_suffixes(tmp_path, memory):
    rng = random.Random(memory)
    for _ in range(150):
        text = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 50))]
        text = (text[: max(1, len(text) // 3)] * 4)[: len(text)] if rng.random() < 0.4 else text
        text = np.array([*text, 0], dtype=np.uint16)
        order = sorted(range(len(text)), key=lambda i: tuple(text[i:]))
        common = [0] + [next(k for k in range(len(text)) if text[a + k] != text[b + k]) for a, b in zip(order, order[1:])]
        found = list(suffixes.sorted_suffixes(text, 1000, str(tmp_path), memory))
        assert np.concatenate([p for p, _ in found]).tolist() == order
        assert np.concatenate([x for _, x in found]).tolist() == common


def expected_cut(texts, width):
    data = [(t or "").encode() for t in texts]
    met = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, dtype=bool)
        for i in range(len(d) - width + 1):
            if met[d[i : i + width]] > 1:
                gone[1 + i : 1 + i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(x for x, g in zip(d, gone[1:]) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_go(spark):
    rng = random.Random(1)
    prose = lambda n: "".join(rng.choice("abcdé ñ") for _ in range(n))
    passage, line = prose(600), prose(120)
    texts = [prose(300) + passage + prose(200), passage[20:] + prose(90), prose(50) + line + prose(500), prose(400) + line + prose(50)]
    texts += [prose(700)] * 3 + ["x" * 900, "ab" * 500, None, "", "short", passage[:150] * 5, prose(30) + texts[0][200:700]]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[1])]
    found = dedup.kept_digests(table(spark, rows), memory=500)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(i, *e) for (i, _), e in zip(rows, expected_cut([t for _, t in rows], 400))], key=str)
    cut = dedup.with_repeats_cut(table(spark, rows))
    assert cut.columns == SCHEMA.replace(",", "").split()[::2]
    assert cut.where("text is null").count() == 1
    assert dedup.kept_digests(table(spark, rows).limit(0)).count() == 0


def test_texts_are_cut_into_slabs(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SLAB", 1 << 10)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, long), (2, long[1000:5000] + "z"), (3, "q" * 3000)]
    found = dedup.kept_digests(table(spark, rows))
    assert sorted(map(tuple, found.collect())) == [(i, *e) for (i, _), e in zip(rows, expected_cut([t for _, t in rows], 400))]


def test_shared_passage_is_spread_over_shards(spark, monkeypatch):
    """No shard that is sorted gets all the sections of a passage that many documents hold."""
    limit, sort = 30_000, suffixes.repeated_starts

    def bounded(parts, *rest):
        if sum(map(len, parts)) > 3 * limit:
            raise MemoryError(f"{sum(map(len, parts))} bytes in a shard")
        return sort(parts, *rest)

    monkeypatch.setattr(dedup, "SHARD_BYTES", limit)
    monkeypatch.setattr(suffixes, "repeated_starts", bounded)
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, other = prose(410), prose(700)
    texts = [prose(rng.randint(60, 150)) + passage + prose(rng.randint(0, 150)) for _ in range(600)]
    texts += [prose(40) + passage[:390] + prose(200), prose(30) + other + prose(20), other[200:] + passage, texts[0][5:], (passage + " ") * 2]
    rows = list(enumerate(texts)) + [(7, texts[7])]
    found = dedup.kept_digests(table(spark, rows))
    assert sorted(map(tuple, found.collect())) == sorted((i, *e) for (i, _), e in zip(rows, expected_cut([t for _, t in rows], 400)))


# --- tokens and packing ---------------------------------------------------------------------

ODD = [
    "Hello world's end", "  two  blanks ", "tab\t\tx \n\n y\n", "it's I'LL we've", "naïve 日本語 text😀 a", None, "", " ", "\n", "a" * 700, "x y" * 400,
    "no. 12345 67", "end \n", "line\n next", "<|endoftext|> <|startoftext|>", " nb  em", "é Ǆ ΣΑΣ", "0\x1c1 \x85z",
]


def test_tokens(spark):
    ranks = queries.byte_bpe_ranks()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*enumerate(ODD), (0, ODD[0]), (None, ODD[1])]
    expected = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    found = tokens.digests(table(spark, rows), ranks, public_tokenizers.PATTERN)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert tokens.digests(table(spark, rows).limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    coded = tokens.encode_documents(table(spark, rows[:5]), ranks, public_tokenizers.PATTERN)
    assert {r.doc_id: (r.ids, bytes(r.decoded)) for r in coded.collect()} == {i: (own.encode_ordinary(t), t.encode()) for i, t in rows[:5]}
    back = tokens.decode(coded.select("doc_id", "ids"), tokens.token_table(spark, ranks), "doc_id")
    assert {r.doc_id: bytes(r.decoded) for r in back.collect()} == {i: t.encode() for i, t in rows[:5]}


def test_decoded_hash_follows_the_ids(spark, monkeypatch):
    """What is decoded is a document's own sequence of ids: a fault in it shows in both hashes."""
    monkeypatch.setattr(tokens, "STEP_IDS", 3)
    ranks = queries.byte_bpe_ranks()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows, join = [*enumerate(ODD)], tokens.document_ids
    for step in (1, -1):
        monkeypatch.setattr(tokens, "document_ids", lambda *args: join(*args)[::step])  # noqa: B023
        found = {r.doc_id: tuple(r)[1:] for r in tokens.digests(table(spark, rows), ranks, public_tokenizers.PATTERN).collect()}
        for i, t in rows:
            ids = own.encode_ordinary(t or "")[::step]
            texts = " ".join(map(str, ids)).encode(), own.decode_bytes(ids)
            assert found[i] == (len(ids), *[hashlib.sha256(x).hexdigest() for x in texts])


def test_both_ways_of_joining_pairs_agree():
    ranks = queries.byte_bpe_ranks()
    rng = random.Random(4)
    for _ in range(200):
        word = "".join(rng.choice("abetion the") for _ in range(rng.randint(1, 80))).encode()
        assert tokens.encode_word(word, ranks) == tokens.encode_long_word(word, ranks)


def check_places(rows, capacity):
    groups = {}
    for r in rows:
        groups.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in groups.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(groups)


def test_packing(spark):
    text = queries.word_bpe_json()
    plain = Tokenizer.from_str(text)
    plain.encode_special_tokens = True
    rows = [*enumerate(ODD), (0, ODD[0]), (None, ODD[1])]
    expected = []
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected += [(i, k, a, len(ids[a : a + 50]), zlib.crc32(ids[a : a + 50].tobytes())) for k, a in enumerate(range(0, len(ids), 50))]
    found = packing.pack(table(spark, rows), text, capacity=50).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(expected, key=str)
    assert check_places(found, 50) >= -(-sum(r["length"] for r in found) // 50)
    assert packing.pack(table(spark, rows).limit(0), text).count() == 0


def first_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        at = next((i for i, r in enumerate(rooms) if r >= x), None)
        if at is None:
            rooms.append(capacity - x)
        else:
            rooms[at] -= x
    return len(rooms)


def optimum(lengths, capacity, rooms=()):
    if not lengths:
        return len(rooms)
    x, rest = lengths[0], lengths[1:]
    tried = {r: i for i, r in enumerate(rooms) if r >= x}
    found = [optimum(rest, capacity, (*rooms[:i], r - x, *rooms[i + 1 :])) for r, i in tried.items()]
    return min([*found, optimum(rest, capacity, (*rooms, capacity - x))])


def test_plans_are_valid_and_dominance_keeps_the_optimum():
    rng = random.Random(9)
    for case in range(300):
        capacity = rng.choice([10, 17, 30])
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 8 if case % 2 else 60)))
        left = dict(counts)
        fixed = packing.reduce_by_dominance(left, capacity)
        used = Counter(left)
        for n, runs in fixed:
            assert sum(x * k for x, k in runs) <= capacity
            for x, k in runs:
                used[x] += n * k
        assert used == counts
        lengths = sorted(counts.elements(), reverse=True)
        if case % 2:
            assert sum(n for n, _ in fixed) + optimum(tuple(sorted(Counter(left).elements(), reverse=True)), capacity) == optimum(tuple(lengths), capacity)
        runs = packing.plan(dict(counts), capacity)
        sequences = fixed + packing.best_fit(left, capacity)
        assert all(sum(x * k for x, k in r) <= capacity for _, r in sequences)
        assert Counter({x: sum(n * k for n, r in sequences for y, k in r if y == x) for x in counts}) == counts
        assert sum(n for n, _ in sequences) <= first_fit(lengths, capacity) + 1
        assert len(runs) >= len(counts)


# --- fingerprints and line rules ------------------------------------------------------------


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def test_fingerprints(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    texts = [" ".join(word() for _ in range(rng.randint(300, 900))) for _ in range(12)]
    texts += [texts[0], texts[1] + " tail", None, "", "one", "two words", "é" * 7 + " ñ" * 400]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    found = fingerprints.edited(table(spark, rows)).select(
        "doc_id", "n_chars", "edited_text", "packed", fingerprints.likeness(F.col("packed"), F.col("edited_packed")), fingerprints.likeness(F.col("packed"), F.col("next_packed"))
    ).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: tuple(r) for r in found}
    order = sorted({i: t or "" for i, t in rows}.items(), reverse=True)
    worst = []
    for k, (i, t) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + follow[:half]
        assert by_id[i][1:3] == (len(t), changed)
        for other, near in ((changed, by_id[i][4]), (follow, by_id[i][5])):
            a, b = shingles(t), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            worst.append(abs(near - true))
            assert 0 <= near <= 1
            if a == b:
                assert near == 1
    assert max(worst) < 0.25 and np.mean(worst) < 0.05
    assert len({bytes(by_id[i][3]) for i, t in rows if t == texts[0]}) == 1
    assert fingerprints.edited(table(spark, rows).limit(0)).count() == 0


_WORDS = random.Random(7)
CLEAN = "\n".join(" ".join("".join(_WORDS.choice("abcdefgh") for _ in range(4)) for _ in range(12)).capitalize() + "." for _ in range(9))


def test_line_rules(spark):
    menu = "Home | About | Contact | Help\n" * 9
    texts = [
        CLEAN, CLEAN + "\nHome | Login | Help", menu + CLEAN[:300], "BUY!! NOW!! " * 40, "a%% b## c** " * 30, None, "", " \n\t", "one two three one two three", CLEAN + "\n" + CLEAN,
        "\n".join(["Accept all cookies to go on."] * 30), "x\x0bу\x0cz\r\n#|<>&%$*", "w " * 30000,
    ]
    rows = list(enumerate(texts)) + [(0, CLEAN), (None, CLEAN)]
    found = {r.doc_id: r for r in quality.clean_lines(table(spark, rows)).collect()}
    for i, t in rows:
        t, r = t or "", found[i]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {p for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
    assert [i for i, r in found.items() if r.kept and i is not None] == [i for i in found if i in (0, 1)]
    assert found[1].clean_text == CLEAN
    kept = quality.keep_good(table(spark, rows))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["0", "0", "1", "None"]
    assert quality.keep_good(table(spark, rows).limit(0)).count() == 0


def test_windows_found_by_words(spark):
    rows = spark.createDataFrame([("a b c x a b c y b c y".split(),), (["p", "q"],)], "w array<string>")
    found = [r[0] for r in rows.where("size(w) > 3").select(quality.places_by_words(F.col("w"))).collect()]
    assert found == [[0, 4, 5, 8]] or found == [[0, 4]]
