"""SimHash, components and URL filters against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from roundscope.llm import simhash, urls
from roundscope.llm.components import connected_components


def components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in linked(i):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def signed(x):
    return int(np.uint64(x).view(np.int64))


def test_flips_meet_for_every_pair():
    masks, ones = simhash.flip_masks()
    flips = {int(m) for m in masks}
    rng = random.Random(3)
    for _ in range(3000):
        a = rng.getrandbits(64)
        d = 0
        for b in rng.sample(range(64), rng.randint(1, 3)):
            d |= 1 << b

        def ball(x):
            return {x ^ m for m in (map(int, masks[1:ones]) if x.bit_count() % 2 else flips)}

        shared = ball(a) & ball(a ^ d)
        assert any(min((a ^ v).bit_count(), (a ^ d ^ v).bit_count()) <= 1 for v in shared)


def test_links_join_all_near_fingerprints(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(300):  # chains and clusters
        x = rng.choice(prints)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        prints.append(x)
    prints = sorted({*prints, 0, 1})
    a = np.array(prints, dtype=np.uint64)
    expected = components(len(a), lambda i: map(int, np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 3)))
    frame = spark.createDataFrame([(signed(x),) for x in prints] * 2 + [(None,)], "simhash long")
    links = simhash.links(frame)
    assert all((np.uint64(np.int64(r.u)) ^ np.uint64(np.int64(r.v))).bit_count() <= 3 for r in links.collect())
    root = {r.node: r.root for r in connected_components(links).collect()}
    found = [root.get(signed(x), signed(x)) for x in prints]
    assert len(set(zip(expected, found))) == len(set(expected)) == len(set(found))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200), (202, 201)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 5 for i in range(5, 40)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def expected_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"word{i % 977}" for i in range(30000))
    rows = [(1, "A b C d"), (2, "a B c D"), (3, None), (4, ""), (5, " \t\n"), (6, "Ärger über"), (6, "Ärger über"), (None, "a b c d"), (8, long), (9, long + " end")]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, simhash string, component_id double")
    found = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert [r[1] for r in sorted(found, key=lambda r: (r[0] is None, r[0] or 0))] == [signed(expected_print(t)) for _, t in rows if _] + [signed(expected_print("a b c d"))]
    near = {r[0]: r[2] for r in found}
    assert near == {1: 1, 2: 1, None: 1, 3: 3, 4: 3, 5: 3, 6: 6, 8: 8, 9: 8}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8]
    assert simhash.keep_one(docs.limit(0)).count() == 0


PAGES = [
    (1, "http://A.bad.net/x", None),
    (2, "https://ok.com/start?utm_source=f&a=1#t", '<LINK href="http://a.bad.net/x" rel="canonical">'),
    (3, "http://ok.com/start?a=1", ""),
    (4, "http://far.com/", "<meta http-equiv='refresh' content='0; url=http://ok.com/start?a=1'>"),
    (5, "http://good.example.net/en/1", '<link rel=canonical href="http://a.bad.net/x">'),
    (6, "http://lone.com", "<link rel='stylesheet' href='http://a.bad.net/x'>"),
    (7, None, "<link rel=canonical href='http://a.bad.net/x'>"),
    (8, "no scheme", None),
    (9, "http://rel.com/a/b", "<link rel=canonical href='c'>"),
    (10, "http://rel.com/a/c", "<meta http-equiv=refresh content='5;URL=//x.net/'>"),
    (10, "http://rel.com/a/c", None),
    (11, "http://example.net.org/fr/", None),
]


def test_urls(spark):
    rules = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
    pages = spark.createDataFrame([(*p, "r", 1) for p in PAGES], "page_id long, url string, html string, rule string, root int")
    found = sorted((tuple(r) for r in urls.judge(pages, rules).collect()), key=str)
    assert sorted(found, key=lambda r: r[0]) == [
        (1, "a.bad.net", "/x", "net/", "block"),
        (2, "ok.com", "/start", None, "block"),
        (3, "ok.com", "/start", None, "block"),
        (4, "far.com", "/", None, "block"),
        (5, "good.example.net", "/en/1", "example.net/en/", "allow"),
        (6, "lone.com", "", None, "allow"),
        (7, "", "", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "rel.com", "/a/b", None, "block"),
        (10, "rel.com", "/a/c", None, "block"),
        (10, "rel.com", "/a/c", None, "block"),
        (11, "example.net.org", "/fr/", "org/fr/", "allow"),
    ]
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_radius_is_bounded(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "simhash long"), 4)
