"""Sections that only share a name are settled before the suffix sort."""

from __future__ import annotations

import random

import pytest
from test_texts import expected_cut

from roundscope.llm import dedup


def _prose(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def _found(spark, texts, width=dedup.WIDTH):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return sorted(map(tuple, dedup.kept_digests(rows, width=width).collect()))


def _expected(texts, width=dedup.WIDTH):
    return [(i, *e) for i, e in enumerate(expected_cut(texts, width))]


def test_a_short_shared_line_brings_nothing_to_the_sort(spark, monkeypatch):
    def none(width, memory):
        def step(frame):
            raise MemoryError(f"{len(frame)} sections sorted")

        return step

    monkeypatch.setattr(dedup, "_sort_shard", none)
    rng = random.Random(15)  # the line holds a gram of a small hash, which names windows of every text
    line = _prose(rng, 120)
    texts = [_prose(rng, 300) + line + _prose(rng, 300) for _ in range(60)]
    texts += [texts[0], texts[1], "short", ""]  # whole copies need no sort either
    assert _found(spark, texts) == _expected(texts)


@pytest.mark.parametrize("width", [16, 17, 40, 41, 400])
def test_passages_around_the_width(spark, width):
    """Passages just below, at and above the width, at both ends of texts, in copies, and held twice by a text."""
    rng = random.Random(width)
    passage = _prose(rng, 3 * width + 40)
    texts = []
    for n in (width - 1, width, width + 1, 2 * width):
        at = rng.randrange(width)
        part = passage[at : at + n]
        texts += [_prose(rng, rng.randint(0, width)) + part + _prose(rng, rng.randint(0, width)) for _ in range(4)]
        texts += [part, part + _prose(rng, 20), _prose(rng, 20) + part, part + _prose(rng, 5) + part]
    texts += [texts[2], texts[3], "ab" * width, "a" * (2 * width), passage, None]
    assert _found(spark, texts, width) == _expected(texts, width)
