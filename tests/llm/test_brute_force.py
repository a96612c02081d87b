"""Scores of the fitted models against plain loops, and their memory."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from roundscope.llm import classifier, language, toxicity

WORDS = "river stone green walk light paper house seven cloud morning garden winter table street music".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", ",", "!", "ß", "é"]) for _ in range(n))


TEXTS = [prose(random.Random(i), n) for i, n in enumerate((1, 3, 40, 200, 900))] + ["", "a", "日本語テキスト", " \n\t "]


def test_classifier(spark):
    rng = random.Random(1)
    rows = [(prose(rng, 60) if y else prose(rng, 60).upper(), y) for y in [0, 1] * 30]
    net = classifier.fit(pd.DataFrame(rows, columns=["text", "label"]), {0: 30, 1: 30})
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in classifier.score(docs, net).collect()}
    for i, text in enumerate(TEXTS):
        data = list(text.encode())
        best = [-math.inf] * classifier.FILTERS
        at = 0
        while True:  # chunks of the width at every stride, until one reaches the end
            chunk = data[at : at + classifier.WIDTH]
            chunk += [classifier.PAD] * (classifier.WIDTH - len(chunk))
            inputs = np.concatenate([net.embed[b] for b in chunk]).astype(np.float64)
            for f in range(classifier.FILTERS):
                best[f] = max(best[f], float(inputs @ net.filters[:, f] + net.bias[f]))
            if at + classifier.WIDTH >= len(data):
                break
            at += classifier.STRIDE
        z = sum(max(0.0, b) * float(w) for b, w in zip(best, net.out)) + net.out_bias
        assert found[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_toxicity(spark):
    rng = random.Random(2)
    rows = [(prose(rng, 80) + (" scumbag idiotic worthlessness" if y else ""), y) for y in [0, 0, 0, 1] * 60]
    model = toxicity.fit(pd.DataFrame(rows, columns=["text", "label"]), {0: 180, 1: 60})
    texts = [*TEXTS, "you idiotic scumbag " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, text in enumerate(texts):
        data = b" " + b" ".join(text.lower().encode().split()) + b" "
        savings, at = [], 0
        while True:
            window = data[at : at + toxicity.WINDOW]
            sizes = [len(toxicity.compressor(d).compress(window)) for d in (model.ordinary, model.toxic)]
            savings.append(sizes[0] - sizes[1])
            if at + toxicity.WINDOW >= len(data):
                break
            at += toxicity.STEP
        greatest = [max(0, s) for s in (sorted(savings, reverse=True) + [0] * 4)[:4]]
        many = sum(s >= toxicity.LEAST_SAVED for s in savings)
        inputs = [1.0, *greatest, math.log(1 + many), sum(s for s in savings if s > 0) / len(savings), math.log(len(savings))]
        z = sum(x * w for x, w in zip(inputs, model.weights))
        assert found[i] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)
    assert zstandard.ZstdCompressor  # the sizes above come from the trained dictionaries alone


def bundle(text, dimensions):
    """Bound trigrams of words between gaps, added one by one."""
    total = np.zeros(dimensions)
    words, own = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            own += c
        elif own:
            words.append(own)
            own = ""
    for word in words:
        codes = [0, *map(ord, word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            vectors = [language.letter_vector(x, dimensions).astype(int) for x in (a, b, c)]
            total += np.roll(vectors[0], 2) * np.roll(vectors[1], 1) * vectors[2]
    return total


@pytest.mark.parametrize("step", [16_000, 5])
def test_language(spark, monkeypatch, step):
    monkeypatch.setattr(language, "STEP_GRAMS", step)
    rng = random.Random(3)
    letters = {"aa": "abcdeil ", "bb": "mnoprstu ", "cc": "дефгиклм "}
    rows = [(i, "".join(rng.choice(letters[x]) for _ in range(rng.randint(5, 60))), x) for i, x in enumerate(["aa", "bb", "cc"] * 8)]
    docs = spark.createDataFrame([*rows, *[(100 + i, t, None) for i, t in enumerate(TEXTS)]], "doc_id long, text string, lang string")
    learned = language.prototypes(docs, F.col("doc_id") % 4 != 2)
    expected = {x: sum(bundle(t, language.DIMENSIONS) for i, t, y in rows if y == x and i % 4 != 2) for x in letters}
    assert {x: v.tolist() for x, v in learned.items()} == {x: v.tolist() for x, v in expected.items()}
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, learned).collect()}
    for i, text, *_ in [*rows, *[(100 + i, t) for i, t in enumerate(TEXTS)]]:
        own = bundle(text, language.DIMENSIONS)
        if not any(c.isalpha() for c in text):
            assert found[i] == ("und", 0.0)
            continue
        cosines = {x: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for x, v in expected.items()}
        best = max(cosines.values())
        assert found[i][1] == pytest.approx(max(0, best), abs=1e-5)
        assert cosines[found[i][0]] == pytest.approx(best, abs=1e-5)


def test_many_trigrams_stay_within_memory():
    """A text of 300,000 distinct trigrams: vectors are made in blocks."""
    rng = random.Random(4)
    text = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300_000))
    letters = language.Letters(language.DIMENSIONS)
    language.bundles([text[:100_000]], letters)  # letters are drawn once
    tracemalloc.start()
    whole, _ = language.bundles([text], letters)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    parts, _ = language.bundles([text[:150_000], text[150_000:]], letters)
    assert np.abs(whole[0] - parts.sum(axis=0)).max() <= 4  # the trigrams at the seam
