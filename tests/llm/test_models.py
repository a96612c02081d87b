"""Fitted models: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from roundscope.llm import classifier, language, toxicity
from roundscope.llm.common import bounded_sample

WORDS = "river stone green walk light paper house seven cloud morning garden winter table street music".split()
INSULTS = "scumbag idiotic worthlessness".split()
ODD = [(1, None), (2, ""), (3, "   "), (3, "   "), (None, "plain words"), (5, "é" * 3000 + " 日本"), (6, "!!")]


def prose(rng, n, insults=0):
    words = [rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n)]
    for _ in range(insults):
        words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
    return " ".join(words)


def odd(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ODD], "doc_id long, text string, score string, label int")


def check_scores(frame):
    rows = frame.collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity(spark):
    rng = random.Random(1)
    texts = [(prose(rng, rng.randint(40, 120), 3 if i % 4 == 0 else 0), int(i % 4 == 0)) for i in range(480)]
    train, held = texts[:320], texts[320:]
    model = toxicity.fit(pd.DataFrame(train, columns=["text", "label"]), {0: 240, 1: 80})
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(held)], "doc_id long, text string")
    found = {r.doc_id: r.score >= toxicity.THRESHOLD for r in toxicity.score(docs, model).collect()}
    label = np.array([y for _, y in held], dtype=bool)
    guess = np.array([found[i] for i in range(len(held))])
    assert guess[label].mean() > 0.95 and guess[~label].mean() < 0.05
    kept = toxicity.drop_toxic(docs.withColumn("score", F.lit("mine")), model)
    assert kept.columns == ["doc_id", "text", "score"]
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(held)) if not guess[i]]
    check_scores(toxicity.score(odd(spark), model))
    assert toxicity.score(odd(spark).limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = pd.DataFrame({"text": pd.Series([], dtype=str), "label": pd.Series([], dtype=int)})
    check_scores(toxicity.score(odd(spark), toxicity.fit(empty, {})))
    check_scores(classifier.score(odd(spark), classifier.fit(empty, {})))
    assert {r.lang_pred for r in language.predict(odd(spark), {}).collect()} == {"und"}


def test_classifier(spark):
    rng = random.Random(2)
    texts = [(prose(rng, rng.randint(30, 200)) if i % 2 else prose(rng, rng.randint(30, 200)).upper().replace(" ", "!! "), i % 2) for i in range(300)]
    net = classifier.fit(pd.DataFrame(texts[:200], columns=["text", "label"]), {0: 100, 1: 100})
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts[200:])], "doc_id long, text string")
    found = {r.doc_id: r.score >= classifier.THRESHOLD for r in classifier.score(docs, net).collect()}
    assert np.mean([found[i] == bool(y) for i, (_, y) in enumerate(texts[200:])]) > 0.97
    check_scores(classifier.score(odd(spark), net))
    assert classifier.score(odd(spark).limit(0), net).count() == 0


def test_long_texts_are_scored_whole(monkeypatch):
    net = classifier.fit(pd.DataFrame({"text": ["aaa bbb", "XXX!! YYY!!"] * 20, "label": [1, 0] * 20}), {0: 20, 1: 20})
    rng = random.Random(3)
    texts = [prose(rng, 500), "", "a", prose(rng, 3), "x" * 4000 + "Z!! Q!!"]
    whole = classifier.score_texts(net, texts)
    monkeypatch.setattr(classifier, "STEP_CHARS", 128)
    assert np.allclose(whole, classifier.score_texts(net, texts), atol=1e-5)


def test_language(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdeil ", "bb": "mnoprstu ", "cc": "дефгиклм "}
    write = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randint(40, 300)))
    rows = [(i, write(x), x) for i, x in enumerate(rng.choice(list(letters)) for _ in range(200))]
    docs = spark.createDataFrame([(*r, 1.0) for r in [*rows, (900, None, "aa"), (901, "abc", None)]], "doc_id long, text string, lang string, score double").repartition(3)
    learned = language.prototypes(docs, F.col("doc_id") % 4 != 2)
    assert sorted(learned) == sorted(letters)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, learned).collect()}
    assert all(found[i][0] == x for i, _, x in rows)
    assert found[900] == ("und", 0.0)
    check_scores(language.predict(odd(spark), learned))
    strange = {r.doc_id: r.lang_pred for r in language.predict(odd(spark), learned).collect()}
    assert strange[2] == strange[3] == strange[6] == "und"
    assert language.predict(docs.limit(0), learned).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(60)] + [(0, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(5, 0), (None, 1)], "doc_id long, toxic int")
    sample = bounded_sample(docs, labels, "toxic", F.col("doc_id") % 3 != 0, 10, 100_000)
    assert sample.groupby("label").size().tolist() == [10, 10]
    assert len(bounded_sample(docs, labels, "toxic", F.col("doc_id") % 3 != 0, 10, 500)) == 0
