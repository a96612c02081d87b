"""The pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from roundscope.llm import simhash, toxicity  # noqa: E402
from roundscope.session import stored  # noqa: E402
from test_links import components, expected_print  # noqa: E402
from test_texts import check_places, expected_cut  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def prose(rng, lines=8):
    word = lambda: "".join(rng.choice("abcdeghilmnoprstu") for _ in range(rng.randint(3, 9)))
    return "\n".join(" ".join(word() for _ in range(12)).capitalize() + "." for _ in range(lines))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    texts, toxic = [], {}
    for i in range(240):
        text = prose(rng)
        if i % 3 == 0:
            for _ in range(4):
                at = rng.choice([k for k, c in enumerate(text) if c == " "])
                text = text[:at] + rng.choice([" scumbag", " idiotic", " worthlessness"]) + text[at:]
        toxic[i] = int(i % 3 == 0)
        texts.append(text)
    passage = prose(rng, 6)
    kinds = {"copy": [], "near": [], "passage": [], "junk": [], "empty": []}
    for kind, made in (
        ("copy", [texts[1]] * 3),
        ("near", [texts[2].replace(".", ",", 1)]),
        ("passage", [prose(rng, 7) + "\n" + passage + "\n" + prose(rng, 7) for _ in range(4)]),
        ("junk", ["BUY!! NOW!! " * 60, "a%%% b### " * 60, "Home | About | Help\n" * 40]),
        ("empty", [None, ""]),
    ):
        for text in made:
            kinds[kind].append(len(texts))
            texts.append(text)
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, kinds, toxic, passage


def test_stages(spark, corpus):
    folder, kinds, toxic, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        source, docs = docs, stored(stage(spark, docs, folder))
        if name != "packing":
            assert docs.columns == source.columns
        kept[name] = (before, docs)
    ids = {name: {r.doc_id for r in docs.select("doc_id").distinct().collect()} for name, (_, docs) in kept.items()}

    lost = set(kept["toxicity"][0]) - ids["toxicity"]
    marked = {i for i, y in toxic.items() if y}
    assert len(lost & marked) > 0.9 * len(marked) and len(lost - marked) < 0.05 * len(kept["toxicity"][0])

    gone = set(kept["quality_rules"][0]) - ids["quality_rules"]
    assert gone == {*kinds["junk"], *kinds["empty"]} & ids["toxicity"]

    before = kept["simhash_dedup"][0]
    order = sorted(before)
    prints = np.array([expected_print(before[i]) for i in order], dtype=np.uint64)
    groups = components(len(order), lambda i: map(int, np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= simhash.RADIUS)))
    assert ids["simhash_dedup"] == {order[g] for g in groups}
    assert not ids["simhash_dedup"] & {*kinds["copy"]}

    before, docs = kept["suffix_dedup"]
    order = sorted(before)
    expected = dict(zip(order, expected_cut([before[i] for i in order], corpus_pipeline.PASSAGE_BYTES)))
    after = {r.doc_id: r for r in docs.collect()}
    assert {i: len(r.text.encode()) for i, r in after.items()} == {i: e[0] - e[1] for i, e in expected.items()}
    assert all(r.n_chars == len(r.text) for r in after.values())
    assert not any(passage in after[i].text for i in kinds["passage"])

    packed = kept["packing"][1].collect()
    assert {r.doc_id for r in packed} == ids["suffix_dedup"]
    check_places([r.asDict() for r in packed], 4096)


def test_run_on_tables_without_rows(spark, corpus, tmp_path):
    folder = corpus[0]
    for table in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert toxicity.THRESHOLD == 0.3
