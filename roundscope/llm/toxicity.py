"""Toxicity by compression distance.

One zstandard dictionary is trained on ordinary text; a second one also holds what sets toxic text apart. That part is
selected, not trained: dictionaries trained on toxic text find far fewer toxic texts (figures in the README). Every
window of a text is compressed with both; where the toxic one saves bytes, the window resembles toxic text. The
greatest savings of a text are turned into a probability by thresholds that are calibrated on labelled texts.

The toxic dictionary is the ordinary one, followed by the word parts that labelled toxic texts have far more often.
The ordinary one is followed by as many bytes that no text holds, so that both code all other matches alike.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import bounded_sample, frames_by_bytes, given_back, label_counts, text_rows, type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the sample that the dictionaries are trained on, for each label.
SAMPLE_ROWS, SAMPLE_BYTES = 1500, 4_000_000
THRESHOLD = 0.3
FEATURES = 7
LEAST_SAVED = 3
WINDOW, STEP = 32, 16
GRAM, LONGEST_PART = 5, 24
BASE_BYTES, PART_BYTES = 8192, 8192
#: How much commoner a gram or word part must be among toxic texts: least likelihood ratios with least factors.
LEAST_RATIOS = ((16.0, 8.0), (60.0, 3.0))


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def plain(text: str) -> bytes:
    """Lower-cased bytes with single blanks between words and around the text."""
    return b" " + b" ".join(text.lower().encode().split()) + b" "


def windows(data: bytes) -> list[bytes]:
    """Half-overlapping windows over the whole text."""
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - WINDOW + STEP), STEP)]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        strategy=zstandard.STRATEGY_BTLAZY2,
        window_log=17,
        hash_log=15,
        chain_log=15,
        search_log=4,
        min_match=5,
        target_length=32,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    content = zstandard.ZstdCompressionDict(dictionary)
    content.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)


def features(text: str, ordinary, toxic) -> tuple[float, ...]:
    """What a text's windows save with the toxic dictionary: the four greatest savings, how many windows save
    ``LEAST_SAVED`` bytes, the mean saving, and how many windows there are (both numbers as logarithms)."""
    saved = sorted((len(ordinary(w)) - len(toxic(w)) for w in windows(plain(text))), reverse=True)
    top = [max(0, x) for x in (saved[:4] + [0] * 4)[:4]]
    many = sum(x >= LEAST_SAVED for x in saved)
    mean = sum(x for x in saved if x > 0) / len(saved)
    return (*top, float(np.log1p(many)), mean, float(np.log(len(saved))))


def _grams(data: bytes, size: int) -> np.ndarray:
    """Codes of the byte grams; those that hold a blank between other bytes are zero."""
    a = np.frombuffer(data, dtype=np.uint8).astype(np.uint64)
    n = len(a) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    codes, inner = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    for j in range(size):
        codes = codes << np.uint64(8) | a[j : j + n]
        if 0 < j < size - 1:
            inner |= a[j : j + n] == 32
    return np.where(inner, np.uint64(0), codes) if size == GRAM else codes


def _families(texts: list[bytes]) -> list[int]:
    """Places of texts that no earlier text shares a least 16-byte gram with: copies must not count as evidence."""
    seen, fresh = set(), []
    for i, data in enumerate(texts):
        codes = _grams(data, 8)
        pair = codes[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ codes[8:] if len(codes) > 8 else codes
        keys = set()
        for salt in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            mixed = (pair ^ pair >> np.uint64(31)) * np.uint64(salt)
            if len(mixed):
                keys.add((salt, int((mixed ^ mixed >> np.uint64(29)).min())))
        if not keys & seen:
            fresh.append(i)
        seen |= keys
    return fresh


def _enriched(toxic_df: np.ndarray, other_df: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    share = (toxic_df + other_df) / (n_toxic + n_other)

    def term(a, b):
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(b, 1e-9)), 0.0)

    ratio = 2 * (
        term(toxic_df, n_toxic * share)
        + term(other_df, n_other * share)
        + term(n_toxic - toxic_df, n_toxic * (1 - share))
        + term(n_other - other_df, n_other * (1 - share))
    )
    times = toxic_df / n_toxic / ((other_df + 1) / n_other)
    return np.any([(ratio > r) & (times > t) for r, t in LEAST_RATIOS], axis=0)


def _word_parts(run: bytes) -> list[bytes]:
    """A run of telling bytes cut into words; a blank stays where the run tells that a word begins or ends there."""
    ended = run.replace(b" ", b" \0 ").split(b"\0")
    return [p for p in ended if len(p.strip()) > 3]


def _pieces(part: bytes) -> set[bytes]:
    """A word part and all its pieces of a gram's size or more: stems recur where whole words do not."""
    n = len(part)
    return {part[a:z] for a in range(n) for z in range(a + GRAM, min(n, a + LONGEST_PART) + 1)}


def telling_parts(toxic: list[bytes], other: list[bytes]) -> list[bytes]:
    """Word parts that toxic texts hold far more often, from the most to the least frequent."""
    if not toxic or not other:
        return []
    counts = []
    for group in (toxic, other):
        codes = np.concatenate([np.unique(_grams(d, GRAM)) for d in group])
        counts.append(np.unique(codes, return_counts=True))
    grams = np.union1d(counts[0][0], counts[1][0])
    df = [np.zeros(len(grams)) for _ in counts]
    for d, (codes, n) in zip(df, counts):
        d[np.searchsorted(grams, codes)] = n
    telling = grams[_enriched(df[0], df[1], len(toxic), len(other)) & (grams != 0)]
    found: Counter[bytes] = Counter()
    for data in toxic:
        hits = np.flatnonzero(np.isin(_grams(data, GRAM), telling))
        mark = np.zeros(len(data) + 1, dtype=np.int8)
        for j in range(GRAM):
            mark[hits + j] = 1
        edges = np.flatnonzero(np.diff(np.r_[np.int8(0), mark]))
        parts = {p for a, z in zip(edges[::2], edges[1::2]) for w in _word_parts(data[a:z]) for p in _pieces(w)}
        found.update(parts)
    joined = b"\n".join(other)
    parts = [p for p, n in found.most_common() if n > 4]
    inside = np.array([found[p] for p in parts], dtype=float)
    elsewhere = np.minimum([joined.count(p) for p in parts], len(other)).astype(float)
    pure = _enriched(inside, elsewhere, len(toxic), len(other)) if parts else []
    kept: list[bytes] = []
    for part in sorted((p for p, ok in zip(parts, pure) if ok), key=len, reverse=True):
        if not any(part in longer for longer in kept):
            kept.append(part)
    return sorted(kept, key=lambda p: (-found[p], p))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w -= np.linalg.solve(curve, slope)
    return w


def fit(sample: pd.DataFrame, counts: dict[int, int]) -> Model:
    """Train on (text, label) rows; ``counts`` are the numbers of labelled documents that they stand for.

    Without texts of both labels nothing sets toxic text apart, and every score is the share of label 1.
    """
    texts = [plain(t) for t in sample["text"]]
    label = sample["label"].to_numpy()
    fresh = _families(texts)
    toxic, other = ([texts[i] for i in fresh if label[i] == v] for v in (1, 0))
    pieces = [w for d in other or toxic for w in windows(d)]
    try:
        base = zstandard.train_dictionary(BASE_BYTES, pieces, k=32, d=6, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        base = b"".join(pieces)[-BASE_BYTES:]  # too few texts to train on: their own bytes serve
    parts, size = [], 0
    for part in telling_parts(toxic, other):
        if size + len(part) > PART_BYTES:
            break
        parts.append(part)
        size += len(part)
    content = b"".join(reversed(parts))
    filler = np.random.default_rng(0).integers(248, 256, len(content), dtype=np.uint8).tobytes()
    model = Model(base + filler, base + content, ())
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if not len(toxic) or not len(other):
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(model.ordinary, model.toxic, (float(odds), *[0.0] * FEATURES))
    pair = [compressor(d).compress for d in (model.ordinary, model.toxic)]
    x = np.array([(1.0, *features(t, *pair)) for t in sample["text"]])
    stands_for = np.array([counts.get(int(v), 1) / max(1, (label == v).sum()) for v in label])
    weights = _logistic(x, label, stands_for * len(label) / stands_for.sum())
    return Model(model.ordinary, model.toxic, tuple(float(w) for w in weights))


def learn(docs: DataFrame, labels: DataFrame, label: str, condition: Column, max_rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a bounded sample of the label rows that meet ``condition``."""
    sample = bounded_sample(docs, labels, label, condition, max_rows, max_bytes)
    return fit(sample, label_counts(labels, label, condition))


def _scores(model: Model, texts: pd.Series, pair) -> np.ndarray:
    x = np.array([(1.0, *features(t, *pair)) for t in texts], dtype=float).reshape(len(texts), 1 + FEATURES)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of ``docs``, from the whole text.

    Null and empty texts are scored as one empty window. Repeated rows score alike; other columns are not read.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = [compressor(d).compress for d in (model.ordinary, model.toxic)]
        for frame in frames_by_bytes(batches):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": _scores(model, frame["text"], pair)})

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInPandas(step, f"doc_id {type_of(rows, 'doc_id')}, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold, with all columns as they were.

    Null and empty texts are scored as one empty window, repeated rows alike; an empty table gives no rows.
    """

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = [compressor(d).compress for d in (model.ordinary, model.toxic)]
        for part in given_back(texts):
            yield pd.Series(_scores(model, part, pair))

    return docs.where(scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) < threshold)
