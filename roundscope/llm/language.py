"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram binds three of them: the first
permuted twice, the second once, multiplied place by place. A text bundles (adds) its trigrams, and a language's
prototype bundles all texts to learn from. A text belongs to the language of the greatest cosine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import frames_by_bytes, text_rows, type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMENSIONS = 1024
SEED = 20
UNKNOWN = "und"
#: Characters whose trigrams are bundled in one step.
STEP_CHARS = 1 << 20
#: Distinct trigrams whose vectors are in memory at a time.
STEP_GRAMS = 16_000


def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The +1/-1 vector of a letter's code point; 0 stands for the gap between words."""
    return np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class Letters:
    """Numbers letters as they are met and keeps their vectors in the three permutations."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.number = np.full(0x110000, -1, dtype=np.int32)
        self.rows = [letter_vector(0, dimensions)]

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """A number for each code point; 0 for what is no letter."""
        for code in np.unique(codes[self.number[codes] < 0]):
            letter = chr(code).isalpha()
            self.number[code] = len(self.rows) if letter else 0
            if letter:
                self.rows.append(letter_vector(int(code), self.dimensions))
        return self.number[codes]

    def trigrams(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Bound vectors, one row for each trigram."""
        first, second, third = (np.array([self.rows[i] for i in x.tolist()], dtype=np.int8) for x in (a, b, c))
        return np.roll(first, 2, axis=1) * np.roll(second, 1, axis=1) * third


def bundles(texts: list[str], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """One bundled vector per text, and how many letters it has.

    Words keep a gap before and after them, and trigrams lie within a word and its gaps.
    """
    texts = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    numbers = letters.numbers(codes)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    kept = (numbers != 0) | np.r_[True, numbers[:-1] != 0] | np.r_[True, doc[1:] != doc[:-1]]
    numbers, doc = numbers[kept].astype(np.int64), doc[kept]
    total = np.bincount(doc, weights=numbers != 0, minlength=len(texts))
    a, b, c = numbers[:-2], numbers[1:-1], numbers[2:]
    inside = (b != 0) & (doc[:-2] == doc[2:])
    size = len(letters.rows)
    code = ((a * size + b) * size + c)[inside]
    grams, where = np.unique(code, return_inverse=True)
    cell, n = np.unique(doc[:-2][inside] * max(1, len(grams)) + where, return_counts=True)
    owner, gram = cell // max(1, len(grams)), cell % max(1, len(grams))
    out = np.zeros((len(texts), letters.dimensions), dtype=np.float32)
    for low in range(0, len(grams), STEP_GRAMS):
        part = grams[low : low + STEP_GRAMS]
        bound = letters.trigrams(part // size // size, part // size % size, part % size).astype(np.float32)
        at = np.flatnonzero((gram >= low) & (gram < low + STEP_GRAMS)) if len(grams) > STEP_GRAMS else np.arange(len(gram))
        owners, begins = np.unique(owner[at], return_index=True)
        for i, begin, end in zip(owners, begins, np.r_[begins[1:], len(at)]):
            held = at[begin:end]
            out[i] += n[held].astype(np.float32) @ bound[gram[held] - low]
    return out, total


def prototypes(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A vector per language from all rows that meet ``learn`` and have a language.

    Tasks bundle what they read and hand on one vector per language; these are added place by place, so neither a
    frequent language nor the number of rows gathers in one task. The result has as many numbers as languages times
    dimensions.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, sums = Letters(dimensions), {}
        for frame in frames_by_bytes(batches, STEP_CHARS):
            vectors, _ = bundles(list(frame["text"]), letters)
            for lang in frame["lang"].unique():
                part = vectors[(frame["lang"] == lang).to_numpy()].sum(axis=0, dtype=np.float64)
                sums[lang] = sums.get(lang, 0) + part
        for lang, vector in sums.items():
            yield pd.DataFrame({"lang": lang, "place": np.arange(dimensions), "value": vector})

    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    summed = rows.mapInPandas(step, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():
        out.setdefault(r["lang"], np.zeros(dimensions))[r["place"]] = r["value"]
    return out


def predict(docs: DataFrame, learned: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): one row per row of ``docs``; score is the cosine, at least 0.

    Texts that are null, empty or without a letter are ``und`` with score 0, and so is every text if nothing was
    learned. Equal cosines go to the least language. Repeated rows are judged alike; other columns are not read.
    """
    names = sorted(learned)
    table = np.array([learned[x] / max(np.linalg.norm(learned[x]), 1e-12) for x in names], dtype=np.float32)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = Letters(table.shape[1] if names else 1)
        for frame in frames_by_bytes(batches, STEP_CHARS):
            vectors, total = bundles(list(frame["text"]), letters)
            known = (total > 0) & bool(names)
            lang, score = np.full(len(frame), UNKNOWN, dtype=object), np.zeros(len(frame))
            if known.any():
                cosine = vectors[known] @ table.T
                cosine /= np.maximum(np.linalg.norm(vectors[known], axis=1), 1e-12)[:, None]
                lang[known] = np.array(names, dtype=object)[cosine.argmax(axis=1)]
                score[known] = np.clip(cosine.max(axis=1), 0, 1)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": lang, "score": score})

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInPandas(step, f"doc_id {type_of(rows, 'doc_id')}, lang_pred string, score double")
