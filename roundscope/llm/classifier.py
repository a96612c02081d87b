"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Every chunk's byte embeddings meet a bank of
learned filters; each filter keeps its greatest value over the chunks, and a linear layer turns these into one
probability. Training sends the error back through the chunk that won for each filter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame

from roundscope.llm.common import bounded_sample, frames_by_bytes, label_counts, text_rows, type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the sample that the network is trained on, for each label.
SAMPLE_ROWS, SAMPLE_BYTES = 1200, 3_000_000
THRESHOLD = 0.3
EMBED, WIDTH, STRIDE, FILTERS = 6, 12, 4, 24
PAD = 256
EPOCHS, BATCH, RATE = 12, 32, 0.01
STEP_CHARS = 1 << 19


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out]


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte numbers of all chunks, and the first chunk of each text; what is beyond a text's end is ``PAD``."""
    counts = [max(1, -(-(len(t) - WIDTH) // STRIDE) + 1) for t in texts]
    first = np.r_[0, np.cumsum(counts)]
    slots = WIDTH // STRIDE - 1
    data = np.full((first[-1] + slots * len(texts)) * STRIDE, PAD, dtype=np.int16)
    for i, t in enumerate(texts):
        at = (first[i] + slots * i) * STRIDE
        data[at : at + len(t)] = np.frombuffer(t, dtype=np.uint8)
    views = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[::STRIDE]
    rows = np.arange(first[-1]) + np.repeat(np.arange(len(texts)), counts) * slots
    return views[rows], first[:-1]


def pooled(net: Network, cut: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Greatest filter value over the chunks of each text."""
    table = np.ascontiguousarray(net.embed[cut].reshape(len(cut), -1))
    return np.maximum.reduceat(table @ net.filters + net.bias, first, axis=0)


def probability(net: Network, top: np.ndarray) -> np.ndarray:
    z = np.maximum(top, 0) @ net.out + net.out_bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(sample: pd.DataFrame, counts: dict[int, int], seed: int = 7) -> Network:
    """Train on (text, label) rows; ``counts`` are the numbers of labelled documents that they stand for.

    Without texts of both labels the filters stay as drawn and every score is near the share of label 1.
    """
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        0.0,
    )
    label = sample["label"].to_numpy(dtype=np.float32)
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    net.out_bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    if len(set(label.tolist())) < 2:
        return net
    net.out = rng.normal(0, 0.1, FILTERS).astype(np.float32)
    weight = np.array([counts.get(int(v), 1) / (label == v).sum() for v in label], dtype=np.float32)
    weight *= len(label) / weight.sum()
    texts = [t.encode() for t in sample["text"]]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in [*net.parts(), np.zeros(1)]]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            pick = order[begin : begin + BATCH]
            cut, first = chunks([texts[i] for i in pick])
            value = np.ascontiguousarray(net.embed[cut].reshape(len(cut), -1)) @ net.filters + net.bias
            ends = np.r_[first[1:], len(cut)]
            won = np.array([value[a:b].argmax(axis=0) + a for a, b in zip(first, ends)])
            top = value[won, np.arange(FILTERS)]
            error = (probability(net, top) - label[pick]) * weight[pick] / len(pick)
            d_out = np.maximum(top, 0).T @ error
            d_top = np.where(top > 0, error[:, None] * net.out, 0)
            d_embed, d_filters = np.zeros_like(net.embed), np.zeros_like(net.filters)
            bytes_won = cut[won]
            for f in range(FILTERS):
                d_filters[:, f] = d_top[:, f] @ net.embed[bytes_won[:, f]].reshape(len(pick), -1)
                back = d_top[:, f, None, None] * net.filters[:, f].reshape(1, WIDTH, EMBED)
                np.add.at(d_embed, bytes_won[:, f], back)
            step += 1
            slopes = [d_embed, d_filters, d_top.sum(axis=0), d_out + 1e-4 * net.out, np.array([error.sum()])]
            for k, (slope, (m, v)) in enumerate(zip(slopes, moments)):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope**2 - v)
                move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                if k < 4:
                    net.parts()[k][...] -= move
                else:
                    net.out_bias -= float(move[0])
    return net


def learn(docs: DataFrame, labels: DataFrame, label: str, condition: Column, max_rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Network:
    """Train on a bounded sample of the label rows that meet ``condition``."""
    sample = bounded_sample(docs, labels, label, condition, max_rows, max_bytes)
    return fit(sample, label_counts(labels, label, condition))


def score_texts(net: Network, texts: list[str]) -> np.ndarray:
    """A probability for each text; long texts are cut into runs of chunks whose greatest values are joined."""
    span = STEP_CHARS - STEP_CHARS % STRIDE
    pieces, owner = [], []
    for i, t in enumerate(texts):
        data = t.encode()
        starts = range(0, max(1, len(data) - WIDTH + STRIDE), span)
        pieces += [data[s : s + span + WIDTH - STRIDE] for s in starts]
        owner += [i] * len(starts)
    top = np.full((len(texts), FILTERS), -np.inf, dtype=np.float32)
    begin, size = 0, 0
    for j in range(len(pieces) + 1):
        if j == len(pieces) or (j > begin and size + len(pieces[j]) > span):
            if j > begin:
                np.maximum.at(top, owner[begin:j], pooled(net, *chunks(pieces[begin:j])))
            begin, size = j, 0
        if j < len(pieces):
            size += len(pieces[j])
    return probability(net, top).astype(float)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row per row of ``docs``, from the whole text.

    Null and empty texts are one chunk of padding. Repeated rows score alike; other columns are not read.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_by_bytes(batches):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": score_texts(net, list(frame["text"]))})

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInPandas(step, f"doc_id {type_of(rows, 'doc_id')}, score double")
