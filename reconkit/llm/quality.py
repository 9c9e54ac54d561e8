"""Byte-level convolutional network for text quality, in numpy.

Filters of ``WIDTH`` bytes slide over the whole text.  Each overlapping chunk of two
blocks keeps, per filter, its largest response (at least zero); their mean over the
document goes through one logistic unit.  Filters and unit are learned together from a
bounded sample of labelled rows; every byte of every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reconkit.llm.common import id_and_text, labelled_sample, slices, tidy

WIDTH = 6  # bytes of a filter; even, as bytes are looked up in pairs
FILTERS = 16
BLOCK = 256  # a chunk is two blocks, the next one starts a block later
SAMPLE_PER_CLASS = 1000  # labelled rows of each class that training may use
SAMPLE_CHUNKS = 8  # chunks of a labelled row, evenly spaced over its whole text
EPOCHS = 16
SHORTENED = 0.3  # share of rows that each epoch shows as short texts
_PIECE = 64 << 10  # bytes convolved at once


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, FILTERS); byte 0 is padding and answers 0
    weights: np.ndarray
    bias: float

    def pair_tables(self) -> list[np.ndarray]:
        return [(self.filters[j][:, None] + self.filters[j + 1][None]).reshape(1 << 16, -1) for j in range(0, WIDTH, 2)]


def blocks_of(n_bytes: np.ndarray) -> np.ndarray:
    return (n_bytes + WIDTH - 1 + BLOCK - 1) // BLOCK


def as_bytes(text: str) -> bytes:
    """UTF-8 with NUL as 1, because 0 is padding."""
    return text.encode("utf-8").replace(b"\0", b"\1")


def score_texts(network: Network, tables: list[np.ndarray], texts: list[str]) -> np.ndarray:
    data = [as_bytes(t) for t in texts]
    blocks = blocks_of(np.array([len(d) for d in data], np.int64))
    stream = b"".join(d.ljust(n * BLOCK, b"\0") for d, n in zip(data, blocks)) + bytes(WIDTH)
    stream = np.frombuffer(stream, np.uint8)
    most = np.empty((int(blocks.sum()), len(network.weights)), np.float32)
    # a text's last windows hold padding only, but would reach into the next text
    last = np.sort((np.cumsum(blocks)[:, None] * BLOCK - np.arange(1, WIDTH)).ravel())
    for first in range(0, len(most) * BLOCK, _PIECE):
        n = min(_PIECE, len(most) * BLOCK - first)
        piece = stream[first : first + n + WIDTH].astype(np.int32)
        pairs = (piece[:-1] << 8) | piece[1:]
        answer = tables[0].take(pairs[:n], axis=0)
        for j, table in enumerate(tables[1:], 1):
            answer += table.take(pairs[2 * j : 2 * j + n], axis=0)
        answer[last[np.searchsorted(last, first) : np.searchsorted(last, first + n)] - first] = 0
        most[first // BLOCK : (first + n) // BLOCK] = answer.reshape(n // BLOCK, BLOCK, -1).max(axis=1)
    most = np.maximum(most, 0)
    # chunk i is blocks i and i + 1 of one document; a document of one block has one chunk
    ends = np.cumsum(blocks)
    chunks = np.maximum(most, np.vstack([most[1:], most[-1:]]))
    alone = blocks == 1
    chunks[ends[alone] - 1] = most[ends[alone] - 1]
    chunks[ends[~alone] - 1] = 0
    sums = np.add.reduceat(chunks.astype(np.float64), ends - blocks, axis=0)
    logit = (sums / np.maximum(blocks - 1, 1)[:, None]) @ network.weights + network.bias
    return 1 / (1 + np.exp(-logit))


def sample_chunks(sample: DataFrame, label: str) -> DataFrame:
    """``doc, label, chunks``: up to ``SAMPLE_CHUNKS`` padded chunks of each labelled row."""
    size = 2 * BLOCK + WIDTH - 1

    def run(batches):
        for part in slices(batches):
            rows = []
            for text in part["text"].to_pylist():
                data = as_bytes(text)
                n = max(1, int(blocks_of(np.array(len(data)))) - 1)
                starts = np.unique(np.linspace(0, n - 1, min(n, SAMPLE_CHUNKS)).astype(np.int64)) * BLOCK
                rows.append(b"".join(data[s : s + size].ljust(size, b"\0") for s in starts))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["label"], pa.array(rows, pa.binary())], ["doc_id", "label", "chunks"])

    picked = sample.selectExpr("doc_id", f"cast({label} as int) as label", "text")
    return picked.mapInArrow(run, "doc_id long, label int, chunks binary")


def train(chunks: np.ndarray, owner: np.ndarray, label: np.ndarray, odds: float = 1.0, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Gradient descent (Adam) on the log loss; ``owner`` is the row of ``label`` each chunk belongs to.

    ``odds`` are those of label 1 among all labelled rows, against those of the sample.
    """
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32)
    filters[:, 0] = 0
    weights, bias = rng.normal(0, 0.5, FILTERS), np.zeros(1)
    positions = chunks.shape[1] - WIDTH + 1
    state = [[np.zeros_like(p, np.float64), np.zeros_like(p, np.float64)] for p in (filters, weights, bias)]
    step, first_chunk = 0, np.searchsorted(owner, np.arange(len(label) + 1))
    lanes = np.arange(FILTERS)
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for docs in np.array_split(order, max(1, len(order) // 48)):
            rows = np.concatenate([np.arange(first_chunk[d], first_chunk[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), first_chunk[docs + 1] - first_chunk[docs])
            n_chunks = np.bincount(own, minlength=len(docs))
            x = chunks[rows]
            short = np.flatnonzero((rng.random(len(docs)) < SHORTENED)[own])
            ends = rng.integers(16, BLOCK, len(short))
            x[short] = np.where(np.arange(x.shape[1]) < ends[:, None], x[short], 0)
            top, at = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64)
            for some in range(0, len(rows), 64):
                part = x[some : some + 64]
                answer = filters[0].take(part[:, :positions], axis=0)
                for j in range(1, WIDTH):
                    answer += filters[j].take(part[:, j : j + positions], axis=0)
                at[some : some + 64] = answer.argmax(axis=1)
                top[some : some + 64] = np.take_along_axis(answer, at[some : some + 64, None], axis=1)[:, 0]
            pooled = np.maximum(top, 0)
            mean = np.zeros((len(docs), FILTERS))
            np.add.at(mean, own, pooled)
            mean /= n_chunks[:, None]
            wrong = (1 / (1 + np.exp(-(mean @ weights + bias))) - label[docs]) / len(docs)
            back = (wrong[:, None] * weights / n_chunks[:, None])[own] * (top > 0)
            slope = np.zeros(filters.shape)
            for j in range(WIDTH):
                np.add.at(slope[j], (np.take_along_axis(x, at + j, axis=1), lanes), back)
            slope[:, 0] = 0
            step += 1
            grads = (slope + 1e-5 * filters, mean.T @ wrong + 1e-4 * weights, np.array([wrong.sum()]))
            for value, grad, (m, v) in zip((filters, weights, bias), grads, state):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                value -= (0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(value.dtype)
    return Network(filters, weights, float(bias[0] + np.log(odds)))


def fit(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS, id_col="doc_id", text_col="text") -> Network:
    """Train on at most ``per_class`` rows of each label; a missing class gives a constant network."""
    rows = sample_chunks(labelled_sample(docs, labels, label, per_class, id_col, text_col), label).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["chunks"], r["label"]))
    y = np.array([r["label"] for r in rows], np.float64)
    totals = dict(labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int")).count().collect())
    if len(np.unique(y)) < 2:
        odds = (y.sum() + 1) / (len(y) - y.sum() + 1)
        return Network(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS), float(np.log(odds)))
    size = 2 * BLOCK + WIDTH - 1
    data = np.concatenate([np.frombuffer(r["chunks"], np.uint8).reshape(-1, size) for r in rows])
    odds = totals[1] / totals[0] * (len(y) - y.sum()) / y.sum()
    return train(data, np.repeat(np.arange(len(rows)), [len(r["chunks"]) // size for r in rows]), y, odds)


def score(docs: DataFrame, network: Network, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, score`` for every row; null text is empty, an empty text scores by the bias alone."""

    def run(batches):
        tables = network.pair_tables()
        for part in slices(batches):
            found = score_texts(network, tables, part["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, network: Network, threshold: float = 0.7, text_col="text") -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns; null text is empty."""

    def run(batches):
        tables = network.pair_tables()
        for part in slices(batches, text_col):
            texts = [t or "" for t in part[text_col].to_pylist()]
            yield part.filter(pa.array(score_texts(network, tables, texts) >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
