"""Classifier chain for toxicity: categories in a fixed order, each sees the earlier ones.

Every link is a logistic model over hashed words and word beginnings plus the earlier
categories' probabilities.  Later links are trained with out-of-fold probabilities of
the earlier ones, so that they see them as uncertain as they are on new texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reconkit.llm.common import (
    id_and_text, joined_bytes, labelled_sample, lower_ascii, slices, word_hashes, words_of,
)

SAMPLE_PER_CLASS = 1500  # labelled rows of each class that training may use
FOLDS = 5
TERMS = 3000  # terms a link may use, chosen on its training rows alone
MIN_ROWS = 4  # rows of the training sample a term must occur in
SURPRISE = 3.0  # standard deviations by which a term's rows must differ from the share of all rows
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that count as a term besides the word
_STEPS = 250

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word and word beginning, ASCII letters lower-cased, repeats included."""
    data, starts = joined_bytes(texts)
    data = lower_ascii(data)
    a, b = words_of(data, _IS_WORD)
    row = np.searchsorted(starts, a, side="right") - 1
    rows, hashes = [row], [word_hashes(data, a, b)]
    for n in BEGINNINGS:
        longer = b - a > n
        rows.append(row[longer])
        hashes.append(word_hashes(data, a[longer], a[longer] + n) ^ np.uint64(n))
    return np.concatenate(rows), np.concatenate(hashes)


@dataclass
class Link:
    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' probabilities
    bias: float

    def probability(self, n: int, row: np.ndarray, term: np.ndarray, before: np.ndarray) -> np.ndarray:
        """``row`` and ``term`` hold each term of a text once."""
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            known = self.terms[at] == term
            logit = np.bincount(row[known], self.weights[at[known]], n)
        else:
            logit = np.zeros(n)
        return 1 / (1 + np.exp(-(logit + before @ self.earlier + self.bias)))


@dataclass
class Chain:
    categories: tuple[str, ...]
    links: list[Link]

    def known(self) -> np.ndarray:
        return np.unique(np.concatenate([k.terms for k in self.links]))

    def probabilities(self, n: int, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        found = np.zeros((n, 0))
        for link in self.links:
            found = np.column_stack([found, link.probability(n, row, term, found)])
        return found


def fit_link(n: int, row: np.ndarray, term: np.ndarray, before: np.ndarray, y: np.ndarray, odds: float = 1.0) -> Link:
    """Logistic regression with a small ridge on the terms that set the classes most apart."""
    positive = y.sum()
    if positive in (0, n):
        return Link(np.zeros(0, np.uint64), np.zeros(0), np.zeros(before.shape[1]), float(np.log((positive + 1) / (n - positive + 1) / 2)))
    terms, index = np.unique(term, return_inverse=True)
    seen, hits = np.bincount(index), np.bincount(index, y[row])
    rate = positive / n
    surprise = np.abs(hits - seen * rate) / np.sqrt(seen * rate * (1 - rate))
    gain = np.where((seen >= MIN_ROWS) & (surprise >= SURPRISE), surprise, 0)
    picked = np.sort(np.argsort(-gain, kind="stable")[: min(TERMS, int((gain > 0).sum()))])
    place = np.full(len(terms), -1)
    place[picked] = np.arange(len(picked))
    use = place[index] >= 0
    r, c = row[use], place[index[use]]
    weights = [np.zeros(len(picked)), np.zeros(before.shape[1]), np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, _STEPS + 1):
        logit = np.bincount(r, weights[0][c], n) + before @ weights[1] + weights[2]
        wrong = (1 / (1 + np.exp(-logit)) - y) / n
        grads = (np.bincount(c, wrong[r], len(picked)) + 2e-4 * weights[0], before.T @ wrong + 2e-4 * weights[1], np.array([wrong.sum()]))
        for w, g, (m, v) in zip(weights, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Link(terms[picked], weights[0], weights[1], float(weights[2][0] + np.log(odds)))


def fit_chain(categories: Sequence[str], n: int, row: np.ndarray, term: np.ndarray, y: np.ndarray, fold: np.ndarray, odds: float = 1.0) -> Chain:
    """``y`` has a column per category; ``odds`` are those of the last one among all rows against the sample's."""
    links, before = [], np.zeros((n, 0))
    for k in range(len(categories)):
        last = k == len(categories) - 1
        links.append(fit_link(n, row, term, before, y[:, k], odds if last else 1.0))
        if last:
            break
        out = np.zeros(n)
        for f in range(FOLDS):
            held = fold == f
            if not held.any():
                continue
            rest, new = np.flatnonzero(~held), np.cumsum(~held) - 1
            keep = ~held[row]
            link = fit_link(len(rest), new[row[keep]], term[keep], before[rest], y[rest, k])
            out[held] = link.probability(n, row, term, before)[held]
        before = np.column_stack([before, out])
    return Chain(tuple(categories), links)


def fit(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], weak: Mapping[str, Column] | None = None,
    per_class: int = SAMPLE_PER_CLASS, id_col="doc_id", text_col="text",
) -> Chain:
    """Train on at most ``per_class`` rows of each value of the last category.

    ``labels`` has a 0/1 column per category; nulls in earlier ones count as 0.  ``weak``
    gives earlier categories as conditions on the column ``text``, which hold for rows
    of the last category only.  Without labelled rows every probability is constant.
    """
    sample = labelled_sample(docs, labels, categories[-1], per_class, id_col, text_col)
    rude = F.col(categories[-1]) == 1
    sample = sample.withColumns({c: (rude & condition).cast("int") for c, condition in (weak or {}).items()})

    def run(batches):
        for part in slices(batches):
            row, term = terms_of(part["text"])
            both = np.unique(np.rec.fromarrays([row, term]))
            cut = np.searchsorted(both.f0, np.arange(part.num_rows + 1))
            sets = [both.f1[cut[i] : cut[i + 1]].tobytes() for i in range(part.num_rows)]
            marks = [part[c] for c in categories]
            yield pa.RecordBatch.from_arrays([part["doc_id"], *marks, pa.array(sets, pa.binary())], ["doc_id", *categories, "terms"])

    marks = [f"cast(coalesce({c}, 0) as int) as {c}" for c in categories]
    picked = sample.selectExpr("doc_id", *marks, "text")
    fields = ", ".join(f"{c} int" for c in categories)
    rows = picked.mapInArrow(run, f"doc_id long, {fields}, terms binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["terms"]))
    n = len(rows)
    sets = [np.frombuffer(r["terms"], np.uint64) for r in rows]
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    term = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    del sets
    # no link can use a term that stands in fewer rows
    _, index, seen = np.unique(term, return_inverse=True, return_counts=True)
    often = seen[index] >= MIN_ROWS
    row, term = row[often], term[often]
    y = np.array([[r[c] for c in categories] for r in rows], np.float64).reshape(n, len(categories))
    last = categories[-1]
    totals = {int(v): k for v, k in labels.filter(f"{last} in (0, 1)").groupBy(last).count().collect()}
    ones = y[:, -1].sum()
    odds = totals[1] / totals[0] * (n - ones) / ones if 0 < ones < n else 1.0
    # folds by id: repeated rows of one document stay together
    fold = np.array([r["doc_id"] % FOLDS for r in rows], np.int64)
    return fit_chain(categories, n, row, term, y, fold, odds)


def score(docs: DataFrame, chain: Chain, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id`` and ``p_<category>`` of every row; null text is empty and scores by the biases."""
    names = [f"p_{c}" for c in chain.categories]

    def run(batches):
        known = chain.known()
        seen = np.zeros(1 << 22, bool)
        seen[known >> np.uint64(42)] = True
        for part in slices(batches):
            row, term = terms_of(part["text"])
            some = np.flatnonzero(seen[term >> np.uint64(42)])
            some = some[np.isin(term[some], known)]
            # each term counts once per text
            order = np.lexsort((term[some], row[some]))
            row, term = row[some][order], term[some][order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
            found = chain.probabilities(part.num_rows, row[first], term[first])
            yield pa.RecordBatch.from_arrays([part["doc_id"], *map(pa.array, found.T.copy())], ["doc_id", *names])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in names))
