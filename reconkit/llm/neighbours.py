"""Nearest neighbours by inner product with a hash-prefix forest.

Every vector gets, per tree, a long string of bits: the sides of random hyperplanes on
which it lies, after one more coordinate has made all lengths equal, so that a large
inner product means a small angle.  Vectors are dealt to blocks of bounded size; a block
holds each tree's strings as a sorted array.  A query descends every array to its
longest prefix match, then all trees ascend together, one bit at a time, until enough
candidates share the prefix; candidates are scored exactly.  All queries meet all
blocks, in cells of bounded size, and only the best of each cell go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from reconkit.llm.common import stored

TREES = 48
BITS = 20  # of a hash string
BLOCK = 8192  # vectors in a block
QUERIES = 2048  # queries in a cell
# candidates over all trees, repeats included, as a share of the block; on vectors without
# any structure 0.9 of the true neighbours need this many, on clustered ones far fewer do
SHARE = 1.1


def hyperplanes(size: int, trees: int = TREES, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size + 1, trees * BITS))


def strings(vectors: np.ndarray, last: np.ndarray, planes: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Hash strings (rows, trees) as integers, the first bit highest."""
    sides = (np.column_stack([vectors, last]) - middle) @ planes > 0
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return sides.reshape(len(vectors), -1, BITS) @ weights


class Forest:
    """Sorted arrays of hash strings of one block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        norms = np.linalg.norm(vectors, axis=1)
        last = np.sqrt(np.maximum(norms.max() ** 2 - norms**2, 0))
        self.vectors, self.planes = vectors, hyperplanes(vectors.shape[1], trees)
        self.middle = np.append(vectors.mean(axis=0), last.mean())
        found = strings(vectors, last, self.planes, self.middle).T
        self.order = np.argsort(found, axis=1, kind="stable")
        self.sorted = np.take_along_axis(found, self.order, axis=1)

    def candidates(self, queries: np.ndarray, k: int, share: float = SHARE) -> Iterator[np.ndarray]:
        """For each query, the rows that share the prefix at the level where the trees together hold enough.

        Enough is ``share`` of the block and k rows in each tree, so k different rows come if there are as many.
        """
        own = strings(queries, np.zeros(len(queries)), self.planes, self.middle)
        trees, n = self.sorted.shape
        enough = np.full(len(queries), share * n + trees * k)
        low, high = np.zeros((trees, len(queries)), np.int64), np.full((trees, len(queries)), n)
        waiting = np.arange(len(queries))
        for level in range(BITS + 1):  # bits dropped from the end: all trees ascend in step
            first = (own[waiting] >> level) << level
            a = np.array([np.searchsorted(s, first[:, t]) for t, s in enumerate(self.sorted)])
            b = np.array([np.searchsorted(s, first[:, t] + (1 << level)) for t, s in enumerate(self.sorted)])
            low[:, waiting], high[:, waiting] = a, b
            waiting = waiting[(b - a).sum(axis=0) < enough[waiting]]
            if not len(waiting):
                break
        for i in range(len(queries)):
            seen = np.zeros(n, bool)
            for t in range(trees):
                seen[self.order[t, low[t, i] : high[t, i]]] = True
            yield np.flatnonzero(seen)

    def nearest(self, queries: np.ndarray, k: int, share: float = SHARE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and inner products of the candidates that can be among the k largest; ties at the limit stay."""
        for query, rows in zip(queries, self.candidates(queries, k, share)):
            scores = self.vectors[rows] @ query
            if len(rows) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= least
                rows, scores = rows[keep], scores[keep]
            yield rows, scores


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` (doubles) of rows whose vector is not null, empty or zero and has finite numbers only; ids once."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    own = own.filter(finite & F.exists("v", lambda x: x != 0))
    return own.groupBy("id").agg(F.min("v").alias("v"))


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE,
    id_col="vec_id", vector_col="embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest candidates but itself, ties to the smaller id.

    Rows with unusable vectors or a null id take no part; of rows that repeat an id the
    smallest vector counts.  Vectors meet queries of their own length only.
    """
    # stored, as both are counted before they are dealt
    base, asked = (stored(usable(x, id_col, vector_col), "vectors") for x in (vectors, queries))
    rows, questions = (x.agg(F.count("*")).head()[0] for x in (base, asked))
    blocks, parts = max(1, -(-rows // BLOCK)), max(1, -(-questions // QUERIES))
    # random dealing: blocks stay near their mean size
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")
    size = F.size("v").alias("size")
    left = base.select("id", "v", size, block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = asked.select("id", "v", size, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part.alias("part"))

    def cell(own: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(questions):
            own = own.sort_values("id")
            ids = own["id"].to_numpy()
            forest = Forest(np.stack(own["v"].to_numpy()))
            for first in range(0, len(questions), 256):
                some = questions.iloc[first : first + 256]
                for query, (at, scores) in zip(some["id"], forest.nearest(np.stack(some["v"].to_numpy()), k + 1, share)):
                    order = [i for i in np.lexsort((ids[at], -scores)) if ids[at[i]] != query][:k]
                    found.append(pd.DataFrame({"query_id": query, "vec_id": ids[at[order]], "score": scores[order]}))
        if not found:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.concat(found)

    keys = ["size", "block", "part"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(cell, "query_id long, vec_id long, score double")
    line = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
