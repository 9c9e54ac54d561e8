"""Benchmark items inside documents: size-partitioned MinHash search, then exact containment.

Items are partitioned by their number of word shingles, a power of two each.  Documents
are read in windows twice as long as the partition's items, one such length apart, so
an item of any length meets a window of its own size whatever the document's length.
Windows whose smallest hash under some function is an item's smallest are candidates;
their texts are then compared shingle by shingle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from reconkit.llm.common import joined_bytes, lower_ascii, mixed, shingle_hashes, slices, stored, tidy, word_hashes, words_of

SHINGLE = 5  # words
CONTAINMENT = 0.8  # share of an item's shingles that a document must hold
FUNCTIONS = 40  # hash functions; a window with the whole item is missed with chance 1e-5 at most
_BITS = 22  # of the two filters, whose size does not depend on the items

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = True
_IS_WORD[128:] = True
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_FACTORS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64)) | np.uint64(1)


def words(text: str) -> list[str]:
    """Runs of letters, digits and all characters beyond ASCII; A-Z as a-z."""
    return _WORD.findall(text.translate(_LOWER))


def shingles(text: str) -> set[tuple[str, ...]]:
    """Word shingles; a text with fewer words is one shingle, one without words has none."""
    own = words(text)
    return {tuple(own[i : i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))} if own else set()


def text_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and where each text's shingles start (one more at the end)."""
    data, starts = joined_bytes(texts)
    data = lower_ascii(data)
    a, b = words_of(data, _IS_WORD)
    hashes = word_hashes(data, a, b)
    first = np.searchsorted(a, starts)
    n_words = np.diff(first)
    n = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, np.minimum(n_words, 1))
    cuts = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(cuts[-1], np.uint64)
    padded = np.concatenate([shingle_hashes(hashes, SHINGLE), np.zeros(SHINGLE, np.uint64)])
    long = n_words >= SHINGLE
    at = np.repeat(np.where(long, first[:-1], 0) - cuts[:-1], n) + np.arange(cuts[-1])
    out[:] = padded[at]
    for i in np.flatnonzero((n_words > 0) & ~long):  # the whole sequence is the shingle
        out[cuts[i]] = shingle_hashes(hashes[first[i] : first[i + 1]], int(n_words[i]))[0]
    return out, cuts


def size_class(n: np.ndarray) -> np.ndarray:
    """Exponent of the least power of two that n shingles fit in."""
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def _key(kind: int, function: int, least: np.ndarray) -> np.ndarray:
    return mixed(least ^ (np.uint64(kind) << np.uint64(8)) ^ np.uint64(function) ^ (least >> np.uint64(32)))


def signatures(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, kind, key``: one row per hash function of each item that has words."""

    def run(batches):
        for part in slices(batches):
            hashes, cuts = text_shingles(part["text"])
            ids = part["item_id"].to_pylist()
            rows = [[], [], []]
            for i in range(part.num_rows):
                own = np.unique(hashes[cuts[i] : cuts[i + 1]])
                if not len(own):
                    continue
                kind = int(size_class(np.array([len(own)]))[0])
                least = [(own * f).min() for f in _FACTORS]
                keys = [_key(kind, j, np.array([m]))[0] for j, m in enumerate(least)]
                rows[0] += [ids[i]] * FUNCTIONS
                rows[1] += [kind] * FUNCTIONS
                rows[2] += np.array(keys, np.uint64).view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64())], ["item_id", "kind", "key"])

    own = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return own.mapInArrow(tidy(run), "item_id long, kind int, key long")


def window_hits(hashes: np.ndarray, cuts: np.ndarray, kinds: list[int], filters: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each window minimum that may be an item's."""
    n = np.diff(cuts)
    texts = np.flatnonzero(n)
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    base = min(kinds)
    rows, keys = [], []
    mask = np.uint64((1 << _BITS) - 1)
    blocks = {k: -(-n[texts] // (1 << k)) for k in kinds}
    owners = {k: np.repeat(texts, blocks[k]) for k in kinds}
    # first position of each block of the smallest kind, first such block of each larger one
    inside = {k: np.arange(blocks[k].sum()) - np.repeat(np.cumsum(blocks[k]) - blocks[k], blocks[k]) for k in kinds}
    starts = cuts[owners[base]] + (inside[base] << base)
    first_block = np.cumsum(blocks[base]) - blocks[base]
    merge = {k: np.repeat(first_block, blocks[k]) + (inside[k] << (k - base)) for k in kinds}
    for j, factor in enumerate(_FACTORS):
        small = np.minimum.reduceat(hashes * factor, starts)
        for k in kinds:
            least = small if k == base else np.minimum.reduceat(small, merge[k])
            # a window is a block and the next one of the same text
            if len(least) > 1:
                same = owners[k][1:] == owners[k][:-1]
                least = np.append(np.where(same, np.minimum(least[:-1], least[1:]), least[:-1]), least[-1])
            key = _key(k, j, least)
            some = np.flatnonzero(filters[0][key & mask])
            some = some[filters[1][(key[some] >> np.uint64(_BITS)) & mask]]
            rows.append(owners[k][some])
            keys.append(key[some])
    return np.concatenate(rows), np.concatenate(keys)


def contained_items(
    docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT,
    id_col="doc_id", text_col="text", item_col="item_id", item_text="text",
) -> DataFrame:
    """``doc_id, item_id, containment``: items of which a document holds at least that share of shingles.

    Each pair comes once, with the largest share if ids repeat.  Null texts are empty and,
    like texts without words, match nothing; null ids stay null and count as one id.
    """
    spark = docs.sparkSession
    signed = stored(signatures(items, item_col, item_text), "signatures")
    kinds = sorted(r[0] for r in signed.select("kind").distinct().collect())  # powers of two: a few
    mask = (1 << _BITS) - 1
    filters = []
    for shift in (0, _BITS):
        bits = signed.select(F.shiftrightunsigned("key", shift).bitwiseAND(mask).alias("bit")).distinct().toPandas()["bit"]
        seen = np.zeros(1 << _BITS, bool)  # at most that many rows came back
        seen[bits.to_numpy(np.int64)] = True
        filters.append(seen)
    filters = spark.sparkContext.broadcast(tuple(filters))

    def search(batches):
        base, n = TaskContext.get().partitionId() << 40, 0
        for part in slices(batches):
            hashes, cuts = text_shingles(part["text"])
            if not kinds or not len(hashes):
                continue
            row, key = window_hits(hashes, cuts, kinds, filters.value)
            if not len(row):
                continue
            both = np.unique(np.rec.fromarrays([row, key]))
            cut = np.flatnonzero(np.concatenate([[True], both.f0[1:] != both.f0[:-1]]))
            found = part.take(pa.array(both.f0[cut]))
            keys = [k.view(np.int64).tolist() for k in np.split(np.ascontiguousarray(both.f1), cut[1:])]
            ids = pa.array(base + n + np.arange(len(cut)))
            n += len(cut)
            yield pa.RecordBatch.from_arrays([ids, found["doc_id"], found["text"], pa.array(keys, pa.list_(pa.int64()))], ["row", "doc_id", "text", "keys"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hits = stored(own.mapInArrow(tidy(search), "row long, doc_id long, text string, keys array<long>"), "hits")
    pairs = hits.select("row", F.explode("keys").alias("key")).join(signed.select("key", "item_id"), "key").select("row", "item_id").distinct()
    texts = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("item")).dropDuplicates()
    matched = pairs.join(texts.filter("item is not null"), pairs["item_id"].eqNullSafe(texts["item_id"])).select("row", pairs["item_id"], "item")
    listed = matched.groupBy("row").agg(F.collect_set(F.struct("item_id", "item")).alias("items"))

    def verify(batches):
        for batch in batches:
            columns = [[], [], []]
            for doc, text, found in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "items"))):
                held = shingles(text)
                for item in found:
                    wanted = shingles(item["item"])
                    share = len(wanted & held) / len(wanted) if wanted else 0.0
                    if wanted and share >= containment:
                        for column, value in zip(columns, (doc, item["item_id"], share)):
                            column.append(value)
            kinds_ = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_)], ["doc_id", "item_id", "containment"])

    checked = hits.select("row", "doc_id", "text").join(listed, "row").select("doc_id", "text", "items")
    return checked.mapInArrow(tidy(verify), "doc_id long, item_id long, containment double").groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))
