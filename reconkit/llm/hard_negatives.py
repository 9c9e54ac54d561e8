"""Hard negatives by inner product: length buckets, sorted coordinate lists, feasible ranges.

Vectors become whole numbers, so scores are exact.  Rows are dealt to blocks of one length
class (lengths within a tenth); a block holds, for each coordinate, its unit vectors'
values in order.  An anchor that needs a score of at least s looks only at blocks whose
longest vector can reach it, and there the cosine must be at least t = s / (|anchor| *
longest).  That bounds each coordinate of a unit vector: the ranges of the anchor's
largest coordinates are cut out of the sorted lists, rows that lie in all of them are
the candidates, and their scores are taken exactly.  Ranges that leave over half a block
don't pay; such anchors are multiplied with the whole block at once.

Thresholds: every anchor first meets one block (of the largest class); the k-th score
found there is a lower bound for all other blocks, which are met in a second pass.
Positives are the best rows of the anchor's label, so only blocks of that label are met;
negatives are the best rows of other labels whose score lies in a band below each
positive's.  No pair leaves a cell but the k best of each anchor and band.

Defined results: rows with a null id, label or vector, or any null or non-finite component,
take no part; of rows that repeat an id the one with the smallest (label, vector) does;
vectors of different sizes never meet; ties go to the smaller id; scores beyond a long
stop at its limits.  An anchor without positives, or without negatives in a band, has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reconkit.llm.common import stored

SCALE = 256
RATIO = 0.9  # shortest to longest of a length class
BLOCK = 16_384  # rows of a class in one block, about
ANCHORS = 16_384  # anchors that meet a block in one cell, about
FOCUS = 6  # coordinates whose ranges are intersected
EXACT = 1 << 21  # components up to here multiply exactly as doubles (2048 of them)
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
_FOUND = "anchor long, slot int, found long, score long"


def usable(rows: DataFrame, label: Column, id_col="vec_id", vector_col="embedding", scale: int = SCALE) -> DataFrame:
    """``id, label, v, size, length, class``: one row an id, vectors as whole numbers."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    good = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.when(finite, whole).alias("v")).dropna()
    one = good.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.*")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    one = one.withColumns({"size": F.size("v"), "length": length})
    return one.withColumn("class", F.when(F.col("length") > 0, F.floor(F.log("length") / -math.log(RATIO))).otherwise(-1).cast("int"))


def feasible(q: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each coordinate of a unit vector whose cosine with unit ``q`` is at least ``t``."""
    reach = math.sqrt(max(0.0, 1 - t * t)) * np.sqrt(np.maximum(0.0, 1 - q * q))
    low = np.where(q <= -t, -1.0, q * t - reach) - 1e-9
    high = np.where(q >= t, 1.0, q * t + reach) + 1e-9
    return low, high


class Block:
    """Vectors of one block with a sorted list for each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray) -> None:
        self.ids, self.labels = ids, labels
        self.exact = not v.size or (np.abs(v.astype(np.float64)).max() <= EXACT and v.shape[1] <= 2048)
        self.v = v.astype(np.float64) if self.exact else v.astype(object)
        own = v.astype(np.float64)
        lengths = np.sqrt((own * own).sum(axis=1))
        self.longest = lengths.max(initial=0.0)
        unit = own / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may score ``least`` with ``q`` (length included); None if the ranges don't cut."""
        length = math.sqrt(float(q @ q))
        if least <= 0:
            return None
        t = least / (length * self.longest) * (1 - 1e-9) if length and self.longest else 2.0
        if t > 1:
            return np.zeros(0, np.int64)
        unit = q / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        low, high = feasible(unit[focus], t)
        cut = [(np.searchsorted(self.values[:, f], a, "left"), np.searchsorted(self.values[:, f], b, "right"), f) for f, a, b in zip(focus, low, high)]
        if math.prod((b - a) / len(self.ids) for a, b, _ in cut) > 0.5:
            return None
        seen = np.zeros(len(self.ids), np.uint8)
        for a, b, f in cut:
            seen[self.order[a:b, f]] += 1
        return np.flatnonzero(seen == len(cut))

    def scores(self, queries: np.ndarray, at=slice(None)) -> np.ndarray:
        """Exact scores (queries by rows) as 64-bit numbers."""
        if self.exact and np.abs(queries.astype(np.float64)).max(initial=0.0) <= EXACT:
            return (queries.astype(np.float64) @ self.v[at].T).astype(np.int64)
        products = queries.astype(object) @ self.v[at].astype(object).T
        return np.clip(products, LOWEST, HIGHEST).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids, in order."""
    at = np.arange(len(ids))
    if len(ids) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return at[np.lexsort([ids[at], ~scores[at]])[:k]]  # ~x orders like -x and can't overflow


def _cell(block: Block, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, bands: list, same_label: bool, k: int) -> list[tuple[int, int, int, int]]:
    """Best rows of one block for its anchors: (anchor, slot, id, score)."""
    out, wide = [], []

    def take(i: int, rows, scores: np.ndarray) -> None:
        own, marks = block.ids[rows], block.labels[rows]
        fit = (own != ids[i]) & ((marks == labels[i]) == same_label)
        own, scores = own[fit], scores[fit]
        for slot, low, high in bands[i]:
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            best = inside[_best(own[inside], scores[inside], k)]
            out.extend((int(ids[i]), slot, int(a), int(s)) for a, s in zip(own[best], scores[best]))

    for i in range(len(ids)):
        rows = block.candidates(v[i].astype(np.float64), float(min(low for _, low, _ in bands[i])))
        if rows is None:
            wide.append(i)
        elif len(rows):
            take(i, rows, block.scores(v[i : i + 1], rows)[0])
    for first in range(0, len(wide), 64):
        some = wide[first : first + 64]
        for i, scores in zip(some, block.scores(v[some])):
            take(i, slice(None), scores)
    return out


def _meet(anchors: DataFrame, probes: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The k best of each anchor and band in every cell; both sides carry ``cell`` columns."""

    def vectors(column: pa.ListArray, n: int) -> np.ndarray:
        return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), np.int64)

    def run(batches):
        key, block, held = None, None, []

        def closed():
            return Block(*(np.concatenate(x) for x in zip(*held))) if held else None

        for batch in batches:
            marks = np.stack([batch[c].to_numpy() for c in ("size", "group", "class", "block", "part", "side")], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(marks, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                mark, part = tuple(marks[a].tolist()), batch.slice(a, b - a)
                own = [part["id"].to_numpy(), part["label"].to_numpy(), vectors(part["v"], b - a)]
                if mark[:5] != key:
                    key, block, held = mark[:5], None, []
                if mark[5] == 0:
                    held.append(own)
                    continue
                block = block or closed()
                if block is None:
                    continue
                for first in range(0, b - a, 1024):
                    some = slice(first, first + 1024)
                    bands = [[(x["slot"], x["low"], x["high"]) for x in row] for row in part["bands"].slice(first, 1024).to_pylist()]
                    found = _cell(block, *(x[some] for x in own), bands, same_label, k)
                    if found:
                        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["anchor", "slot", "found", "score"])

    cell = ["size", "group", "class", "block", "part"]
    shared = [*cell, "side", "id", "label", "v", "bands"]
    parts = int(probes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    empty = F.expr("cast(null as array<struct<slot: int, low: long, high: long>>)")
    both = probes.withColumns({"side": F.lit(0), "bands": empty}).select(shared).unionByName(anchors.withColumn("side", F.lit(1)).select(shared))
    return both.repartition(parts, *cell).sortWithinPartitions(*cell, "side", "id").mapInArrow(run, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "found")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def best_in_bands(anchors: DataFrame, rows: DataFrame, same_label: bool, k: int, block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """``anchor, slot, found, score, place``: the k best rows in each band of each anchor, by exact score.

    ``anchors`` are ``usable`` rows with ``bands`` (slot, low, high; both ends count).  With
    ``same_label`` rows of the anchor's label count, else all others; never the anchor itself.
    """
    group = F.col("label") if same_label else F.lit(0).cast("long")
    anchors, rows = anchors.filter(F.size("bands") > 0).withColumn("group", group), rows.withColumn("group", group)
    keys = ["size", "group"]
    asked = anchors.groupBy(keys).agg(F.ceil(F.count("*") / anchor_block).cast("int").alias("parts"))
    classes = rows.groupBy(*keys, "class").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.max("length").alias("longest"), F.count("*").alias("n"))
    classes = classes.join(asked, keys)
    largest = Window.partitionBy(keys).orderBy(F.desc("n"), F.desc("class"))  # length classes of a group: few rows
    classes = stored(classes.withColumn("first", F.row_number().over(largest) == 1).drop("n"), "classes")
    dealt = rows.join(classes, [*keys, "class"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own_part = F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part")
    asking = anchors.drop("class").join(classes, keys).select("id", "label", "v", "size", "group", "length", "bands", own_part, "class", "blocks", "longest", "first")

    seeds = _top(_meet(asking.filter("first").withColumn("block", F.lit(0)), dealt.filter("first and block = 0"), same_label, k), k)
    seeds = stored(seeds, "seeds")
    # from k rows on, the k-th score bounds the band from below for all other blocks
    least = seeds.filter(F.col("place") == k).groupBy(F.col("anchor").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("least"))
    raised = F.transform("bands", lambda x: F.struct(x["slot"].alias("slot"), F.coalesce(F.expr("least")[x["slot"]], x["low"]).alias("low"), x["high"].alias("high")))
    left = asking.join(least, "id", "left").withColumn("bands", raised)
    least_of = F.array_min(F.transform("bands", lambda x: x["low"])).cast("double")
    left = left.filter((least_of <= 0) | (least_of * (1 - 1e-9) <= F.col("length") * F.col("longest")))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("not first or block > 0")
    rest = _meet(left, dealt.filter("not first or block > 0"), same_label, k)
    return _top(seeds.drop("place").unionByName(rest), k)


def mine(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col="vec_id", vector_col="embedding", scale: int = SCALE, block: int = BLOCK, anchor_block: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id`` (and ``label``) that marks the anchor rows.  Negatives
    score between ``low`` and ``high`` percent of their positive, both included.
    """
    rows = stored(usable(vectors, label, id_col, vector_col, scale), "usable")
    chosen = rows.filter(anchors)
    any_score = F.struct(F.lit(0).alias("slot"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high"))
    best = best_in_bands(chosen.withColumn("bands", F.array(any_score)), rows, True, positives, block, anchor_block)
    best = stored(best.select("anchor", "place", F.col("found").alias("positive"), F.col("score").alias("positive_score")), "positives")
    exact = F.col("positive_score").cast("decimal(20,0)")
    least, most = F.ceil(exact * low / 100).cast("long"), F.floor(exact * high / 100).cast("long")
    bands = best.withColumns({"low": least, "high": most}).filter("low <= high")
    bands = bands.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct(F.col("place").alias("slot"), "low", "high")).alias("bands"))
    found = best_in_bands(chosen.join(bands, "id"), rows, False, negatives, block, anchor_block)
    found = found.select("anchor", F.col("slot").alias("of"), F.col("place").alias("rank"), F.col("found").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = found.join(best.withColumnRenamed("place", "of"), ["anchor", "of"])
    return joined.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", "negative_id", "positive_score", "negative_score")
