"""Best-fit packing of token sequences with large items matched first.

All decisions depend on how many pieces there are of each length, so the plan is made
from one count per length (at most the capacity).  Pieces above a third of the capacity
meet at most one other in a bin: the longest takes the longest that still fits.  The
rest go, longest first, to the tightest gap.  The plan is a list of rules "pieces of
length l with ranks r0.. go to bins b0.., t in each, from offset o", whose number the
capacity bounds.  Ranks come from counts per task, so no length meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from reconkit.llm.common import id_and_text, slices, stored, tidy, with_fields
from reconkit.llm.tokens import TEXT_BYTES, encoder

CAPACITY = 4096


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, piece, start, length, ids`` (unsigned 32 bits, little-endian); only longer documents are cut.

    Null text is empty; every document has at least its end id.
    """

    def run(batches):
        own = encoder(tokenizer, False)
        end = np.array([end_id], "<u4")
        for part in slices(batches, limit=TEXT_BYTES):
            columns = [[], [], [], [], []]
            for doc, ids in zip(part["doc_id"].to_pylist(), own.encode(part["text"].to_pylist())):
                ids = np.concatenate([ids.astype("<u4"), end])
                for k, first in enumerate(range(0, len(ids), capacity)):
                    cut = ids[first : first + capacity]
                    for column, value in zip(columns, (doc, k, first, len(cut), cut.tobytes())):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids"])
        own.forget()

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, piece int, start long, length long, ids binary")


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rules (length, first rank, rows, rows in each bin, first bin, offset) from the pieces of each length."""
    left = counts.astype(object)  # Python integers: counts have no bound
    taken = [0] * (capacity + 1)
    gaps: dict[int, list[tuple[int, int]]] = {}
    rules, bins = [], 0

    def put(length: int, n: int, each: int, first_bin: int, offset: int) -> None:
        rules.append((length, taken[length], n, each, first_bin, offset))
        taken[length] += n
        left[length] -= n

    def leave(gap: int, first_bin: int, n: int) -> None:
        if gap and n:
            gaps.setdefault(gap, []).append((first_bin, n))

    least = capacity // 3
    for a in range(capacity, least, -1):
        b = min(a, capacity - a)
        while left[a]:
            while b > least and (left[b] < 1 or b == a and left[a] < 2):
                b -= 1
            if b <= least:
                n = left[a]
                put(a, n, 1, bins, 0)
                leave(capacity - a, bins, n)
            elif a == b:
                n = left[a] // 2
                put(a, 2 * n, 2, bins, 0)
                leave(capacity - 2 * a, bins, n)
            else:
                n = min(left[a], left[b])
                put(a, n, 1, bins, 0)
                put(b, n, 1, bins, a)
                leave(capacity - a - b, bins, n)
            bins += n
    for a in range(least, 0, -1):
        fits = sorted(g for g in gaps if g >= a)
        while left[a]:
            if fits:
                gap = fits[0]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], fits[0]
            else:
                gap, first, n = capacity, bins, -(-left[a] // (capacity // a))
                bins += n
            each = gap // a
            full = min(n, left[a] // each)
            if full:
                put(a, full * each, each, first, capacity - gap)
                leave(gap - each * a, first, full)
            if full < n and left[a]:  # the last pieces of this length share one bin
                rest = left[a]
                put(a, rest, rest, first + full, capacity - gap)
                leave(gap - rest * a, first + full, 1)
                full += 1
            leave(gap, first + full, n - full)
    return np.array(rules, np.int64).reshape(-1, 6)


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``; other columns stay.

    ``items`` is written to the shared folder once; the columns ``_part`` and ``_rank`` must be free.
    """
    schema = items.schema

    def rank(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            length = batch["length"].to_numpy()
            order = np.argsort(length, kind="stable")
            sizes = np.bincount(length, minlength=capacity + 1)
            ranks = np.empty(len(length), np.int64)
            ranks[order] = np.arange(len(length)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(seen, sizes)
            seen += sizes
            own = [pa.array(np.full(len(length), part, np.int32)), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "_part", "_rank"])

    ranked = stored(items.mapInArrow(rank, with_fields(schema, _part="int", _rank="long")), "pieces")
    sizes = ranked.groupBy("length", "_part").agg(F.count("*").alias("n"))
    over = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    befores = sizes.withColumn("_before", F.coalesce(F.sum("n").over(over), F.lit(0))).drop("n")
    counts = np.zeros(capacity + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]
    rules = plan(counts, capacity)
    rules = rules[np.lexsort((rules[:, 1], rules[:, 0]))]
    first_rule = np.searchsorted(rules[:, 0], np.arange(capacity + 2))

    def assign(batches):
        for batch in batches:
            length, position = batch["length"].to_numpy(), batch["_rank"].to_numpy() + batch["_before"].to_numpy()
            at = np.empty(len(length), np.int64)
            for one in np.unique(length):
                rows, lo, hi = length == one, first_rule[one], first_rule[one + 1]
                at[rows] = lo + np.searchsorted(rules[lo:hi, 1], position[rows], side="right") - 1
            _, r0, _, each, b0, offset = rules[at].T
            own = [pa.array(b0 + (position - r0) // each), pa.array(offset + (position - r0) % each * length)]
            keep = [batch[c] for c in schema.names]
            yield pa.RecordBatch.from_arrays([*keep, *own], [*schema.names, "sequence_id", "offset"])

    joined = ranked.join(befores, ["length", "_part"])
    return joined.mapInArrow(assign, with_fields(schema, sequence_id="long", offset="long"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, id_col="doc_id", text_col="text") -> DataFrame:
    """Pieces of all documents with their ids and their places."""
    return place(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), capacity)
