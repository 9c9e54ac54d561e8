"""Name matching by equality and by prefix."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reconkit.operators.cumulative import MAX_ROW_BUCKETS
from reconkit.session import checkpointed, local_rows, parallelism

BATCH_CHARACTERS = 1 << 20


def _prefixes(name: str) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(1), F.length(name)), lambda n: F.substring(F.col(name), F.lit(1), n)))


def short_prefix_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: Sequence[str] = ()
) -> DataFrame:
    """``prefix_match_join`` for names: two equi-joins on all prefixes, without a stored copy.

    A text of n characters is written n times over, so this is for column names and the like.
    """
    by = list(by)
    a = left.select(*by, F.col(left_on).alias("_a")).filter(F.length("_a") > 0).distinct()
    b = right.select(*by, F.col(right_on).alias("_b")).filter(F.length("_b") > 0).distinct()
    longer_a = a.select(*by, "_a", _prefixes("_a").alias("_b")).join(b, [*by, "_b"], "left_semi")
    longer_b = b.select(*by, "_b", _prefixes("_b").alias("_a")).join(a, [*by, "_a"], "left_semi")
    pairs = longer_a.unionByName(longer_b).distinct()
    return pairs.select(*by, F.col("_a").alias(left_on), F.col("_b").alias(right_on))


class _Open:
    """Texts of one group that the sweep has passed and that the current text starts with."""

    def __init__(self) -> None:
        self.group, self.texts = None, []

    def move(self, group: tuple, text: str) -> None:
        """Go on to the next text in order and drop what it does not start with."""
        if group != self.group:
            self.group, self.texts = group, []
        while self.texts and not text.startswith(self.texts[-1][0]):
            self.texts.pop()


def _rows(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple]:
    for batch in batches:
        groups = zip(*(batch[c].to_pylist() for c in by)) if by else iter([()] * batch.num_rows)
        yield from zip(batch["_range"].to_pylist(), groups, *(batch[c].to_pylist() for c in ("_t", "_a", "_b")))


def _starts(ranged: DataFrame, by: list[str]) -> dict[int, list[tuple[int, bool, bool]]]:
    """For each range, the texts of earlier ranges that its first text starts with, as (length, on the left, on the right).

    What is open at the end of a range are prefixes of its last text, so lengths are enough,
    and of two neighbouring ranges only the common beginning of their edge texts counts.
    """
    kinds = {f.name: f.dataType for f in ranged.schema}
    group = ", ".join(f"{side}_{c} {kinds[c].simpleString()}" for side in ("first", "last") for c in by)
    edge = "part int, " + (group + ", " if by else "") + "first string, last string, open array<struct<n: int, a: boolean, b: boolean>>"
    edge_schema = to_arrow_schema(StructType.fromDDL(edge))

    def edges(batches):
        state, first, at = _Open(), None, None
        for at, group, text, a, b in _rows(batches, by):
            first = first or (group, text)
            state.move(group, text)
            state.texts.append((text, a, b))
        if first:
            row = {"part": at, "first": first[1], "last": state.texts[-1][0], "open": [{"n": len(t), "a": a, "b": b} for t, a, b in state.texts]}
            row |= {f"first_{c}": v for c, v in zip(by, first[0])} | {f"last_{c}": v for c, v in zip(by, state.group)}
            yield pa.RecordBatch.from_pylist([row], edge_schema)

    found = checkpointed(ranged.mapInArrow(edges, edge))
    parts = [r[0] for r in found.select("part").orderBy("part").collect()]
    after = local_rows(ranged.sparkSession, list(zip(parts, parts[1:])), "_before int, _part int")
    before = found.join(after, found["part"] == after["_before"]).select("_part", F.col("last").alias("_last"), *[F.col(f"last_{c}").alias(f"_last_{c}") for c in by])

    def shared(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                same = {side: r["_part"] is not None and all(r[f"_last_{c}"] == r[f"{side}_{c}"] for c in by) for side in ("first", "last")}
                common = {side: len(os.path.commonprefix([r["_last"], r[side]])) if same[side] else 0 for side in same}
                out.append({"part": r["part"], "at_first": common["first"], "at_last": common["last"], "open": r["open"]})
            yield pa.RecordBatch.from_pylist(out, short_schema)

    short = "part int, at_first int, at_last int, open array<struct<n: int, a: boolean, b: boolean>>"
    short_schema = to_arrow_schema(StructType.fromDDL(short))
    met = found.join(before, found["part"] == before["_part"], "left").mapInArrow(shared, short)
    carried, starts = [], {}
    for r in met.orderBy("part").collect():  # one row a range: lengths, no texts
        starts[r["part"]] = [e for e in carried if e[0] <= r["at_first"]]
        carried = [e for e in carried if e[0] <= r["at_last"]] + [(e["n"], e["a"], e["b"]) for e in r["open"]]
        carried = sorted({e[0]: e for e in carried}.values())
    return starts


def prefix_match_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Pairs where either text is a prefix of the other, for texts of any length.

    The distinct texts of both sides are range-partitioned in order.  All that start with a
    text follow it without a gap, so one pass over a range with a stack of open prefixes
    finds its pairs; what is open across a range limit is carried as lengths.  Each text is
    shuffled twice, whatever its length.  Empty and null texts, and rows with a null in
    ``by``, match nothing.
    """
    by = list(by)
    side = lambda df, on, a: df.select(*by, F.col(on).alias("_t"), F.lit(a).alias("_a"), F.lit(not a).alias("_b"))
    both = side(left, left_on, True).unionByName(side(right, right_on, False)).filter(F.length("_t") > 0).dropna(subset=by or None)
    texts = both.groupBy(*by, "_t").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    spread = texts.repartitionByRange(parts or parallelism(left.sparkSession, MAX_ROW_BUCKETS), *by, "_t").sortWithinPartitions(*by, "_t")
    ranged = checkpointed(spread.withColumn("_range", F.spark_partition_id()))
    starts = _starts(ranged, by)
    schema = StructType([ranged.schema[c] for c in by]).add(left_on, "string").add(right_on, "string")
    arrow = to_arrow_schema(schema)

    def sweep(batches):
        state, begun, out, held = _Open(), False, [], 0
        for at, group, text, a, b in _rows(batches, by):
            if not begun:
                begun, state.group = True, group
                state.texts = [(text[:n], x, y) for n, x, y in starts.get(at, [])]
            state.move(group, text)
            found = [(text, text)] if a and b else []
            for t, x, y in state.texts:
                found += ([(text, t)] if a and y else []) + ([(t, text)] if b and x else [])
            state.texts.append((text, a, b))
            for pair in found:
                out.append((*group, *pair))
                held += len(pair[0]) + len(pair[1]) + 64
                if held > BATCH_CHARACTERS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return ranged.mapInArrow(sweep, schema)


def list_difference(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    mode: str = "prefix",
    drop: Sequence[str] = (),
) -> DataFrame:
    """Distinct names of ``left`` without a match in ``right``, after a drop list.

    Drop patterns are regular expressions anchored at the start of the name.
    """
    names = left.select(left_on).distinct()
    if drop:
        names = names.filter(~F.col(left_on).rlike("^(?:" + "|".join(drop) + ")"))
    if mode == "exact":
        matched = right.select(F.col(right_on).alias(left_on))
    elif mode == "prefix":
        matched = prefix_match_join(names, right, left_on, right_on).select(left_on)
    else:
        raise ValueError(f"unknown mode {mode}")
    return names.join(matched.distinct(), left_on, "left_anti")


def greedy_column_match(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """One-to-one name mapping per table pair: equal names, then free prefix matches.

    ``source``/``target``: (by..., position, column_name).  Candidates come from
    a distributed join on prefixes; only the choice between them is sequential, inside
    one table pair, whose size is the number of columns of a table.
    """
    by = list(by)
    a = source.select(*by, F.col("position").alias("a_pos"), F.col("column_name").alias("a"))
    b = target.select(*by, F.col("position").alias("b_pos"), F.col("column_name").alias("b"))
    pairs = short_prefix_join(a, b, "a", "b", by)
    first_a = a.groupBy(*by, "a").agg(F.min("a_pos").alias("a_pos"))
    first_b = b.groupBy(*by, "b").agg(F.min("b_pos").alias("b_pos"))
    candidates = pairs.join(first_a, [*by, "a"]).join(first_b, [*by, "b"])

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        equal = pdf[pdf.a == pdf.b]
        chosen = list(zip(equal.a_pos, equal.a, equal.b))
        done, taken = set(equal.a), set(equal.b)
        for row in pdf[pdf.a != pdf.b].sort_values(["a_pos", "b_pos"]).itertuples():
            if row.a not in done and row.b not in taken:
                done.add(row.a)
                taken.add(row.b)
                chosen.append((row.a_pos, row.a, row.b))
        out = pd.DataFrame(chosen, columns=["position", "source_name", "target_name"])
        for i, name in enumerate(by):
            out.insert(i, name, key[i])
        return out

    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in by] + ["position int", "source_name string", "target_name string"])
    return candidates.groupBy(*by).applyInPandas(choose, schema)
