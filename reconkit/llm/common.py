"""Helpers of the text operators: bounded Arrow slices, words and rolling hashes in numpy."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from reconkit.session import scratch_path

SLICE_BYTES = 1 << 20
_PRIME = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (as long) and the text (null as empty), under names that can't clash with others."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` text bytes each; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def tidy(run):
    """``run`` for ``mapInArrow``, which gives freed memory back to the system when its task ends: workers outlive tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform.startswith("linux"):
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return wrapped


def tasks_for(rows: int, each: int) -> int:
    """Tasks of about ``each`` rows; for ``coalesce``, which never makes them more than they are."""
    return max(1, -(-rows // each))


def joined_up(df: DataFrame, tasks: int | None) -> DataFrame:
    """``df`` in at most so many tasks, where the rows are known to be few; None leaves it as it is."""
    return df.coalesce(tasks) if tasks else df


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back: short lineage, rows survive lost executors.

    ``tasks`` bounds the files where the rows are known to be few.
    """
    path = scratch_path(df.sparkSession, name)
    joined_up(df, tasks).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fields(schema: StructType, **kinds: str) -> StructType:
    """A copy of ``schema`` with more fields."""
    return StructType([*schema.fields, *StructType.fromDDL(", ".join(f"{k} {v}" for k, v in kinds.items())).fields])


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, a line feed after each, and where each text starts (one more at the end)."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes + 1, out=starts[1:])
    data = "\n".join(texts.to_pylist()) + "\n"
    return np.frombuffer(data.encode("utf-8"), np.uint8), starts


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


class Powers:
    """Powers of the hash base and their inverses, grown on demand."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _PRIME), ("down", _INVERSE)):
                table = np.full(max(n, 1 << 20), base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that ``is_word`` (a table of 256) marks."""
    marks = np.zeros(len(data) + 2, np.int8)
    marks[1:-1] = is_word[data]
    steps = np.flatnonzero(np.diff(marks))
    return steps[0::2], steps[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from running sums; the same wherever the word stands."""
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions are left out."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - k + 1 + i])
    return out


def hash_of_words(words: list[str]) -> np.uint64:
    """The shingle hash of these words, as ``shingle_hashes`` gives it."""
    data = " ".join(words).encode("utf-8")
    buffer = np.frombuffer(data, np.uint8)
    table = np.ones(256, bool)
    table[32] = False
    return shingle_hashes(word_hashes(buffer, *words_of(buffer, table)), len(words))[0]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col="doc_id", text_col="text") -> DataFrame:
    """At most ``per_class`` texts of each value 0 and 1 of ``label``, chosen by a hash of id and text.

    ``doc_id, text`` and all columns of ``labels`` but its id come back.  Rows with a null id or
    another label take no part; an id with several labels or texts counts once for each pair.
    """
    own = id_and_text(docs, id_col, text_col)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[c for c in labels.columns if c not in ("doc_id", "text")])
    marks = marks.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = [marks.filter(F.col(label) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    # at most 2 * per_class rows, so the broadcast has a bound
    rows = own.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    order = F.xxhash64("doc_id", "text")
    parts = [rows.filter(F.col(label) == v).orderBy(order).limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def held_out(doc_id: Column) -> Column:
    """True for a quarter of the ids, whose labels no model sees."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2
