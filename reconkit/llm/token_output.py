"""Token ids as canonical length-limited Huffman codes, in independent blocks.

A token file is a folder: ``code`` holds the length of each id's code, ``blocks`` the
blocks.  A block holds whole documents, each from a byte limit on, and bit offsets every
``CHECKPOINT_IDS`` ids, so any stretch can be decoded by itself.  Codes come from the
counts of the whole input; decoding looks up ``LIMIT`` bits at once in a table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from reconkit.llm.common import id_and_text, slices, stored, tidy
from reconkit.llm.tokens import TEXT_BYTES, encoder
from reconkit.session import local_rows

LIMIT = 18  # longest code in bits
CHECKPOINT_IDS = 512
BLOCK_BYTES = 128 << 10

_BLOCK = (
    "part int, block int, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "doc_bytes array<long>, checkpoints binary, payload binary"
)


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, ids`` (unsigned 16 bits, little-endian), ``end_id`` after each document; null text is empty."""
    return counted_token_ids(docs, tokenizer, end_id, id_col, text_col).filter("counts is null").drop("counts")


def counted_token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col="doc_id", text_col="text") -> DataFrame:
    """``token_ids`` with a column ``counts``: null but for one row a task, which has no ids but counts those of the task's others."""

    def run(batches):
        own, total = encoder(tokenizer, True), np.zeros(1 << 16, np.int64)
        end = np.array([end_id], "<u2")
        names = ["doc_id", "ids", "counts"]
        for part in slices(batches, limit=TEXT_BYTES):
            found = own.encode(part["text"])
            for ids in found:
                total += np.bincount(ids, minlength=1 << 16) if len(ids) > 1 << 14 else 0
            short = [ids for ids in found if len(ids) <= 1 << 14]
            total += np.bincount(np.concatenate([*short, np.repeat(end, len(found))]), minlength=1 << 16)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([x.tobytes() + end.tobytes() for x in found], pa.binary()), pa.nulls(len(found), pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, ids binary, counts binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs, from the ``counts`` rows of ``counted_token_ids`` or else the ids themselves."""
    given = "counts" in tokens.columns

    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for part in slices(batches, "told"):
            held = part["told"].to_pylist()
            total += sum(np.frombuffer(x, "<i8") for x in held) if given else np.bincount(np.frombuffer(b"".join(held), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["id", "n"])

    told = F.col("counts" if given else "ids").alias("told")
    return tokens.select(told).filter("told is not null").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves, row, kinds = counts[used].astype(np.float64), np.zeros(0), []
    for _ in range(limit):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        row = both[order]
        kinds.append(order < len(leaves))
    need = 2 * len(used) - 2
    for kind in reversed(kinds):
        n = int(kind[:need].sum())
        lengths[used[:n]] += 1
        need = 2 * (need - n)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id: the lengths alone restore them."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        steps = np.uint64(1) << (LIMIT - lengths[order]).astype(np.uint64)
        left = np.concatenate([[np.uint64(0)], np.cumsum(steps)[:-1]])
        codes[order] = left >> (LIMIT - lengths[order]).astype(np.uint64)
    return codes


def pack_bits(ids: np.ndarray, n: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Codes of documents with ``n`` ids each, every document from a byte limit on.

    Returns the bytes, where each document starts (one more at the end), and each id's bit offset in its document.
    """
    size = lengths[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    bounds = np.concatenate([[0], np.cumsum(n)])
    bits = ends[bounds[1:]] - ends[bounds[:-1]]
    starts = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    inside = ends[:-1] - np.repeat(ends[bounds[:-1]], n)
    at = inside + np.repeat(8 * starts[:-1], n)
    words = (8 * starts[-1] + 31) // 32
    shifted = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    # bits never overlap, so sums below 2**32 stand for "or" and stay exact in doubles
    out = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), words + 1)
    out += np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)[: words + 1]
    return out[:words].astype(">u4").tobytes()[: starts[-1]], starts, inside


class Decoder:
    def __init__(self, lengths: np.ndarray):
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = 1 << (LIMIT - lengths[order])
        self.id, self.size = np.zeros(1 << LIMIT, np.uint16), np.ones(1 << LIMIT, np.int64)
        self.id[: spans.sum()] = np.repeat(order, spans)
        self.size[: spans.sum()] = np.repeat(lengths[order], spans)

    def ids(self, payload: bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``n`` ids from each bit offset ``at``, all offsets in step; one table look-up per id."""
        if not len(at):
            return np.zeros(0, np.uint16)
        longest = int(n.max())
        data = np.frombuffer(payload + bytes(4 + longest * LIMIT // 8 + 1), np.uint8).astype(np.uint32)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.empty((longest, len(at)), np.uint16)
        at = at.astype(np.int64)
        for step in range(longest):
            bits = (window[at >> 3] >> (32 - LIMIT - (at & 7)).astype(np.uint32)) & np.uint32((1 << LIMIT) - 1)
            out[step] = self.id[bits]
            at = at + self.size[bits]
        return out.T[np.arange(longest) < n[:, None]]


def place(doc_id: int | None, tie: int) -> tuple[bool, int, int]:
    """Sort key of a document, null ids first."""
    return doc_id is not None, doc_id or 0, tie


def write_token_file(tokens: DataFrame, path: str) -> None:
    """Write ``doc_id, ids`` to the folder ``path`` in ascending order of doc_id, nulls first, equal ids by content.

    ``tokens`` is read several times, so it should be stored, with ``tie = xxhash64(ids)`` for the
    order of equal ids and the ``counts`` of ``counted_token_ids``; what is missing is made.
    No ids at all make empty tables.
    """
    spark = tokens.sparkSession
    counts = np.zeros(1 << 16, np.int64)
    for row in id_counts(tokens).collect():  # at most one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    local_rows(spark, [(int(i), int(lengths[i])) for i in used], "id long, bits long").coalesce(1).write.parquet(f"{path}/code")

    # stretches of ascending (doc_id, tie), found on the keys alone: a range shuffle of the
    # codes would make them twice, once for its sample
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_first("doc_id"), F.col("tie").asc()]
    tokens = tokens.filter("ids is not null")
    keyed = tokens if "tie" in tokens.columns else tokens.withColumn("tie", F.xxhash64("ids"))
    spread = keyed.select("doc_id", "tie").repartitionByRange(4 * parts, *order).withColumn("p", F.spark_partition_id())
    # one row per stretch
    starts_of = sorted(place(*r[0]) for r in spread.groupBy("p").agg(F.min(F.struct("doc_id", "tie")).alias("m")).select("m").collect())

    def code(batches):
        for part in slices(batches, "ids", 1 << 20):
            rows = part["ids"].to_pylist()
            n = np.array([len(r) // 2 for r in rows], np.int64)
            data, starts, inside = pack_bits(np.frombuffer(b"".join(rows), "<u2"), n, codes, lengths)
            bits = [data[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            cuts = np.concatenate([[0], np.cumsum(n)]).tolist()
            marks = [inside[a:b:CHECKPOINT_IDS].astype("<i8").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            keys = zip(part["doc_id"].to_pylist(), part["tie"].to_pylist())
            stretch = [bisect_right(starts_of, place(*key)) - 1 for key in keys]
            own = [pa.array(n), pa.array(bits, pa.binary()), pa.array(marks, pa.binary()), pa.array(stretch, pa.int32())]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["tie"], *own], ["doc_id", "tie", "n", "bits", "marks", "stretch"])

    def block(batches):
        part = number = first = 0
        for some in slices(batches, "bits", BLOCK_BYTES):
            stretch = some["stretch"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(stretch)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows = some.slice(a, b - a)
                if stretch[a] != part:
                    part, number, first = int(stretch[a]), 0, 0
                n, bits = rows["n"].to_numpy(), rows["bits"].to_pylist()
                at = np.concatenate([[0], np.cumsum([len(x) for x in bits])])[:-1]
                marks = [np.frombuffer(m, "<i8") + 8 * x for m, x in zip(rows["marks"].to_pylist(), at)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                        pa.array([int(n.sum())], pa.int64()), pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                        pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([[len(x) for x in bits]], pa.list_(pa.int64())),
                        pa.array([np.concatenate(marks).astype("<i8").tobytes()], pa.binary()), pa.array([b"".join(bits)], pa.binary()),
                    ],
                    ["part", "block", "first_id", "n_ids", "doc_ids", "lengths", "doc_bytes", "checkpoints", "payload"],
                )
                number, first = number + 1, first + int(n.sum())

    coded = keyed.mapInArrow(code, "doc_id long, tie long, n long, bits binary, marks binary, stretch int")
    ordered = coded.repartition(parts, "stretch").sortWithinPartitions("stretch", *order)
    ordered.mapInArrow(block, _BLOCK).write.parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document: ids as unsigned 32 bits, little-endian."""
    lengths = np.zeros(1 << 16, np.int64)
    for row in spark.read.parquet(f"{path}/code").collect():  # at most one row per id of the vocabulary
        lengths[row["id"]] = row["bits"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # one row per stretch, of which there are four for each shuffle partition when it was written
    totals = sorted(tuple(r) for r in blocks.groupBy("part").agg(F.sum("n_ids")).collect())
    before, seen = {}, 0
    for part, n in totals:
        before[part], seen = seen, seen + n

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder(lengths)
        for rows in slices(batches, "payload", 16 * BLOCK_BYTES):
            payloads = rows["payload"].to_pylist()
            lengths_of = [np.array(x, np.int64) for x in rows["lengths"].to_pylist()]
            base = 8 * (np.cumsum([len(p) for p in payloads]) - [len(p) for p in payloads])
            marks = np.concatenate([np.frombuffer(m, "<i8") + b for m, b in zip(rows["checkpoints"].to_pylist(), base)])
            n = np.concatenate(lengths_of)
            stretches = -(-n // CHECKPOINT_IDS)
            size = np.full(stretches.sum(), CHECKPOINT_IDS, np.int64)
            size[np.cumsum(stretches)[n > 0] - 1] = ((n - 1) % CHECKPOINT_IDS + 1)[n > 0]
            ids = own.ids(b"".join(payloads), marks, size).astype("<u4").tobytes()
            ends = np.cumsum(n)
            cut = [ids[4 * (e - m) : 4 * e] for e, m in zip(ends.tolist(), n.tolist())]
            of_block = np.repeat(np.arange(len(payloads)), [len(x) for x in lengths_of])
            block_start = np.array([before[p] for p in rows["part"].to_pylist()]) + rows["first_id"].to_numpy()
            block_ids = np.array([x.sum() for x in lengths_of])
            start = (block_start - np.cumsum(block_ids) + block_ids)[of_block] + ends - n
            doc_ids = pa.array([d for x in rows["doc_ids"].to_pylist() for d in x], pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start), pa.array(n), pa.array(cut, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def token_round_trip(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col="doc_id", text_col="text") -> DataFrame:
    """Encode all texts, write the token file and read it back."""
    tokens = stored(counted_token_ids(docs, tokenizer, end_id, id_col, text_col).withColumn("tie", F.xxhash64("ids")), "token-ids")
    write_token_file(tokens, path)
    return read_token_file(docs.sparkSession, path)
