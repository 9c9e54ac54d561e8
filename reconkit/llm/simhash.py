"""SimHash fingerprints and links at a small Hamming radius, compared as bit planes.

Fingerprints are cut into four fields; two that differ in at most two bits agree in two
whole fields, so equal pairs of fields give the candidates.  Within such a group the
fingerprints stand as bit planes: word k holds one bit of 64 fingerprints, differences
are added with carry-save counters, and a block stops as soon as all its distances
exceed the radius.  Groups above ``GROUP`` fingerprints are not compared at all: there
every fingerprint is listed under itself and under each single-bit change, and those
listed together differ in two bits at most, so each list is linked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from reconkit.llm.common import id_and_text, slices, stored
from reconkit.llm.components import components

BITS = 64
RADIUS = 2
FIELD = 16  # bits; four fields, any two give a key
GROUP = 4096  # fingerprints compared with each other in one task
AT_ONCE = 1 << 12  # words of a plane that queries of a block are compared with at once
SEED = 42
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)} | {chr(c): " " for c in (9, 10, 11, 12, 13)})


def fingerprint(text: str, words_in_shingle: int = 3) -> int:
    """SimHash of the word shingles, repeats included; 0 without words.

    A-Z count as a-z; words end at blanks 9 to 13 and 32.  A shorter text is one shingle.
    """
    words = [w for w in text.translate(_LOWER).split(" ") if w]
    if not words:
        return 0
    data = " ".join(words).encode("utf-8")
    ends = np.cumsum([len(w) + 1 for w in map(str.encode, words)]) - 1
    k = min(words_in_shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(data[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Each bit that is set in over half the hashes."""
    total = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 14):
        some = hashes[first : first + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_in_shingle: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, fingerprint`` (a long with the 64 bits) of every row; null text is empty."""

    def run(batches):
        for part in slices(batches):
            found = np.array([fingerprint(t, words_in_shingle) for t in part["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint long")


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 of them in a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = ((padded[None] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def near(values: np.ndarray, planes: np.ndarray, which: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position in ``which``, position in ``values``) at most ``radius`` bits apart."""
    found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    counters, words = max(1, int(radius).bit_length()), planes.shape[1]
    together = max(1, AT_ONCE // max(1, words))
    for first in range(0, len(which), together):
        some = which[first : first + together]
        # all ones where the query has the bit
        flips = np.uint64(0) - ((some[None] >> np.arange(BITS, dtype=np.uint64)[:, None]) & np.uint64(1))
        query, word = np.repeat(np.arange(len(some)), words), np.tile(np.arange(words), len(some))
        count = [np.zeros(len(word), np.uint64) for _ in range(counters)]
        over = np.zeros(len(word), np.uint64)
        for b in range(BITS):
            carry = planes[b, word] ^ flips[b, query]
            for c in count:  # add one bit to 64 counters at once
                c[:], carry = c ^ carry, c & carry
            over |= carry
            if b % 16 == 15:
                stay = (over | _above(count, radius)) != ~np.uint64(0)
                if not stay.all():
                    query, word, over, count = query[stay], word[stay], over[stay], [c[stay] for c in count]
                if not len(word):
                    break
        if len(word):
            far = over | _above(count, radius)
            bits = np.unpackbits(far.view(np.uint8).reshape(len(word), 8), axis=1, bitorder="little")
            row, bit = np.nonzero(bits == 0)
            at = word[row] * 64 + bit
            real = at < len(values)
            found[0].append(first + query[row[real]])
            found[1].append(at[real])
    return np.concatenate(found[0]), np.concatenate(found[1])


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters hold more than ``radius``."""
    more, same = np.zeros_like(count[0]), np.full_like(count[0], ~np.uint64(0))
    for bit in reversed(range(len(count))):
        if radius >> bit & 1:
            same &= count[bit]
        else:
            more |= same & count[bit]
            same &= ~count[bit]
    return more


def spanning(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together what is within the radius: (larger, smallest reachable) positions."""
    n = len(values)
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    planes = planes_of(values)
    for first in range(0, n, 512):
        some = values[first : first + 512]
        for a, b in zip(*near(values, planes, some)):
            x, y = root(first + int(a)), root(int(b))
            if x != y:
                parent[max(x, y)] = min(x, y)
    top = np.array([root(x) for x in range(n)], np.int64)
    child = np.flatnonzero(top != np.arange(n))
    return child, top[child]


def links(distinct: DataFrame, group: int = GROUP) -> DataFrame:
    """``a, b``: links between distinct fingerprints that join all within the radius, never all pairs.

    ``distinct`` has one column ``fingerprint`` (long) without repeats.
    """
    fields = [F.shiftrightunsigned("fingerprint", FIELD * i).bitwiseAND(0xFFFF) for i in range(BITS // FIELD)]
    keys = [F.struct(F.lit(i).alias("kind"), fields[a].alias("x"), fields[b].alias("y")) for i, (a, b) in enumerate(combinations(range(4), 2))]
    listed = distinct.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    sizes = listed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sized = listed.join(sizes, "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def flush():
            values = np.array(held, np.int64).view(np.uint64)
            x, y = spanning(values) if len(values) > 2 else _pair(values)
            values = values.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(values[x]), pa.array(values[y])], ["a", "b"])

        for batch in batches:
            for key, value in zip(batch["key"].to_pylist(), batch["fingerprint"].to_pylist()):
                key = (key["kind"], key["x"], key["y"])
                if key != held_key:
                    if held:
                        yield flush()
                    held_key, held = key, []
                held.append(value)
        if held:
            yield flush()

    few = sized.filter(F.col("n") <= group).select("key", "fingerprint")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: few bytes take long to compare
    small = few.repartition(parts, "key").sortWithinPartitions("key", "fingerprint").mapInArrow(compare, "a long, b long")
    # the rest: each value under itself and under every value one bit away
    flips = [F.lit(0).cast("long")] + [F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(BITS)]
    many = sized.filter(F.col("n") > group).select("fingerprint").distinct()
    spread = many.select("fingerprint", F.explode(F.transform(F.array(*flips), lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("near"))
    middle = spread.groupBy("near").agg(F.collect_set("fingerprint").alias("all"))  # at most 65 values
    exact = middle.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).filter("a <> b")
    return small.unionByName(exact)


def _pair(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    close = len(values) == 2 and int(values[0] ^ values[1]).bit_count() <= RADIUS
    return (np.array([1]), np.array([0])) if close else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def near_duplicates(docs: DataFrame, words_in_shingle: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id reachable over links.

    Rows without words have fingerprint 0 and link like any other.  A null id stays a row
    of its class but is never the smallest id, unless no other is there: then it is null.
    """
    marked = stored(fingerprints(docs, words_in_shingle, id_col, text_col), "fingerprints")
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    joined = stored(links(classes.select("fingerprint")), "links")
    groups = components(joined)  # node, component: fingerprints
    members = classes.join(groups, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    smallest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = members.join(smallest, "component").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
