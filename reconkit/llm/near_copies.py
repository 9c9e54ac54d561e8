"""Near copies on word shingles: SimHash distances as bit planes, then exact Jaccard similarity.

Two texts with a Jaccard similarity of 0.8 differ in some 10 and seldom 20 of 64 SimHash bits,
too many for keys made of the bits.  So candidates meet under bands of MinHash values of
the same shingles; inside a group the bit-sliced comparison of ``simhash`` keeps what is
within the radius.  Of these pairs only a forest that holds the group together goes on,
pairs with the most equal MinHash values first, and each of its links is verified on the
texts themselves.  Texts of a group that lie in different components after that are compared
block by block, whatever their distance in bits: each such pair with enough equal MinHash
values is compared in its cell, on sorted 32-bit hashes of the shingles, and only what
passes there goes on to the texts.  So neither the radius nor a link that failed hides a
true one, and texts of one boilerplate send no pairs out of their cells.  Equal texts are
one text from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reconkit.llm.common import joined_up, mixed, slices, stored, tasks_for, tidy
from reconkit.llm.components import LINKS, components
from reconkit.llm.decontaminate import shingles, text_shingles
from reconkit.llm.simhash import majority, near, planes_of

RADIUS = 20  # bits
SIMILARITY = 0.8
SLACK = 0.2  # the share of equal MinHash values may fall this much short: over four standard deviations
BANDS, ROWS = 16, 5  # a pair of similarity 0.8 shares no band with chance 0.002
GROUP = 1024  # texts compared with each other in one cell of a larger group
TOGETHER = 256  # texts of small cells that are compared in one go, each with those of its cell
CELL_BYTES = 4 << 20  # shingle hashes of a block of such texts
SPARE = 2  # shingles that 32-bit hashes may fall short by
BROADCAST_KEYS = 1 << 18  # of 16 bytes; more keys are joined by a shuffle of the texts
ANCHORS = 128  # texts of a larger group that every cell of it holds
TEXTS = 1 << 11  # in a task, of keys, sketches and bands; a shuffle may have far more partitions than that
PAIRS = 1 << 9  # in a task, with both texts
_FACTORS = mixed(np.arange(101, 101 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    own = F.coalesce(text, F.lit(""))
    return F.unhex(F.substring(F.sha2(own, 256), 1, 32))


def sketches(texts: DataFrame) -> DataFrame:
    """``key, size, fingerprint, bands, values`` of each text (``key, text``) that has a word; values are 16 bits of each MinHash."""

    def run(batches):
        for part in slices(batches):
            hashes, cuts = text_shingles(part["text"])
            rows = np.flatnonzero(np.diff(cuts))
            if not len(rows):
                continue
            values = np.empty((len(_FACTORS), len(rows)), np.uint64)
            for j, factor in enumerate(_FACTORS):
                values[j] = np.minimum.reduceat(hashes * factor, cuts[rows])
            bands = np.zeros((BANDS, len(rows)), np.uint64)
            for b in range(BANDS):
                for r in range(ROWS):
                    bands[b] = mixed(bands[b] * np.uint64(31) + values[b * ROWS + r])
                bands[b] ^= np.uint64(b)
            different = [np.unique(hashes[cuts[i] : cuts[i + 1]]) for i in rows]
            prints = np.array([majority(x) for x in different], np.uint64)
            sizes = pa.array([len(x) for x in different], pa.int32())
            listed = pa.array(list(np.ascontiguousarray(bands.T).view(np.int64)), pa.list_(pa.int64()))
            own = part["key"].take(pa.array(rows))
            kept = [v.tobytes() for v in np.ascontiguousarray(mixed(values).T).astype("<u2")]
            columns = [own, sizes, pa.array(prints.view(np.int64)), listed, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "size", "fingerprint", "bands", "values"])

    return texts.mapInArrow(tidy(run), "key binary, size int, fingerprint long, bands array<long>, values binary")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``key, shingles``: sorted upper halves of each text's different shingle hashes, four bytes each."""

    def run(batches):
        for part in slices(batches):
            hashes, cuts = text_shingles(part["text"])
            sets = [(np.unique(hashes[a:b]) >> np.uint64(32)).astype("<u4") for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([part["key"], pa.array([x.tobytes() for x in sets], pa.binary())], ["key", "shingles"])

    return texts.mapInArrow(tidy(run), "key binary, shingles binary")


def common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values of each of the others ``one`` holds too; all are sorted and not empty."""
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat(hit, starts, dtype=np.int64)


def holding(prints: np.ndarray, values: np.ndarray, cells: np.ndarray, radius: int = RADIUS, similarity: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links that join all pairs of a cell within the radius whose MinHash values don't speak against them; likest first."""
    parent = list(range(len(prints)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    planes, found = planes_of(prints), []
    for first in range(0, len(prints), 16):
        a, b = near(prints, planes, prints[first : first + 16], radius)
        keep = (b < a + first) & (cells[a + first] == cells[b])
        a, b = a[keep] + first, b[keep]
        alike = (values[a] == values[b]).sum(axis=1, dtype=np.uint16)
        keep = alike >= (similarity - SLACK) * values.shape[1]
        found.append((alike[keep], a[keep].astype(np.uint16), b[keep].astype(np.uint16)))
    alike, left, right = (np.concatenate(x) for x in zip(*found))
    out = []
    for level in np.unique(alike)[::-1]:
        at = np.flatnonzero(alike == level)
        for a, b in zip(left[at].tolist(), right[at].tolist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((a, b))
        if len(out) == len(prints) - 1:
            break
    return out


def candidate_links(sketched: DataFrame, radius: int = RADIUS, group: int = GROUP, tasks: int | None = None) -> DataFrame:
    """``a, b``: keys of texts within the radius that share a band; links, not all pairs.

    ``tasks`` bounds those that deal out texts, not those that compare them.

    Groups above ``group`` texts are dealt to cells by hash; some ``ANCHORS`` of them are in
    every cell, so that most of a group holds together.  ``open_links`` has the pairs left.
    """
    listed = sketched.select("key", F.explode("bands").alias("band"))
    sizes = listed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    sized = listed.join(sizes, "band")
    cells = F.ceil(F.col("n") / group).cast("int")
    own_cell = F.pmod(F.xxhash64("key"), cells).cast("int")
    # about ANCHORS texts of a large group, chosen by hash, go to all its cells
    anchor = (F.col("n") > group) & (F.pmod(F.xxhash64("key", "band"), F.ceil(F.col("n") / ANCHORS)) == 0)
    cell = F.when(anchor, F.sequence(F.lit(0), cells - 1)).otherwise(F.array(own_cell))
    named = joined_up(sized.select("band", "key", F.explode(cell).alias("cell")), tasks)
    dealt = joined_up(named.join(sketched.select("key", "fingerprint", "values"), "key"), tasks)

    def compare(batches):
        mark, cells, keys, prints, values = None, [], [], [], []

        def flush():
            own = np.frombuffer(b"".join(values), "<u2").reshape(len(keys), -1)
            links = holding(np.array(prints, np.int64).view(np.uint64), own, np.array(cells), radius)
            return pa.RecordBatch.from_arrays([pa.array([keys[i] for i, _ in links], pa.binary()), pa.array([keys[j] for _, j in links], pa.binary())], ["a", "b"])

        number = 0
        for batch in batches:
            for band, one, key, print_, value in zip(*(batch[c].to_pylist() for c in ("band", "cell", "key", "fingerprint", "values"))):
                if (band, one) != mark:
                    if len(keys) >= TOGETHER:  # small cells are compared in one go
                        yield flush()
                        cells, keys, prints, values = [], [], [], []
                    mark, number = (band, one), number + 1
                cells.append(number)
                keys.append(key)
                prints.append(print_)
                values.append(value)
        if keys:
            yield flush()

    parts = int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: few bytes take long to compare
    ordered = dealt.repartition(parts, "band", "cell").sortWithinPartitions("band", "cell", "key")
    return ordered.mapInArrow(tidy(compare), "a binary, b binary").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def undecided(sketched: DataFrame, groups: DataFrame, tasks: int | None = None) -> DataFrame:
    """``at, band, key, component, n, bytes, most``: groups of texts that share a band and lie in several components.

    ``groups`` are the components so far (``node, component``); a text in none is its own.
    ``n`` texts are in the group, ``most.n`` of them in the component ``most.component``;
    their shingle hashes take ``bytes``.
    """
    own = F.coalesce("component", "key").alias("component")
    named = sketched.join(groups, sketched["key"] == groups["node"], "left").select("key", own, "size", "bands")
    listed = joined_up(named, tasks).select("key", "component", "size", F.posexplode("bands").alias("at", "band"))
    counts = listed.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum(F.col("size") * 4).alias("bytes"))
    sizes = joined_up(counts, tasks).groupBy("band").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "component")).alias("most"))
    return listed.drop("size").join(sizes.filter("n > most.n"), "band")


def hub_links(apart: DataFrame, groups: DataFrame, good: DataFrame, tasks: int | None = None) -> DataFrame:
    """``a, b``: each text outside its group's largest component with that component's best linked text."""
    degrees = good.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    best = joined_up(groups.join(degrees, "node"), tasks).groupBy("component").agg(F.max(F.struct("links", "node")).alias("best"))
    hubs = joined_up(best.select(F.col("component").alias("home"), F.col("best.node").alias("hub")), tasks)
    asking = apart.filter(F.col("component") != F.col("most.component")).select("key", F.col("most.component").alias("home")).distinct()
    met = joined_up(asking, tasks).join(hubs, "home").select(F.greatest("key", "hub").alias("a"), F.least("key", "hub").alias("b"))
    return joined_up(met, tasks).distinct()


def open_links(apart: DataFrame, sketched: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, group: int = GROUP, tasks: int | None = None) -> DataFrame:
    """``a, b``: pairs of the ``undecided`` groups that lie in different components and are near copies by their hashes.

    Texts outside a group's largest component meet all its texts: every block of the former
    is compared with every block of the latter in a cell of its own, so no pair is left out.
    Only MinHash values and ``shingle_sets`` count here: few shingles may differ in more
    bits than any radius.  A pair is compared under the first band that both texts have.
    """
    blocks = F.ceil(F.greatest(F.col("n") / group, F.col("bytes") / CELL_BYTES)).cast("int")
    sides = F.ceil(blocks * (F.col("n") - F.col("most.n")) / F.col("n")).cast("int")
    rest = F.col("component") != F.col("most.component")
    asked = F.transform(F.sequence(F.lit(0), sides - 1), lambda i: F.struct(i.alias("side"), F.pmod(F.xxhash64("key"), blocks).cast("int").alias("block"), F.lit(False).alias("asks")))
    asking = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(F.pmod(F.xxhash64("key"), sides).cast("int").alias("side"), i.alias("block"), F.lit(True).alias("asks")))
    cell = F.explode(F.when(rest, F.concat(asked, asking)).otherwise(asked)).alias("cell")
    dealt = apart.select("at", "band", "key", "component", rest.alias("rest"), cell).select("at", "band", "cell.*", "key", "component", "rest")
    dealt = joined_up(dealt.join(sketched.select("key", "size", "bands", "values").join(sets, "key"), "key"), tasks)
    told = ["at", "key", "component", "rest", "asks", "size", "bands", "values", "shingles"]

    def compare(batches):
        mark, rows = None, []

        def flush():
            number = {}
            at, keys = rows[0][0], [r[1] for r in rows]
            part = np.array([number.setdefault(r[2], len(number)) for r in rows])
            beyond, asks = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
            sizes, bands = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
            values = np.frombuffer(b"".join(r[7] for r in rows), "<u2").reshape(len(rows), -1)
            held = [np.frombuffer(r[8], "<u4") for r in rows]
            place = {k: i for i, k in enumerate(sorted(set(keys)))}
            order = np.array([place[k] for k in keys])
            other, some = np.flatnonzero(~asks), np.flatnonzero(asks)
            columns = np.ascontiguousarray(values[other].T)
            found = []
            for first in range(0, len(some), 16):
                x = some[first : first + 16]
                # two texts of the rest ask each other: once is enough
                fit = (part[x][:, None] != part[other]) & (~beyond[other] | (order[x][:, None] > order[other]))
                less, more = np.minimum(sizes[x][:, None], sizes[other]), np.maximum(sizes[x][:, None], sizes[other])
                fit &= less >= similarity * more
                if np.count_nonzero(fit) > len(fit) * 64:  # value by value; else pair by pair
                    alike = sum((values[x, v][:, None] == columns[v]).view(np.uint8) for v in range(len(columns)))
                    i, j = np.nonzero(fit & (alike >= (similarity - SLACK) * len(columns)))
                    i, j = x[i], other[j]
                else:
                    i, j = np.nonzero(fit)
                    i, j = x[i], other[j]
                    keep = (values[i] == values[j]).sum(axis=1) >= (similarity - SLACK) * values.shape[1]
                    i, j = i[keep], j[keep]
                keep = ~(bands[i, :at] == bands[j, :at]).any(axis=1)
                i, j = i[keep], j[keep]
                for a in np.unique(i).tolist():
                    b = j[i == a]
                    same = common(held[a], [held[k] for k in b.tolist()]) + SPARE
                    found += [(a, k) for k in b[same >= similarity * (sizes[a] + sizes[b] - same)].tolist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in end], pa.binary()) for end in zip(*found)], ["a", "b"])

        for batch in batches:
            for band, side, block, *row in zip(*(batch[c].to_pylist() for c in ("band", "side", "block", *told))):
                if (band, side, block) != mark:
                    if rows:
                        yield from flush()
                    mark, rows = (band, side, block), []
                rows.append(row)
        if rows:
            yield from flush()

    parts = int(sketched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "band", "side", "block").sortWithinPartitions("band", "side", "block", "key")
    return ordered.mapInArrow(tidy(compare), "a binary, b binary").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def verified(links: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, tasks: int | None = None) -> DataFrame:
    """The links whose texts' shingle sets have at least that Jaccard similarity."""
    left = joined_up(links.join(texts.select(F.col("key").alias("a"), F.col("text").alias("x")), "a"), tasks)
    both = joined_up(left.join(texts.select(F.col("key").alias("b"), F.col("text").alias("y")), "b"), tasks)

    def run(batches):
        for batch in batches:
            for part in slices(iter([batch]), "x"):
                keep = []
                for x, y in zip(part["x"].to_pylist(), part["y"].to_pylist()):
                    one, two = shingles(x), shingles(y)
                    same = len(one & two)
                    keep.append(same >= similarity * (len(one) + len(two) - same))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a binary, b binary")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, id_col="doc_id", text_col="text", group: int = GROUP) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (nulls last); all columns stay.

    Null texts are empty ones; texts without words are copies only of equal texts.  Of
    rows that repeat id and text one stays.  Columns ``__key, __of, __stays, __id, __n`` and
    ``__wanted`` must be free.
    """
    keyed = docs.withColumn("__key", text_key(F.col(text_col)))
    # one row per text: its smallest id, how many rows hold that id and how many it has in all
    first = F.min_by(F.struct("id", "n"), F.struct(F.col("id").isNull(), "id"))
    each = keyed.groupBy(F.col("__key").alias("key"), F.col(id_col).alias("id")).agg(F.count("*").alias("n"))
    slim = stored(each.groupBy("key").agg(first.alias("first"), F.sum("n").alias("rows")).select("key", "first.id", "first.n", "rows"), "texts")
    tasks = tasks_for(slim.count(), TEXTS)
    sketched = sketches(keyed.select(F.col("__key").alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))).dropDuplicates(["key"])
    sketched = stored(sketched, "sketches", tasks)
    candidates = stored(candidate_links(sketched, radius, group, tasks), "candidates", tasks)

    def small(keys, n):
        """Broadcast where the number of keys allows it, so that no text is shuffled."""
        return F.broadcast(keys) if n <= BROADCAST_KEYS else keys

    def texts_of(keys, n):
        """``key, text`` of these ``n`` keys (stored, without repeats), once each."""
        named = keys.withColumnRenamed("key", "__wanted")
        found = keyed.join(small(named, n), keyed["__key"] == named["__wanted"], "left_semi")
        return joined_up(found.groupBy(F.col("__key").alias("key")).agg(F.first(F.coalesce(text_col, F.lit(""))).alias("text")), tasks_for(n, PAIRS))

    def proven(pairs):
        many = pairs.count()
        ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "ends", tasks_for(many, LINKS))
        texts = stored(texts_of(ends, ends.count()), "end-texts")
        return stored(verified(pairs, texts, similarity, tasks_for(many, PAIRS)), "verified")

    def merged(groups, found):
        """The components after more links, from those before."""
        return stored(components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found)), "components")

    good = proven(candidates)
    groups = stored(components(good), "components")
    apart = stored(undecided(sketched, groups, tasks), "undecided", tasks)
    if not apart.isEmpty():
        # most of what is left belongs to a hub; then all pairs of different components that were not tried
        hubs = stored(hub_links(apart, groups, good, tasks).join(candidates, ["a", "b"], "left_anti"), "hubs", tasks)
        tried = candidates.unionByName(hubs)
        groups = merged(groups, proven(hubs))
        apart = stored(undecided(sketched, groups, tasks), "undecided", tasks)
        wanted = stored(joined_up(apart.select("key").distinct(), tasks), "undecided-keys")
        sets = stored(shingle_sets(texts_of(wanted, wanted.count())), "shingles")
        left = joined_up(open_links(apart, sketched, sets, similarity, group, tasks), tasks)
        groups = merged(groups, proven(stored(left.join(tried, ["a", "b"], "left_anti"), "open", tasks)))
    named = slim.join(groups, slim["key"] == groups["node"], "left").withColumn("component", F.coalesce("component", "key"))
    best = F.min_by(F.struct("key", "id", "n"), F.struct(F.col("id").isNull(), "id", "key"))
    named = joined_up(named, tasks)
    whole = named.groupBy("component").agg(best.alias("best"), F.sum("rows").alias("rows")).filter("rows > 1")
    # only texts with more rows or copies have a fate, all others stay
    fates = named.join(whole.drop("rows"), "component").select(
        F.col("key").alias("__of"), (F.col("best.key") == F.col("key")).alias("__stays"), F.col("best.id").alias("__id"), F.col("best.n").alias("__n")
    )
    fates = stored(fates, "fates", tasks)
    chosen = keyed.join(small(fates, fates.count()), F.col("__key") == F.col("__of"), "left")
    chosen = chosen.filter(F.col("__of").isNull() | (F.col("__stays") & F.col(id_col).eqNullSafe(F.col("__id"))))
    kept = chosen.filter("__of is null or __n = 1")
    if not fates.filter("__stays and __n > 1").isEmpty():
        kept = kept.unionByName(chosen.filter("__n > 1").dropDuplicates(["__key"]))
    return kept.select(docs.columns)
