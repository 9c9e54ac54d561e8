"""SimHash, near copies, decontamination and nearest neighbours against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reconkit.llm import decontaminate, near_copies, neighbours, simhash
from reconkit.llm.components import components


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes, linked):
    """Smallest node of each node's component, by search."""
    out = {}
    for start in sorted(nodes):
        if start in out:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += [y for y in nodes if y not in out and linked(x, y)]
    return out


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aB é\t\n\x1c z", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=20), st.lists(st.integers(0, 63), max_size=60), st.integers(0, 20))
def test_bit_planes_find_all_within_the_radius(base, flips, radius):
    values = list(base)
    for i, b in enumerate(flips):
        values.append(values[i % len(values)] ^ (1 << b))
    values = np.array(values, np.uint64)
    a, b = simhash.near(values, simhash.planes_of(values), values, radius)
    want = {(i, j) for i, x in enumerate(values) for j, y in enumerate(values) if int(x ^ y).bit_count() <= radius}
    assert set(zip(a.tolist(), b.tolist())) == want


@pytest.mark.parametrize("group", [1, 5, 4096])
def test_links_join_what_is_near(spark, group):
    rng = random.Random(group)
    values = {rng.getrandbits(64) for _ in range(30)}
    for _ in range(120):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = {r["node"]: r["component"] for r in components(simhash.links(df, group)).collect()}
    want = smallest_reachable(signed, lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count() <= 2)
    assert {v: found.get(v, v) for v in signed} == want


def test_simhash_components_of_awkward_texts(spark, awkward, nothing, rows_of):
    rows = simhash.near_duplicates(awkward).collect()
    plain = rows_of(awkward)
    assert len(rows) == len(plain)
    prints = {}
    for doc, text in plain:
        prints.setdefault(slow_fingerprint(text), []).append(doc)
    top = smallest_reachable(list(prints), lambda x, y: (x ^ y).bit_count() <= 2)
    least = {}
    for value, ids in prints.items():
        known = [d for d in ids if d is not None]
        least[top[value]] = min([*known, *least.get(top[value], [])], default=None)
        least[top[value]] = [] if least[top[value]] is None else [least[top[value]]]
    got = sorted(((r["doc_id"], r["fingerprint"] & (2**64 - 1), r["component_id"]) for r in rows), key=str)
    want = sorted(((d, slow_fingerprint(t), (least[top[slow_fingerprint(t)]] or [None])[0]) for d, t in plain), key=str)
    assert got == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()))
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def copies(words, n, rng):
    """Originals with copies in which some words are changed."""
    out = []
    for i in range(n):
        own = rng.choices(words, k=rng.choice([8, 60, 200]))
        out.append(" ".join(own))
        for share in (0.0, 0.01, 0.03, 0.3):
            out.append(" ".join(rng.choice(words) if rng.random() < share else w for w in own))
    return out


def test_near_copies(spark, words, awkward, nothing, rows_of):
    rng = random.Random(3)
    texts = copies(words, 40, rng)
    docs = awkward.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True)
    kept = near_copies.deduplicated(docs)
    assert kept.columns == docs.columns
    plain = sorted({(d is None, d or 0, t) for d, t in rows_of(docs)})
    sets = [decontaminate.shingles(t) for _, _, t in plain]

    def linked(i, j):
        if plain[i][2] == plain[j][2]:
            return True
        same = len(sets[i] & sets[j])
        return bool(same) and same >= 0.8 * (len(sets[i]) + len(sets[j]) - same)

    top = smallest_reachable(list(range(len(plain))), linked)
    want = sorted({(plain[i][1] if not plain[i][0] else None, plain[i][2]) for i in top.values()}, key=str)
    assert sorted(rows_of(kept), key=str) == want
    assert near_copies.deduplicated(nothing).count() == 0


def many_partitions(spark):
    """A session whose shuffles have far more partitions than these tests have rows for, none of them coalesced."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "64")
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return own


def tasks_of(spark, run):
    """What ``run`` returns and how many tasks its jobs had."""
    group, sc = f"tasks-{random.random()}", spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    told = sc.statusTracker()
    stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
    return out, sum(x.numCompletedTasks for x in map(told.getStageInfo, stages) if x)


def test_few_links_take_few_tasks(spark):
    """Rounds of components follow the number of links, not that of a shuffle's partitions."""
    rng = random.Random(41)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(250)] + [(5, 5), (3, 2)]
    own = many_partitions(spark)
    links = own.createDataFrame(edges, "a long, b long").coalesce(2)
    found, tasks = tasks_of(own, lambda: dict(map(tuple, components(links).collect())))
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    pairs = {frozenset(e) for e in edges}
    assert found == smallest_reachable(nodes, lambda x, y: frozenset((x, y)) in pairs)
    assert tasks < 200


def test_small_near_copies_take_few_tasks(spark, words):
    """Few texts: steps between the comparisons don't take a task for each partition of a shuffle."""
    texts = copies(words, 40, random.Random(43)) + star(random.Random(12).choices(words, k=200), 60, 9, random.Random(14))
    own = many_partitions(spark)
    docs = own.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    kept, tasks = tasks_of(own, lambda: sorted(r["doc_id"] for r in near_copies.deduplicated(docs).collect()))
    want = sorted(r["doc_id"] for r in near_copies.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), group=16).collect())
    assert kept == want and tasks < 1500


def test_large_groups_are_dealt_to_cells(spark, words):
    rng = random.Random(4)
    own = rng.choices(words, k=400)
    rows = []
    for i in range(300):
        copy = list(own)
        copy[rng.randrange(400)] = f"w{i}"
        rows.append((bytes([i // 256, i % 256]), " ".join(copy)))
    sketched = near_copies.sketches(spark.createDataFrame(rows, "key binary, text string")).cache()
    found = components(near_copies.candidate_links(sketched, group=64)).collect()
    assert len({bytes(r["component"]) for r in found}) == 1 and len(found) == 300


def star(own, n, changed, rng):
    """A text and copies of it, each with other words at some five-word stretches of its own."""
    out = [" ".join(own)]
    for i in range(n):
        copy = list(own)
        for at in rng.sample(range(0, len(own), 5), changed):
            copy[at] = f"w{i}x{at}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("group", [32, near_copies.GROUP])
def test_large_stars_hold_together(spark, words, group):
    """Copies close to one text only, in groups above and below the size of a cell: each must meet that text."""
    texts = star(random.Random(12).choices(words, k=200), 400, 4, random.Random(14))  # all share a band with the first
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert [r["doc_id"] for r in near_copies.deduplicated(docs, group=group).collect()] == [0]


def test_short_near_copies_far_apart_in_bits(spark):
    """Four of five shingles in common, over RADIUS bits apart."""
    rng = random.Random(21)
    texts = []
    while len(texts) < 40:
        own = [f"w{rng.randrange(10**6)}" for _ in range(9)]
        pair = [" ".join(own), " ".join(own[:8])]
        a, b = (simhash.majority(np.unique(decontaminate.text_shingles(pa.array([t]))[0])) for t in pair)
        if (a ^ b).bit_count() > near_copies.RADIUS:
            texts += pair
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sketched = near_copies.sketches(docs.selectExpr("cast(text as binary) as key", "text")).collect()
    bands = {bytes(r["key"]).decode(): set(r["bands"]) for r in sketched}
    met = [i for i in range(0, 40, 2) if bands[texts[i]] & bands[texts[i + 1]]]
    kept = {r["doc_id"] for r in near_copies.deduplicated(docs).collect()}
    assert len(met) >= 18 and kept == set(range(40)) - {i + 1 for i in met}


def test_contained_items(spark, words, awkward, nothing, rows_of):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate([3, 5, 6, 9, 14, 30, 59, 120])] + [(50, None), (51, " !"), (52, "same TEXT, here"), (None, "only here it has a null id")]
    texts = []
    for i, text in [x for x in items if x[1] and len(x[1]) > 3]:
        own = text.split()
        host = rng.choices(words, k=rng.choice([50, 3000]))
        at = rng.randrange(len(host))
        texts.append(" ".join(host[:at] + own + host[at:]))
        texts.append(" ".join(host[:at] + own[: len(own) // 2] + host[at:]))
        texts.append(text.upper().replace(" ", " - "))
    docs = awkward.unionByName(spark.createDataFrame([(2000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], round(r["containment"], 9)) for r in decontaminate.contained_items(docs, bench).collect()}
    want = set()
    for doc, text in rows_of(docs):
        held = decontaminate.shingles(text)
        for item, wanted in ((i, decontaminate.shingles(t or "")) for i, t in items):
            if wanted and len(wanted & held) >= 0.8 * len(wanted):
                want.add((doc, item, round(len(wanted & held) / len(wanted), 9)))
    assert got == want and len(want) > 15
    assert decontaminate.contained_items(nothing, bench).count() == 0
    assert decontaminate.contained_items(docs, bench.limit(0)).count() == 0


def test_text_shingles_agree_with_words():
    texts = ["", "a", "a b c d", "A b, c! d e f", "é日 x 7 y z"]
    hashes, cuts = decontaminate.text_shingles(pa.array(texts))
    assert np.diff(cuts).tolist() == [len(decontaminate.shingles(t)) for t in texts]


def test_forest_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    data = np.vstack([rng.normal(size=(1200, 16)), rng.normal(size=(40, 16)).repeat(20, axis=0) + 0.05 * rng.normal(size=(800, 16))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [float("inf")] * 16), (None, rows[0][1]), (20, rows[20][1]), (5080, [1.0, 2.0]), (5081, [2.0, 1.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    vectors = vectors.unionByName(spark.createDataFrame([(5100, [1.0, None])], "vec_id long, embedding array<double>"), allowMissingColumns=True)
    found = neighbours.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by_query) == {*range(0, 2000, 20), 5080}
    assert [v for v, _ in by_query.pop(5080)] == [5081]
    hits = 0
    for query, own in by_query.items():
        scores = data @ data[query]
        assert len(own) == 20 and query not in dict(own)
        assert all(abs(scores[v] - s) < 1e-9 for v, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20]) & set(dict(own)))
    assert hits >= 0.9 * 20 * len(by_query)
    assert neighbours.search(vectors.limit(0), vectors).count() == 0 == neighbours.search(vectors, vectors.limit(0)).count()


def test_forest_ties_go_to_the_smaller_id(spark):
    vectors = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(60)], "vec_id long, embedding array<float>")
    found = neighbours.search(vectors, vectors.filter("vec_id = 40"), k=5).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("n, group", [(600, near_copies.GROUP), (900, 200)])
def test_boilerplate_stays_in_its_cells(spark, words, n, group):
    """Texts from one boilerplate, similar to about 0.66, and a few true copies: only these leave the cells."""
    rng = random.Random(31)
    own = rng.choices(words, k=200)
    texts = []
    for i in range(n):
        copy = list(own)
        for at in rng.sample(range(0, 200, 5), 9):
            copy[at] = f"w{i}x{at}"
        texts.append(" ".join(copy))
    texts += [t.rsplit(" ", 1)[0] for t in texts[:6]]
    sets = [decontaminate.shingles(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    keyed = docs.select(near_copies.text_key(F.col("text")).alias("key"), "text", "doc_id").cache()
    sketched = near_copies.sketches(keyed.select("key", "text")).cache()
    none = spark.createDataFrame([], "node binary, component binary")
    apart = near_copies.undecided(sketched, none)
    links = near_copies.open_links(apart, sketched, near_copies.shingle_sets(keyed.select("key", "text")), group=group)
    ids = {bytes(r["key"]): r["doc_id"] for r in keyed.collect()}
    got = {tuple(sorted((ids[bytes(r["a"])], ids[bytes(r["b"])]))) for r in links.collect()}
    share = lambda i, j: (same := len(sets[i] & sets[j])) / (len(sets[i]) + len(sets[j]) - same)
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if share(i, j) >= 0.8}
    assert want <= got and len(got) < 1000
    # beyond the true links only those that the spare shingles let through
    assert all(share(i, j) > 0.78 for i, j in got)


def test_pipeline_bounds_batches_and_row_groups(spark, tmp_path):
    """What a task holds of the texts at once: batches that the allocator pools, rows decoded at once, row groups."""
    import pyarrow.parquet as pq

    import corpus_pipeline

    own = spark.newSession()
    corpus_pipeline.small_batches(own)
    random = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.sha2(F.concat_ws("-", "id", i), 512)))
    texts = own.range(0, 10_000, 1, 1).select("id", random.alias("text"))  # 41 MB in one task

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "n"])

    found = texts.mapInArrow(sizes, "bytes long, n long").agg(F.max("bytes").alias("most"), F.sum("n").alias("n")).first()
    assert found.n == 10_000 and found.most <= 2 << 20
    texts.write.parquet(str(tmp_path / "texts"))
    (file,) = (tmp_path / "texts").glob("*.parquet")
    facts = pq.ParquetFile(file).metadata
    assert facts.num_rows == 10_000 and max(facts.row_group(i).total_byte_size for i in range(facts.num_row_groups)) <= 16 << 20
    assert int(own.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
