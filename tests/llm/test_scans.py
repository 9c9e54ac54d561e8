"""Secret and license scans, quality and toxicity models, and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reconkit.llm import decontaminate, licenses, quality, secret_scan, toxicity
from reconkit.llm.common import held_out
from reconkit.llm.queries import QUERIES, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def secret_texts():
    rng = random.Random(8)
    parts = ["password", "PASSWD", "secret", "token", "api_key", "ApiKey", " = ", ":", '"', "'", "é🙂", " ", "\n", "abc", "abcdef", "AKIA", "0123456789ABCDEF", "0123456789abcdef", "deadbeefcafe", "x"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(400)]


def test_secret_base_spans(spark, awkward, nothing, rows_of):
    docs = awkward.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(secret_texts())], "doc_id long, text string"), allowMissingColumns=True)
    base = F.filter("found", lambda x: x["kind"] != "random")
    got = secret_scan.find_secrets(docs).select("doc_id", secret_scan.digest(base).alias("s")).collect()
    want = [(d, ",".join(base_spans(t))) for d, t in rows_of(docs)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(w for _, w in want)
    assert secret_scan.find_secrets(nothing).count() == 0


def test_secret_query_digest(spark, folder):
    text = dict(map(tuple, table(spark, folder, "documents").select("doc_id", "text").collect()))
    rows = QUERIES["op5_secret_scan"](spark, folder).collect()
    assert len(rows) == len(text)
    for r in rows:
        spans = base_spans(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]


def test_random_strings_are_found_and_regular_ones_are_not(spark):
    rng = random.Random(2)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(alphabet, k=n)) + "7" for n in (24, 32, 40, 60) for _ in range(60)]
    dull = ["a" * 30 + "1", "abcabcabc" * 5 + "1", "0000000000000000000000001111111111111111", "word-word-word-word-word-word-1", "2024-01-01-2024-01-02-2024-01-03"]
    docs = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(keys + dull * 10)], "doc_id long, text string")
    found = {r["doc_id"] for r in secret_scan.find_secrets(docs).collect() if any(s["kind"] == "random" for s in r["found"])}
    assert len(found & set(range(len(keys)))) >= 0.9 * len(keys)
    assert len(found - set(range(len(keys)))) <= 0.1 * 10 * len(dull)


def test_p_value_is_uniform_for_random_strings(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("0123456789ABCDEF", k=48)),) for _ in range(1500)]
    p = [r[0] for r in spark.createDataFrame(rows, "v string").select(secret_scan.p_value(F.col("v"))).collect()]
    assert 0.02 <= np.mean(np.array(p) < 0.1) <= 0.16


def test_redact(spark, awkward, nothing, rows_of):
    done = secret_scan.redact(awkward)
    assert done.columns == awkward.columns and done.count() == awkward.count() and secret_scan.redact(nothing).count() == 0
    text = {r["doc_id"]: r["text"] for r in done.collect()}
    assert text[10] == "MIT license, Released under the MIT License. [secret] [secret]" and text[1] is None and text[2] == ""
    before = sorted((str(d), t) for d, t in rows_of(awkward) if not base_spans(t))
    assert [x for x in sorted((str(d), t) for d, t in rows_of(done)) if "[secret]" not in x[1]] == before


def test_license_phrases_and_notices(spark, awkward, nothing, rows_of, words):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(words, k=40)) + ".\n" + t + "\n" + " ".join(rng.choices(words, k=20)) for _, t in licenses.TEMPLATES]
    inserted = licenses.TEMPLATES[8][1].replace("source and binary", "source and also binary")
    texts += [inserted, "The Apache-License, mit/LICENSE general. Public license", "mit é license", "under the terms of"]
    docs = awkward.unionByName(spark.createDataFrame([(7000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True)
    rows = licenses.scan(docs).collect()
    plain = rows_of(docs)
    assert len(rows) == len(plain)
    want = []
    for doc, text in plain:
        own = decontaminate.words(text)
        hits = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in hits]
        want.append((doc, len(own), len(hits), min(at, default=None), max(at, default=None), sorted({x for _, x in hits})))
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    labels = {r["doc_id"]: r["labels"] for r in rows}
    for i, (label, _) in enumerate(licenses.TEMPLATES):
        assert label in labels[7000 + i]
    n = 7000 + len(licenses.TEMPLATES)
    assert [labels[n + i] for i in range(4)] == [["bsd"], ["apache", "gpl", "mit"], [], []]
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) and set(r["base_labels"]) <= set(r["labels"]) for r in rows)
    assert licenses.scan(nothing).count() == 0


def test_notice_spans(spark):
    text = "x y z licensed under cc by nc 4 0 end"
    row = licenses.notices(spark.createDataFrame([(1, text), (None, "a")], "doc_id long, text string")).collect()
    assert [(r["label"], r["first_word"], r["last_word"], r["score"]) for r in row] == [("cc-by-nc", 3, 9, 1.0)]


@pytest.fixture(scope="module")
def labelled(spark, words):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(360):
        own = rng.choices(words, k=rng.randint(20, 120))
        bad, rude = i % 3 == 0, i % 4 == 1
        if bad:
            own = [w + rng.choice(["&&&", "%%%", "###"]) for w in own]
        if rude:
            for w in rng.choices(["idiot", "grumpfel", "trash"], k=4):
                own.insert(rng.randrange(len(own)), w)
        rows.append((i, " ".join(own), 0))
        marks.append((i, int(not bad), int(rude)))
    return spark.createDataFrame(rows, "doc_id long, text string, score int"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark, labelled, awkward, nothing):
    docs, labels = labelled
    network = quality.fit(docs, labels.filter(~held_out(F.col("doc_id"))), "quality")
    rows = quality.score(docs, network).withColumn("out", held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [(r["score"] >= 0.7) == (r["quality"] == 1) for r in rows if r["out"]]
    assert np.mean(right) >= 0.95 and len(right) > 50
    scores = quality.score(awkward, network).collect()
    assert len(scores) == awkward.count() and all(0 <= r["score"] <= 1 for r in scores)
    kept = quality.accepted(awkward, network, 0.7)
    assert kept.columns == awkward.columns and kept.count() == sum(r["score"] >= 0.7 for r in scores)
    assert quality.score(nothing, network).count() == 0 == quality.accepted(nothing, network).count()


def test_quality_reads_the_whole_text(labelled):
    rng = np.random.default_rng(1)
    network = quality.Network(rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), rng.normal(size=quality.FILTERS), 0.1)
    network.filters[:, 0] = 0
    texts = ["", "a", "é" * 128, "ab" * 126, "xyz " * 5000, "\0" * 300, "q" * (1 << 17) + "end"]

    def plain(text):
        data = np.frombuffer(quality.as_bytes(text), np.uint8)
        n = int(quality.blocks_of(np.array(len(data))))
        padded = np.concatenate([data, np.zeros(n * quality.BLOCK + quality.WIDTH - len(data), np.uint8)])
        answer = sum(network.filters[j][padded[j : j + n * quality.BLOCK]] for j in range(quality.WIDTH))
        most = np.maximum(answer.reshape(n, quality.BLOCK, -1).max(axis=1), 0)
        chunks = most if n == 1 else np.maximum(most[:-1], most[1:])
        return 1 / (1 + np.exp(-(chunks.astype(float).mean(axis=0) @ network.weights + network.bias)))

    got = quality.score_texts(network, network.pair_tables(), texts)
    assert np.allclose(got, [plain(t) for t in texts], atol=1e-4)


def test_quality_without_labels(spark, labelled):
    docs, labels = labelled
    assert quality.score(docs, quality.fit(docs, labels.limit(0), "quality")).select("score").distinct().collect()[0][0] == 0.5
    ones = quality.fit(docs, labels.filter("quality = 1"), "quality")
    assert quality.score(docs, ones).select("score").distinct().count() == 1


def test_toxicity_chain(spark, labelled, awkward, nothing):
    docs, labels = labelled
    people = labels.join(docs, "doc_id").withColumn("people", (F.col("text").contains("idiot") & (F.col("toxic") == 1)).cast("int")).select("doc_id", "people", "toxic")
    chain = toxicity.fit(docs, people.filter(~held_out(F.col("doc_id"))), ["people", "toxic"])
    rows = toxicity.score(docs, chain).join(people, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["p_toxic"] >= 0.5) == (r["toxic"] == 1) for r in rows]) >= 0.95
    assert np.mean([(r["p_people"] >= 0.5) == (r["people"] == 1) for r in rows]) >= 0.9
    assert len(chain.links[1].earlier) == 1 and chain.links[1].earlier[0] > 0
    scored = toxicity.score(awkward, chain).collect()
    assert len(scored) == awkward.count() and all(0 <= r["p_toxic"] <= 1 for r in scored)
    assert toxicity.score(nothing, chain).count() == 0
    empty = toxicity.fit(docs, people.limit(0), ["people", "toxic"])
    assert toxicity.score(docs, empty).select("p_toxic").distinct().count() == 1


def test_later_links_learn_from_rows_they_have_not_seen():
    rng = np.random.default_rng(3)
    n = 400
    noise = rng.integers(1, 1 << 40, (n, 30)).astype(np.uint64) % np.uint64(60) + np.uint64(1)
    row, term = np.repeat(np.arange(n), 30), noise.ravel()
    both = np.unique(np.rec.fromarrays([row, term]))
    y = rng.integers(0, 2, (n, 2)).astype(float)
    chain = toxicity.fit_chain(["a", "b"], n, both.f0, both.f1, y, np.arange(n) % toxicity.FOLDS)
    # the first category is noise, so its out-of-fold probability is of no use to the second
    assert abs(chain.links[1].earlier[0]) < 3
    y[:, 1] = y[:, 0] = (noise == 7).any(axis=1)
    chain = toxicity.fit_chain(["a", "b"], n, both.f0, both.f1, y, np.arange(n) % toxicity.FOLDS)
    assert chain.links[1].earlier[0] > 1


def test_pipeline_stages(spark, folder, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    docs = table(spark, folder, "documents")
    items = [decontaminate.shingles(r["text"]) for r in table(spark, folder, "benchmark").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(k))
        stage(spark, docs, folder).write.parquet(out)
        new = spark.read.parquet(out)
        if name == "best-fit packing":
            assert {r["doc_id"] for r in new.collect()} == set(before) and new.count() > 0
            break
        assert new.columns == docs.columns
        rows = new.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "secret scans":
            assert not gone and all(not base_spans(t) for t in after.values())
            assert all(after[d] == before[d] for d in after if "[secret]" not in after[d]) and all(r["n_chars"] == len(r["text"]) for r in rows)
        else:
            assert all(after[d] == before[d] for d in after)
        held = {d: decontaminate.shingles(t) for d, t in before.items()}
        if name == "benchmark decontamination":
            assert gone == {d for d, s in held.items() if any(len(q & s) >= 0.8 * len(q) for q in items if q)}
        if name == "simhash near-dedup":
            def alike(x, y):
                same = len(held[x] & held[y])
                return before[x] == before[y] or same and same >= 0.8 * (len(held[x]) + len(held[y]) - same)

            ids = sorted(before)
            assert all(any(alike(d, o) for o in ids if o < d) for d in gone)
            assert not any(alike(a, b) for i, a in enumerate(sorted(after)) for b in sorted(after)[:i])
        before, docs = after, new
