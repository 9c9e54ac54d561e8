"""Packing, token files and token counts against the library, one text at a time."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reconkit.llm import packing, token_counts, token_output, tokens

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "s", "t", "r", "v", "e", "l", "m", "d", "'", " ", "  ", "\n", "\t ", "7", "!", "é", "日", "\x1c", "\x85 ", "<|endoftext|>", "İ"]


LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}
COUNTER = token_counts.TokenCounter(BYTES)


def library_ids(path, text):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=5))
def test_ids_and_counts_equal_the_library(texts):
    for path, spaces in ((BYTES, True), (WORDS, False)):
        own = tokens.encoder(path, spaces).encode(texts)
        assert [x.tolist() for x in own] == [library_ids(path, t) for t in texts]
    assert COUNTER.counts(texts).tolist() == [len(library_ids(BYTES, t)) for t in texts]


ODD = [*PIECES, *"xyzÀÿ×÷ªµ.,-'|<>09²½", "'s", "'ll", "\r\n", "\x0b", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u0301", "ß", "ŀ", "я", "ह", "🙂", "\x00", "\x7f"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=25).map("".join), max_size=6))
def test_cut_texts_equal_the_library(texts):
    own = tokens.encoder(BYTES, True)
    want = [library_ids(BYTES, t) for t in texts]
    for given_texts in (texts, pa.array([None, "x ", *texts], pa.string())[2:], pa.array([*texts, "s"], pa.large_string())[: len(texts)]):
        assert [x.tolist() for x in own.encode(given_texts)] == want


def test_words_are_kept_without_their_marks():
    own = tokens.PieceEncoder(BYTES, True)
    words = [f"{a}{b}" for a in ("Ein", "zwei", "élan", "Übe") for b in "abcde"]
    text = " ".join(w + m for w in words for m in (".", ",", "!", ".\nUnd", ":\n\nOder", ")"))
    assert own.encode([text])[0].tolist() == library_ids(BYTES, text)
    assert len(own.seen.pieces) <= len(words) + 12  # not one for each word and mark


def test_table_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 20)
    monkeypatch.setattr(tokens, "SEEN_PIECES", 20)
    own = tokens.PieceEncoder(BYTES, True)
    for i in range(10):
        text = " ".join(["again", "w0x1", *(f"w{i}x{j}." for j in range(15)), "and", f"w{i - 1}x14.", "again"])
        assert own.encode([text])[0].tolist() == library_ids(BYTES, text)
        assert len(own.kept) <= 35 and len(own.bare) <= 35 and len(own.seen.pieces) <= 35


def test_long_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "SEEN_LETTERS", 5000)
    own = tokens.PieceEncoder(BYTES, True)
    for i in range(40):
        text = f"{i}" + "日本語" * 300 + f" kept {i}"
        assert own.encode([text])[0].tolist() == library_ids(BYTES, text)
        assert sum(map(len, own.seen.pieces)) == own.seen.letters <= 7000


def test_token_counts_of_awkward_texts(spark, awkward, nothing, rows_of):
    found = sorted(map(tuple, token_counts.count_tokens(awkward, BYTES).collect()), key=str)
    want = [(d, len(t.encode()), len(library_ids(BYTES, t))) for d, t in rows_of(awkward)]
    assert found == sorted(((*w, w[2] > 512) for w in want), key=str)
    assert token_counts.count_tokens(nothing, BYTES).count() == 0


def test_token_file_round_trip(spark, awkward, nothing, rows_of, tmp_path):
    path = str(tmp_path / "file")
    found = token_output.token_round_trip(awkward, path, BYTES).collect()
    want = sorted((d is not None, d or 0, np.array([*library_ids(BYTES, t), 0], "<u4").tobytes()) for d, t in rows_of(awkward))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in found) == want
    order = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r["doc_id"] for r in found), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in order] == [sum(r["n_tokens"] for r in order[:i]) for i in range(len(order))]
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.selectExpr("max(length(payload))").head()[0] < 4 * sum(r["n_tokens"] for r in found)
    assert token_output.token_round_trip(nothing, str(tmp_path / "none"), BYTES).count() == 0


@pytest.mark.parametrize("limit", [9, 12, 18])
def test_code_lengths_are_limited_and_complete(limit):
    rng = np.random.default_rng(limit)
    counts = np.zeros(1000, np.int64)
    used = rng.choice(1000, 300, replace=False)
    counts[used] = (1.1 ** np.arange(300)).astype(np.int64) + 1
    lengths = token_output.code_lengths(counts, limit)
    assert lengths.max() <= limit and (lengths > 0).sum() == 300
    assert sum(2.0 ** -lengths[used]) == 1
    if limit == 18:
        fixed = token_output.code_lengths(counts, 9)
        assert (counts * lengths).sum() <= (counts * fixed).sum()


def test_codes_of_one_and_no_id():
    counts = np.zeros(10, np.int64)
    assert token_output.code_lengths(counts).sum() == 0
    counts[3] = 5
    assert token_output.code_lengths(counts).tolist() == [0, 0, 0, 1, 0, 0, 0, 0, 0, 0]


def test_pack_bits_and_decoder():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.01, 5000), 900).astype("<u2")
    lengths = token_output.code_lengths(np.bincount(ids, minlength=1 << 16))
    n = np.array([0, 1, 700, 0, 4299])
    data, starts, inside = token_output.pack_bits(ids, n, token_output.canonical_codes(lengths), lengths)
    own, first = token_output.Decoder(lengths), 0
    for a, b, size in zip(starts[:-1], starts[1:], n):
        marks = inside[first : first + size : token_output.CHECKPOINT_IDS]
        sizes = np.minimum(size - np.arange(len(marks)) * token_output.CHECKPOINT_IDS, token_output.CHECKPOINT_IDS)
        assert own.ids(data[a:b], marks, sizes).tolist() == ids[first : first + size].tolist()
        first += size


def check_places(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_awkward_texts(spark, awkward, nothing, rows_of):
    rows = packing.pack(awkward, WORDS, 1, 512).collect()
    want = []
    for doc, text in rows_of(awkward):
        ids = [*library_ids(WORDS, text), 1]
        want += [(doc, k, a, np.array(ids[a : a + 512], "<u4").tobytes()) for k, a in enumerate(range(0, len(ids), 512))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in rows), key=str) == sorted(want, key=str)
    n = check_places(rows, 512)
    assert n <= 1.05 * -(-sum(r["length"] for r in rows) // 512) + 1
    assert packing.pack(nothing, WORDS).count() == 0


def test_hot_length_is_spread(spark):
    items = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 7L, id % 29 + 1) as length").repartition(6)
    rows = packing.place(items, 30).collect()
    assert len(rows) == 3000
    total = sum(r["length"] for r in rows)
    assert check_places(rows, 30) <= 1.03 * total / 30 + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_plan_places_everything_once(lengths):
    capacity = 20
    counts = np.bincount(np.array(lengths, np.int64), minlength=capacity + 1)
    rows = []
    for length, r0, n, each, b0, offset in packing.plan(counts, capacity).tolist():
        rows += [{"length": length, "sequence_id": b0 + i // each, "offset": offset + i % each * length} for i in range(n)]
    assert sorted(r["length"] for r in rows) == sorted(lengths)
    # first fit decreasing is the usual yardstick
    bins = []
    for x in sorted(lengths, reverse=True):
        k = next((i for i, b in enumerate(bins) if b + x <= capacity), None)
        if k is None:
            bins.append(x)
        else:
            bins[k] += x
    assert check_places(rows, capacity) <= len(bins) + 1


def test_query_digest(spark, folder):
    from reconkit.llm.queries import QUERIES, table

    text = dict(plain_rows(table(spark, folder, "documents")))
    ids = {d: np.array([*library_ids(BYTES, t), 0], "<u4") for d, t in random.Random(1).sample(sorted(text.items()), 40)}
    found = {r["doc_id"]: r for r in QUERIES["op7_token_file"](spark, folder).collect()}
    assert len(found) == len(text)
    assert all(found[d]["ids_crc32"] == zlib.crc32(x.tobytes()) and found[d]["n_tokens"] == len(x) for d, x in ids.items())


def plain_rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
