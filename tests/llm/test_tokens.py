import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltmill.llm import packing, token_files, tokens

from .conftest import corpus

pytest.importorskip("public_tokenizers")
FILES = {tokens.ByteLevel: "byte_bpe_50k.json", tokens.WordEnds: "word_bpe_49k.json"}
ODD = ["a  b\n\n c d.", "  lead", "trail ", "\n", "a\tb \n c", "I'm he's, don't! it's 3.14 ́x", "ÀÉ İstanbul Σας ΣΑΣ H̱ x", "<|endoftext|> hi", "foo!, bar?. z", "a\x1cb !\x1c! c", " ", "\r\n\r\nfoo\r\n", "“foo”. ”, x—y… 12a34", "日本語、テスト。foo", "a b  c", "﻿x", "１２３ a१b"]


@pytest.mark.parametrize("kind", FILES)
def test_ids_like_the_library(kind, monkeypatch):
    e = kind(tokens.vocabulary(FILES[kind]))
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice("ab Z.,'!\n\t 0é”— İ's  -") for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + [t for _, t in corpus() if t is not None]
    for most in (tokens.MEMO, 50):  # a memo that overflows all the time too
        monkeypatch.setattr(tokens, "MEMO", most)
        monkeypatch.setattr(tokens.W, "CHUNK", 4000)
        got = [ids for _, run in e(pa.array(texts)) for ids in run]
        assert all(np.array_equal(a, e.one(t)) for a, t in zip(got, texts, strict=True))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=9), max_size=6))
def test_coding_round_trip(docs):
    parts = [token_files.encode(np.array(d, np.uint32)) for d in docs]
    out = token_files.decode(b"".join(c for c, _ in parts), b"".join(d for _, d in parts), np.array([len(d) for d in docs], np.int64))
    assert out.tolist() == [x for d in docs for x in d]


def test_files(spark, make, tmp_path):
    e = tokens.ByteLevel(tokens.vocabulary("byte_bpe_50k.json"))
    rows = [r for r in corpus(2) if r[0] is not None] + [(-5, "x" * 3000), (None, "no id")]
    for size in (1 << 30, 3000):
        token_files.write_ids(make(rows), f"file://{tmp_path}/{size}", shard_bytes=size)
        got = [tuple(r) for r in token_files.read_ids(spark, f"file://{tmp_path}/{size}").collect()]
        want, at = [], 0
        coded = [(i, np.append(e.one(t) if t else np.zeros(0, np.uint32), np.uint32(2)).astype("<u4")) for i, t in rows]
        for i, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1].tobytes()))):
            want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
        assert sorted(got, key=lambda r: r[1]) == want
    # one id with a third of all rows, all alike: its rows are cut over shards
    hot = [(k, f"text {k}") for k in range(400)] + [(7, "the same text again")] * 200
    token_files.write_ids(make(hot), f"file://{tmp_path}/hot", shard_bytes=200)
    blocks = spark.read.parquet(f"file://{tmp_path}/hot/blocks").select("shard", "doc_ids").collect()
    assert sum(7 in r.doc_ids for r in blocks) > 2 and max(len(r.doc_ids) for r in blocks) < 150
    got = sorted((r.start, r.doc_id) for r in token_files.read_ids(spark, f"file://{tmp_path}/hot").collect())
    assert [d for _, d in got] == sorted(d for d, _ in hot)
    token_files.write_ids(make([]), f"file://{tmp_path}/none")
    assert token_files.read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_pack(make):
    e = tokens.WordEnds(tokens.vocabulary("word_bpe_49k.json"))
    rows = [*corpus(6), (7000, "many words here " * 700)]
    got = packing.pack(make(rows), length=128).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for s in by.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0, *(r.length for r in s)])[:-1].tolist() and sum(r.length for r in s) <= 128
    want = []
    for i, t in rows:
        ids = np.append(e.one(t) if t else np.zeros(0, np.uint32), np.uint32(1)).astype("<u4")
        want += [(i, k, a, len(ids[a : a + 128]), zlib.crc32(ids[a : a + 128].tobytes())) for k, a in enumerate(range(0, len(ids), 128))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    total = sum(r.length for r in got)
    assert len(by) <= -(-total // 128) * 1.05 + 1
    assert packing.pack(make([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_places_every_piece(histogram):
    found = {}
    plan = packing.plan(histogram, length=64, width=4)
    for seq, n in plan:
        assert 0 < sum(seq) <= 64 and n > 0
        for x in seq:
            found[x] = found.get(x, 0) + n
    assert found == histogram


def test_nnls_and_patterns():
    assert sorted(packing.patterns(4, 3)) == [(2, 1, 1), (2, 2), (3, 1), (4,)]
    a = np.array([[1.0, 0, 1], [0, 1, 1]])
    x = packing.nnls(a, np.array([3.0, 2.0]))
    assert (x >= 0).all() and np.allclose(a @ x, [3, 2], atol=1e-3)
    # the optimality conditions, on a problem with more patterns than lengths
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 4, (30, 200)).astype(float), rng.integers(0, 1000, 30).astype(float)
    x = packing.nnls(a, b)
    g, bound = a.T @ (a @ x - b), 1e-5 * np.abs(a.T @ b).max()
    assert (x >= 0).all() and (g >= -bound).all() and (g[x > 0] <= bound).all()
