import os
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltmill.llm import words as W

PATTERNS = {"alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "space": r"[^\x20\x09-\x0D]+"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("kind", PATTERNS)
@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=60)), max_size=8), chunk=st.sampled_from([1, 20, 1 << 20]))
def test_words_like_patterns(kind, texts, chunk):
    found = {}
    for i, j, x in W.runs(pa.array(texts, pa.string()), kind, chunk):
        for r in range(i, j):
            found[r] = [(x.string(k), x.hash[k]) for k in range(x.first[r - i], x.first[r - i + 1])]
    want = [re.findall(PATTERNS[kind], (t or "").translate(LOWER)) for t in texts]
    assert [[w for w, _ in found[r]] for r in range(len(texts))] == want
    by_word = {}
    for ws in found.values():
        for w, h in ws:
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_long_text_and_kgrams():
    text = "ab cd " * 500_000
    (_, _, x), = W.runs(pa.array([text]), "space")
    assert len(x.hash) == 1_000_000 and len(set(x.hash.tolist())) == 2
    g = W.kgrams(x.hash, 3)
    assert len(g) == 999_998 and len(np.unique(g)) == 2
    assert len(W.kgrams(x.hash[:2], 3)) == 0


def test_pieces_of_a_long_text(monkeypatch):
    """Hashes don't depend on how a long text is cut into pieces, nor on a word that is longer than a piece."""
    rng = np.random.default_rng(4)
    text = " ".join(rng.choice(["ab", "cdé", "x" * 40, "y\n", "z" * 3000], 4000))
    want = {k: W.split(*W.buffer_of(pa.array([text, None, "", text[:500]])), k) for k in PATTERNS}
    monkeypatch.setattr(W, "CHUNK", 500)
    monkeypatch.setattr(W, "_powers", (np.ones(1, W.U), np.ones(1, W.U)))
    for k, x in want.items():
        y = W.split(*W.buffer_of(pa.array([text, None, "", text[:500]])), k)
        assert all(np.array_equal(getattr(x, f), getattr(y, f)) for f in ("start", "end", "hash", "first"))


def test_memory_of_a_long_text():
    """A text of 50 MB takes about a dozen times its bytes, and not forty times."""
    code = (
        "import resource, pyarrow as pa; from siltmill.llm import words as W; a = pa.array([('some words of it ' * 3_000_000)[:50_000_000]]);"
        "b = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; (_, _, x), = W.runs(a, 'space'); g = W.kgrams(x.hash, 5);"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - b) / 50e3)"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert float(out.stdout) < 18
