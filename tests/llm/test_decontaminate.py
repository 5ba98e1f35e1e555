import hashlib
import random
import re

from siltmill.llm import decontaminate as op

from .conftest import corpus

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(docs, items):
    grams = {}
    for i, t in items:
        w = words(t)
        m = min(13, len(w))
        for k in range(len(w) - m + 1) if m else ():
            grams.setdefault(tuple(w[k : k + m]), set()).update([str(i)] if i is not None else [])
    out = []
    for d, t in docs:
        w = words(t)
        hit, names = set(), set()
        for m in {len(g) for g in grams}:
            for k in range(len(w) - m + 1):
                if (g := tuple(w[k : k + m])) in grams:
                    hit |= set(range(k, k + m))
                    names |= grams[g]
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def bench(docs, seed=4):
    rnd = random.Random(seed)
    items = []
    for k in range(25):
        w = (rnd.choice(docs)[1] or "x").split()
        a = rnd.randrange(len(w)) if w else 0
        items.append((k, " ".join(w[a : a + rnd.choice([1, 5, 13, 14, 30])])))
    return [*items, (3, "a second text of a known id"), (None, "no id"), (None, docs[4][1]), (90, None), (91, ""), (92, "same same same"), (93, "word " * 40)]


def test_like_brute_force(spark, make):
    docs = corpus(3) + [(5000, "word " * 300), (5001, "same " * 200)]
    items = bench(docs)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for most in (8 << 20, 150):  # a broadcast, and a join of fingerprints: the same rows
        assert sorted((tuple(r) for r in op.decontaminate(make(docs), b, broadcast_bytes=most).collect()), key=repr) == want


def test_empty(spark, make):
    b = spark.createDataFrame([], "item_id long, text string")
    r = op.decontaminate(make([(1, "a b"), (2, None)]), b).collect()
    assert sorted((x.doc_id, x.n_words, x.n_hit, x.contaminated) for x in r) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert op.decontaminate(make([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_remove_leaks(spark, make):
    leak = " ".join(f"w{k}" for k in range(13))
    clean = " ".join(f"c{k}" for k in range(400))
    docs = make([(1, leak), (2, f"{clean} {leak.upper()}! {clean}"), (3, clean), (4, None)])
    b = spark.createDataFrame([(1, leak), (2, "x y " * 50)], "item_id long, text string")
    for most in (8 << 20, 60):
        got = {r.doc_id: r.text for r in op.remove_leaks(docs, b, broadcast_bytes=most).collect()}
        assert got == {2: f"{clean} ! {clean}", 3: clean, 4: None}
    assert op.remove_leaks(docs, b).columns == docs.columns
