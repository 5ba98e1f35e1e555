"""The three learned models: quality, suffix tree, language."""

import itertools
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from siltmill.llm import langid, quality, suffix_tree
from siltmill.llm import words as W
from siltmill.llm.common import table

from .conftest import corpus

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# ---- quality


def test_quality_edges(spark, make):
    docs = make([(1, None), (2, ""), (3, "plain words here"), (3, "plain words here"), (None, "x"), (4, "%%% " * 1000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(1, 9)] + [(None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, ones).collect()
    assert len(got) == 6 and {r.score for r in got} == {1.0} and {r.predicted for r in got} == {1}
    assert quality.score_quality(make([]), ones).count() == 0
    kept = quality.keep_good(docs, ones)
    assert kept.columns == docs.columns and kept.count() == 6


def test_quality_model_is_the_density():
    rng = np.random.default_rng(3)
    x = {0: rng.normal(1, 2, (400, quality.D)), 1: rng.normal(0, 1, (900, quality.D))}
    sums = {k: (o := np.concatenate([np.ones((len(v), 1)), v], axis=1)).T @ o for k, v in x.items()}
    m = quality.Discriminant(sums)
    p = x[1][:5]
    want = []
    for k in (0, 1):
        cov = m.factor[k] @ m.factor[k].T
        d = p - x[k].mean(axis=0)
        want.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1]))
    assert np.allclose(m.score(p), 1 / (1 + np.exp(-np.clip(want[1] - want[0] + np.log(900 / 400), -50, 50))))
    assert (m.score(x[1]) > 0.5).mean() > 0.95 and (m.score(x[0]) < 0.5).mean() > 0.95


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    r = quality.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert len(r) > 40 and np.mean([x.predicted == x.quality for x in r]) > 0.93
    assert all(x.held_out == (crc(x.doc_id, 5) == 0) for x in r)


# ---- suffix tree


def test_base_scores_like_brute_force(make):
    rows = [r for r in corpus(8) if r[0] is not None]
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "\0"]
    c = Counter(w for i, t in rows if crc(i, 10) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.held_out, r.train_tokens, round(r.base_score, 6)) for r in suffix_tree.score_texts(make(rows)).collect()), key=repr)
    want = [(i, len(w := tokens(t)), sum(c[x] > 0 for x in w), crc(i, 10) == 0, n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for i, t in rows]
    assert got == sorted(want, key=repr)
    assert suffix_tree.score_texts(make([])).count() == 0
    only = suffix_tree.score_texts(make([(i, "a b") for i in range(40) if crc(i, 10) == 0])).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in only} == {(0, 0, 0.0)}


def tokens_of(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), "\0"]


def brute_tree(texts, depth, least=2, prior=20.0):
    """The root and, by context, (what it leaves to others, what each token after it gains), grown by plain counting of tuples."""
    seqs = [tokens_of(t) for t in texts]
    uni = Counter(w for s in seqs for w in s)
    n, v = sum(uni.values()), len(uni)
    root = lambda w: (uni[w] + 0.1) / (n + 0.1 * (v + 1))
    counted = {(w,): c for w, c in uni.items() if c >= least}
    shorter = {k: root(k[0]) for k in counted}
    states, gains, runs_by_state = {}, {}, {}
    for size in range(1, depth + 1):
        runs = Counter(r for s in seqs for i in range(size, len(s)) if (r := tuple(s[i - size : i + 1]))[:-1] in counted and r[1:] in shorter)
        runs = {r: c for r, c in runs.items() if c >= least}
        p = {r: (c + prior * shorter[r[1:]]) / (counted[r[:-1]] + prior) for r, c in runs.items()}
        after = {}
        for context in {r[:-1] for r in runs}:
            own = [r for r in runs if r[:-1] == context]
            raw = {r: runs[r] / counted[context] for r in own}
            other, left = max(1 - sum(raw.values()), 0), max(1 - sum(shorter[r[1:]] for r in own), 1e-12)
            d = sum(raw[r] * math.log(raw[r] / shorter[r[1:]]) for r in own) + (other * math.log(other / left) if other > 1e-12 else 0)
            if counted[context] * d > 0.5 * (len(own) + 1) * math.log(n):
                states[context] = math.log10(max(1 - sum(p[r] for r in own), 1e-12) / left)
                gains |= {r: math.log10(p[r] / shorter[r[1:]]) - states[context] for r in own}
                after |= {r: p[r] for r in own}
        counted, shorter = runs, after
        if not after:
            break
    return root, states, gains


def brute_score(tree, text, depth):
    root, states, gains = tree
    s, out = tokens_of(text), 0.0
    for i, w in enumerate(s):
        out += math.log10(root(w))
        for size in range(1, min(depth, i) + 1):
            out += states.get(tuple(s[i - size : i]), 0.0) + gains.get(tuple(s[i - size : i + 1]), 0.0)
    return out


def test_tree_like_brute_force(make):
    """Text with order of several words, repeated documents, and the odd rows: every score is that of the plain tree; held-out ones rise,
    and a state's probabilities sum to one."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(12)]
    follow = {(a, b): rng.choice(words, 2) for a in words for b in words}

    def walk(n):
        w = ["w0", "w1"]
        for _ in range(n):
            w.append(str(rng.choice(follow[w[-2], w[-1]], p=[0.9, 0.1])))
        return " ".join(w)

    rows = [(i, walk(60)) for i in range(40)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(rows[:5])] + [(200, None), (201, ""), (202, "w0 unseen w1")]
    rows += [(300 + i, t) for i, (_, t) in enumerate(corpus(8)[:20])]
    tree = brute_tree([t for i, t in rows if crc(i, 10)], 4)
    assert {len(c) for c in tree[1]} >= {1, 2, 3}
    got = {r.doc_id: r for r in suffix_tree.score_texts(make(rows), fewest=2).collect()}
    for i, t in rows:
        assert abs(got[i].score - brute_score(tree, t, 4)) < 1e-6 * max(1, abs(got[i].score)), i
    assert all(got[i].score > got[i].base_score for i in range(40) if not crc(i, 10))
    root, states, gains = tree
    vocabulary = {w for i, t in rows if crc(i, 10) for w in tokens_of(t)}

    def prob(context, w):
        x = root(w)
        for k in range(1, len(context) + 1):
            x *= 10 ** (states.get(context[-k:], 0.0) + gains.get((*context[-k:], w), 0.0))
        return x

    for context in list(states)[:20]:
        unknown = 0.1 / (sum(1 for i, t in rows if crc(i, 10) for _ in tokens_of(t)) + 0.1 * (len(vocabulary) + 1))
        lost = 10 ** sum(states.get(context[-k:], 0.0) for k in range(1, len(context) + 1))
        assert abs(sum(prob(context, w) for w in vocabulary) + unknown * lost - 1) < 1e-6


def test_tree_joined_in_shares(spark, make, monkeypatch):
    """Rare words and runs come from joins, share by share: the scores are the plain tree's, no share is empty or all, and at the end
    only tables that the result reads are left."""
    rows = [(i, t) for i, (_, t) in enumerate(corpus(8))] * 2
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    tables, real = [], suffix_tree.written

    def written(df, tag):
        tables.append((tag, real(df, tag)))
        return tables[-1][1]

    monkeypatch.setattr(suffix_tree, "written", written)
    monkeypatch.setattr(suffix_tree, "HOT", 1.0)
    monkeypatch.setattr(suffix_tree, "FREQUENT", 0.01)
    out = suffix_tree.score_texts(make(rows), fewest=2)
    tree = brute_tree([t for i, t in rows if crc(i, 10)], 4)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i].score - brute_score(tree, t, 4)) < 1e-6 * max(1, abs(got[i].score)), i
    shares = Counter(tag for tag, _ in tables)
    assert shares["sums"] == shares["gains"] == suffix_tree.SHARES > 1
    left = [tag for tag, t in tables if os.path.isdir(t._siltmill_path.removeprefix("file:"))]
    assert Counter(left) == {"scored": 1, "sums": suffix_tree.SHARES, "gains": suffix_tree.SHARES}
    assert all(t.count() for tag, t in tables if tag in ("sums", "gains"))


# ---- language


def test_forward_backward_like_enumeration():
    rng = np.random.default_rng(4)
    emit, trans, start = rng.normal(size=(3, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 1, 3])
    gamma, pairs, total = langid.marginals(emit, trans, start, lengths)
    logs, all_pairs = 0.0, np.zeros((3, 3))
    for r, n in enumerate(lengths):
        weight = {y: math.exp(start[y[0]] + sum(emit[r, t, y[t]] for t in range(n)) + sum(trans[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product(range(3), repeat=n)}
        z = sum(weight.values())
        logs += math.log(z)
        for t in range(n):
            assert np.allclose(gamma[r, t], [sum(w for y, w in weight.items() if y[t] == k) / z for k in range(3)])
        assert not gamma[r, n:].any()
        for y, w in weight.items():
            for a, b in itertools.pairwise(y):
                all_pairs[a, b] += w / z
    assert np.allclose(pairs, all_pairs) and abs(total - logs) < 1e-9


def test_code_switched_words():
    """Words of two languages in one line are told apart."""
    rows = [("der und die keit schung " * 20, "de"), ("the and ing thing with " * 20, "en")] * 10
    f = langid.fit(rows, bits=12)
    (_, _, x), = W.runs(pa.array(["the thing and with schung die keit und"]), "alnum")
    first, kind = langid.types_of(x.hash)
    emit = langid.potentials(f.weights, *langid.word_features(x, first, f.bits))[kind][None]
    gamma, _, _ = langid.marginals(emit, f.trans, f.start, np.array([8]))
    assert [f.labels[k] for k in gamma[0].argmax(axis=1)] == ["en"] * 4 + ["de"] * 4


def test_language_edges(spark):
    rows = [(i, ("the and with thing " if i % 2 else "der und die keit ") * 9, "en" if i % 2 else "de", "s") for i in range(60)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "123 !!", "en", "s"), (103, "“—”", "de", "s"), (None, "der und", None, "s"), (104, "the " * 5000, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.identify(df, bits=12).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (100, 101, 102, 103))
    assert got[104].lang_pred == "en" and got[None].lang_pred == "de" and not got[None].held_out
    assert all(got[i].lang_pred == rows[i][2] and 0.5 < got[i].score <= 1 and got[i].held_out == (crc(i, 4) == 2) for i in range(60))
    assert langid.identify(df.where("doc_id < 0")).count() == 0
    assert {r.lang_pred for r in langid.identify(df.where("lang is null")).collect()} == {"und"}


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    r = langid.identify(docs, sample=300).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(r) > 150 and np.mean([x.lang_pred == x.lang for x in r]) > 0.95


def test_sample_has_rare_languages_and_bounded_bytes(spark):
    rows = [(k, f"word{k} of a text", "en" if k % 500 else "xx") for k in range(3000)] + [(5000 + k, "long " * 30_000, "yy") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.training_sample(docs, sample=60, most=6000)
    n = Counter(lang for _, lang in got)
    assert 15 <= n["en"] <= 20 and n["xx"] >= 2 and n["yy"] == 1
    assert sum(len(t) for t, lang in got if lang != "yy") < 6000


def test_words_of_mixed_texts(spark, make):
    """Code-switched text: every word gets its own language, and the switches are counted."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").where("lang in ('en', 'de')")
    field = langid.fit(langid.training_sample(docs, 200))
    pick = lambda lang: next(r.text for r in docs.where(f"lang = '{lang}' and length(text) between 300 and 3000").orderBy("doc_id").collect())
    a, b = (" ".join(re.findall(r"[^\W\d_]+", pick(lang))[:12]) for lang in ("en", "de"))
    x = W.split(*W.buffer_of(pa.array([f"{a} {b}"])), "alnum")
    best = [field.labels[k] for k in field.words(x).argmax(axis=1)]
    n = len(a.split())
    assert best[:n].count("en") > 0.8 * n and best[n:].count("de") > 0.8 * (len(best) - n)
    every = langid.label_words(docs.limit(5), 50).collect()
    assert {r.lang for r in every} <= {"en", "de"} and all(0 < r.marginal <= 1.0001 for r in every)
