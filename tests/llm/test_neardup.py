import re
from collections import Counter

import pytest

from siltmill.llm import graph
from siltmill.llm import neardup as op

from .conftest import corpus

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, percent=85, k=5):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out[d, len(sets[i]), c, d is None and c is None or d == c] += 1
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_like_brute_force(make, block):
    rows = [r for r in corpus(11) if r[0] is not None]
    got = Counter(tuple(r) for r in op.near_duplicates(make(rows), block=block).collect())
    assert got == brute(rows)


def test_chains_across_blocks(make):
    """A chain of texts, each near the next one only, dealt into many blocks."""
    words = [f"w{k}" for k in range(160)]
    rows = []
    for k in range(40):
        rows.append((500 - k, " ".join(words)))
        words[(k * 37) % 160] = f"new{k}"
    got = Counter(tuple(r) for r in op.near_duplicates(make(rows), block=4).collect())
    assert got == brute(rows)


def test_empty_and_null(make):
    assert op.near_duplicates(make([])).count() == 0
    got = sorted(tuple(r) for r in op.near_duplicates(make([(2, None), (1, ""), (3, " \n"), (5, "a"), (4, "A")])).collect())
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False)]


def test_cluster_without_links(make, monkeypatch):
    """Texts that share common wording and nothing else: one cluster of candidates, many blocks, no links. Prefix tokens keep them apart: no sets meet across blocks."""
    common = [f"c{k}" for k in range(60)]
    rows = [(k, " ".join([*common, *(f"own{k}x{j}" for j in range(30))])) for k in range(40)]
    sets = op.shingle_sets(next(op.W.runs(op.pa.array([t for _, t in rows]), "space"))[2])
    counts = Counter()
    for s in sets:
        counts.update((s >> op.W.U(64 - op.SKETCH)).tolist())
    cells = op.np.zeros(1 << op.SKETCH, op.np.int64)
    cells[list(counts)] = list(counts.values())
    shared = Counter(t for s in sets for t in op.prefix(s, cells, 85).tolist())
    assert max(shared.values()) == 1
    got = Counter(tuple(r) for r in op.near_duplicates(make(rows), block=4, rows=1).collect())
    assert got == brute(rows)


def test_drop_decides_by_row(make):
    """A doc_id with two texts loses only the copy; copies without an id go too; of texts without ids one stays."""
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "a b c d e f"
    docs = make([(1, a), (7, a), (7, b), (None, a), (None, c), (None, c), (None, None), (None, None), (8, "")])
    assert sorted(((r.doc_id, r.text) for r in op.drop_near_duplicates(docs).collect()), key=repr) == sorted([(1, a), (7, b), (None, c), (None, None), (8, "")], key=repr)
    got = Counter(tuple(r) for r in op.near_duplicates(docs).collect())
    assert got[None, 2, 1, False] == 1 and got[7, 2, 1, False] == 1 and got[7, 2, 7, True] == 1 and got[None, 2, None, True] == 2


def test_drop(make):
    docs = make([(2, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (3, "x y z"), (None, "q")])
    left = op.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3]


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 100), (200, 201), (203, 202), (201, 202)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 200: 200, 201: 200, 202: 200, 203: 200}
