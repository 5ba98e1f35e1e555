import re

from siltmill.llm import substring as op

from .conftest import corpus

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UNIT = re.compile(r"(?s).+?(?:\n|[.!?][ \t\r\x0b\x0c]|\Z)")


def brute(rows, least):
    rows = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, []
    for d, t in rows:
        at, units = 0, []
        for m in UNIT.finditer(t):
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", m.group(0).translate(LOWER))
            if w:
                units.append([m.start() if units else 0, len(w), tuple(w)])
        ends = [u[0] for u in units[1:]] + [len(t)] * bool(units)
        run = []

        def close(run=run, d=d):
            if run and sum(x[2] for x in run) >= least:
                for keeper in {x[3] for x in run}:
                    out.append((d, run[0][0], run[-1][1], sum(x[2] for x in run), len(run), keeper, sum(x[3] == keeper for x in run)))
            run.clear()

        for u, e in zip(units, ends, strict=True):
            if u[2] in seen:
                run.append((u[0], e, u[1], seen[u[2]]))
            else:
                seen[u[2]] = d
                close()
        close()
    return sorted(out, key=repr)


def test_like_brute_force(make):
    rows = [r for r in corpus(9) if r[0] is not None]
    ids = [r[0] for r in rows]
    # one text for each id: which of two comes first is then no question of hashes
    rows = [r for k, r in enumerate(rows) if ids.index(r[0]) == k or rows[ids.index(r[0])] == r]
    for least in (1, 8):
        got = sorted((tuple(r) for r in op.repeats(make(rows), least).collect()), key=repr)
        assert got == brute(rows, least)


def test_drop(make):
    line = "This very line has clearly more than eight words in it."
    docs = make([(1, f"{line}\nOwn words of the first."), (2, f"Own words of the second.\n{line}"), (3, line), (4, None), (5, ""), (6, "Short one.\nShort one.")])
    got = {r.doc_id: r.text for r in op.drop_repeats(docs).collect()}
    assert got == {1: f"{line}\nOwn words of the first.", 2: "Own words of the second.\n", 4: None, 5: "", 6: "Short one.\nShort one."}
    assert op.drop_repeats(docs).columns == docs.columns
    assert op.repeats(make([])).count() == 0


def test_repeated_rows(make):
    line = "This very line has clearly more than eight words in it."
    assert op.drop_repeats(make([(1, line), (1, line), (None, line)])).count() == 1
