"""Substring deduplication by line and sentence hashing.

A text is cut behind every newline and behind every white space that follows
one of . ! ?; each part that holds words is a unit, and wordless parts go to
the unit before them. A unit is normalised to its lower-cased words and has a
96-bit digest. Digests are grouped over all documents with map-side partials;
the occurrence with the least (doc_id, place) stays, the others are marked.
Marked units that follow each other form a span, and a span of ``min_words``
words or more is removed. Spans keep their offsets in the original text.

A digest that a third of all rows hold costs no more than others: its minimum
is pre-aggregated, and the join that marks occurrences is an equi-join that
adaptive execution splits. Text moves once, to meet its marks.

Defined cases: null and empty texts have no units and stay; of document rows
with equal doc_id and text one is kept; a null doc_id ranks first; an empty
table gives an empty result; extra columns are kept by ``drop_repeats`` and
ignored by ``repeats``; a text of nothing but removed spans becomes empty, and
``drop_repeats`` leaves its row out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import once, prepare, table, with_texts, written

MIN_WORDS = 8
_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?"])
_SPACE = ~W.CLASSES["space"]


def units(x: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each unit of a run (words never cross units), and the text of each unit."""
    buf = x.buf
    cut = buf == 10
    if len(buf) > 1:
        cut[1:] |= _SPACE[buf[1:]] & _STOP[buf[:-1]]
    if len(x.start) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.concatenate([[0], np.cumsum(cut)])
    text_of = x.text_of()
    new = np.concatenate([[True], (seen[x.start[1:]] != seen[x.start[:-1]]) | (text_of[1:] != text_of[:-1])])
    first = np.flatnonzero(new)
    return first, text_of[first]


def digests(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of each unit's words."""
    last = np.append(first[1:], len(h))
    second = lambda lo, hi: W.mix(h[lo:hi] ^ W.U(0x5851F42D4C957F2D))
    out = [W.range_hashes(v, len(h), first, last) for v in (lambda lo, hi: h[lo:hi], second)]
    return out[0].view(np.int64), (out[1] >> W.U(33)).astype(np.int32)


def _occurrences(batches):
    for batch in batches:
        ids, keys = (batch.column(k).to_pandas().to_numpy() for k in ("rank_id", "text_key"))
        got = []
        for i, _, x in W.runs(batch.column("text"), "alnum"):
            first, text_of = units(x)
            if len(first):
                a, b = digests(x.hash, first)
                start = np.searchsorted(text_of, text_of, "left")
                got.append((a, b, ids[i + text_of], keys[i + text_of], (np.arange(len(first)) - start).astype(np.int32)))
        if got:
            cols = [np.concatenate(c) for c in zip(*got, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["digest", "check", "rank_id", "text_key", "unit"])


def _removed(min_words: int, names: list[str], text_out: bool):
    """Rows with their marked units -> rows with spans, and the text without them."""

    def removed(batches):
        for batch in batches:
            texts, marks = batch.column("text").to_pylist(), batch.column("__marks").to_pylist()
            rows: list[list] = []
            out = list(texts)
            keep = [True] * len(texts)
            for r, m in enumerate(marks):
                spans = []
                if m:
                    kept = {d["unit"]: d["kept"] for d in m}
                    _, _, x = next(W.runs(pa.array([texts[r]], pa.large_string()), "alnum"))
                    first, _ = units(x)
                    count = np.diff(np.append(first, len(x.start)))
                    # a unit starts behind the cut before its first word
                    cut = x.buf == 10
                    cut[1:] |= _SPACE[x.buf[1:]] & _STOP[x.buf[:-1]]
                    at = np.append(0, np.flatnonzero(cut) + 1)
                    begin = at[np.searchsorted(at, x.start[first], "right") - 1]
                    begin[0] = 0
                    begin = np.append(begin, len(x.buf))
                    chars = np.concatenate([[0], np.cumsum((x.buf & 0xC0) != 0x80)])
                    order = sorted(kept)
                    i = 0
                    while i < len(order):
                        j = i
                        while j + 1 < len(order) and order[j + 1] == order[j] + 1:
                            j += 1
                        a, b = order[i], order[j]
                        n = int(count[a : b + 1].sum())
                        if n >= min_words:
                            keepers = Counter(kept[u] for u in range(a, b + 1))
                            spans.append((int(begin[a]), int(begin[b + 1]), int(chars[begin[a]]), int(chars[begin[b + 1]]), n, b - a + 1, keepers))
                        i = j + 1
                    if spans:
                        raw, parts, p = x.buf.tobytes(), [], 0
                        for s in spans:
                            parts.append(raw[p : s[0]])
                            p = s[1]
                        out[r] = b"".join([*parts, raw[p:]]).decode("utf-8", "replace")
                        keep[r] = bool(out[r].strip())
                rows.append(spans)
            if text_out:
                b = with_texts(batch.select(names), out, [bool(x) for x in rows])
                yield b.filter(pa.array(keep))
            else:
                ids = batch.column("doc_id").to_pylist()
                flat = [(ids[r], *s[2:6], keeper, n) for r, spans in enumerate(rows) for s in spans for keeper, n in s[6].items()]
                cols = list(zip(*flat, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start_char", "end_char", "n_words", "n_units", "kept_doc_id", "kept_units"])

    return removed


def _marked(docs: DataFrame) -> DataFrame:
    """Each distinct document row with its units that occur earlier."""
    prepare(docs)
    docs, repeats = once(docs)
    least = F.lit(-(2**63))
    rank, key = F.coalesce("doc_id", least), F.xxhash64("text") if repeats else F.lit(0).cast("long")
    seen = docs.select(rank.alias("rank_id"), key.alias("text_key"), "text").mapInArrow(_occurrences, "digest long, check int, rank_id long, text_key long, unit int")
    seen = written(seen, "units")
    first = seen.groupBy("digest", "check").agg(F.min(F.struct("rank_id", "text_key", "unit")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = first.select("digest", "check", F.col("f.rank_id").alias("kept"), F.col("f.text_key").alias("kept_key"), F.col("f.unit").alias("kept_unit"))
    # written, not reused: as a table of its own, the join's sides are two exchanges, of which a hot digest's can be split
    first = written(first, "first")
    later = seen.join(first, ["digest", "check"]).where("rank_id != kept or text_key != kept_key or unit != kept_unit")
    marks = later.groupBy("rank_id", "text_key").agg(F.collect_list(F.struct("unit", F.when(F.col("kept") != least, F.col("kept")).alias("kept"))).alias("__marks"))
    marks = marks.withColumnsRenamed({"rank_id": "__rank", "text_key": "__key"})
    return docs.join(marks, (rank == F.col("__rank")) & (key == F.col("__key")), "left").drop("__rank", "__key")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed span and document that keeps some of its units: doc_id, start_char, end_char (behind it), n_words, n_units, kept_doc_id, kept_units."""
    marked = _marked(docs.select("doc_id", "text")).where("__marks is not null")
    return marked.mapInArrow(_removed(min_words, [], False), "doc_id long, start_char long, end_char long, n_words long, n_units long, kept_doc_id long, kept_units long")


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the removed spans; columns stay, n_chars follows a changed text."""
    return _marked(docs).mapInArrow(_removed(min_words, docs.columns, True), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
p AS (
  SELECT doc_id, unnest(u) AS part, generate_subscripts(u, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '(?s).+?(?:\n|[.!?][ \t\r\x0B\x0C]|\z)') AS u FROM d)),
q AS (
  SELECT doc_id, i, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
         sum(length(part)) OVER (PARTITION BY doc_id) AS total,
         regexp_extract_all(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM p),
u AS (
  SELECT doc_id, row_number() OVER v AS k, CASE WHEN row_number() OVER v = 1 THEN 0 ELSE pos END AS a, coalesce(lead(pos) OVER v, total) AS b,
         len(w) AS n, array_to_string(w, ' ') AS norm
  FROM q WHERE len(w) > 0 WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT *, row_number() OVER x AS r, first_value(doc_id) OVER x AS kept FROM u WINDOW x AS (PARTITION BY norm ORDER BY doc_id, k)),
g AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS island FROM m WHERE r > 1),
s AS (SELECT doc_id, island, min(a) AS a, max(b) AS b, sum(n) AS n, count(*) AS u FROM g GROUP BY doc_id, island HAVING sum(n) >= 8)
SELECT doc_id, CAST(s.a AS BIGINT) AS start_char, CAST(s.b AS BIGINT) AS end_char, CAST(s.n AS BIGINT) AS n_words, u AS n_units, kept AS kept_doc_id, count(*) AS kept_units
FROM s JOIN g USING (doc_id, island) GROUP BY doc_id, island, s.a, s.b, s.n, u, kept
"""
