"""Benchmark decontamination by winnowing.

Every k-gram of words is hashed, and of each window of w consecutive k-gram
hashes the minimum is kept (all places of it, on ties), in the benchmark items
and in the documents alike. A shared span of k + w - 1 words has w common
k-grams, whose minimum both sides keep, so none is missed. The fingerprints of
the two sides are joined and each hit is extended, word by word, as far as a
span of the asked length can reach; it counts if the words shared then are
enough. Items shorter than a span are matched whole, with k their own length.

The documents are never shuffled while the benchmark's distinct texts are no more
than ``broadcast_bytes``, which is checked: its fingerprints are broadcast then.
A larger benchmark is a table of fingerprints, each with the words around it, and
so are the documents' fingerprints that a bitmap of bounded size lets pass; the
two are joined on the fingerprint, extended pair by pair, and the hits of a
document are united. Adaptive execution splits hot fingerprints.

Defined cases: a null or empty text has no words and no hits; items without
words match nothing; an item with a null id hits words, but has no name to be
counted or listed under; items with the same id are one item; a
repeated document row gets its row again; an empty benchmark hits nothing;
extra columns are ignored by ``decontaminate`` and kept by ``remove_leaks``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import Bits, prepare, table, with_texts, written

SPAN, K = 13, 9
#: Bytes of distinct benchmark texts up to which their fingerprints are broadcast.
BROADCAST = 8 << 20
_HITS = "doc_id long, text_key long, n_words long, starts array<int>, ends array<int>, items array<string>"
_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def winnow(grams: np.ndarray, text_of: np.ndarray, w: int) -> np.ndarray:
    """Places of k-grams that are the least of a window of w k-grams of one text."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    for j in range(1, w):
        np.minimum(least, grams[j : j + n], out=least)
    inside = text_of[:n] == text_of[w - 1 : w - 1 + n]
    keep = np.zeros(len(grams), bool)
    for j in range(w):
        keep[j : j + n] |= inside & (grams[j : j + n] == least)
    return np.flatnonzero(keep)


class Family:
    """Fingerprints of the items that are searched with the same k, w and span."""

    def __init__(self, span: int, k: int):
        self.span, self.k, self.w = span, k, span - k + 1
        self.prints = np.zeros(0, W.U)

    def places(self, h: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kept places and their fingerprints."""
        g = W.kgrams(h, self.k)
        if not len(g):
            return np.zeros(0, np.int64), g
        # a k-gram lies in one text if its first and last word do
        last = text_of[self.k - 1 : self.k - 1 + len(g)]
        own = np.where(text_of[: len(g)] == last, text_of[: len(g)], -1 - np.arange(len(g)))
        p = winnow(g, own, self.w)
        p = p[own[p] >= 0]
        return p, g[p]


class Index:
    """The fingerprints of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], span: int, k: int):
        items = sorted({(i, t) for i, t in items if t}, key=lambda x: (x[0] or "", x[0] is not None, x[1]))
        texts = pa.array([t for _, t in items], pa.large_string())
        found = [x for _, _, x in W.runs(texts, "alnum")]
        counts = np.concatenate([x.counts for x in found]) if found else np.zeros(0, np.int64)
        h = np.concatenate([x.hash for x in found]) if found else np.zeros(0, W.U)
        self.ids = [i for i, _ in items]
        item_of = np.repeat(np.arange(len(items)), counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        self.hash, self.item_of = h, item_of
        self.families = []
        for length in sorted({min(int(c), span) for c in counts if c}):
            f = Family(length, min(k, length) if length == span else length)
            chosen = np.flatnonzero(counts >= span if length == span else counts == length)
            words = np.concatenate([np.arange(first[i], first[i + 1]) for i in chosen])
            p, g = f.places(h[words], item_of[words])
            at = words[p]
            # one place of each item, fingerprint and surrounding is enough
            around = [item_of[at].astype(W.U), g]
            for j in [*range(-(f.span - f.k), 0), *range(f.k, f.span)]:
                q = np.clip(at + j, 0, len(h) - 1)
                around.append(np.where((at + j >= 0) & (at + j < len(h)) & (item_of[q] == item_of[at]), h[q], W.U(0)))
            _, one = np.unique(np.stack(around), axis=1, return_index=True) if len(at) else (0, np.zeros(0, np.int64))
            order = one[np.argsort(g[one], kind="stable")]
            f.prints, f.at = g[order], at[order]
            bits = np.zeros(1 << 20, bool)
            bits[(f.prints & W.U((1 << 20) - 1)).astype(np.int64)] = True
            f.bits = bits
            self.families.append(f)

    def spans(self, h: np.ndarray, text_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first word, word behind the last, item) of the extended hits."""
        n = len(h)
        for f in self.families:
            p, g = f.places(h, text_of)
            near = f.bits[(g & W.U((1 << 20) - 1)).astype(np.int64)]
            p, g = p[near], g[near]
            lo, hi = np.searchsorted(f.prints, g, "left"), np.searchsorted(f.prints, g, "right")
            i, x = W.expand(lo, hi)
            p, q = p[i], f.at[x]
            same = np.ones(len(p), bool)
            for j in range(f.k):
                same &= h[p + j] == self.hash[q + j]
            p, q = p[same], q[same]
            left, right = np.zeros(len(p), np.int64), np.full(len(p), f.k)
            for reach, step in ((left, -1), (right, 1)):
                going = np.ones(len(p), bool)
                for j in range(1, f.span - f.k + 1):
                    d, b = (p - j, q - j) if step < 0 else (p + f.k - 1 + j, q + f.k - 1 + j)
                    ok = (d >= 0) & (d < n) & (b >= 0) & (b < len(self.hash))
                    d, b = np.clip(d, 0, n - 1), np.clip(b, 0, len(self.hash) - 1)
                    going &= ok & (text_of[d] == text_of[p]) & (self.item_of[b] == self.item_of[q]) & (h[d] == self.hash[b])
                    reach += going
            long = left + right >= f.span
            yield p[long] - left[long], p[long] + right[long], self.item_of[q[long]]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null").distinct()


def _index(benchmark: DataFrame, span: int, k: int, most: int) -> Index | None:
    """The benchmark's index for a broadcast, or None if its texts are more than so many bytes."""
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    if size > most and (_items(benchmark).agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) > most:
        return None
    return Index([(r.item, r.text) for r in _items(benchmark).toLocalIterator()], span, k)


def _unite(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _scan(held, only_hits: bool):
    """A function for mapInArrow over (doc_id, text_key, text)."""

    def scan(batches):
        index = held.value
        for batch in batches:
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
            rows = []
            for i, j, x in W.runs(batch.column("text"), "alnum"):
                text_of = x.text_of()
                got = list(index.spans(x.hash, text_of))
                a, b, item = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in range(3))
                order = np.argsort(text_of[a] if len(a) else a, kind="stable")
                a, b, item = a[order], b[order], item[order]
                cut = np.searchsorted(text_of[a] if len(a) else a, np.arange(j - i + 1))
                for r in range(j - i):
                    lo, hi, base = cut[r], cut[r + 1], x.first[r]
                    if lo == hi and only_hits:
                        continue
                    joined = _unite(a[lo:hi] - base, b[lo:hi] - base) if lo < hi else []
                    names = sorted({index.ids[k] for k in np.unique(item[lo:hi])} - {None})
                    rows.append((ids[i + r], keys[i + r], int(x.counts[r]), [s for s, _ in joined], [e for _, e in joined], names))
            names = ("doc_id", "text_key", "n_words", "starts", "ends", "items")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=list(names))

    return scan


_PRINT = "print long, around binary, at int"


def _printed(families: list[Family], names: list[str], whole: bool, bits=None):
    """Fingerprints of texts with the words around them: of benchmark items (``whole``: a family has the items of its own length),
    or of documents, where the bitmap has them."""

    def printed(batches):
        for batch in batches:
            for i, _, x in W.runs(batch.column("text"), "alnum"):
                h, text_of = x.hash, x.text_of()
                for f in families:
                    p, g = f.places(h, text_of)
                    g = W.mix(g + W.U(f.span))
                    if whole:
                        own = x.counts[text_of[p]]
                        keep = own >= f.span if f.span == families[-1].span and f.k < f.span else own == f.span
                    else:
                        keep = bits.value.has(g)
                    p, g = p[keep], g[keep]
                    if not len(p):
                        continue
                    q = p[:, None] + np.arange(-(f.span - f.k), f.span)[None, :]
                    r = np.clip(q, 0, len(h) - 1)
                    around = np.where((q == r) & (text_of[r] == text_of[p][:, None]), h[r], W.U(0))
                    size = around.shape[1] * 8
                    raw = pa.Array.from_buffers(pa.binary(), len(p), [None, pa.py_buffer(np.arange(0, size * len(p) + 1, size, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(around))])
                    t = text_of[p]
                    cols = [batch.column(c).take(pa.array(i + t)) for c in names]
                    if not whole:
                        cols.append(pa.array(x.counts[t].astype(np.int64)))
                    cols += [pa.array(g.view(np.int64)), raw, pa.array((p - x.first[t]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, names=[*names, *([] if whole else ["n_words"]), "print", "around", "at"])

    return printed


def _extended(span: int, k: int):
    """Pairs of places with equal fingerprints -> spans of the document that are shared to their whole length."""

    def extended(batches):
        for batch in batches:
            doc, own, at = batch.column("around"), batch.column("own"), batch.column("at").to_numpy()
            start, end = np.full(len(at), -1, np.int32), np.zeros(len(at), np.int32)
            size = np.array([len(b.as_buffer()) // 8 for b in doc])
            for m in np.unique(size):
                rows = np.flatnonzero(size == m)
                a, b = (np.frombuffer(b"".join(c.take(pa.array(rows)).to_pylist()), W.U).reshape(len(rows), -1) for c in (doc, own))
                # a window of the main family has span - k words on both sides; a short item is its own window
                side, core = (span - k, k) if m == 2 * span - k and k < span else (0, m)
                if a.shape != b.shape:
                    continue
                same = (a == b) & (a != 0)
                left = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
                right = np.cumprod(same[:, side + core :], axis=1).sum(axis=1)
                ok = same[:, side : side + core].all(axis=1) & (left + core + right >= (span if side else core))
                start[rows[ok]] = at[rows[ok]] - left[ok]
                end[rows[ok]] = at[rows[ok]] + core + right[ok]
            keep = pa.array(start >= 0)
            out = [*(batch.column(c) for c in ("doc_id", "text_key", "n_words", "item")), pa.array(start), pa.array(end)]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "text_key", "n_words", "item", "start", "end"]).filter(keep)

    return extended


def _merge(batches):
    """The spans of a document's hits, united."""
    for batch in batches:
        starts, ends = [], []
        for parts in batch.column("parts").to_pylist():
            joined = _unite(*(np.array([p[c] for p in parts], np.int64) for c in ("start", "end")))
            starts.append([s for s, _ in joined])
            ends.append([e for _, e in joined])
        kind = pa.list_(pa.int32())
        cols = [batch.column(k) for k in ("doc_id", "text_key", "n_words")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(starts, kind), pa.array(ends, kind), batch.column("items")], names=["doc_id", "text_key", "n_words", "starts", "ends", "items"])


def _counts(batches):
    for batch in batches:
        n = [x.counts for _, _, x in W.runs(batch.column("text"), "alnum")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())], names=["doc_id", "text_key", "n_words"])


def _lengths(span: int):
    def lengths(batches):
        for batch in batches:
            for _, _, x in W.runs(batch.column("text"), "alnum"):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.minimum(x.counts, span)).astype(np.int64))], names=["n"])

    return lengths


def _joined_hits(rows: DataFrame, benchmark: DataFrame, span: int, k: int) -> DataFrame:
    """Hits of documents (doc_id, text_key, text) by a join of fingerprint tables."""
    spark = rows.sparkSession
    items = _items(benchmark)
    sizes = sorted(r.n for r in items.mapInArrow(_lengths(span), "n long").distinct().collect() if r.n)  # at most ``span`` numbers
    families = [Family(n, min(k, n) if n == span else n) for n in sizes]
    theirs = written(items.mapInArrow(_printed(families, ["item"], True), f"item string, {_PRINT}").select("item", "print", F.col("around").alias("own")).distinct(), "prints")
    bits = spark.sparkContext.broadcast(Bits.of(theirs.select(F.col("print").alias("k"))))
    mine = rows.mapInArrow(_printed(families, ["doc_id", "text_key"], False, bits), f"doc_id long, text_key long, n_words long, {_PRINT}")
    hits = mine.join(theirs, "print").mapInArrow(_extended(span, k), "doc_id long, text_key long, n_words long, item string, start int, end int")
    # equal rows have equal hits, so a repeated row needs them once
    hits = hits.groupBy("doc_id", "text_key", "n_words").agg(F.collect_set(F.struct("start", "end")).alias("parts"), F.array_sort(F.collect_set("item")).alias("items"))
    return hits.mapInArrow(_merge, _HITS)


def find_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, broadcast_bytes: int = BROADCAST, only_hits: bool = False) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, the word spans shared with the benchmark and the items they come from."""
    spark = prepare(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    index = _index(benchmark, span, k, broadcast_bytes)
    if index:
        return rows.mapInArrow(_scan(spark.sparkContext.broadcast(index), only_hits), _HITS)
    joined = _joined_hits(rows, benchmark, span, k)
    if only_hits:
        return joined
    counted = rows.mapInArrow(_counts, "doc_id long, text_key long, n_words long")
    b = joined.withColumnsRenamed({"doc_id": "b_id", "text_key": "b_key"}).drop("n_words")
    empty = F.array().cast("array<int>")
    return counted.join(b, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("text_key") == F.col("b_key")), "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("starts", empty).alias("starts"), F.coalesce("ends", empty).alias("ends"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, share: int = 20, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """One row per document row: words, words inside shared spans, items, and whether 1/``share`` of the words or more are hit."""
    found = find_spans(docs, benchmark, span, k, broadcast_bytes)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    found = found.withColumn("n_hit", n_hit)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.array_distinct("items")), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
    )


def _cut(held, share: int):
    def cut(batches):
        index = held.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out, keep = list(texts), [True] * len(texts)
            for i, j, x in W.runs(batch.column("text"), "alnum"):
                text_of = x.text_of()
                got = list(index.spans(x.hash, text_of))
                if not sum(len(g[0]) for g in got):
                    continue
                a, b = (np.concatenate([g[k] for g in got]) for k in range(2))
                for r in np.unique(text_of[a]):
                    own = text_of[a] == r
                    joined = _unite(a[own], b[own])
                    if share * sum(e - s for s, e in joined) >= x.counts[r]:
                        keep[i + r] = False
                        continue
                    raw, lo = x.buf[x.offsets[r] : x.offsets[r + 1]].tobytes(), x.offsets[r]
                    parts, at = [], 0
                    for s, e in joined:
                        parts.append(raw[at : x.start[s] - lo])
                        at = int(x.end[e - 1] - lo)
                    out[i + r] = b"".join([*parts, raw[at:]]).decode("utf-8", "replace")
            yield with_texts(batch, out, [a is not b for a, b in zip(out, texts, strict=True)]).filter(pa.array(keep))

    return cut


def remove_leaks(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, share: int = 20, broadcast_bytes: int = BROADCAST) -> DataFrame:
    """Documents without benchmark text: contaminated ones are dropped, and shared spans are cut from the rest. Columns stay."""
    spark = prepare(docs)
    index = _index(benchmark, span, k, broadcast_bytes)
    if index:
        return docs.mapInArrow(_cut(spark.sparkContext.broadcast(index), share), docs.schema)
    spans = find_spans(docs, benchmark, span, k, broadcast_bytes, only_hits=True)
    b = spans.withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "n_words": "__n", "starts": "__starts", "ends": "__ends"}).drop("items")
    keyed = docs.join(b, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left").drop("__id", "__key")
    return keyed.mapInArrow(_cut_known(share, docs.columns), docs.schema)


def _cut_known(share: int, columns: list[str]):
    def cut(batches):
        for batch in batches:
            out, keep = batch.column("text").to_pylist(), [True] * batch.num_rows
            for r, (n, starts, ends) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("__n", "__starts", "__ends")), strict=True)):
                if not starts:
                    continue
                if share * sum(e - s for s, e in zip(starts, ends, strict=True)) >= n:
                    keep[r] = False
                    continue
                _, _, x = next(W.runs(pa.array([out[r]], pa.large_string()), "alnum"))
                raw, parts, at = x.buf.tobytes(), [], 0
                for s, e in zip(starts, ends, strict=True):
                    parts.append(raw[at : x.start[s]])
                    at = int(x.end[e - 1])
                out[r] = b"".join([*parts, raw[at:]]).decode("utf-8", "replace")
            yield with_texts(batch.select(columns), out, [bool(x) for x in batch.column("__starts").to_pylist()]).filter(pa.array(keep))

    return cut


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bl AS (SELECT item, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT item, m, w, unnest(generate_series(1, len(w) - m + 1)) AS i FROM bl)),
ms AS (SELECT DISTINCT m FROM bl),
dw AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT r, m, w, unnest(generate_series(1, len(w) - m + 1)) AS i FROM t, ms WHERE len(w) >= m)),
hit AS (SELECT r, item, i, dw.m AS m FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM (SELECT DISTINCT r, i, m FROM hit)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM t LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
