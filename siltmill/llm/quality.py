"""Quality classification by a regularised quadratic discriminant.

Each whole text gives a vector of document statistics, made near-normal by
logarithms and log-odds. Per label the mean and covariance of all training
rows come from pre-aggregated sums; a covariance is shrunk towards the pooled
one and that towards its diagonal. A score is the logistic of the difference of
the two log densities (half squared Mahalanobis distances from cached Cholesky
factors, and log determinants) plus the log ratio of the labels' shares.

Training rows are those whose crc32(doc_id as text) mod 5 is not 0; all of them
are used. Labels, lang, source and doc_id are never inputs of a score.

Defined cases: a null text counts as empty and is scored like any other; a row
of labels with a null quality or doc_id is left out; several label rows of a
document all count; with no training rows every score is 0.5, with rows of one
label 1.0 or 0.0; a null doc_id is not held out; repeated rows get their row
again; extra columns are ignored by ``score_quality`` and kept by
``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import prepare, removed, table, written

THRESHOLD, FOLDS = 0.3, 5
POOL, RIDGE = 0.1, 0.05

_KINDS = ["lower", "upper", "digit", "space", "newline", "stop", "comma", "bar", "bang", "mark", "other", "wide"]


def _kind(b: int) -> int:
    c = chr(b)
    for k, hit in enumerate((97 <= b <= 122, 65 <= b <= 90, 48 <= b <= 57, c in " \t\r\v\f", c == "\n", c in ".?", c in ",;:", c == "|", c == "!", c in "#$%&*@^~<>{}[]\\/=+_`", b < 128, True)):
        if hit:
            return k
    raise AssertionError


_KIND = np.array([_kind(b) for b in range(256)], np.int64)
FEATURES = [*_KINDS, "words", "word_length", "word_spread", "distinct", "top_word", "shouted", "marked", "lines", "line_words", "repeated_lines", "repeated_pairs", "sentence_words"]
D = len(FEATURES)


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log-odds of a share, half a count added to both sides."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def features(x: W.Words) -> np.ndarray:
    """Statistics of each text of a run, from words that are runs of other than white space."""
    n = len(x.offsets) - 1
    kind = _KIND[x.buf]
    size = np.diff(x.offsets)
    doc = np.repeat(np.arange(n), size)
    by = np.bincount(doc * len(_KINDS) + kind, minlength=n * len(_KINDS)).reshape(n, -1).astype(float)
    out = np.zeros((n, D))
    out[:, : len(_KINDS)] = _odds(by, size[:, None].astype(float))
    words = x.counts.astype(float)
    text_of = x.text_of()
    length = (x.end - x.start).astype(float)
    some = np.maximum(words, 1)
    mean = np.bincount(text_of, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(text_of, length**2, n) / some - mean**2, 0))
    last = kind[x.end - 1] if len(x.end) else np.zeros(0, np.int64)
    first = kind[x.start] if len(x.start) else np.zeros(0, np.int64)
    # a shouted word starts with two capitals
    second = kind[np.minimum(x.start + 1, x.end - 1)] if len(x.start) else first
    shouted = np.bincount(text_of, (first == 1) & (second == 1) & (length > 1), n)
    marked = np.bincount(text_of, last >= _KINDS.index("bar"), n)
    stops = np.bincount(text_of, last == _KINDS.index("stop"), n)
    distinct, top, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
    two = W.kgrams(x.hash, 2)
    for r, (a, b) in enumerate(zip(x.first[:-1].tolist(), x.first[1:].tolist(), strict=True)):
        if b > a:
            s = np.sort(x.hash[a:b])
            at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
            distinct[r], top[r] = len(at) - 1, np.diff(at).max()
            if b - a > 1:
                s = np.sort(two[a : b - 1])
                pairs[r] = (s[1:] == s[:-1]).sum()
    lines, again = np.zeros(n), np.zeros(n)
    ends = np.flatnonzero(x.buf == 10)
    marks = np.unique(np.concatenate([x.offsets, ends + 1]))
    a, b = marks[:-1], marks[1:]
    full = b - a > 1
    a, b = a[full], b[full]
    b = np.where(x.buf[b - 1] == 10, b - 1, b) if len(b) else b
    h, d = W.hashes(x.buf, a, b), np.searchsorted(x.offsets, a, "right") - 1
    lines = np.bincount(d, minlength=n).astype(float)
    if len(h):
        order = np.lexsort((h, d))
        same = (h[order][1:] == h[order][:-1]) & (d[order][1:] == d[order][:-1])
        again = np.bincount(d[order][1:][same], minlength=n).astype(float)
    out[:, len(_KINDS) :] = np.stack(
        [np.log1p(words), np.log1p(mean), np.log1p(spread), _odds(distinct, words), _odds(top, words), _odds(shouted, words), _odds(marked, words), np.log1p(lines), np.log1p(words / np.maximum(lines, 1)), _odds(again, lines), _odds(pairs, words), np.log1p(words / (stops + 1))],
        axis=1,
    )
    return out


def measure(texts: pa.Array) -> np.ndarray:
    found = [features(x) for _, _, x in W.runs(texts, "space")]
    return np.concatenate(found) if found else np.zeros((0, D))


def _measured(batches):
    for batch in batches:
        f = measure(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1, dtype=np.int32) * D), pa.array(f.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def _moments(batches):
    """Sums of (1, x, x x') by label over a partition; one row for each sum."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x, y = _matrix(batch.column("x")), batch.column("quality").to_numpy(zero_copy_only=False)
        for label in np.unique(y):
            own = np.concatenate([np.ones(((y == label).sum(), 1)), x[y == label]], axis=1)
            sums[int(label)] = sums.get(int(label), 0) + own.T @ own
    for label, m in sums.items():
        i = np.arange(m.size)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, label)), pa.array(i), pa.array(m.ravel())], names=["label", "i", "v"])


class Discriminant:
    """Two normal densities and the share of label 1."""

    def __init__(self, sums: dict[int, np.ndarray], pool: float = POOL, ridge: float = RIDGE):
        n = {k: float(sums[k][0, 0]) if k in sums else 0.0 for k in (0, 1)}
        self.constant = None
        if not n[0] or not n[1]:
            self.constant = 0.5 if n[0] == n[1] else float(n[1] > 0)
            return
        mean = {k: sums[k][0, 1:] / n[k] for k in n}
        scatter = {k: sums[k][1:, 1:] - n[k] * np.outer(mean[k], mean[k]) for k in n}
        pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
        diagonal = np.diag(np.diag(pooled) + 1e-6)
        self.mean, self.factor, self.inverse, self.log_det = mean, {}, {}, {}
        for k in n:
            cov = (1 - pool) * (scatter[k] + D * pooled) / (n[k] + D) + pool * pooled
            self.factor[k] = np.linalg.cholesky((1 - ridge) * cov + ridge * diagonal)
            self.inverse[k] = np.linalg.inv(self.factor[k])
            self.log_det[k] = 2 * np.log(np.diag(self.factor[k])).sum()
        self.prior = np.log(n[1] / n[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = {}
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.inverse[k].T
            density[k] = -0.5 * ((z**2).sum(axis=1) + self.log_det[k])
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.prior, -50, 50)))


def held_out(folds: int = FOLDS):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """The model of all label rows outside the held-out fold. Only sums reach the driver: 2 * (D + 1)**2 numbers."""
    y = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = measured.where(~held_out()).join(y, "doc_id").select("x", "quality")
    sums = rows.mapInArrow(_moments, "label long, i long, v double").groupBy("label", "i").agg(F.sum("v").alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for r in sums:
        out.setdefault(r.label, np.zeros((D + 1) ** 2))[r.i] = r.v
    return Discriminant({k: v.reshape(D + 1, D + 1) for k, v in out.items()})


def _scored(model: Discriminant):
    def scored(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(_matrix(batch.column("x"))))], names=["doc_id", "held_out", "score"])

    return scored


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, held_out, score of label 1, predicted."""
    prepare(docs)
    measured = written(docs.select("doc_id", "text").mapInArrow(_measured, "doc_id long, x array<double>"), "measured")
    model = fit(measured, labels)
    out = measured.withColumn("held_out", held_out()).mapInArrow(_scored(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _kept(model: Discriminant, threshold: float):
    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(measure(batch.column("text"))) >= threshold))

    return kept


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more; columns stay. Texts don't move: statistics are taken where they lie, once for the fit and once for the filter."""
    prepare(docs)
    measured = written(docs.select("doc_id", "text").mapInArrow(_measured, "doc_id long, x array<double>"), "measured")
    model = fit(measured, labels)
    removed(measured)
    return docs.mapInArrow(_kept(model, threshold), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
