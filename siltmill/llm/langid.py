"""Language identification by a linear-chain conditional random field over words.

Each word of a line is a position of the chain, each learned language a label.
A word's potential is a sum of learned weights of its features: its prefixes
and suffixes of 1 to 3 bytes, its inner n-grams of 2 and 3 bytes with word ends
marked, and the word itself (the lexicon), all hashed into one table. Learned
transitions tie neighbours, so a short word follows its surroundings, while a
passage in another language may switch. Marginals come from forward-backward;
a document's language is that of the largest sum of its words' marginals, and
its score the share of that sum. ``label_words`` gives every word's own label.

The weights are fitted by full-batch Adam on the exact likelihood of labelled
documents whose crc32(doc_id as text) mod 4 is not 2. The fit takes a bounded
sample of them, about ``SAMPLE`` documents and ``SAMPLE_BYTES`` bytes (documented
parameters), dealt evenly to the languages, those with the least hashes of each
and long ones last, so that a rare language has its share; every word of them
counts. A chain is a line, cut at newlines and every ``LINE`` words, in the fit as
in use. Lines of several training documents are joined at random into
code-switched ones, so that transitions between languages are learned too.

Defined cases: a null text and a text without a letter is ``und`` with score 0;
so is everything if nothing can be learned; ties go to the language first in
order; rows with a null lang or doc_id are not learned from, and a null doc_id
is not held out; repeated rows get their row again; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import prepare, table

SAMPLE, SAMPLE_BYTES, LONG, BITS, STEPS, LINE, FOLDS, HELD = 1500, 8 << 20, 64 << 10, 18, 40, 32, 4, 2
_RESULT = "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"
_WORDS = "doc_id long, word_no long, word string, lang string, marginal double"
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def types_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct word, for each word the number of its kind)."""
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return first, inverse


def word_features(x: W.Words, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the words ``at``, one word's behind another's, and where each word's begin."""
    a, b = x.start[at].astype(np.int64), x.end[at].astype(np.int64)
    low = W.LOWER[x.buf].astype(W.U)
    n = b - a
    parts = []
    mask = W.U((1 << bits) - 1)

    def put(kind: int, values: np.ndarray, own: np.ndarray) -> None:
        parts.append((own, (W.mix(values * W.U(64) + W.U(kind)) & mask).astype(np.int32)))

    every = np.arange(len(at))
    put(0, x.hash[at], every)
    code = np.zeros(len(at), W.U)
    tail = np.zeros(len(at), W.U)
    for k in (1, 2, 3):
        has = n >= k
        code[has] = code[has] * W.U(257) + low[a[has] + k - 1] + W.U(1)
        tail[has] = tail[has] * W.U(257) + low[b[has] - k] + W.U(1)
        put(k, code[has], every[has])
        put(3 + k, tail[has], every[has])
    for k in (2, 3):
        own, p = W.expand(a, np.maximum(b - k + 1, a))
        v = np.zeros(len(p), W.U)
        for j in range(k):
            v = v * W.U(257) + low[p + j] + W.U(1)
        put(6 + k, v, own)
    own = np.concatenate([o for o, _ in parts])
    slots = np.concatenate([s for _, s in parts])
    order = np.argsort(own, kind="stable")
    return slots[order], np.searchsorted(own[order], every)


def potentials(weights: np.ndarray, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each word's weights, by label."""
    return np.stack([np.add.reduceat(w[slots], first) for w in weights], axis=1) if len(first) else np.zeros((0, len(weights)))


def marginals(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many lines at once: emit is (lines, places, labels). Gives label marginals, summed pair marginals and the log partition sum."""
    rows, places, k = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - top)
    move = np.exp(trans)
    inside = np.arange(places)[None, :] < lengths[:, None]
    alpha = np.zeros((places, rows, k))
    scale = np.ones((places, rows))
    for t in range(places):
        v = (np.exp(start)[None, :] if t == 0 else alpha[t - 1] @ move) * e[:, t]
        s = v.sum(axis=1)
        on = inside[:, t]
        alpha[t] = np.where(on[:, None], v / s[:, None], alpha[t - 1] if t else v)
        scale[t] = np.where(on, s, 1.0)
    beta = np.ones((rows, k))
    gamma = np.zeros((rows, places, k))
    pairs = np.zeros((k, k))
    for t in range(places - 1, -1, -1):
        on = inside[:, t]
        g = alpha[t] * beta
        gamma[:, t] = np.where(on[:, None], g / g.sum(axis=1, keepdims=True), 0)
        if t:
            right = e[:, t] * beta / scale[t][:, None]
            pairs += (alpha[t - 1][on].T @ right[on]) * move
            beta = np.where(on[:, None], right @ move.T, beta)
    total = np.log(scale).sum() + (top[:, :, 0] * inside).sum()
    return gamma, pairs, float(total)


def lines_of(x: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each chain: lines of one text, cut every ``LINE`` words."""
    text_of, n = x.text_of(), len(x.hash)
    line = np.concatenate([[0], np.cumsum(x.buf == 10)])[x.start]
    new = np.concatenate([[True], (line[1:] != line[:-1]) | (text_of[1:] != text_of[:-1])])
    at = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    at = np.flatnonzero(place % LINE == 0)
    return at, np.diff(np.append(at, n))


class Field:
    """A learned field: weights by label and slot, transitions and starts."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.labels, self.weights, self.trans, self.start = labels, weights, trans, start
        self.bits = int(weights.shape[1] - 1).bit_length() if len(labels) else 0

    def words(self, x: W.Words) -> np.ndarray:
        """Marginals by word and label."""
        out = np.zeros((len(x.hash), len(self.labels)))
        if not len(x.hash) or not self.labels:
            return out
        first, kind = types_of(x.hash)
        emit = potentials(self.weights, *word_features(x, first, self.bits))
        at, size = lines_of(x)
        order = np.argsort(size, kind="stable")
        for lo in range(0, len(order), 4096):
            rows = order[lo : lo + 4096]
            places = np.arange(int(size[rows].max()))[None, :]
            inside = places < size[rows][:, None]
            p = at[rows][:, None] + np.minimum(places, size[rows][:, None] - 1)
            gamma, _, _ = marginals(emit[kind[p]], self.trans, self.start, size[rows])
            out[p[inside]] = gamma[inside]
        return out


def fit(rows: list[tuple[str, str]], bits: int = BITS, steps: int = STEPS, seed: int = 7) -> Field:
    """The field of (text, lang) rows, the same for the same rows in any order."""
    rows = sorted(rows)
    labels = sorted({lang for _, lang in rows})
    k = len(labels)
    if not k:
        return Field([], np.zeros((0, 1)), np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    size = 1 << bits
    weights, trans, start = np.zeros((k, size)), np.zeros((k, k)), np.zeros(k)
    buf, offsets = W.buffer_of(pa.array([t for t, _ in rows], pa.large_string()))
    x = W.split(buf, offsets, "alnum")
    if not len(x.hash):
        return Field([], np.zeros((0, 1)), np.zeros((0, 0)), np.zeros(0))
    y = np.repeat([labels.index(lang) for _, lang in rows], x.counts)
    first, kind = types_of(x.hash)
    slots, begin = word_features(x, first, bits)
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(begin, len(slots))))
    # a quarter of the full lines get a tail from another one
    at, n = lines_of(x)
    p = at[:, None] + np.minimum(np.arange(LINE)[None, :], n[:, None] - 1)
    other = rng.permutation(len(p))
    from_here = np.where(rng.random(len(p)) < 0.25, rng.integers(1, LINE, len(p)), LINE)
    full = (n == LINE) & (n[other] == LINE)
    p = np.where(full[:, None] & (np.arange(LINE)[None, :] >= from_here[:, None]), p[other], p)
    words, truth = kind[p], y[p]
    inside = np.arange(LINE)[None, :] < n[:, None]
    moments = [np.zeros_like(a) for a in (weights, trans, start)], [np.zeros_like(a) for a in (weights, trans, start)]
    seen = np.zeros((len(first), k))
    np.add.at(seen, (words[inside], truth[inside]), 1)
    pairs = np.zeros((k, k))
    np.add.at(pairs, (truth[:, :-1][inside[:, 1:]], truth[:, 1:][inside[:, 1:]]), 1)
    starts = np.bincount(truth[:, 0], minlength=k).astype(float)
    total = inside.sum()
    for step in range(1, steps + 1):
        emit = potentials(weights, slots, begin)
        expected, moved, begun = np.zeros((len(first), k)), np.zeros((k, k)), np.zeros(k)
        for lo in range(0, len(p), 4096):
            w = words[lo : lo + 4096]
            gamma, pair, _ = marginals(emit[w], trans, start, n[lo : lo + 4096])
            for j in range(k):
                expected[:, j] += np.bincount(w.ravel(), gamma[:, :, j].ravel(), len(first))
            moved += pair
            begun += gamma[:, 0].sum(axis=0)
        by_type = seen - expected
        g = np.stack([np.bincount(slots, by_type[owner, j], size) for j in range(k)])
        grads = (g / total - 1e-6 * weights, (pairs - moved) / total - 1e-4 * trans, (starts - begun) / total - 1e-4 * start)
        for a, d, m, v in zip((weights, trans, start), grads, *moments, strict=True):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            a += 0.3 / np.sqrt(step) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(labels, weights.astype(np.float32), trans, start)


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False))


def training_sample(docs: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """(text, lang) of labelled documents outside the fold, an equal part of ``sample`` rows and ``most`` bytes for each language.

    Rows are cut by hash before they move, at a hash that about four times a language's part stays below.
    """
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return []
    each, size = max(1, sample // len(counts)), max(1, most // len(counts))
    hashed = rows.select("text", "lang", F.xxhash64("doc_id", F.lit(11)).alias("h"), F.octet_length("text").alias("size"), "doc_id")
    cut = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, int(min(-(2**63) + max(4 * each / n, 64 / n) * 2**64, 2**63 - 1)))))
    near = hashed.where(F.col("h") <= cut[F.col("lang")])
    w = Window.partitionBy("lang").orderBy(F.col("size") > LONG, "h", "doc_id", "text")
    first = near.withColumn("k", F.row_number().over(w)).where(F.col("k") <= each)
    taken = first.withColumn("so_far", F.sum("size").over(w)).where((F.col("so_far") <= size) | (F.col("k") == 1))
    return [(r.text, r.lang) for r in taken.select("text", "lang").collect()]


def _predicted(held):
    def predicted(batches):
        field = held.value
        for batch in batches:
            rows = []
            for _, _, x in W.runs(batch.column("text"), "alnum"):
                word, text_of, texts = field.words(x), x.text_of(), len(x.counts)
                total = np.stack([np.bincount(text_of, word[:, k], texts) for k in range(len(field.labels))], axis=1) if field.labels else np.zeros((texts, 0))
                best = word.argmax(axis=1) if field.labels else np.zeros(len(word), np.int64)
                switched = np.bincount(text_of[1:][(best[1:] != best[:-1]) & (text_of[1:] == text_of[:-1])], minlength=texts) if len(best) else np.zeros(texts, np.int64)
                letters = np.add.reduceat(np.append(_LETTER[x.buf], False).astype(np.int64), np.minimum(x.offsets[:-1], len(x.buf))) * (np.diff(x.offsets) > 0)
                for r in range(texts):
                    known = letters[r] > 0 or any(c.isalpha() for c in x.buf[x.offsets[r] : x.offsets[r + 1]].tobytes().decode("utf-8", "replace"))
                    s = total[r].sum()
                    k = int(np.argmax(total[r])) if known and s > 0 else -1
                    rows.append((field.labels[k] if k >= 0 else "und", float(min(total[r, k] / s, 1.0)) if k >= 0 else 0.0, int(x.counts[r]), int(switched[r])))
            made = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            cols = [batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, t) for c, t in zip(made, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches"])

    return predicted


def _labelled(held):
    def labelled(batches):
        field = held.value
        for batch in batches:
            for i, _, x in W.runs(batch.column("text"), "alnum"):
                if not len(x.hash) or not field.labels:
                    continue
                word, t = field.words(x), x.text_of()
                best = word.argmax(axis=1)
                ids = batch.column("doc_id").take(pa.array(i + t))
                cols = [ids, pa.array(np.arange(len(t)) - x.first[t]), pa.array([x.string(k) for k in range(len(t))]), pa.array([field.labels[k] for k in best]), pa.array(word[np.arange(len(t)), best])]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "word_no", "word", "lang", "marginal"])

    return labelled


def _learned(docs: DataFrame, sample: int, bits: int):
    spark = prepare(docs)
    return spark.sparkContext.broadcast(fit(training_sample(docs, sample), bits))  # 2**bits weights for each language


def identify(docs: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score, n_words, and n_switches: how often a word's language isn't that of the word before."""
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(_predicted(_learned(docs, sample, bits)), _RESULT)


def label_words(docs: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """One row per word of every document: doc_id, word_no (from 0), word, its language and that label's marginal."""
    return docs.select("doc_id", "text").mapInArrow(_labelled(_learned(docs, sample, bits)), _WORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
