"""Language-model scoring by a probabilistic suffix tree over words.

The root is the smoothed unigram distribution of all training tokens. A context
is any run of up to ``DEPTH`` preceding words that is followed by the same token
four times or more (``LEAST``, an absolute count, so that the model grows with
the input). Its distribution keeps the tokens seen after it so often; counts are
smoothed towards the distribution of the context without its first word, and
what is left goes to the other tokens in that distribution's proportions, so
every state's probabilities sum to one. A context is retained if its count times
the divergence from the shorter context exceeds half its number of symbols times
log N. Contexts are made longer by a word where the shorter one was retained, and
where their own words were counted, until none of a length is retained or
``DEPTH`` is reached (None: no bound). A token is scored in the state of the
longest retained suffix; suffixes of states are states.

As suffixes of states are states, a token's log probability is the root's plus
what each state on the way to the longest adds to it. That is the sum of a value
for each context (what it leaves to tokens that weren't seen after it) and one
for each context with a token seen after it. So the model is one distributed
table from the hash of a run of words to a value, and a document gains the sum
over its runs: those that make up ``HOT`` of the tokens or more meet a broadcast
part of the table, at most 1 / HOT runs of each length, the others meet the rest
in an equi-join and come back as one sum per document. A broadcast bitmap of
bounded size spares runs without a value the exchange; all that it lets pass
wrongly is dropped by the join. Counts of rare words are joined likewise. Both
are dealt by their hashes into ``SHARES`` that are joined one after the other,
so that the disks hold one share's exchange at a time.

Words are known by 64-bit hashes, and so are runs of them. Rows whose
crc32(doc_id as text) mod 10 is not 0 are learned from. Defined cases: a null
text is empty and is its end token alone; a null doc_id is learned from and is
no held-out row; repeated rows each count in learning and get their row again;
with no training rows every token has the probability of an unknown one; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import Bits, columns, made, prepare, remove_since, removed, repeats, table, tidy, written

LEAST, DEPTH, FREQUENT, HOT, PRIOR, FOLDS = 4, 4, 1e-6, 3e-6, 20.0, 10
#: Runs of words that a task tallies at once.
TALLIED = 3_000_000
#: Pairs of words, the most of all runs, are counted in so many passes, so that no more than that part of them is on the disks at once.
PASSES = 2
#: Words and runs that meet the distributed part of the model are joined in so many equal shares of their hashes; a power of two.
SHARES = 4
END = W.mix(np.array([0x0E4D], W.U))[0]
_WORDS, _RUNS = ([f"{c}{k}" for k in range(SHARES)] for c in ("words", "runs"))
_SCORED = "doc_id long, text_key long, held_out boolean, n_tokens long, known long, base double, added double" + "".join(f", {c} array<struct<h:long,n:int>>" for c in _WORDS + _RUNS)


def tokens(x: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end token behind each text's, and where each text's begin (one more at the end)."""
    n = len(x.counts)
    first = x.first + np.arange(n + 1)
    out = np.empty(len(x.hash) + n, W.U)
    ends = first[1:] - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word], out[ends] = x.hash, END
    return out, first


class Tally:
    """Counts of 64-bit keys in a task: merged as they come, handed on when too many."""

    def __init__(self, most: int = 1_500_000):
        self.most, self.parts, self.held = most, [], 0

    def add(self, keys: np.ndarray):
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.held += len(k)
        if self.held > self.most:
            k, n = self._merged()
            if len(k) > self.most // 2:
                yield k, n
            else:
                self.parts, self.held = [(k, n)], len(k)

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[at], np.add.reduceat(counts, at)

    def rest(self):
        if self.parts:
            yield self._merged()


def _rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["k", "n"])


def _unigrams(batches):
    tally = Tally()
    for batch in batches:
        for _, _, x in W.runs(batch.column("text"), "space"):
            for k, n in tally.add(tokens(x)[0]):
                yield _rows(k, n)
    for k, n in tally.rest():
        yield _rows(k, n)


@dataclass
class Vocabulary:
    """Frequent tokens: sorted hashes and counts, with totals of all tokens."""

    hash: np.ndarray
    count: np.ndarray
    total: int
    distinct: int

    def __post_init__(self):
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hash >> W.U(42)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the tokens; -1 for those that aren't frequent."""
        out = np.full(len(h), -1)
        maybe = np.flatnonzero(self.bits[(h >> W.U(42)).astype(np.int64)])
        if len(maybe) and len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, h[maybe]), len(self.hash) - 1)
            hit = self.hash[at] == h[maybe]
            out[maybe[hit]] = at[hit]
        return out

    def log_root(self, count):
        return np.log10((count + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    @property
    def root(self) -> np.ndarray:
        return (self.count + 0.1) / (self.total + 0.1 * (self.distinct + 1))


def _where(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def join_runs(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of runs of n + 1 words from those of their first and of their last n."""
    return W.mix(before * W.U(0x9E3779B97F4A7C15) + last)


def runs_of(h: np.ndarray, first: np.ndarray, most: int):
    """For lengths from 1 to ``most``: the hash of the run of that many tokens that ends at each place, and whether the place's text has one."""
    within = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    run = h
    for length in range(1, most + 1):
        yield run, within >= length - 1
        if length < most:
            longer = run.copy()
            longer[1:] = join_runs(run[:-1], run[1:])
            run = longer


def _pairs(held, length: int, part: int, of: int):
    """Runs of ``length`` tokens, each as the hashes of all but its last and of all but its first token, with counts. Of the two
    bitmaps one must have the first, the other the second. Only runs of the ``part``-th of ``of`` equal shares of the hashes."""

    def tallied(parts):
        before, last = (np.concatenate(c) for c in zip(*parts, strict=True))
        key = join_runs(before, last)
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(np.append(at, len(key)))
        return pa.RecordBatch.from_arrays([pa.array(before[order[at]].view(np.int64)), pa.array(last[order[at]].view(np.int64)), pa.array(n.astype(np.int64))], names=["before", "last", "n"])

    def pairs(batches):
        (first_bits, second_bits), parts, n = held.value, [], 0
        for batch in batches:
            for _, _, x in W.runs(batch.column("text"), "space"):
                h, first = tokens(x)
                *_, (run, has) = runs_of(h, first, length - 1)
                within = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
                ends = np.flatnonzero(has[:-1] & (within[1:] >= length - 1)) + 1
                if of > 1:
                    ends = ends[(run[ends - 1] + run[ends]) % W.U(of) == part]
                ends = ends[second_bits.has(run[ends])]
                ends = ends[first_bits.has(run[ends - 1])]
                parts.append((run[ends - 1], run[ends]))
                n += len(ends)
                if n > TALLIED:
                    yield tallied(parts)
                    parts, n = [], 0
        if n:
            yield tallied(parts)

    return pairs


def _keyed(batches):
    for batch in batches:
        before, last = (batch.column(c).to_numpy().view(W.U) for c in ("before", "last"))
        yield pa.RecordBatch.from_arrays([pa.array(join_runs(before, last).view(np.int64)), *batch.columns], names=["k", *batch.schema.names])


@dataclass
class Tree:
    """The broadcast part of the model: sorted hashes of frequent runs with their values, and a bitmap of all runs that have one."""

    vocabulary: Vocabulary
    hash: np.ndarray
    seen: np.ndarray  # what a run adds to its last token, as a context with a token seen after it
    rest: np.ndarray  # what it adds to the token after it, as a context
    bits: Bits
    depth: int

    def gains(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What frequent runs add to each place, and the other runs that may have a value: their hashes and the places they end at."""
        out, rare, at = np.zeros(len(h) + 1), [np.zeros(0, W.U)], [np.zeros(0, np.int64)]
        shorter = None
        for length, (run, has) in enumerate(runs_of(h, first, self.depth + 1 if self.depth else 0), 1):
            # from three words on, a run with a value has a suffix with one
            on = np.flatnonzero(has if length < 3 else has & shorter)
            on = on[self.bits.has(run[on])]
            shorter = np.zeros(len(h), bool)
            shorter[on] = True
            k = _where(self.hash, run[on])
            hot = k >= 0
            out[on[hot]] += self.seen[k[hot]]
            out[on[hot] + 1] += self.rest[k[hot]]
            rare.append(run[on[~hot]])
            at.append(on[~hot])
        return out[:-1], np.concatenate(rare), np.concatenate(at)

    def added(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """What the broadcast states add to the root's log10 probability of each token."""
        return self.gains(np.where(ids >= 0, self.vocabulary.hash[ids], W.U(1)), first)[0]


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def grow(texts: DataFrame, counts: DataFrame, total: int, distinct: int, depth: int | None = DEPTH, fewest: int = LEAST) -> list[tuple[DataFrame, DataFrame]]:
    """For each length of contexts up to the longest with a state: the tokens after states (k, n, p, seen), and the states (before, size, rest).

    A run that comes ``fewest`` times has its first and its last words so often,
    so runs are only counted where bitmaps of shorter ones have both.
    """
    spark = texts.sparkSession
    known = counts.where(F.col("n") >= fewest).select("k", "n", ((F.col("n") + 0.1) / (total + 0.1 * (distinct + 1))).alias("p"))
    shorter = known.select(F.col("k").alias("last"), F.col("p").alias("shorter"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    before = None  # the table that known reads, from the second length on
    while depth is None or len(levels) < depth:
        with tidy(spark):
            bits = Bits.of(known), Bits.of(shorter.select(F.col("last").alias("k")))
        held = spark.sparkContext.broadcast(bits)
        of = 1 if levels else PASSES
        parts = []
        for part in range(of):
            rows = texts.mapInArrow(_pairs(held, len(levels) + 2, part, of), "before long, last long, n long").groupBy("before", "last").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)
            parts.append(written(rows, "counted"))
        counted = reduce(DataFrame.union, parts)
        sized = counted.join(known.select(F.col("k").alias("before"), F.col("n").alias("size")), "before").join(shorter, "last")
        keyed = sized.select("before", "last", "n", "size", "shorter").mapInArrow(_keyed, "k long, before long, last long, n long, size long, shorter double")
        own = written(keyed.drop("last"), "pairs")
        removed(*parts, *([before] if before else []))
        before = own
        pairs = own.withColumn("p", (F.col("n") + PRIOR * F.col("shorter")) / (F.col("size") + PRIOR))
        held.unpersist()
        raw, left = F.col("n") / F.col("size"), F.greatest(1 - F.col("shorter_sum"), F.lit(1e-12))
        states = pairs.groupBy("before").agg(
            F.first("size").alias("size"), F.count("*").alias("m"), F.sum("p").alias("p_sum"), F.sum("shorter").alias("shorter_sum"),
            F.greatest(1 - F.sum(raw), F.lit(0.0)).alias("other"), F.sum(raw * F.log(raw / F.col("shorter"))).alias("d"),
        )
        other = F.when(F.col("other") > 1e-12, F.col("other") * F.log(F.col("other") / left)).otherwise(0.0)
        passed = F.col("size") * (F.col("d") + other) > 0.5 * (F.col("m") + 1) * F.log(F.lit(float(max(total, 2))))
        rest = F.log10(F.greatest(1 - F.col("p_sum"), F.lit(1e-12)) / left)
        states = written(states.where(passed).select("before", "size", rest.alias("rest")), "states")
        if not states.take(1):
            removed(states)
            break
        after = written(pairs.join(states.select("before", "rest"), "before").select("k", "n", "p", (F.log10(F.col("p") / F.col("shorter")) - F.col("rest")).alias("seen")), "after")
        levels.append((after, states))
        known, shorter = pairs.select("k", "n"), after.select(F.col("k").alias("last"), F.col("p").alias("shorter"))
    if before:
        removed(before)
    return levels


def model(training: DataFrame, depth: int | None = DEPTH, fewest: int = LEAST) -> tuple[Tree, DataFrame, DataFrame]:
    """The tree of the training rows' texts, the counts (k, n) of all their tokens, and the rest of the model: runs that aren't in the tree, with their values (k, v)."""
    spark = training.sparkSession
    texts = training.select("text")
    counts = written(texts.mapInArrow(_unigrams, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")), "counts")
    t = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = t["n"] or 0, t["v"]
    # at most 1 / FREQUENT rows
    h, n = columns(counts.where(F.col("n") >= max(1, FREQUENT * total)).select("k", "n"))
    h = h.view(W.U)
    order = np.argsort(h)
    vocabulary = Vocabulary(h[order], n[order], total, distinct)
    levels = grow(texts, counts, total, distinct, depth, fewest)
    values = counts.select("k", F.lit(0.0).alias("seen"), F.lit(0.0).alias("rest"), "n").where("false")
    for after, states in levels:
        values = values.union(after.select("k", "seen", F.lit(0.0).alias("rest"), "n")).union(states.select(F.col("before").alias("k"), F.lit(0.0).alias("seen"), "rest", F.col("size").alias("n")))
    values = written(values.groupBy("k").agg(F.sum("seen").alias("seen"), F.sum("rest").alias("rest"), F.max("n").alias("n")), "values")
    least = max(fewest, HOT * total)
    # at most 1 / HOT runs of each length
    h, seen, rest = columns(values.where(F.col("n") >= least).select("k", "seen", "rest"))
    h = h.view(W.U)
    order = np.argsort(h)
    with tidy(spark):
        tree = Tree(vocabulary, h[order], seen[order], rest[order], Bits.of(values), len(levels))
    for pair in levels:
        removed(*pair)
    return tree, counts, values.where(F.col("n") < least).select("k", (F.col("seen") + F.col("rest")).alias("v"))


def learn(training: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of the training rows' texts, and the counts (k, n) of all their tokens."""
    return model(training)[:2]


def _sums(own: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of n texts, each once in a text: how many a text has, the hashes, how often each."""
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    at = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])])) if len(h) else np.zeros(0, np.int64)
    return np.bincount(own[at], minlength=n), h[at].view(np.int64), np.diff(np.append(at, len(h))).astype(np.int32)


def _lists(parts: list) -> pa.ListArray:
    lengths, hs, ns = zip(*parts, strict=True) if parts else ([], [], [])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths) if lengths else [])]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(hs) if hs else np.zeros(0, np.int64)), pa.array(np.concatenate(ns) if ns else np.zeros(0, np.int32))], names=["h", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def _scored(held):
    def scored(batches):
        tree = held.value
        v = tree.vocabulary
        logs = v.log_root(v.count)
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            lists: list[list] = [[] for _ in _WORDS + _RUNS]
            for _, _, x in W.runs(batch.column("text"), "space"):
                h, first = tokens(x)
                ids = v.find(h)
                text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
                n = len(first) - 1
                known = ids >= 0
                gain, rare, at = tree.gains(h, first)
                cols[0].append(np.diff(first))
                cols[1].append(np.bincount(text_of[known], minlength=n))
                cols[2].append(np.bincount(text_of[known], logs[ids[known]], n) if len(logs) else np.zeros(n))
                cols[3].append(np.bincount(text_of, gain, n))
                own, key = np.concatenate([text_of[~known], text_of[at]]), np.concatenate([h[~known], rare])
                share = (key & W.U(SHARES - 1)).astype(np.int64)
                share[len(key) - len(rare) :] += SHARES
                for k, part in enumerate(lists):
                    mine = share == k
                    part.append(_sums(own[mine], key[mine], n))
            flat = [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(cols, (np.int64, np.int64, float, float), strict=True)]
            keep = [batch.column(k) for k in ("doc_id", "text_key", "held_out")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)), pa.array(flat[2]), pa.array(flat[3]), *map(_lists, lists)], names=["doc_id", "text_key", "held_out", "n_tokens", "known", "base", "added", *_WORDS, *_RUNS])

    return scored


def score_texts(docs: DataFrame, depth: int | None = DEPTH, fewest: int = LEAST) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepare(docs)
    mark = made()
    docs = docs.select("doc_id", "text")
    with tidy(spark):
        again = repeats(docs)
    tree, counts, values = model(docs.where(~held_out()), depth, fewest)
    v = tree.vocabulary
    held = spark.sparkContext.broadcast(tree)
    rows = docs.withColumn("text_key", F.xxhash64("text") if again else F.lit(0).cast("long")).withColumn("held_out", held_out())
    distinct = rows.dropDuplicates(["doc_id", "text"]) if again else rows
    scored = written(distinct.select("doc_id", "text_key", "held_out", "text").mapInArrow(_scored(held), _SCORED), "scored")
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    base = F.log10((F.coalesce("n", F.lit(0)) + 0.1) / (v.total + 0.1 * (v.distinct + 1)))
    least = max(1, FREQUENT * v.total)

    def joined(names: list[str], found: DataFrame, how: str, tag: str, **sums) -> tuple[list[DataFrame], DataFrame]:
        """The sums by document over the lists ``names``, joined share by share and so not on the disks together: their tables, and all in one."""
        parts = []
        for share, name in enumerate(names):
            mine = scored.select(key.alias("id"), "text_key", F.explode(name).alias("r")).select("id", "text_key", F.col("r.h").alias("k"), F.col("r.n").alias("m"))
            own = found.where(F.col("k").bitwiseAND(F.lit(SHARES - 1)) == share)
            parts.append(written(mine.join(own, "k", how).groupBy("id", "text_key").agg(*(c.alias(a) for a, c in sums.items())), tag))
        return parts, reduce(DataFrame.union, parts).groupBy("id", "text_key").agg(*(F.sum(a).alias(a) for a in sums))

    known = F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0))
    kept, rare = joined(_WORDS, counts.where(F.col("n") < least), "left", "sums", rare_base=F.sum(F.col("m") * base), rare_known=known)
    removed(counts)
    more, gains = joined(_RUNS, values, "inner", "gains", rare_added=F.sum(F.col("m") * F.col("v")))
    remove_since(spark, mark, scored, *kept, *more)
    out = scored.drop(*_WORDS, *_RUNS)
    for found in (rare, gains):
        found = found.withColumnRenamed("text_key", "sum_key")
        out = out.join(found, (key == F.col("id")) & (F.col("text_key") == F.col("sum_key")), "left").drop("id", "sum_key")
    score = F.col("base") + F.coalesce("rare_base", F.lit(0.0))
    out = out.select(
        "doc_id", "text_key", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"), score.alias("base_score"), (score + F.col("added") + F.coalesce("rare_added", F.lit(0.0))).alias("score"),
    )
    if again:
        mine = rows.select(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
        out = mine.join(out, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")))
    return out.drop("text_key", "own_id", "own_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
