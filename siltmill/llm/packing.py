"""Best-fit packing by length patterns and non-negative least squares.

Documents become token ids with an end id, and only those longer than a
sequence are cut. What is planned is the histogram of piece lengths, which has
no more entries than a sequence has places, whatever the number of documents:

1. Patterns of few pieces are enumerated over length classes of ``WIDTH``
   tokens whose classes add up to a sequence.
2. Non-negative least squares fits how often each pattern is repeated to the
   histogram of classes; repeats are rounded down.
3. Each repeat takes pieces of its classes, longest first, and fills what is
   left with the longest piece that fits.
4. What is over is packed best fit, longest first.

Both steps work on groups of equal sequences, so the plan is a short list of
(lengths, repeats). Pieces of one length are interchangeable: each gets its
place by its number among them, counted in salted groups, so that a length that
a third of all pieces have is no single task's.

Defined cases: a null text is empty and has its end id alone; a null doc_id is
packed like any other; repeated rows are packed once each; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltmill.llm.common import prepare, table, written
from siltmill.llm.tokens import WordEnds, encoder, vocabulary

LENGTH, END, WIDTH, PARTS = 4096, 1, 64, 4
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def patterns(classes: int, parts: int) -> list[tuple[int, ...]]:
    """Classes in descending order, at most ``parts`` of them, that add up to ``classes``."""
    out = []

    def grow(left: int, most: int, so_far: tuple[int, ...]) -> None:
        if not left:
            out.append(so_far)
        elif len(so_far) < parts:
            for c in range(min(left, most), 0, -1):
                if c * (parts - len(so_far)) >= left:
                    grow(left - c, c, (*so_far, c))

    grow(classes, classes, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 5000, near: float = 1e-6) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by accelerated projected gradients with restarts.

    It ends when the optimality conditions hold to ``near`` of the largest
    gradient at 0: no gradient is below it, nor above it where x is positive.
    """
    v = np.ones(a.shape[1])
    for _ in range(30):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v) or 1
    step = 1 / max(np.linalg.norm(a.T @ (a @ v)), 1e-9)
    x = y = np.zeros(a.shape[1])
    bound = near * max(float(np.abs(a.T @ b).max(initial=0)), 1e-12)
    t = 1.0
    for k in range(rounds):
        z = np.maximum(y - step * (a.T @ (a @ y - b)), 0)
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (y - z) @ (z - x) > 0:  # the momentum leads up again
            t, u = 1.0, 1.0
        y, x, t = z + (t - 1) / u * (z - x), z, u
        if k % 20 == 19:
            g = a.T @ (a @ x - b)
            if (g >= -bound).all() and (g[x > 0] <= bound).all():
                break
    return x


class _Stock:
    """Counts of pieces by length, with the longest length up to a bound."""

    def __init__(self, histogram: dict[int, int], length: int):
        self.n = np.zeros(length + 1, np.int64)
        for k, v in histogram.items():
            self.n[k] += v
        self.length = length

    def longest(self, most: int, least: int = 1) -> int:
        """0 if there is none from ``least`` to ``most``."""
        if most < least:
            return 0
        at = np.flatnonzero(self.n[least : most + 1])
        return int(at[-1]) + least if len(at) else 0


def plan(histogram: dict[int, int], length: int = LENGTH, width: int = WIDTH, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of the pieces of a sequence, number of such sequences); every piece of the histogram is in one."""
    stock, out = _Stock(histogram, length), defaultdict(int)
    classes = length // width
    of = np.minimum((np.arange(length + 1) + width - 1) // width, classes)
    counts = np.bincount(of, weights=stock.n, minlength=classes + 1)[1:]
    shapes = patterns(classes, parts)
    a = np.zeros((classes, len(shapes)))
    for j, s in enumerate(shapes):
        for c in s:
            a[c - 1, j] += 1
    repeats = np.floor(nnls(a, counts / max(counts.max(), 1)) * max(counts.max(), 1) + 1e-6).astype(np.int64)
    # sequences with the longest pieces first: they have the fewest choices
    for j in sorted(np.flatnonzero(repeats), key=lambda j: shapes[j], reverse=True):
        left = int(repeats[j])
        while left:
            taken: list[int] = []
            room = length
            for c in shapes[j][:-1]:
                own = _pick(stock, taken, min(c * width, room), (c - 1) * width + 1)
                if not own:
                    break
                taken.append(own)
                room -= own
            else:
                while own := _pick(stock, taken, room, 1):
                    taken.append(own)
                    room -= own
            if len(taken) < len(shapes[j]) - 1 or not taken:
                break
            uses = defaultdict(int)
            for x in taken:
                uses[x] += 1
            m = min(left, *(int(stock.n[x]) // k for x, k in uses.items()))
            for x, k in uses.items():
                stock.n[x] -= m * k
            out[tuple(taken)] += m
            left -= m
    # the rest: best fit decreasing, over groups of equal sequences by the room that is left
    room_of: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    has = np.zeros(length + 1, bool)

    def put(room: int, seq: tuple[int, ...], n: int) -> None:
        room_of[room][seq] = room_of[room].get(seq, 0) + n
        has[room] = True

    for x in range(length, 0, -1):
        left = int(stock.n[x])
        while left:
            at = np.flatnonzero(has[x:])
            if len(at):
                room = int(at[0]) + x
                seq, n = next(iter(room_of[room].items()))
                fits = max(1, min(room // x, left // n if n <= left else 1))
                m = min(n, left // fits)
                if m == n:
                    del room_of[room][seq]
                    has[room] = bool(room_of[room])
                else:
                    room_of[room][seq] = n - m
                put(room - x * fits, seq + (x,) * fits, m)
            else:
                fits = max(1, min(length // x, left))
                m = left // fits
                put(length - x * fits, (x,) * fits, m)
            left -= m * fits
    for groups in room_of.values():
        for seq, n in groups.items():
            out[seq] += n
    return sorted(((s, n) for s, n in out.items() if n), reverse=True)


def _pick(stock: _Stock, taken: list[int], most: int, least: int) -> int:
    """The longest length that still has a piece besides those taken."""
    while True:
        x = stock.longest(most, least)
        if not x or stock.n[x] > taken.count(x):
            return x
        most = x - 1


class Places:
    """For a piece's length and number among that length: sequence and offset."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]], length: int):
        used: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for seq, n in planned:
            offset = 0
            for x, same in itertools.groupby(sorted(seq, reverse=True)):
                for _ in same:
                    rows.append((x, used[x], sequence, offset))
                    used[x] += n
                    offset += x
            sequence += n
        rows.sort()
        t = np.array(rows, np.int64).reshape(-1, 4)
        self.lengths, self.first, self.sequence, self.offset = t.T
        self.start = np.searchsorted(self.lengths, np.arange(length + 2))

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.lengths.astype(float) * 2.0**40 + self.first
        at = np.searchsorted(key, lengths.astype(float) * 2.0**40 + ranks, "right") - 1
        return self.sequence[at] + ranks - self.first[at], self.offset[at]


def _pieces(path: str, length: int, end: int):
    def pieces(batches):
        enc = encoder(WordEnds, path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            ids = batch.column("doc_id").to_pylist()
            for i, found in enc(batch.column("text")):
                for doc, own in zip(ids[i : i + len(found)], found, strict=True):
                    own = np.append(own, np.uint32(end)).astype("<u4")
                    for k, at in enumerate(range(0, len(own), length)):
                        part = own[at : at + length]
                        for c, v in zip(cols, (doc, k, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                            c.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return pieces


def _placed(held):
    def placed(batches):
        for batch in batches:
            s, o = held.value.of(*(batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank")))
            kept = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(s, pa.int64()), pa.array(o, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return placed


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: where its ids start in the document, how many they are, their checksum, its sequence and place."""
    spark = prepare(docs)
    made = written(docs.select("doc_id", "text").mapInArrow(_pieces(path or vocabulary("word_bpe_49k.json"), length, end), _PIECES), "pieces")
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return made.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    held = spark.sparkContext.broadcast(Places(plan(histogram, length), length))
    salts = 16 + sum(histogram.values()) // 500_000
    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("number", number).join(before, ["length", "salt"]).withColumn("rank", (F.col("before") + F.col("number") - 1).cast("long"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(held), _PIECES + ", sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
