"""Nearest neighbours by a forest of random-projection trees.

Vectors are made comparable for the inner product by one more coordinate,
sqrt(M**2 - |x|**2) with M the greatest norm, and 0 for a query. A tree splits
a sample by hyperplanes between two random points of it, at the median, down to
leaves of ``LEAF`` sample points. Trees are fitted on at most ``SAMPLE`` distinct
vectors (a documented bound, those with the least hashes); every vector is then
routed to its leaf of every tree. A query walks all trees through one shared
priority queue, nearest hyperplanes first, until the leaves it has reached hold
a share of all vectors, counted once for each tree, and one tree's hold K + 1.
Within those leaves inner products are exact, in double precision on the
original vectors.

The share is measured, not set: ``PROBES`` vectors of the sample are searched
for in the sample by brute force, and the share is the least that reaches
``RECALL`` of their true neighbours. Vectors in clusters need few leaves, and
those without any structure in many dimensions nearly all of them.

Equal vectors are one entry with its ``K`` + 1 smallest ids: no more of them can
be among the K nearest. Neighbouring leaves are dealt together in blocks of
bounded size, and a large leaf in several; a query is sent once to a block, with
the leaves it visits there, and streamed against it, so no task holds more than
a block or all of its queries. Only a block's best entries for a query leave it.

Defined cases: a vector that is null, zero, or holds a null or non-finite number
takes no part, nor does one without an id; vectors of different lengths are
searched apart, as they have no inner product; rows with the same id and vector
are one; of rows with the same id and other vectors each is a query and a
candidate of its own; with fewer candidates than K all are returned; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltmill.llm.common import least_hashed, prepare, table, written

K, TREES, LEAF, SAMPLE, PROBES, RECALL, BLOCK = 20, 2, 32, 20_000, 200, 0.95, 4096
_RESULT = "q long, entry long, score double"


class Forest:
    """Trees as arrays: for each inner node a normal, an offset and two children; a child below 0 is leaf -1 - child."""

    def __init__(self, sample: np.ndarray, trees: int, leaves: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.trees = [self._grow(sample, max(1, leaves), rng) for _ in range(trees)]

    @staticmethod
    def _grow(sample: np.ndarray, leaves: int, rng) -> dict:
        normals, offsets, left, right = [], [], [], []
        count = 0

        def split(rows: np.ndarray, share: int) -> int:
            nonlocal count
            for _ in range(8 if share > 1 and len(rows) > 1 else 0):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                size = np.linalg.norm(normal)
                if size < 1e-12:
                    continue
                normal = normal / size
                side = sample[rows] @ normal
                offset = float(np.median(side))
                above = side > offset
                if not above.any() or above.all():
                    continue
                me = len(normals)
                for x, v in ((normals, normal), (offsets, offset), (left, 0), (right, 0)):
                    x.append(v)
                left[me] = split(rows[~above], share // 2)
                right[me] = split(rows[above], share - share // 2)
                return me
            count += 1
            return -count

        root = split(np.arange(len(sample)), leaves)
        d = sample.shape[1]
        return {"root": root, "normals": np.array(normals).reshape(-1, d), "offsets": np.array(offsets), "left": np.array(left, int), "right": np.array(right, int), "leaves": count}

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.trees)), np.int64)
        for t, tree in enumerate(self.trees):
            at = np.full(len(x), tree["root"])
            while (inner := np.flatnonzero(at >= 0)).size:
                n = at[inner]
                above = np.einsum("ij,ij->i", x[inner], tree["normals"][n]) > tree["offsets"][n]
                at[inner] = np.where(above, tree["right"][n], tree["left"][n])
            out[:, t] = -1 - at
        return out

    def search(self, x: np.ndarray, counts: list[np.ndarray], enough: float, least: int = 0) -> list[list[tuple[int, int]]]:
        """For each vector the (tree, leaf) pairs reached through the shared queue until they hold ``enough`` vectors, and one tree's ``least``."""
        margins = [x @ t["normals"].T - t["offsets"] if len(t["offsets"]) else np.zeros((len(x), 0)) for t in self.trees]
        lists = [(m.tolist(), t["left"].tolist(), t["right"].tolist(), c.tolist()) for m, t, c in zip(margins, self.trees, counts, strict=True)]
        out = []
        for i in range(len(x)):
            queue = [(-np.inf, t, tree["root"]) for t, tree in enumerate(self.trees)]
            got, found, own = 0, [], [0] * len(self.trees)
            while queue and (got < enough or max(own) < least):
                far, t, n = heapq.heappop(queue)
                m, left, right, count = lists[t]
                if n < 0:
                    if count[-1 - n]:
                        found.append((t, -1 - n))
                        got += count[-1 - n]
                        own[t] += count[-1 - n]
                    continue
                v = m[i][n]
                heapq.heappush(queue, (max(far, -v), t, right[n]))
                heapq.heappush(queue, (max(far, v), t, left[n]))
            out.append(found)
        return out


def _vectors(column: pa.Array) -> np.ndarray:
    d = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d).astype(np.float64)


def raised(x: np.ndarray, most: float) -> np.ndarray:
    """With the coordinate that makes all norms ``most``."""
    return np.concatenate([x, np.sqrt(np.maximum(most**2 - (x**2).sum(axis=1), 0))[:, None]], axis=1)


def share_for(forest: Forest, sample: np.ndarray, k: int, probes: int, recall: float) -> float:
    """The least share of vectors, over all trees, whose leaves hold ``recall`` of the probes' true neighbours in the sample."""
    n = len(sample)
    if n <= k + 1 or recall >= 1:
        return 1.0
    leaf = forest.route(sample)
    counts = [np.bincount(leaf[:, t], minlength=tree["leaves"]) for t, tree in enumerate(forest.trees)]
    asked = np.concatenate([sample[: min(probes, n), :-1], np.zeros((min(probes, n), 1))], axis=1)
    close = asked @ sample.T
    close[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    true = np.argpartition(-close, k, axis=1)[:, :k]
    reached = []
    for own, order in zip(true, forest.search(asked, counts, np.inf), strict=True):
        at = [np.full(tree["leaves"], n * len(forest.trees)) for tree in forest.trees]
        got = 0
        for t, x in order:
            got += counts[t][x]
            at[t][x] = got
        reached.append(np.min([at[t][leaf[own, t]] for t in range(len(at))], axis=0))
    return float(np.quantile(np.concatenate(reached), recall)) / (n * len(forest.trees))


def groups_of(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf its group of neighbouring leaves, and for each group the number of its blocks. A group is over a block only if a leaf is."""
    group = np.zeros(len(counts), np.int64)
    sizes = [0]
    for i, c in enumerate(counts.tolist()):
        if sizes[-1] and sizes[-1] + c > block:
            sizes.append(0)
        group[i] = len(sizes) - 1
        sizes[-1] += c
    return group, np.maximum(1, -(-np.array(sizes, np.int64) // block))


def _routed(held, most: float):
    def routed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = held.value.route(raised(_vectors(batch.column("v")), most))
            trees = leaf.shape[1]
            row = pa.array(np.repeat(np.arange(len(leaf)), trees))
            cols = [batch.column(k).take(row) for k in ("entry", "v")]
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(trees), len(leaf))), pa.array(leaf.ravel()), *cols], names=["tree", "leaf", "entry", "v"])

    return routed


def _asked(held, counts: list[np.ndarray], enough: float, least: int, groups: list[tuple[np.ndarray, np.ndarray]]):
    def asked(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column("v"))
            for i in range(0, len(x), 512):
                part = x[i : i + 512]
                found = held.value.search(np.concatenate([part, np.zeros((len(part), 1))], axis=1), counts, enough, least)
                rows = []
                for r, leaves in enumerate(found):
                    here: dict[tuple[int, int], list[int]] = {}
                    for t, leaf in leaves:
                        here.setdefault((t, int(groups[t][0][leaf])), []).append(leaf)
                    rows += [(r + i, t, g, b, own) for (t, g), own in here.items() for b in range(int(groups[t][1][g]))]
                if not rows:
                    continue
                r, t, g, b, own = zip(*rows, strict=True)
                at = pa.array(r)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (t, g, b)), pa.array(own, pa.list_(pa.int64())), *(batch.column(k).take(at) for k in ("entry", "v"))], names=["tree", "group", "block", "leaves", "entry", "v"])

    return asked


class _Best:
    """The best entries of each query so far, within a task."""

    def __init__(self, k: int):
        self.k, self.parts, self.n = k, [], 0

    def add(self, query: np.ndarray, entry: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((query, entry, score))
        self.n += len(query)
        if self.n > 2_000_000:
            self.parts = [self.reduced()]
            self.n = len(self.parts[0][0])

    def reduced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, e, s = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((e, q))
        q, e, s = q[order], e[order], s[order]
        one = np.concatenate([[True], (q[1:] != q[:-1]) | (e[1:] != e[:-1])])
        q, e, s = q[one], e[one], s[one]
        order = np.lexsort((e, -s, q))
        q, e, s = q[order], e[order], s[order]
        at = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        place = np.arange(len(q)) - np.repeat(at, np.diff(np.append(at, len(q))))
        top = place < self.k
        return q[top], e[top], s[top]


def _scored(k: int):
    """Rows dealt by (tree, group, block) and sorted with entries before queries -> the best entries of each query here."""

    def scored(batches):
        best, key = _Best(k), None
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x, leaves = _vectors(batch.column("v")), batch.column("leaves")
            c = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("tree", "group", "block", "side")], axis=1)
            ids = batch.column("entry").to_numpy(zero_copy_only=False)
            flat, at_leaf = leaves.flatten().to_numpy(), leaves.offsets.to_numpy() - leaves.offsets[0].as_py()
            cut = np.concatenate([[0], np.flatnonzero((c[1:] != c[:-1]).any(axis=1)) + 1, [len(c)]])
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                here = tuple(c[a, :3].tolist())
                if here != key:
                    key, held = here, []
                if c[a, 3] == 0:
                    held.append((ids[a:b], x[a:b], flat[at_leaf[a:b]]))
                    continue
                if not held:
                    continue
                e, v, own = (np.concatenate(p) for p in zip(*held, strict=True))
                held = [(e, v, own)]
                low_leaf = int(own.min())
                for i in range(a, b, 512):
                    j = min(b, i + 512)
                    s = x[i:j] @ v.T
                    # only vectors of the leaves that a query visits
                    visits = np.zeros((j - i, int(own.max()) - low_leaf + 1), bool)
                    r = np.repeat(np.arange(j - i), np.diff(at_leaf[i : j + 1]))
                    f = flat[at_leaf[i] : at_leaf[j]] - low_leaf
                    ok = (f >= 0) & (f < visits.shape[1])
                    visits[r[ok], f[ok]] = True
                    s[~visits[:, own - low_leaf]] = -np.inf
                    n = min(k, len(e))
                    low = -np.partition(-s, n - 1, axis=1)[:, n - 1]
                    # everything as good as the last one, so that ties are left to the ids
                    r, q = np.nonzero((s >= low[:, None]) & (s > -np.inf))
                    # one by one: sums of a matrix product depend on the shape of the block
                    best.add(ids[i:j][r], e[q], np.einsum("ij,ij->i", x[i:j][r], v[q]))
        q, e, s = best.reduced()
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(e), pa.array(s)], names=["q", "entry", "score"])

    return scored


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The k nearest found of every query (vec_id, embedding) among ``vectors`` (vec_id, embedding): query_id, rank, vec_id, score."""
    spark = prepare(vectors)
    good = "vec_id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)"
    used = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(good)
    base, asked = used(vectors), used(queries)
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for row in asked.select(F.size("v").alias("d")).distinct().orderBy("d").collect():  # a row for each length of vectors
        of = F.size("v") == row.d
        out = out.unionByName(_nearest(base.where(of), asked.where(of), k, trees, leaf, sample, recall, block))
    return out


def _nearest(base: DataFrame, asked: DataFrame, k: int, trees: int, leaf: int, sample: int, recall: float, block: int) -> DataFrame:
    spark = base.sparkSession
    hashed = lambda df: df.withColumn("h", F.xxhash64("v")).dropDuplicates(["h", "v", "vec_id"])
    # equal vectors: their smallest ids; the limit is applied before rows move
    w = Window.partitionBy("h", "v").orderBy("vec_id")
    least = hashed(base).withColumn("k", F.row_number().over(w)).where(F.col("k") <= k + 1)
    index = written(least.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("entry", F.monotonically_increasing_id()), "index")
    asked = written(hashed(asked).withColumn("q", F.monotonically_increasing_id()), "asked")
    n, most = index.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = raised(np.array([r.v for r in least_hashed(index.select("v", "h"), "h", n, sample, ["v"])]), most)
    forest = Forest(fitted, trees, -(-len(fitted) // leaf))
    enough = share_for(forest, fitted, k, PROBES, recall) * n * trees
    held = spark.sparkContext.broadcast(forest)
    routed = written(index.select("entry", "v").mapInArrow(_routed(held, most), "tree long, leaf long, entry long, v array<double>"), "routed")
    counts = [np.zeros(t["leaves"], np.int64) for t in forest.trees]
    for r in routed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():  # trees * leaves rows
        counts[r.tree][r.leaf] = r.n
    groups = [groups_of(c, block) for c in counts]
    deal = spark.createDataFrame([(t, i, int(g), int(blocks[g])) for t, (group, blocks) in enumerate(groups) for i, g in enumerate(group)], "tree long, leaf long, group long, blocks long")
    entries = routed.join(F.broadcast(deal), ["tree", "leaf"]).select("tree", "group", F.pmod(F.xxhash64("entry"), F.col("blocks")).alias("block"), F.array("leaf").alias("leaves"), "entry", "v", F.lit(0).alias("side"))
    visits = asked.select(F.col("q").alias("entry"), "v").mapInArrow(_asked(held, counts, enough, k + 1, groups), "tree long, group long, block long, leaves array<long>, entry long, v array<double>")
    both = entries.unionByName(visits.withColumn("side", F.lit(1)))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(width, "tree", "group", "block").sortWithinPartitions("tree", "group", "block", "side")
    found = dealt.mapInArrow(_scored(k + 1), _RESULT).groupBy("q", "entry").agg(F.max("score").alias("score"))
    rows = found.join(index.select("entry", "ids", F.col("h").alias("own")), "entry").join(asked.select("q", F.col("vec_id").alias("query_id"), "h"), "q")
    rows = rows.select("q", "query_id", F.explode("ids").alias("vec_id"), "score", (F.col("own") == F.col("h")).alias("same")).where("not (same and vec_id = query_id)")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "embeddings")
    return nearest(t, t.where("vec_id % 20 = 0"))
