"""Near-duplicate removal by min-max hashing.

A document's set holds the hashes of its 5-word shingles. Under each of
``PERMS`` permutations both the least and the greatest value are kept: two
signature values for one evaluation, each equal in two sets with a chance of
their similarity. Bands mix minima and maxima of different permutations.

1. One pass over the texts: set size, a 128-bit key of the whole set, bands.
2. Documents with the same set are one node (grouped with map-side partials).
3. Each band value links its nodes to the least of them; the connected
   components of these links are clusters of candidates. No pairs are listed.
4. Clusters are compared on full shingle sets. A cluster over ``BLOCK`` nodes or
   ``BLOCK_SHINGLES`` shingles is dealt into blocks, each with the same few
   pivots, so that copies of one text find together at once.
5. Clusters that still are in several components are cut finer: similar sets
   share a token of their prefixes (the rarest tokens, one more than they may
   differ by), in any one order of tokens, so components over prefix tokens lose
   no link. The order is that of a count sketch of bounded size. Texts that only
   share common wording fall apart here, without being compared. What is outside
   the largest component of a finer cluster is compared with all of its blocks.
   So a task never holds more than two blocks, and every two nodes that end in
   different components have been compared or can't be similar.

Two sets at the threshold of 0.85 miss all 30 bands of 6 values with a chance
of 7e-7, more similar ones far less; a shared neighbour heals even that.

Defined cases: null, empty and wordless texts have size 0 and are linked with
nothing; fewer words than a shingle make one shingle of all of them; a null
doc_id takes part, and is nobody's smallest id unless all of its component are
null; kept is whether doc_id and component_id are the same (both may be null);
repeated rows are copies; an empty table gives an empty result; other columns
are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``, which
decides row by row: of each component the rows of one text stay, the text with
the smallest id (ids before nulls, then by a hash of the text), and of rows with
the same id and text one stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltmill.llm import words as W
from siltmill.llm.common import made, one_each, prepare, remove_since, removed, repeats, separate, table, written
from siltmill.llm.graph import components, in_groups

SHINGLE, BANDS, ROWS, BLOCK, BLOCK_SHINGLES, PIVOTS = 5, 30, 6, 256, 500_000, 8
PERMS = BANDS * ROWS // 2
#: Cells of the count sketch that orders tokens: 2 ** 18 counts, so 2 MB to the driver and in a broadcast, whatever the input.
SKETCH = 18
_SIG = "doc_id long, text_key long, n_shingles long, node binary, bands array<long>"


def shingle_sets(x: W.Words, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a run."""
    g = W.kgrams(x.hash, k)
    out = []
    for a, b in zip(x.first[:-1].tolist(), x.first[1:].tolist(), strict=True):
        if b - a >= k:
            s = np.sort(g[a : b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(W.kgrams(x.hash[a:b], b - a) if b > a else np.zeros(0, W.U))
    return out


def node_key(s: np.ndarray) -> bytes:
    """128 bits of a whole set."""
    both = np.array([s.sum(dtype=W.U), W.mix(s ^ W.U(0xA5A5A5A5A5A5A5A5)).sum(dtype=W.U)], W.U)
    return W.mix(both + W.U(len(s))).astype(">u8").tobytes()


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band values of non-empty sets: both ends of bands * rows / 2 permutations."""
    if not sets:
        return np.zeros((0, bands), W.U)
    perms = (bands * rows + 1) // 2
    factors = W.mix(np.arange(1, perms + 1, dtype=W.U)) | W.U(1)
    flat = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    ends = np.empty((2 * perms, len(sets)), W.U)
    y = np.empty_like(flat)
    for p in range(perms):
        np.multiply(flat, factors[p], out=y)
        np.minimum.reduceat(y, at, out=ends[p])
        np.maximum.reduceat(y, at, out=ends[perms + p])
    out = np.empty((len(sets), bands), W.U)
    for b in range(bands):
        v = np.full(len(sets), W.U(b + 1))
        for r in range(rows):
            v = W.mix(v * W.U(0x9E3779B97F4A7C15) + ends[b + r * bands])
        out[:, b] = v
    return out


def _sign(bands: int, rows: int, k: int):
    def sign(batches):
        for batch in batches:
            sizes, nodes, values = [], [], []
            for _, _, x in W.runs(batch.column("text"), "space"):
                sets = shingle_sets(x, k)
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full, bands, rows).view(np.int64))
                for s in sets:
                    sizes.append(len(s))
                    nodes.append(node_key(s) if len(s) else None)
                    values.append(next(sig) if len(s) else None)
            offsets = np.concatenate([[0], np.cumsum([bands if v is not None else 0 for v in values])]).astype(np.int32)
            flat = np.concatenate([v for v in values if v is not None]) if offsets[-1] else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            cols = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "n_shingles", "node", "bands"])

    return sign


class Comparer:
    """An inverted index of shingle sets, for intersections of one set with all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)[order]
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        self.values, self.at = flat[first], np.append(first, len(flat))

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Which sets are similar enough to s."""
        # sets of such sizes that no intersection could be enough need no look
        fits = (100 * np.minimum(len(s), self.sizes) >= percent * np.maximum(len(s), self.sizes))
        if not fits.any():
            return fits
        i = np.searchsorted(self.values, s)
        i = i[(i < len(self.values)) & (self.values[np.minimum(i, len(self.values) - 1)] == s)]
        _, x = W.expand(self.at[i], self.at[i + 1])
        both = np.bincount(self.owners[x], minlength=len(self.sizes))
        return fits & (both > 0) & (100 * both >= percent * (len(s) + self.sizes - both))


def joined(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first of its component: all links are followed, but sets that are reached already aren't compared again."""
    n = len(sets)
    label = np.full(n, -1)
    rest, index = np.arange(n), Comparer(sets)
    for start in range(n):
        if label[start] >= 0:
            continue
        label[start] = start
        todo = [start]
        while todo:
            p = todo.pop()
            if 2 * (label[rest] < 0).sum() < len(rest):
                rest = rest[label[rest] < 0]
                if len(rest):
                    index = Comparer([sets[i] for i in rest])
            if not len(rest):
                return label
            new = rest[index.linked(sets[p], percent) & (label[rest] < 0)]
            label[new] = start
            todo += new.tolist()
    return label


def _sets_of(t: pa.Table, column: str = "shingles") -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), W.U) for b in t.column(column)]


def _within(percent: int):
    """mapInArrow over rows dealt and sorted by (cluster, block): (node, first node of its component there, whether more blocks follow)."""

    def within(batches):
        for t in in_groups(batches, ["cluster", "block"]):
            nodes = t.column("node").to_pylist()
            label = joined(_sets_of(t), percent)
            large = pa.array([t.column("blocks")[0].as_py() > 1] * len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([nodes[k] for k in label], pa.binary()), large], names=["a", "b", "large"])

    return within


def _counted(batches):
    """Counts of tokens by cell of the sketch."""
    total = np.zeros(1 << SKETCH, np.int64)
    for batch in batches:
        for b in batch.column("shingles"):
            cells = np.frombuffer(b.as_buffer(), W.U) >> W.U(64 - SKETCH)
            total += np.bincount(cells.astype(np.int64), minlength=1 << SKETCH)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "n"])


def prefix(s: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest tokens of a set, by (count of the cell, token): two sets that are similar enough share one of them."""
    m = len(s) - (-(-percent * len(s) // 100)) + 1
    order = np.lexsort((s, counts[(s >> W.U(64 - SKETCH)).astype(np.int64)]))
    return s[order[:m]]


def _prefixes(held, percent: int):
    def prefixes(batches):
        counts = held.value
        for batch in batches:
            got = [prefix(np.frombuffer(b.as_buffer(), W.U), counts, percent) for b in batch.column("shingles")]
            at = np.repeat(np.arange(len(got)), [len(g) for g in got])
            flat = np.concatenate(got) if got else np.zeros(0, W.U)
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(at)), pa.array(flat.view(np.int64))], names=["node", "value"])

    return prefixes


def _across(percent: int):
    """mapInArrow over rows dealt by (cluster, block, other): links between components of stragglers and of a block."""

    def across(batches):
        for t in in_groups(batches, ["cluster", "block", "other"]):
            side = np.array(t.column("side").to_pylist())
            labels = np.array(t.column("component").to_pylist(), dtype=object)
            sets = _sets_of(t)
            here, there = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(here) or not len(there):
                continue
            index, links = Comparer([sets[i] for i in there]), set()
            for p in here:
                for c in set(labels[there[index.linked(sets[p], percent)]]):
                    if c != labels[p]:
                        links.add((labels[p], c))
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return across


def _shingled(k: int):
    def shingled(batches):
        for batch in batches:
            keep, nodes, out, want = [], [], [], batch.column("node").to_pylist()
            for i, _, x in W.runs(batch.column("text"), "space"):
                for r, s in enumerate(shingle_sets(x, k)):
                    if len(s) and node_key(s) == want[i + r]:
                        keep.append(i + r)
                        nodes.append(want[i + r])
                        out.append(s.tobytes())
            n = batch.column("cluster").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([n, pa.array(nodes, pa.binary()), pa.array(out, pa.binary())], names=["cluster", "node", "shingles"])

    return shingled


def _clusters(values: DataFrame) -> DataFrame:
    """(node, cluster) of the nodes of (node, value) that share a value with another one: components over links to each value's least node."""
    least = values.groupBy("value").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = written(values.join(separate(least), "value").where("a != node").select("a", F.col("node").alias("b")).distinct(), "stars")
    out = written(components(stars).withColumnRenamed("component", "cluster"), "clusters")
    removed(stars)
    return out


def _dealt(sets: DataFrame, block: int, shingles: int) -> DataFrame:
    """Sets (node, cluster, shingles) with the number of their cluster's blocks, and their own block."""
    sizes = sets.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles") / 8).alias("m"))
    sizes = sizes.select("cluster", F.ceil(F.greatest(F.col("n") / block, F.col("m") / shingles)).cast("long").alias("blocks"))
    return sets.join(separate(sizes), "cluster").select(*sets.columns, "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))


def _finer(loose: DataFrame, percent: int) -> DataFrame:
    """Nodes of (node, shingles) with the finer cluster of those that share a prefix token; a set that shares none is left out."""
    spark = loose.sparkSession
    cells = loose.select("shingles").mapInArrow(_counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most 2 ** SKETCH rows
    counts = np.zeros(1 << SKETCH, np.int64)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    held = spark.sparkContext.broadcast(counts)
    return _clusters(loose.select("node", "shingles").mapInArrow(_prefixes(held, percent), "node binary, value long"))


def _several(rows: DataFrame) -> DataFrame:
    """Of (cluster, component, shingles): clusters with more than one component, their largest one, and the size of what is outside."""
    count = rows.groupBy("cluster", "component").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles") / 8).alias("m"))
    most = count.groupBy("cluster").agg(F.max(F.struct("n", "m", "component")).alias("most"), F.sum("n").alias("n"), F.sum("m").alias("m")).where("n > most.n")
    return most.select("cluster", F.col("most.component").alias("most"), (F.col("n") - F.col("most.n")).alias("out_n"), (F.col("m") - F.col("most.m")).alias("out_m"))


def _labels(docs: DataFrame, nodes: DataFrame, percent: int, k: int, block: int, shingles: int) -> DataFrame:
    """(node, component) of the nodes that are in a cluster of candidates."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cluster = _clusters(nodes.select("node", F.explode("bands").alias("value")))
    # full sets of the clusters' nodes, each from one of its documents
    chosen = nodes.join(cluster, "node").select(F.col("pick.id").alias("__id"), F.col("pick.key").alias("__key"), "node", "cluster")
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    texts = docs.join(chosen, (key == F.col("__id")) & (F.col("text_key") == F.col("__key"))).select("node", "cluster", "text")
    sets = texts.mapInArrow(_shingled(k), "cluster binary, node binary, shingles binary")
    sets = written(sets.dropDuplicates(["node"]) if repeats(docs) else sets, "sets")
    dealt = written(_dealt(sets, block, shingles), "dealt")
    removed(sets)
    # a large cluster's pivots: some of its nodes, least hashes first, found block by block and so of bounded number
    large = dealt.where("blocks > 1")
    first = large.groupBy("cluster", "block").agg(F.min(F.struct(F.xxhash64("node", F.lit(1)).alias("h"), "node")).alias("f")).select("cluster", "block", "f.*")
    pivots = first.withColumn("k", F.row_number().over(Window.partitionBy("cluster").orderBy("h", "node"))).where(F.col("k") <= PIVOTS)
    pivots = large.join(separate(pivots.select("node")), "node")
    spread = pivots.withColumn("into", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("into != block").drop("block").withColumnRenamed("into", "block")
    groups = dealt.unionByName(spread).select("cluster", "block", "node", "shingles", "blocks")
    inside = written(groups.repartition(width, "cluster", "block").sortWithinPartitions("cluster", "block", "node").mapInArrow(_within(percent), "a binary, b binary, large boolean"), "within")
    done = inside.where("not large").select(F.col("a").alias("node"), F.col("b").alias("component"))
    if not large.take(1):
        return done
    label = written(components(inside.where("large").select("a", "b")), "label")
    apart = written(large.select("cluster", "node", "shingles").join(label, "node"), "apart")
    loose = apart.join(separate(_several(apart).select("cluster")), "cluster").select("node", "shingles", "component")
    loose = written(loose, "loose")
    if loose.take(1):
        label = _rejoined(loose, label, percent, block, shingles, width)
    return done.unionByName(label)


def _rejoined(loose: DataFrame, label: DataFrame, percent: int, block: int, shingles: int, width: int) -> DataFrame:
    """The labels (node, component), with components joined that have links between the loose sets (node, shingles, component)."""
    sets = loose.join(_finer(loose, percent), "node")
    dealt = written(_dealt(sets, block, shingles), "finer")
    blocks = F.ceil(F.greatest(F.col("out_n") / block, F.col("out_m") / shingles)).cast("long")
    split = written(dealt.join(separate(_several(dealt).select("cluster", "most", blocks.alias("s_blocks"))), "cluster"), "split")
    if not split.take(1):
        return label
    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("s_blocks"))
    left = split.where("component != most").select("cluster", numbers("blocks").alias("block"), own.alias("other"), F.lit(0).alias("side"), "component", "node", "shingles")
    right = split.select("cluster", "block", numbers("s_blocks").alias("other"), F.lit(1).alias("side"), "component", "node", "shingles")
    grid = left.unionByName(right).repartition(width, "cluster", "block", "other").sortWithinPartitions("cluster", "block", "other").select("cluster", "block", "other", "side", "component", "shingles")
    links = written(grid.mapInArrow(_across(percent), "a binary, b binary").distinct(), "across")
    if not links.take(1):
        return label
    over = components(links).select(F.col("node").alias("component"), F.col("component").alias("joined"))
    return label.join(separate(over), "component", "left").select("node", F.coalesce("joined", "component").alias("component"))


def _found(docs: DataFrame, percent: int, shingle: int, bands: int, rows: int, block: int, shingles: int) -> DataFrame:
    """One row per document row: doc_id, text_key, n_shingles, component_id, and whether its text is the one that stays of its component."""
    spark, mark = prepare(docs), made()
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sig = written(docs.mapInArrow(_sign(bands, rows, shingle), _SIG), "signatures")
    pick = F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), F.col("text_key").alias("key")))
    nodes = sig.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), pick.alias("pick"), F.first("bands").alias("bands"))
    nodes = written(nodes, "nodes")
    label = written(_labels(docs, nodes, percent, shingle, block, shingles), "label")
    remove_since(spark, mark, sig, nodes, label)
    whole = label.join(nodes.select("node", "least"), "node")
    # the least id, and the text that stays: null ids come last
    first = whole.groupBy("component").agg(F.min("least").alias("smallest"), F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("stays"))
    grouped = whole.join(separate(first), "component").select("node", F.col("smallest").alias("__least"), (F.col("stays.node") == F.col("node")).alias("__stays"))
    ids = nodes.select("node", "least").join(separate(grouped), "node", "left").select("node", F.coalesce("__least", "least").alias("c"), F.coalesce("__stays", F.lit(True)).alias("stays"))
    out = sig.select("doc_id", "text_key", "n_shingles", "node").join(separate(ids), "node", "left")
    c = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("c"))
    return out.select("doc_id", "text_key", "n_shingles", c.alias("component_id"), F.coalesce("stays", F.lit(True)).alias("stays"))


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept. Sets are linked with 100 * both >= percent * either."""
    out = _found(docs, percent, shingle, bands, rows, block, shingles)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE, bands: int = 46, rows: int = ROWS, block: int = BLOCK, shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The documents without near copies: of each component the text with the smallest id stays, once. With 46 bands a lone pair at 0.8 is missed as rarely as one at 0.85 with 30."""
    mark = made()
    found = _found(docs, percent, shingle, bands, rows, block, shingles)
    # a row goes if its text isn't its component's, or if the same text is there with a smaller id
    same_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = written(found.where(~F.col("stays") | ~same_id).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "gone")
    remove_since(docs.sparkSession, mark, gone)
    left = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_anti")
    return one_each(left) if repeats(docs) else left


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
