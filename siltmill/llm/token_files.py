"""Token ids in files, by frequency-ranked byte-aligned variable-length coding.

An id is replaced by its rank among all ids of the corpus, the most frequent
first. A rank takes 1 to 4 bytes, lowest first; its number of bytes, less one,
is two bits in a separate control byte that four ranks share. A document's
control bytes are followed by padding bits only, so documents can be told apart
and moved. Decoding looks every control byte up in a table of 256 entries for
its four lengths and gathers the data bytes with numpy.

A file set is a folder with ``ranks`` (rank, id) and ``blocks``: rows of one
shard and block with the doc_ids, their numbers of tokens, the control bytes and
the data bytes of some documents, in ascending doc_id over shards and blocks.
Spark's writers commit the blocks, so a task that is lost and run again leaves
no half file, and any store that Spark writes to will do.

Shards are ranges of (doc_id, checksum of the ids, row) that Spark's range
exchange cuts from a bounded sample of keys, about ``SHARD_BYTES`` of text each,
so rows of one doc_id, or equal rows, are cut too, however many they are. A task
sorts its range, with spills, and streams it into blocks. Only ids move between
executors; texts don't. Defined cases: a null text is empty and has its end id
alone; a null doc_id comes first; repeated doc_ids are in order of their ids'
checksums, and repeated rows are written once each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltmill.llm.common import delete, prepare, shared_dir, table
from siltmill.llm.tokens import ByteLevel, encoder, vocabulary

END, SHARD_BYTES, BLOCK_TOKENS = 2, 48 << 20, 1 << 20
#: Lengths of the four numbers of each control byte.
_LENGTHS = np.array([[1 + (b >> (2 * k) & 3) for k in range(4)] for b in range(256)], np.int64)
_BLOCKS = "shard long, block int, doc_ids array<long>, n_tokens array<long>, control binary, data binary"


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of numbers below 2**32."""
    r = ranks.astype(np.uint32)
    size = 1 + (r >= 1 << 8).astype(np.int64) + (r >= 1 << 16) + (r >= 1 << 24)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[: len(r)] = size - 1
    q = codes.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    every = r.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), every[np.arange(4) < size[:, None]].tobytes()


def decode(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The numbers of documents with ``counts`` numbers each, whose control bytes and data bytes stand one behind another."""
    groups = -(-counts // 4)
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    if (counts % 4).any():
        first = np.concatenate([[0], np.cumsum(groups)])[:-1] * 4
        real = np.arange(len(sizes)) - np.repeat(first, groups * 4) < np.repeat(counts, groups * 4)
        sizes = sizes[real]
    at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(sizes > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenise(path: str, end: int):
    def tokenise(batches):
        enc = encoder(ByteLevel, path)
        kind = "<u2" if max(enc.size - 1, end) < 1 << 16 else "<u4"
        for batch in batches:
            for i, found in enc(batch.column("text")):
                out, crc = [], []
                for own in found:
                    a = np.append(own, np.uint32(end)).astype("<u4")
                    crc.append(zlib.crc32(a.tobytes()))
                    out.append(a.astype(kind).tobytes())
                cols = [batch.column("doc_id").slice(i, len(out)), pa.array(crc, pa.int64()), pa.array(out, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "crc", "ids"])

    return tokenise


def _counted(kind: str):
    def counted(batches):
        total = np.zeros(1, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind)
            n = np.bincount(ids, minlength=len(total))
            n[: len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return counted


def _blocked(kind: str, held):
    """Documents in order -> coded blocks of about ``BLOCK_TOKENS`` tokens. The task's range is the shard."""

    def block_of(shard: int, number: int, rows: list[tuple]) -> pa.RecordBatch:
        ids, n, control, data = zip(*rows, strict=True)
        cols = [pa.array([shard], pa.int64()), pa.array([number], pa.int32()), pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(n)], pa.list_(pa.int64())), pa.array([b"".join(control)], pa.binary()), pa.array([b"".join(data)], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["shard", "block", "doc_ids", "n_tokens", "control", "data"])

    def blocked(batches):
        rank, shard = held.value, TaskContext.get().partitionId()
        rows, tokens, number = [], 0, 0
        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(raw.as_buffer(), kind)
                rows.append((doc, len(ids), *encode(rank[ids])))
                tokens += len(ids)
                if tokens >= BLOCK_TOKENS:
                    yield block_of(shard, number, rows)
                    rows, tokens, number = [], 0, number + 1
        if rows:
            yield block_of(shard, number, rows)

    return blocked


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the token ids of all documents to ``folder`` in the format above."""
    spark = prepare(docs)
    path = path or vocabulary("byte_bpe_50k.json")
    kind = "<u2" if max(encoder(ByteLevel, path).size - 1, end) < 1 << 16 else "<u4"
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(int(size // shard_bytes) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select("doc_id", "text").mapInArrow(_tokenise(path, end), "doc_id long, crc long, ids binary")
    raw = f"{folder}/ids"
    ids.write.option("compression", "zstd").parquet(raw)
    ids = spark.read.parquet(raw)
    # no more rows than the vocabulary has ids
    counts = ids.select("ids").mapInArrow(_counted(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    order = sorted(counts, key=lambda r: (-r.n, r.id))
    rank = np.zeros(max((r.id for r in order), default=0) + 1, np.uint32)
    rank[[r.id for r in order]] = np.arange(len(order))
    spark.createDataFrame([(k, r.id) for k, r in enumerate(order)], "rank long, id long").coalesce(1).write.parquet(f"{folder}/ranks")
    held = spark.sparkContext.broadcast(rank)
    order = [F.col("doc_id").asc_nulls_first(), F.col("crc"), F.col("row")]
    dealt = ids.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    dealt.mapInArrow(_blocked(kind, held), _BLOCKS).write.option("compression", "zstd").parquet(f"{folder}/blocks")
    delete(spark, raw)


def _decoded(held):
    def decoded(batches):
        ids = held.value
        for batch in batches:
            rows = []
            for start, docs, counts, control, data in zip(*(batch.column(k).to_pylist() for k in ("start", "doc_ids", "n_tokens", "control", "data")), strict=True):
                raw = ids[decode(control, data, np.array(counts, np.int64))].astype("<u4").tobytes()
                at = 0
                for d, n in zip(docs, counts, strict=True):
                    rows.append((d, start + at, n, zlib.crc32(raw[4 * at : 4 * (at + n)])))
                    at += n
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return decoded


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # no more than the vocabulary
    ids = np.zeros(len(ranks) + 1, np.uint32)
    for r in ranks:
        ids[r.rank] = r.id
    held = spark.sparkContext.broadcast(ids)
    blocks = spark.read.parquet(f"{folder}/blocks")
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = blocks.select("shard", "block", size.alias("n"))
    # starts of shards in two levels, so that the only window over all rows has one for each thousand shards
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n")).withColumn("group", F.floor(F.col("shard") / 1000))
    groups = shards.groupBy("group").agg(F.sum("n").alias("n")).withColumn("first", F.sum("n").over(Window.orderBy("group")) - F.col("n")).drop("n")
    own = shards.withColumn("own", F.sum("n").over(Window.partitionBy("group").orderBy("shard")) - F.col("n"))
    shards = own.join(groups, "group").select("shard", (F.col("first") + F.col("own")).alias("before"))
    inner = sizes.withColumn("inner", F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).drop("n")
    starts = inner.join(shards, "shard").select("shard", "block", (F.col("before") + F.col("inner")).alias("start"))
    placed = blocks.join(F.broadcast(starts) if _few(starts) else starts, ["shard", "block"])
    return placed.select("start", "doc_ids", "n_tokens", "control", "data").mapInArrow(_decoded(held), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _few(starts: DataFrame, most: int = 200_000) -> bool:
    """Whether a row for each block is small enough to broadcast."""
    return starts.limit(most + 1).count() <= most


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), folder)
    return read_ids(spark, folder)


