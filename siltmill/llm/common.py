"""What the operators of this subpackage share: reading tables and cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from siltmill import ship

#: A filter has 16 to 32 bits for each of its keys, but no more than 2 ** MOST_BITS (16 MB).
MOST_BITS = 27
_OWN: list[str] = []
_MADE: list[str] = []
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from spark.checkpoint.dir. Where that is unset, a temporary folder if the session is
    local, with driver and executors in one process; else an error, as executors can't see each other's disks."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="siltmill-shared-"))
        atexit.register(shutil.rmtree, _OWN[0].removeprefix("file://"), True)
    return _OWN[0]


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run within go as each ends, not when the driver happens to collect its garbage."""
    old = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, old)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later steps survive lost executors and don't compute it anew.

    The shuffle files of the write go when it is done, so that those of many steps don't add up on the disks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.parquet(path)
    _MADE.append(path)
    out = spark.read.parquet(path)
    out._siltmill_path = path
    return out


def made() -> int:
    """How many tables have been written; see ``remove_since``."""
    return len(_MADE)


def remove_since(spark: SparkSession, mark: int, *kept: DataFrame) -> None:
    """Delete the tables written since ``made()`` gave ``mark``, but those that are still read."""
    stay = {getattr(t, "_siltmill_path", None) for t in kept}
    for path in _MADE[mark:]:
        if path not in stay:
            delete(spark, path)
    _MADE[mark:] = [p for p in _MADE[mark:] if p in stay]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it is, through Spark's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def removed(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_siltmill_path", None):
            delete(t.sparkSession, path)


def prepare(df: DataFrame) -> SparkSession:
    """The session of a table, with the package on the executors and Arrow's batches bounded."""
    ship.prepare(df.sparkSession)
    return df.sparkSession


def parts_for(spark: SparkSession, n_bytes: float, each: float = 32e6) -> int:
    """Shuffle partitions for so many bytes: the session's number or more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_bytes / each) + 1)


def repeats(docs: DataFrame) -> bool:
    """Whether ids repeat or are null, so that a doc_id alone doesn't tell rows apart. Reads the id column only."""
    n = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("m"), F.countDistinct("doc_id").alias("d")).first()
    return not n["n"] == n["m"] == n["d"]


def one_each(docs: DataFrame) -> DataFrame:
    """One row of each doc_id and text: the first by its other columns as JSON, so that it is the same one in every run."""
    rest = F.to_json(F.struct(F.lit(1).alias("_"), *(F.col(c) for c in docs.columns if c not in ("doc_id", "text"))))
    w = Window.partitionBy("doc_id", "text").orderBy(rest)
    return docs.withColumn("__row", F.row_number().over(w)).where(F.col("__row") == 1).drop("__row")


def once(docs: DataFrame) -> tuple[DataFrame, bool]:
    """The documents with one row of each doc_id and text, and whether a doc_id may still repeat. Nothing moves if ids are unique."""
    if not repeats(docs):
        return docs, False
    return one_each(docs), True


def with_texts(batch: pa.RecordBatch, texts: list[str | None], changed: list[bool]) -> pa.RecordBatch:
    """The batch with other texts; n_chars, where there is one, follows a changed text."""
    k = batch.schema.get_field_index("text")
    batch = batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))
    if (k := batch.schema.get_field_index("n_chars")) >= 0:
        n = [len(t or "") if c else old for t, c, old in zip(texts, changed, batch.column(k).to_pylist(), strict=True)]
        batch = batch.set_column(k, batch.schema.field(k), pa.array(n, batch.schema.field(k).type))
    return batch


def least_hashed(df: DataFrame, h: str, n: int, sample: int, ties: list[str]) -> list[Row]:
    """The ``sample`` rows with the least 64-bit hashes in column ``h``, of about ``n`` rows.

    Rows are cut at a hash that about twice as many stay below, so that tasks
    send the driver that many together and not that many each; the cut is moved
    up in the rare case that too few do.
    """
    share = 2 * sample / max(n, 1)
    while True:
        part = df if share >= 1 else df.where(F.col(h) < int(-(2**63) + share * 2**64))
        got = part.orderBy(h, *ties).limit(sample).collect()
        if share >= 1 or len(got) >= sample:
            return got
        share *= 4


def separate(df: DataFrame) -> DataFrame:
    """A small aggregate as a join's side with an exchange of its own.

    Joined as it is, an aggregate by the join's key keeps its partitioning, and
    adaptive execution can't split the other side's hot keys. Behind a rebalance
    both sides are exchanged for the join, so it can, or broadcast a small side.
    """
    return df.hint("rebalance")


def columns(df: DataFrame) -> list[np.ndarray]:
    """The columns of a bounded table, by Arrow: rows as Python objects would fill the driver."""
    return [c.to_numpy() for c in df.toArrow().columns]


@dataclass
class Bits:
    """A Bloom filter of 64-bit hashes: three probes, by rotations of a key. Says yes to all its keys and to few others while it isn't full."""

    words: np.ndarray
    size: int

    @staticmethod
    def of(df: DataFrame) -> Bits:
        """The filter of the column k. Tasks send only words of it."""
        size = min(MOST_BITS, max(10, (16 * df.count()).bit_length()))
        turned = [f"(shiftleft(k, {r}) | shiftrightunsigned(k, {64 - r}))" if r else "k" for r in _TURNS]
        places = df.select(F.explode(F.array(*(F.expr(f"shiftrightunsigned({k}, {64 - size})") for k in turned))).alias("p"))
        rows = places.groupBy(F.expr("shiftrightunsigned(p, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b"))
        at, bits = columns(rows)
        words = np.zeros(1 << (size - 6), np.uint64)
        words[at] = bits.view(np.uint64)
        return Bits(words, size)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        left = np.arange(len(h))
        for r in _TURNS:
            k = h[left]
            if r:
                k = k << np.uint64(r) | k >> np.uint64(64 - r)
            k = k >> np.uint64(64 - self.size)
            left = left[(self.words[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63)) & np.uint64(1)).astype(bool)]
        out[left] = True
        return out


_TURNS = (0, 21, 42)
