"""Cleaning as files arrive: a file stream, and each batch without what was seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions.urls import article_id
from siltmill.plans.pipelines import clean_corpus
from siltmill.sources.io import parse_records, site_of


def clean_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, config: DataFrame, **options):
    """Start a query that cleans new files of ``source`` and appends articles to Parquet at ``sink``/clean, rejected lines to ``sink``/rejects.

    The first record of a site and id counts, over all batches, whether or not it
    passes the gate: its key goes to ``sink``/seen, and later records with it are
    left out before any page is read. Each batch has folders of its own that a
    run of it again overwrites, so nothing is there twice after a failure.
    """
    lines = spark.readStream.format("text").load(source).select(
        site_of(F.col("_metadata.file_path")).alias("site"), F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("at"), F.col("value").alias("line")
    )

    def batch(df: DataFrame, number: int) -> None:
        own = df.withColumn("place", F.struct("at.file", "at.block", F.monotonically_increasing_id().alias("n"))).drop("at")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/seen")
        seen = None
        if path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            seen = spark.read.parquet(f"{sink}/seen").where(F.col("batch") < number).select("site", "id")
        clean, rejects = clean_corpus(own, config, seen=seen, **options)
        keys = parse_records(own)[0].select("site", article_id(F.col("url")).alias("id")).distinct()
        for name, rows in (("clean", clean), ("rejects", rejects), ("seen", keys)):
            rows.write.mode("overwrite").parquet(f"{sink}/{name}/batch={number}")

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
