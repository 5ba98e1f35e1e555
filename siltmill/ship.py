"""Makes this package importable on the executors, and bounds what their Python workers hold.

Functions handed to mapInArrow and the like are pickled by reference, so
every Python worker has to import the package. On a cluster the driver's
copy is added to the job once as a zip file, which Spark itself serves.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()
#: Spark's default for the bytes of an Arrow batch.
_SIZES = ("67108864b", "67108864", "64m", "64MB")


def ship(spark: SparkSession) -> None:
    """Send the package's source files to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="siltmill-"), "siltmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("siltmill", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """Make the package known to the executors, and bound Arrow's batches of texts where their limits are still Spark's defaults.

    A batch has at most 2,000 rows and about 8 MB, so that neither a task's buffers nor its Python worker grow with the
    lengths of texts. A session that sets its own limits keeps them.
    """
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    ship(spark)
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, "2000")
    if spark.conf.get(size) in _SIZES:
        spark.conf.set(size, "8m")
