"""The package on the executors' Python path."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

# Rows that go to Python at once; texts may be long, and both sides hold a batch.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: SparkContext | None = None


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package's modules to the executors once, as ``--py-files`` would, and bounds the
    batches that go to Python."""
    global _shipped
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    if _shipped is not spark.sparkContext:
        path = os.path.join(tempfile.mkdtemp(prefix="run-"), "loomfeed.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for top, _, names in os.walk(PACKAGE):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(top, name)
                        archive.write(file, os.path.relpath(file, os.path.dirname(PACKAGE)))
        spark.sparkContext.addPyFile(path)
        _shipped = spark.sparkContext
    return spark
