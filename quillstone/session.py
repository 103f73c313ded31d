"""Makes this package importable on the executors of any session."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()

#: Bytes of a batch between the JVM and a Python worker, where the session names
#: none: with rows of whole texts Spark's 64 MB weigh several times on an executor.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's modules to the executors, once per application.

    The driver serves one small archive; executors that join later, or replace
    lost ones, fetch it as well."""
    if not spark.conf._jconf.contains(BATCH[0]):
        spark.conf.set(*BATCH)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        home = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="quillstone-"), "quillstone_modules.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(home.rglob("*.py")):
                z.write(p, p.relative_to(home.parent))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark
