"""Takes this package to the executors' Python workers, so that they need no install of it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application once; Spark's own file server hands it to executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="opsignals-"), "opsignals.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
