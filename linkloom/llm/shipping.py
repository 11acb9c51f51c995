"""Make this library importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package as a zip to the session once. Executors fetch it from
    the driver, so a cluster needs no installation of it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="linkloom-zip-"), "linkloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
