"""Make this package importable in the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Lets the grouped functions run wherever the package was only imported on
    the driver; harmless where it is installed on all machines.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="roost-ship-")) / "roost_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
