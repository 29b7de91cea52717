"""Makes the package importable where tasks run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def importable(spark: SparkSession) -> SparkSession:
    """Send the package's source to the application's Python workers, once."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        # the driver serves the archive as long as it lives, from where it lies
        made = tempfile.mkdtemp(prefix="txquality-source-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        copy = shutil.copytree(package, Path(made) / "source" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(Path(made) / package.name), "zip", copy.parent, package.name))
        _SHIPPED.add(context.applicationId)
    return spark
