"""Making the package importable in Python workers wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="machiya-"), "machiya.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, Path("machiya") / path.relative_to(root))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
