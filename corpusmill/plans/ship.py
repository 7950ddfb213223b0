"""Give Python workers this package where their path doesn't hold it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's files, once for each application."""
    context = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    path = Path(tempfile.mkdtemp(prefix="corpusmill-")) / "corpusmill.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted([*ROOT.glob("corpusmill/**/*.py"), *ROOT.glob("corpus_pipeline.py")]):
            z.write(p, p.relative_to(ROOT))
    context.addPyFile(str(path))
