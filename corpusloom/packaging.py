"""Makes this package importable on the executors of any session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent


def ship(spark: SparkSession, package: Path = PACKAGE) -> None:
    """Send a package's sources (this one's by default) to the executors, once per Spark context.

    Functions that Python workers run are pickled by reference, so each worker must be able to import
    the module. Spark copies the archive to the executors itself; no shared folder is involved.
    """
    sc = spark.sparkContext
    shipped = sc.__dict__.setdefault("_corpusloom_shipped", set())
    if package.name in shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="corpusloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    shipped.add(package.name)
