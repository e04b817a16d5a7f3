"""Give Python workers the packages their functions are in."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import lakeops

PACKAGES = (Path(lakeops.__file__).parent, Path(__file__).parent)
_shipped: set[str] = set()


def package_zip(folder: str) -> str:
    """Both packages' modules in one archive."""
    path = f"{folder}/lakeops_llm.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for package in PACKAGES:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
    return path


def ship(spark: SparkSession) -> None:
    """Add the packages to the application's Python files, once.

    Workers start elsewhere than the driver and need not find them by themselves.
    Installed from an archive (``--py-files``) they are there already.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped or not all(p.is_dir() for p in PACKAGES):
        return
    spark.sparkContext.addPyFile(package_zip(tempfile.mkdtemp(prefix="lakeops-")))
    _shipped.add(application)
