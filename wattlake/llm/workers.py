"""What the Python workers of a session need."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

import wattlake


def reachable(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it.

    Needed where the package isn't installed and lies on a path that all machines see.
    """
    root = str(Path(wattlake.__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        paths = [x for x in (known, root) if x]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)
