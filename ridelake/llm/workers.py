"""Make this package importable in Spark's Python workers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ridelake.session import staging_path

_ROOT = str(Path(__file__).resolve().parents[2])


def share_code(spark: SparkSession) -> None:
    """Put the package's folder on the workers' path.

    It must be at that place on every executor; otherwise install the package there or ship it with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``session.materialize`` with closer packing, for frames that carry whole texts.

    A staged frame stays until the application releases its staging: what a stage returns may be read at any time.
    """
    path = staging_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
