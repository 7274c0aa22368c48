"""Where Python workers find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def share_package(spark: SparkSession) -> None:
    """Let workers import the package from where the driver did, if they share its file system (else use --py-files)."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
