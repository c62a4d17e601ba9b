"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a new folder of this machine, which only a local master may use."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="plantflow-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found
