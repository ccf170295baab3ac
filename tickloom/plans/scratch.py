"""A folder for what a query writes: in the shared folder of the cluster, or a temporary one on local masters."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return f"{at.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    atexit.register(shutil.rmtree, folder, True)
    return f"{folder}/scratch"
