"""The folder that driver and executors share."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="kilnstream-")
    return f"{base.rstrip('/')}/kilnstream-{uuid.uuid4().hex}"
