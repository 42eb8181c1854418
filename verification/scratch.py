"""A folder that all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or below the warehouse where that is unset, as in tests.

    Both are shared by all executors. Results of queries are read from these folders later, so they stay; whoever set the
    checkpoint folder can empty it once results are written.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/funnelwright-{uuid.uuid4().hex}"
