"""Shared scratch storage and lineage cuts.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``, which the driver and all executors share. Only where
that setting is absent on a local master (unit tests) a local folder is made.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder, as a URI without trailing slash."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage: later stages restart from files that outlive any executor.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
