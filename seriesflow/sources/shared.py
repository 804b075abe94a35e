"""A folder that all executors share, for tables that are written and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rows a written dimension is broadcast.
BROADCAST_ROWS = 100_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir; where that is unset and Spark is one local process, in a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not context.master.split("[")[0] == "local":
                raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
            path = tempfile.mkdtemp(prefix="seriesflow-")
        context.setCheckpointDir(path)
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: what uses it more than once reads it, and doesn't make it anew."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side(table: DataFrame) -> DataFrame:
    """A written table as the smaller side of a join: broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table
