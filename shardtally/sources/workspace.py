"""Intermediate tables: written once to the folder that all executors share, then read back.

The folder is the one named in ``spark.checkpoint.dir``. A cluster must name one; a local
master gets a temporary folder when none is named. What an application writes is deleted when
its driver ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_folders: dict[str, str] = {}


def _delete(spark: SparkSession, path: str) -> None:
    """At the end of the driver; a session stopped earlier took nothing else with it."""
    if spark.sparkContext._jsc is None:
        return
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError(f"name a folder that all executors share in {SETTING}")
            base = tempfile.mkdtemp(prefix="shardtally-")
        _folders[app] = f"{base.rstrip('/')}/shardtally-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, _folders[app])
    return _folders[app]


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cut lineage that survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:8]}"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
