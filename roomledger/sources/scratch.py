"""Where queries keep files that they write and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    ``spark.checkpoint.dir`` of the session, or else the checkpoint folder of its context. Where
    neither is set, the warehouse, if it is on a file system that machines share or if there is
    one machine only (master ``local``); an error otherwise, since every machine would write
    into a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    scheme, mark, _ = warehouse.partition(":/")
    if (mark and scheme != "file") or spark.conf.get("spark.master", "local").split("[")[0] == "local":
        return warehouse
    raise ValueError("set spark.checkpoint.dir to a folder that all machines share")


def _context_folder(spark: SparkSession) -> str | None:
    context = getattr(spark, "sparkContext", None)
    found = context._jsc.sc().getCheckpointDir() if context is not None else None
    return found.get() if found is not None and found.isDefined() else None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_folder(spark)}/roomledger-{uuid.uuid4().hex}-{label}"


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder on any file system that Spark reaches; none is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
