"""Report sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(
    df: DataFrame, uri: str, format: str = "csv", mode: str = "overwrite", single_file: bool = False
) -> None:
    """Write a report to any file system Spark reaches (a path, ``s3a://``, ``hdfs://``).

    ``single_file`` is for reports of bounded size: only the finished rows move to one
    task, the computation before keeps its parallelism. Failures propagate.
    """
    writer = (df.repartition(1) if single_file else df).write.mode(mode)
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(uri)
