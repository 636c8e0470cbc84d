"""Readers for the raw tables of a marketplace export.

One glob per table unions the files of all cities. Cells that do not fit the schema become
null; ``rejected_records`` tells which records have such cells. Cells that are missing at the
end of a record are null, and what is over is left out, as always in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import schemas

REJECTED = "__rejected"

# Schema of each table, and whether its fields may hold line breaks.
TABLES = {
    "listings": (schemas.LISTINGS, True),
    "calendar": (schemas.CALENDAR, False),
    "reviews": (schemas.REVIEWS, True),
}


def _read_csv(spark: SparkSession, path: str, table: str, partitions: int | None) -> DataFrame:
    schema, multi_line = TABLES[table]
    df = spark.read.csv(
        path, schema=schema, header=True, sep=",", quote='"', escape='"', multiLine=multi_line
    )
    return df if partitions is None else df.repartition(partitions)


def read_listings(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Listings CSV; prose fields may hold line breaks.

    A gzip or multi-line file is read by one task. ``partitions`` spreads its rows
    afterwards; for repeated use, stage the table as Parquet instead.
    """
    return _read_csv(spark, path, "listings", partitions)


def read_calendar(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Calendar CSV, one line per listing and day."""
    return _read_csv(spark, path, "calendar", partitions)


def read_reviews(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Reviews CSV; comments may hold line breaks."""
    return _read_csv(spark, path, "reviews", partitions)


def rejected_records(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(table, file, record, columns) of the records of a table that the reader does not take whole.

    ``record`` is the text as it stands in the file. ``columns`` names the columns whose cells
    hold a text that does not fit their type, which the readers above give as null. Nothing is
    dropped: the readers return these records too.
    """
    schema, multi_line = TABLES[table]
    kinds = spark.createDataFrame([], schema).schema
    options = {"header": True, "sep": ",", "quote": '"', "escape": '"', "multiLine": multi_line}
    typed = spark.read.csv(path, schema=f"{schema}, {REJECTED} string", columnNameOfCorruptRecord=REJECTED, **options)
    # the cells of a rejected record once more, as texts; all typed columns are read beside them
    texts = ", ".join(f"`{f.name}` string" for f in kinds)
    cells = F.from_csv(REJECTED, texts, {k: str(options[k]) for k in ("sep", "quote", "escape")})
    rejected = typed.withColumn("__cells", F.when(F.col(REJECTED).isNotNull(), cells))
    misfits = [
        F.when(F.col(f"__cells.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for f in kinds
        if f.dataType.typeName() != "string"
    ]
    return rejected.filter(F.col(REJECTED).isNotNull()).select(
        F.lit(table).alias("table"),
        F.col("_metadata.file_path").alias("file"),
        F.col(REJECTED).alias("record"),
        F.array_compact(F.array(*misfits)).alias("columns"),
    )


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """(table, file, column, n_records) of ``rejected_records``."""
    columns = rejected.select("table", "file", F.explode("columns").alias("column"))
    return columns.groupBy("table", "file", "column").agg(F.count(F.lit(1)).alias("n_records"))
