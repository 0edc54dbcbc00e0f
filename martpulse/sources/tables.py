"""Batch table scans (parquet). Column lists are passed down so the scan reads only what is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHARED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Scan one shared table; ``columns`` prunes the parquet ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """The same table as a file stream (a glob path, since the source wants a directory or pattern)."""
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = table_path(sf_dir, name)
    return reader.parquet(path[:-1] + "[" + path[-1] + "]")

