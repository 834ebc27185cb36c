"""Reading tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """CSV with header. The schema is given, so no extra pass infers it; several files are one scan."""
    return spark.read.schema(schema).csv(paths if isinstance(paths, str) else list(paths), header=True)


def read_table(
    spark: SparkSession, paths: str | Sequence[str], where: Column | str | None = None, merge_schema: bool = False
) -> DataFrame:
    """Parquet table, several tables, or the partitions that satisfy ``where`` (pruned at the scan)."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    df = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return df if where is None else df.where(where)


def read_with_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet rows with the file each came from and when that file was written (``_source_file``, ``_source_modified``).

    Both come from the scan's file metadata, per row, also where one task reads several files.
    """
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.col("_metadata.file_modification_time").alias("_source_modified"))


def read_snapshot(spark: SparkSession, path: str, date: str, column: str = "snapshot_date") -> DataFrame:
    """One snapshot of a table; an absent snapshot is an error."""
    df = spark.read.parquet(path).where(F.col(column) == F.lit(date).cast("date"))
    if df.isEmpty():
        raise ValueError(f"no rows for {column} = {date} in {path}")
    return df
