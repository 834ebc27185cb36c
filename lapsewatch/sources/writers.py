"""Writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.snapshots import new_snapshots


def shared_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables under the cluster's ``spark.checkpoint.dir``.

    Where that is not set it lies in the warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a table's first partition column by its folders, in order; no rows are read."""
    if not path_exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_table(
    df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite", files: int | None = None, gather: bool = True
) -> None:
    """Parquet table.

    Modes: ``overwrite``, ``append``, ``overwrite_partitions`` (only the partitions present in ``df``).
    With ``by``, rows of a partition value are gathered before the write by a rebalance, which splits
    large partitions and merges small ones, so a hot partition does not become one huge task. ``files``
    bounds the file count by a shuffle, which leaves the work before it as parallel as it was. Rows that all
    have one partition value need no gathering; without ``gather`` the tasks that made them write them.
    """
    if by and gather:
        df = df.hint("rebalance", *by)
    elif files is not None and not by:
        df = df.repartition(files)
    writer = df.write.option("compression", "snappy")
    if mode == "overwrite_partitions":
        if not by:
            raise ValueError("overwrite_partitions needs partition columns")
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, by: Sequence[str] = (), files: int | None = None, mode: str = "overwrite") -> None:
    """CSV with header, partitioned or in a bounded number of files."""
    if files is not None and not by:
        df = df.repartition(files)
    writer = df.write.mode(mode).option("header", True)
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Report table as one JSON-lines or CSV file, written by one task: for tables of a few thousand rows at most."""
    one = report.repartition(1).write.mode("overwrite")
    if fmt == "json":
        one.json(path)
    elif fmt == "csv":
        one.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")


def write_if_absent(df: DataFrame, path: str, date: str = "snapshot_date") -> None:
    """Append only the snapshots the table does not hold yet; a rerun adds nothing."""
    spark = df.sparkSession
    if path_exists(spark, path):
        df = new_snapshots(df, spark.read.parquet(path), date)
    write_table(df, path, [date], "append")


def write_predictions(preds: DataFrame, path: str) -> None:
    """Scores by model and snapshot date; rerunning a scoring replaces its own partition."""
    write_table(preds, path, ["model_file", "snapshot_date"], "overwrite_partitions")


def materialise(df: DataFrame) -> DataFrame:
    """Cut a long lineage by a written table in the shared folder."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
