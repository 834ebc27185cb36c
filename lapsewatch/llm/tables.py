"""Reading the given tables, and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write a table under ``spark.checkpoint.dir`` and read it back: it is computed once, its lineage is cut,
    and it outlives lost executors. Without that setting the warehouse folder is used, which executors share.

    The plan that led to the table is garbage afterwards. It is collected at once, which keeps a driver that runs many
    steps small and lets Spark delete the shuffle files of the finished step."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id: str, modulus: int) -> Column:
    """Whether the CRC-32 of the id as text is divisible by ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == 0


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``bad`` (doc_id, _print), _print being the hash of the text."""
    bad = bad.select(F.col("doc_id").alias("_bad"), "_print").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]) & (
        F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == bad["_print"]), "left_anti")


def finite(vector: Column) -> Column:
    """Whether an array is not null and holds neither null nor non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good, F.lit(False))


def commonest_width(rows: DataFrame, column: str) -> tuple[int, int]:
    """The commonest length of an array column, ties to the longer, and how many rows have it; (0, 0) without rows."""
    top = rows.groupBy(F.size(column).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return (top["width"], top["count"]) if top else (0, 0)
