"""Incremental merge of new rows into a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import union_aligned
from ..operators.latest import dedup
from .writers import path_exists, remove, write_table


def touched(existing: DataFrame, new: DataFrame, part: Sequence[str]) -> DataFrame:
    """Existing rows in partitions that occur in ``new``.

    The smallest and largest touched value of each partition column become a filter, which prunes directories; the
    touched partitions themselves are then found by a semi join, for any number of them.
    """
    types = dict(existing.dtypes)
    values = new.select(*[F.col(c).cast(types[c]).alias(c) for c in part]).distinct()
    span = values.agg(*[f for i, c in enumerate(part) for f in (
        F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.coalesce(F.bool_or(F.isnull(c)), F.lit(False)).alias(f"null{i}"))]).first()
    near = existing
    for i, c in enumerate(part):
        inside = F.col(c).between(F.lit(span[f"lo{i}"]), F.lit(span[f"hi{i}"]))
        near = near.where(inside | F.col(c).isNull() if span[f"null{i}"] else inside)
    same = [near[c].eqNullSafe(values[c]) for c in part]
    return near.join(values, same, "left_semi")


def merge_partitions(
    new: DataFrame,
    existing: DataFrame | None,
    part: Sequence[str],
    keys: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """The touched partitions after the merge: old and new rows, one per key, the first in ``order``.

    Untouched partitions are neither read nor returned; write the result with ``overwrite_partitions``.
    Deduplication is per key within the touched partitions.
    """
    rows = new if existing is None else union_aligned(touched(existing, new, part), new)
    return dedup(rows, keys, order)


def merge_view(
    new: DataFrame, existing: DataFrame, part: Sequence[str], keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The whole table after the merge, without writing it."""
    values = new.select(*part).distinct()
    same = [existing[c].eqNullSafe(values[c]) for c in part]
    untouched = existing.join(values, same, "left_anti")
    return union_aligned(untouched, merge_partitions(new, existing, part, keys, order))


def merge_into(
    new: DataFrame, path: str, part: Sequence[str], keys: Sequence[str], order: Sequence[Column]
) -> None:
    """Merge into a table on disk, rewriting only the touched partitions. Running it twice changes nothing."""
    spark = new.sparkSession
    existing = spark.read.parquet(path) if path_exists(spark, path) else None
    merged = merge_partitions(new, existing, part, keys, order)
    write_table(merged, path, part, "overwrite_partitions")


def replace_dates(new: DataFrame, path: str, part: Sequence[str], date: str, start: str, end: str) -> None:
    """Replace the rows dated start..end of a table whose partitions may hold other dates as well.

    Partitions that are left without any row are removed after the write. Running it twice changes nothing.
    """
    spark = new.sparkSession
    if not path_exists(spark, path):
        return write_table(new, path, part, "overwrite_partitions")
    inside = F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    existing = spark.read.parquet(path)
    types = dict(existing.dtypes)
    dated = existing.where(inside).select(*part).unionByName(
        new.select(*[F.col(c).cast(types[c]).alias(c) for c in part])).distinct()
    near = touched(existing.withColumn("_file", F.input_file_name()), dated, part)
    out = union_aligned(near.where(~F.coalesce(inside, F.lit(False))).drop("_file"), new)
    filled = out.select(*[F.col(c).cast(types[c]).alias(f"_{c}") for c in part]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in part]
    # one row per emptied directory
    emptied = [r[0] for r in near.join(filled, same, "left_anti").select(
        F.regexp_replace("_file", "/[^/]*$", "")).distinct().collect()]
    write_table(out, path, part, "overwrite_partitions")
    for folder in emptied:
        remove(spark, folder)
