"""Gold tables bucketed by observation, so that features, labels and scores join without a shuffle.

A table is partitioned by date and, within a date, hashed by (entity, date) into a fixed number of buckets. Two tables with
the same number of buckets meet bucket by bucket. Bucketing by the pair keeps an entity with very many dates spread out.
The layout lives in the session's catalog; ``register`` describes a stored table to another session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import path_exists, remove

KEYS = ("msno", "snapshot_date")
#: Partition column: the date as text, because a column cannot both partition and bucket a table.
DAY = "day"


def register(spark: SparkSession, name: str, path: str, schema: str, buckets: int, keys: Sequence[str] = KEYS) -> None:
    """Describe a bucketed table under ``path`` to the session; ``schema`` are its columns without the partition column."""
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} ({schema}, {DAY} STRING) USING parquet PARTITIONED BY ({DAY})
        CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'""")
    if path_exists(spark, path):
        # dates written by other sessions
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str] = KEYS,
                   span: tuple[str, str] | None = None) -> DataFrame:
    """Write the dates of ``df``, replacing those dates only, and return the whole table.

    With ``span`` the rows are all there are between two dates: stored dates inside it that ``df`` lacks are removed.
    Rows are shuffled once, into the buckets, so that a bucket of a date is one file.
    """
    spark = df.sparkSession
    register(spark, name, path, _ddl(df), buckets, keys)
    dated = df.repartition(buckets, *keys).withColumn(DAY, F.date_format(keys[-1], "yyyy-MM-dd"))
    # insertInto follows the session's setting alone, and goes by position
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        dated.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    if span:
        _remove_emptied(df, name, path, keys[-1], span)
    return spark.table(name)


def _remove_emptied(df: DataFrame, name: str, path: str, date: str, span: tuple[str, str]) -> None:
    # days are bounded by the calendar
    spark = df.sparkSession
    filled = {r[0] for r in df.select(F.date_format(date, "yyyy-MM-dd")).distinct().collect()}
    stored = [r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    for day in stored:
        if span[0] <= day <= span[1] and day not in filled:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({DAY} = '{day}')")
            remove(spark, f"{path}/{DAY}={day}")
