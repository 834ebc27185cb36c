"""Raw files arriving in a folder, merged batch by batch into a partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.merge import merge_into


def ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    part: Sequence[str],
    keys: Sequence[str],
    order: Sequence[Column],
    fmt: str = "csv",
) -> StreamingQuery:
    """Process all files not yet seen and stop. The merge is idempotent, so a replayed batch is harmless."""
    stream = spark.readStream.schema(schema).format(fmt).option("header", True).load(source)

    def step(batch: DataFrame, _: int) -> None:
        merge_into(prepare(batch), target, part, keys, order)

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
