"""Sharding by sampled splitters; DataFrame functions only.

Records are keyed by a hash of their text, so equal texts lie together. A size-weighted key sample gives quantile
boundaries of many narrow ranges, every record finds its range by halving, and the exact size of each range is counted.
Keys that alone overfill a range are taken out of it; one that is larger than a shard is divided by a hash of the record's
id, and records that share even that, if they overfill a range, by a number each. The ranges and pieces, a bounded number, are dealt to the shards, the largest first and each to the emptiest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored, table

SHARDS = 16
#: Ranges for each shard, a power of two; the shards differ by about one range.
RANGES_PER_SHARD = 64
#: Expected rows of the weighted sample; its rows, 16 bytes each, go to the driver.
SAMPLE = 50_000


def _size(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def _below(key: Column, cuts: list[int], df: DataFrame, name: str) -> DataFrame:
    """Add the number of ``cuts`` that are not above the key, found by halving."""
    width = 1
    while width <= len(cuts):
        width *= 2
    padded = F.array(*[F.lit(c) for c in cuts], *[F.lit(None).cast("long")] * (width - 1 - len(cuts)))
    df = df.withColumn(name, F.lit(0))
    step = width // 2
    while step:
        above = F.coalesce(key >= F.get(padded, F.col(name) + (step - 1)), F.lit(False))
        df = df.withColumn(name, F.col(name) + F.when(above, step).otherwise(0))
        step //= 2
    return df


def _splitters(light: DataFrame, total: int, ranges: int) -> list[int]:
    rate = SAMPLE / total
    draw = F.pmod(F.xxhash64("_id", "_h", F.lit(11)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = light.where(draw < F.col("_size") * rate).select("_h", F.greatest(F.col("_size") * 1.0, F.lit(1 / rate)).alias("w"))
    drawn = sorted((r["_h"], r["w"]) for r in sample.collect())
    each, sofar, cuts = sum(w for _, w in drawn) / ranges if drawn else 1.0, 0.0, []
    for h, w in drawn:
        if sofar >= each * (len(cuts) + 1) and len(cuts) < ranges - 1 and (not cuts or h > cuts[-1]):
            cuts.append(h)
        sofar += w
    return cuts


def _deal(sizes: list[int], shards: int) -> list[int]:
    """Shard of each unit: the largest first, each to the emptiest shard."""
    full, where = [0] * shards, [0] * len(sizes)
    for u in sorted(range(len(sizes)), key=lambda u: (-sizes[u], u)):
        where[u] = min(range(shards), key=lambda s: (full[s], s))
        full[where[u]] += sizes[u]
    return where


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text plus 1), ``shard`` and ``slot``; columns of these names are replaced.

    Shards hold nearly equal sums of sizes. Slots count from 0 without a gap in each shard. Equal texts share a shard, unless
    they are together larger than one. A null text has no bytes and stands with the empty one. Null and repeated keys
    are rows like any other. Rows equal in key and text are divided only where they overfill a range of a divided text; the
    numbers that divide them follow the order of reading. An empty table gives no rows.
    """
    ranges = shards * RANGES_PER_SHARD
    rows = docs.withColumns({
        "_id": F.coalesce(F.col(key).cast("string"), F.lit("")), "_size": _size(text),
        "_h": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    light = stored(rows.select("_id", "_size", "_h"))
    total = light.agg(F.sum("_size")).first()[0]
    if total is None:
        return docs.drop("size", "shard", "slot").withColumns(
            {"size": F.lit(0).cast("long"), "shard": F.lit(0), "slot": F.lit(0).cast("long")})
    cuts = _splitters(light, total, ranges)
    # keys that alone overfill a range: at most one for each range
    by_key = light.groupBy("_h").agg(F.sum("_size").alias("s")).where(F.col("s") > total / ranges)
    heavy = sorted((r["_h"], r["s"]) for r in by_key.collect())
    pieces = [-(-s * ranges // total) if s > total / shards else 1 for _, s in heavy]
    first, n = [], len(cuts) + 1
    for p in pieces:
        first.append(n)
        n += p

    # records equal in text and id that overfill a range of a divided text: at most one group for each range
    divided = [h for (h, _), p in zip(heavy, pieces) if p > 1]
    rows, light = (df.withColumn("_row", F.lit(None).cast("long")) for df in (rows, light))
    if divided:
        equal = light.where(F.col("_h").isin(divided)).groupBy("_h", "_id").agg(F.sum("_size").alias("s")).where(F.col("s") > total / ranges)
        alike = [r["a"] for r in equal.select(F.xxhash64("_h", "_id").alias("a")).collect()]
        if alike:
            same = F.xxhash64("_h", "_id").isin(alike)
            numbered = stored(rows.where(same).withColumn("_row", F.monotonically_increasing_id()))
            rows = rows.where(~same).unionByName(numbered)
            light = light.where(~same).unionByName(numbered.select(*light.columns))

    def units(df: DataFrame) -> DataFrame:
        df = _below(F.col("_h"), cuts, df, "_unit")
        if not heavy:
            return df
        which = F.array_position(F.array(*[F.lit(h) for h, _ in heavy]), F.col("_h")) - 1
        base, parts = (F.get(F.array(*map(F.lit, x)), F.col("_heavy").cast("int")) for x in (first, pieces))
        piece = F.pmod(F.xxhash64("_id", "_row", F.lit(13)), parts).cast("int")
        return df.withColumn("_heavy", which).withColumn("_unit", F.when(F.col("_heavy") >= 0, base + piece).otherwise(F.col("_unit")))

    sizes, counts = [0] * n, [0] * n
    for r in units(light).groupBy("_unit").agg(F.sum("_size").alias("s"), F.count("*").alias("c")).collect():
        sizes[r["_unit"]], counts[r["_unit"]] = r["s"], r["c"]
    where, begin, filled = _deal(sizes, shards), [0] * n, [0] * shards
    for u in range(n):
        begin[u] = filled[where[u]]
        filled[where[u]] += counts[u]
    lookup = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_unit"))
    inside = Window.partitionBy("_unit").orderBy("_h", "_id", "_row")
    return units(rows).withColumns({
        "size": F.col("_size"), "shard": lookup(where),
        "slot": lookup(begin).cast("long") + F.row_number().over(inside) - 1,
    }).drop("_id", "_size", "_h", "_row", "_unit", "_heavy")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return shard(docs)
