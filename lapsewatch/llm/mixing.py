"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Every source wants a share of the budget by its weight, but takes at most ``epochs`` times its own size; what is cut off
is shared among the others by weight until no source is above its cap. The documents of a source are
repeated as often as its target holds the source's size; the rest is filled with the documents that come first in a
seeded hash order, up to the document that comes nearest to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ordering import hash_buckets, running_sums
from .tables import stored, table

WEIGHTS, EPOCHS, SEED = (1, 2, 3), 3, 7
#: Fixed value: a word is a run of anything but space and control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], epochs: int) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, target); one row per source goes in and out.

    Weights repeat over the sources in code point order, null last. Sources are taken in the order in which they reach
    their cap as the water level rises; the level is that of the first one that does not.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(order) - 1) % len(weights)
    src = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), at))
    src = src.withColumn("cap", F.lit(epochs) * F.col("source_size"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    src = src.withColumns({
        "rank": F.row_number().over(rising),
        "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))})
    free = src.withColumn("below", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("rank"))).over(everything))
    free = free.withColumn("water", F.max(F.when(F.col("rank") == F.col("below"), F.col("level"))).over(everything))
    full = F.col("below").isNull() | (F.col("rank") < F.col("below"))
    return free.select("source", "source_size", "weight", F.when(full, F.col("cap").cast("double")).otherwise(
        F.col("water") * F.col("weight")).alias("target"))


def _digest(key: str, text: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col(text)))


def plan(docs: DataFrame, key: str, source: str, text: str, weights: Sequence[float], epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Light rows (key, source, size, digest), and per source: size, target, whole repetitions, last digest taken once more."""
    rows = stored(docs.select(
        F.col(key).alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
        _digest(key, text, seed).alias("digest")))
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("int")
    sources = sources.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    run = running_sums(hash_buckets(rows, "digest"), ["source"], ["digest"], {"size": F.col("size")})
    side = sources.select(F.col("source").alias("_source"), "part")
    taken = run.join(side, F.col("source").eqNullSafe(F.col("_source"))).where(
        F.col("size_before") + F.col("size") / 2 < F.col("part"))
    cuts = taken.groupBy("source").agg(F.max("digest").alias("cut")).withColumnRenamed("source", "_source")
    out = sources.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source", "part")
    return rows, stored(out)


def repeats(digest: str, whole: str, cut: str) -> Column:
    return F.col(whole) + F.coalesce((F.col(digest) <= F.col(cut)).cast("int"), F.lit(0))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(key, size, source_size, target, repeats, taken) for every row of ``docs``.

    Size is the number of words; a null or empty text has none. A null source is a source of its own. The budget
    is the size of all documents; sources without words get none of it. Rows equal in key and text share one place
    in the hash order, so they are repeated alike. An empty table gives no rows. The source table is ordered as a whole:
    it has one row per source. A source that holds most rows is ordered in 4096 hash buckets.
    """
    rows, sources = plan(docs, key, source, text, weights, epochs, seed)
    sources = sources.withColumnRenamed("source", "_source")
    out = rows.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumn("repeats", repeats("digest", "whole", "cut"))
    return out.select(F.col("id").alias(key), "size", "source_size", "target", "repeats",
                      (F.col("size") * F.col("repeats")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return mix(table(spark, sf_dir, "documents")).drop("repeats")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. The texts are not shuffled: they meet one row per source."""
    _, sources = plan(docs, "doc_id", "source", "text", WEIGHTS, EPOCHS, SEED)
    sources = sources.select(F.col("source").alias("_source"), F.col("whole").alias("_whole"), F.col("cut").alias("_cut"))
    out = docs.withColumn("_digest", _digest("doc_id", "text", SEED)).join(
        sources, F.col("source").cast("string").eqNullSafe(F.col("_source")))
    times = F.nullif(repeats("_digest", "_whole", "_cut"), F.lit(0))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)



SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR), text)) AS digest FROM documents),
s AS (
  SELECT *, {EPOCHS} * source_size AS cap,
         ([1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
r AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rnk,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s),
f AS (SELECT min(rnk) AS below, arg_min(level, rnk) AS water FROM r WHERE level * w <= cap),
t AS (
  SELECT source, source_size, CASE WHEN below IS NULL OR rnk < below THEN CAST(cap AS DOUBLE) ELSE water * w END AS target
  FROM r, f),
p AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole FROM t),
o AS (
  SELECT d.*, source_size, target, whole, target - whole * source_size AS part,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN before + size / 2 < part THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
