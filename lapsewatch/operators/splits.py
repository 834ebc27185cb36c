"""Temporal splits, samples and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import hash_buckets, running_sums
from .clean import resolve_label

KEYS = ("msno", "snapshot_date")


def _windows(train_date: str, train: int, val: int, test: int, oot: int) -> list[tuple[str, Column, Column]]:
    """Start and end of each split, counted back from the training date in calendar months."""
    end = F.lit(train_date).cast("date")
    out = []
    for name, months in (("oot", oot), ("test", test), ("val", val), ("train", train)):
        start = F.add_months(end, -months)
        out.append((name, start, F.date_sub(end, 1)))
        end = start
    return out[::-1]


def split_windows(spark: SparkSession, train_date: str, train: int = 8, val: int = 2, test: int = 2,
                  oot: int = 2) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("split"), s.alias("start_date"), e.alias("end_date"))
            for n, s, e in _windows(train_date, train, val, test, oot)]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def temporal_split(
    df: DataFrame, train_date: str, train: int = 8, val: int = 2, test: int = 2, oot: int = 2,
    date: str = "snapshot_date",
) -> DataFrame:
    """Tag each row with its split; rows outside all windows are dropped. The outer bounds reach the scan."""
    windows = _windows(train_date, train, val, test, oot)
    d = F.col(date)
    tag = F.lit(None).cast("string")
    for name, start, end in windows:
        tag = F.when(d.between(start, end), F.lit(name)).otherwise(tag)
    return df.where(d.between(windows[0][1], windows[-1][2])).withColumn("split", tag)


def training_set(features: DataFrame, labels: DataFrame, how: str = "inner", keys=KEYS) -> DataFrame:
    """Features with labels. ``left_from_labels`` keeps every label, with NULL features where absent."""
    if how == "left_from_labels":
        return labels.join(features, list(keys), "left")
    return features.join(labels, list(keys), "inner")


def digest(keys, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def stratified_sample(df: DataFrame, label: str, frac: float, seed: int = 42, keys=None) -> DataFrame:
    """Bernoulli sample with the same fraction per label.

    With ``keys`` the choice hangs on a hash of the row key, so reruns and lost executors give the
    same rows; without, it is ``sampleBy``.
    """
    label = resolve_label(df, label)
    if keys is None:
        return df.sampleBy(F.col(label).cast("int"), {0: frac, 1: frac}, seed)
    # 28 bits of the digest as a number in [0, 1)
    u = F.conv(F.substring(digest(keys, seed), 1, 7), 16, 10).cast("double") / F.lit(float(16**7))
    return df.where((u < frac) & F.col(label).isin(0, 1))


def random_sample(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=frac, seed=seed)


def _stratum_rank(df: DataFrame, label: str, seed: int, keys, digits: int) -> DataFrame:
    """Zero-based rank in hash order within each label (``_before``) and the label's size (``_n_total``).

    A label is a third of the rows or more, so the order is cut into 16 ** digits parts by the digest.
    Raise ``digits`` where a 4096th of a label is too much for one task.
    """
    hashed = hash_buckets(df.withColumn("_digest", digest(keys, seed)), "_digest", digits)
    ranked = running_sums(hashed, [label], ["_digest", *keys], {"_n": F.lit(1)})
    return ranked.withColumnRenamed("_n_before", "_before").drop("_digest")


def stratified_split(df: DataFrame, label: str, ratio: float, seed: int = 42, keys=KEYS, digits: int = 3) -> DataFrame:
    """Column ``part`` train/test: exactly round(ratio * n) rows of each label train, chosen by hash."""
    label = resolve_label(df, label)
    ranked = _stratum_rank(df, label, seed, keys, digits)
    part = F.when(F.col("_before") < F.floor(F.col("_n_total") * ratio + 0.5), "train").otherwise("test")
    return ranked.withColumn("part", part).drop("_before", "_n_total")


def assign_folds(df: DataFrame, label: str, k: int, seed: int = 42, keys=KEYS, digits: int = 3) -> DataFrame:
    """Column ``fold`` 0..k-1 with label shares equal up to one row."""
    label = resolve_label(df, label)
    ranked = _stratum_rank(df, label, seed, keys, digits)
    return ranked.withColumn("fold", F.pmod(F.col("_before"), F.lit(k)).cast("int")).drop("_before", "_n_total")


def split_stats(df: DataFrame, label: str, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("label_mean"))
