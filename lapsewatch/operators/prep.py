"""Feature preparation: fitted on one DataFrame, applied as columns to any other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The twelve model features; the first two codes are categories.
CATEGORICAL = ["registered_via", "city_clean"]
FEATURES = [
    "tenure_days_at_snapshot", "registered_via", "city_clean", "sum_secs_w30", "active_days_w30",
    "complete_rate_w30", "sum_secs_w7", "engagement_ratio_7_30", "days_since_last_play", "trend_secs_w30",
    "auto_renew_share", "last_is_auto_renew",
]
ACTIVITY = ["sum_secs_w30", "active_days_w30", "complete_rate_w30", "sum_secs_w7", "engagement_ratio_7_30",
            "days_since_last_play", "trend_secs_w30"]
DEMOGRAPHIC = ["tenure_days_at_snapshot", "registered_via", "city_clean"]


def any_null(cols: Sequence[str]) -> Column:
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.col(c).isNull()
    return hit


def missing_flag_fill(df: DataFrame, cols: Sequence[str], name: str = "missing_any") -> DataFrame:
    """0/1 flag for any missing value, then zeros in their place."""
    return df.withColumn(name, any_null(cols).cast("int")).na.fill(0, subset=list(cols))


def missing_flags(df: DataFrame, groups: dict[str, Sequence[str]], fill_cols: Sequence[str] = ()) -> DataFrame:
    """One 0/1 flag per feature group, then zeros for ``fill_cols``."""
    out = df.withColumns({name: any_null(cols).cast("int") for name, cols in groups.items()})
    return out.na.fill(0, subset=list(fill_cols)) if fill_cols else out


def _quoted(value) -> str:
    """A fitted value as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def _stage(before: Sequence[str], after: Sequence[str]) -> SQLTransformer:
    """Stage that replaces columns by expressions; all other columns pass."""
    drop = f" EXCEPT ({', '.join(f'`{c}`' for c in before)})" if before else ""
    return SQLTransformer(statement=f"SELECT *{drop}, {', '.join(after)} FROM __THIS__")


def fill_stage(cols: Sequence[str], name: str = "missing_any") -> SQLTransformer:
    """:func:`missing_flag_fill` as a stage that can be saved."""
    missing = " OR ".join(f"`{c}` IS NULL" for c in cols)
    return _stage(cols, [f"CAST({missing} AS INT) AS `{name}`", *[f"coalesce(`{c}`, 0) AS `{c}`" for c in cols]])


@dataclass
class OneHot:
    """Indicator columns per category, the first (smallest) category left out.

    Categories come from the fitted rows alone; an unseen one gets all zeros. They are collected in one job. With ``limit``
    a column of more categories is refused; :func:`category_pipeline` is the sparse form for wide ones.
    """

    categories: dict[str, list]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], limit: int | None = None) -> OneHot:
        row = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in cols]).first()
        wide = [c for c in cols if limit is not None and len(row[c]) > limit]
        if wide:
            raise ValueError(f"more than {limit} categories: {', '.join(wide)}")
        return cls({c: list(row[c]) for c in cols})

    def columns(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in vs[1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        flags = {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0))
                 for c, vs in self.categories.items() for v in vs[1:]}
        return df.withColumns(flags).drop(*self.categories)

    def stage(self) -> SQLTransformer:
        """The same columns as a stage that can be saved."""
        return _stage(list(self.categories), [
            f"coalesce(CAST(`{c}` = {_quoted(v)} AS INT), 0) AS `{c}_{v}`" for c, vs in self.categories.items() for v in vs[1:]])


@dataclass
class Scaler:
    """(x - mean) / population standard deviation; a constant column is only centred."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], exclude: Sequence[str] = ()) -> Scaler:
        cols = [c for c in cols if c not in set(exclude)]
        row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}__{c}")
                       for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return cls({c: (row[f"m__{c}"] or 0.0, row[f"s__{c}"] or 1.0) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()})

    def stage(self) -> SQLTransformer:
        """The same columns as a stage that can be saved."""
        return _stage(list(self.stats), [
            f"(`{c}` - double('{m!r}')) / double('{s!r}') AS `{c}`" for c, (m, s) in self.stats.items()])


def category_pipeline(cols: Sequence[str]) -> Pipeline:
    """Index by frequency, unknown values kept as their own index, one-hot as sparse vectors."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in cols]
    encode = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_oh" for c in cols], dropLast=True)
    return Pipeline(stages=[*index, encode])


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    y = F.col(label).cast("int")
    return df.agg(F.struct(F.count_if(y == 0).alias("neg"), F.count_if(y == 1).alias("pos")).alias("c"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight n / (2 * class size) on each row. No shuffle by label: two keys would mean two tasks."""
    y = F.col(label).cast("int")
    n = F.col("_c.neg") + F.col("_c.pos")
    weight = F.when(y == 1, n / (2 * F.col("_c.pos"))).when(y == 0, n / (2 * F.col("_c.neg")))
    return df.withColumn("_c", _class_counts(df, label).scalar()).withColumn(name, weight).drop("_c")


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive; NULL without positives."""
    c = _class_counts(df, label)
    return c.select(F.when(F.col("c.pos") > 0, F.col("c.neg") / F.col("c.pos")).alias("scale_pos_weight"))


def with_pos_weight(df: DataFrame, label: str, name: str = "weight", like: DataFrame | None = None) -> DataFrame:
    """Row weight: the positive scale for positives, 1 for negatives. The scale is that of ``like``, or of the rows themselves."""
    scale = pos_weight(df if like is None else like, label).scalar()
    return df.withColumn("_s", scale).withColumn(
        name, F.when(F.col(label) == 1, F.col("_s")).otherwise(F.lit(1.0))).drop("_s")


def align_features(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The fitted columns in their order, as double; missing columns and values are 0."""
    have, types = set(df.columns), dict(df.dtypes)

    def feature(c: str) -> Column:
        if c not in have:
            return F.lit(0.0).alias(c)
        source = F.col(c).cast("int") if types[c] == "boolean" else F.col(c)
        return F.coalesce(source.try_cast("double"), F.lit(0.0)).alias(c)

    return df.select(*keep, *[feature(c) for c in cols])


def features_with_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    """Columns whose name starts with one of the prefixes."""
    return [c for c in df.columns if c.startswith(tuple(prefixes))]
