"""Row-level cleaning and naming rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cast_columns, drop_null, parse_yyyymmdd

# Accepted id names, score names by priority, label fallbacks.
ID_NAMES = ["msno", "member_id", "user_id", "userid", "id", "memberid"]
SCORE_NAMES = ["prediction_proba", "model_prediction_proba", "churn_proba", "proba", "probability",
               "prob", "score", "prediction", "pred"]
NOT_SCORES = ["msno", "snapshot_date", "id", "member_id", "userid"]
LABEL_NAMES = ["label", "is_churn", "churn"]


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions; rows without key, date or expiry are dropped."""
    typed = raw.withColumns({
        "transaction_date": parse_yyyymmdd("transaction_date"),
        "membership_expire_date": parse_yyyymmdd("membership_expire_date"),
    })
    typed = cast_columns(typed, {
        "is_auto_renew": "int", "is_cancel": "int", "payment_method_id": "string",
        "payment_plan_days": "int", "plan_list_price": "int", "actual_amount_paid": "int",
    })
    kept = drop_null(typed, ["msno", "transaction_date", "membership_expire_date"])
    return kept.withColumns({"year": F.year("transaction_date"), "month": F.month("transaction_date")})


def validity_rules() -> dict[str, Column]:
    """What a usable transaction must satisfy."""
    return {
        "plan_days": F.col("payment_plan_days") >= 0,
        "list_price": F.col("plan_list_price") >= 0,
        "amount_paid": F.col("actual_amount_paid") >= 0,
        "expiry_order": F.col("membership_expire_date") >= F.col("transaction_date"),
    }


def _all(rules: dict[str, Column]) -> Column:
    cond = F.lit(True)
    for rule in rules.values():
        cond = cond & F.coalesce(rule, F.lit(False))
    return cond


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that pass every rule; an undecided (NULL) rule counts as failed."""
    return df.where(_all(rules))


def rejects(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows :func:`keep_valid` drops, with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull())
    return df.where(~_all(rules)).withColumn("broken_rules", F.concat_ws(",", broken))


def keep_frequent(df: DataFrame, c: str, lo: int, hi: int, min_count: int, name: str | None = None) -> DataFrame:
    """Add ``c`` cleaned: kept where it lies in lo..hi and occurs at least ``min_count`` times, else NULL.

    The values that qualify are a small table whose size Spark measures before it picks the join.
    """
    name = name or f"{c}_clean"
    common = (
        df.where(F.col(c).between(lo, hi)).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_count).select(F.col(c).alias("_value"), F.col(c).alias(name))
    )
    return df.join(common, F.col(c) == F.col("_value"), "left").drop("_value")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; missing ones are NULL, extra ones are dropped."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)


def union_tagged(parts: dict[str, DataFrame], tag: str = "source_file") -> DataFrame:
    """Union of several inputs, each row tagged with the name of its own input."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = union_aligned(out, df)
    return out


def canonical_id(df: DataFrame, name: str = "msno") -> DataFrame:
    """Rename the first column with a known id name to ``name``."""
    if name in df.columns:
        return df
    hit = next((c for c in df.columns if c.lower() in ID_NAMES), None)
    if hit is None:
        raise KeyError(f"no id column among {df.columns}")
    return df.withColumnRenamed(hit, name)


def score_column(df: DataFrame) -> str:
    """The score column: by priority, exact name before part of a name; else the first numeric column."""
    lowered = {c.lower(): c for c in reversed(df.columns)}
    for wanted in SCORE_NAMES:
        if wanted in lowered:
            return lowered[wanted]
        part = next((c for c in df.columns if wanted in c.lower()), None)
        if part is not None:
            return part
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.NumericType) and f.name not in NOT_SCORES]
    if not numeric:
        raise KeyError(f"no score column among {df.columns}")
    return numeric[0]


def canonical_score(df: DataFrame, name: str = "prediction_proba", check: bool = True) -> DataFrame:
    """Rename the score column and read it as double; an all-NULL score is an error."""
    hit = score_column(df)
    out = df.withColumnRenamed(hit, name).withColumn(name, F.col(name).try_cast("double"))
    if check and out.where(F.col(name).isNotNull()).isEmpty():
        raise ValueError(f"score column {hit!r} holds no number")
    return out


def resolve_label(df: DataFrame, name: str = "label") -> str:
    """The label column: ``name`` if present, else the first known fallback."""
    for c in [name, *LABEL_NAMES]:
        if c in df.columns:
            return c
    raise ValueError(f"label column {name!r} not found")


def project(df: DataFrame, rename: dict[str, str] | None = None, drop: Sequence[str] = (),
            order: Sequence[str] | None = None) -> DataFrame:
    """Rename, drop and reorder columns."""
    out = df.drop(*drop).withColumnsRenamed(rename or {})
    return out.select(*order) if order else out
