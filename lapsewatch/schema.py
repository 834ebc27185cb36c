"""Table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType()}


def _struct(spec: str) -> T.StructType:
    fields = (f.split() for f in spec.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


MEMBERS_RAW = _struct(
    "msno string, city int, bd int, gender string, registered_via int, registration_init_time int")
TRANSACTIONS_RAW = _struct(
    "msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
    "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int")
USER_LOGS_RAW = _struct(
    "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
    "total_secs double")
LABELS = _struct("snapshot_date date, msno string, is_churn int")
PREDICTIONS = _struct("msno string, snapshot_date date, churn_proba double, model_file string")


def check(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail at planning time when a contracted column is absent or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = [f"{f.name}: {f.dataType.simpleString()} expected, {have[f.name].simpleString() if f.name in have else 'absent'}"
           for f in schema.fields if have.get(f.name) != f.dataType]
    if bad:
        raise ValueError("; ".join(bad))
    return df
