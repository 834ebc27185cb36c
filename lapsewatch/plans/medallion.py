"""Raw tables to gold tables, as lazily chained DataFrames."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_transactions
from ..operators.labels import churn_label
from ..operators.latest import expiry_snapshots, latest_transaction
from ..operators.members import clean_members, members_asof
from ..operators.outliers import clean_user_logs
from ..operators.snapshots import registered_asof, snapshot_grid
from ..operators.timeline import Activity, Bounds, Payments, observation_features, observations, within
from ..operators.window_state import WindowState, bring_forward
from ..functions.columns import coalesce_category, with_year_month
from ..sources.buckets import write_bucketed
from ..sources.merge import replace_dates
from ..sources.writers import write_table

DAILY_SUMS = [f"num_{m}_w30_sum" for m in ("25", "50", "75", "985", "100")]


@dataclass
class Silver:
    members: DataFrame
    transactions: DataFrame
    user_logs: DataFrame


def silver(members: DataFrame, transactions: DataFrame, user_logs: DataFrame, exact: bool = False) -> Silver:
    return Silver(clean_members(members), clean_transactions(transactions), clean_user_logs(user_logs, exact))


def feature_store(snaps: DataFrame, members: DataFrame, txn: DataFrame, logs: DataFrame, start: str, end: str,
                  wide: int = 30, narrow: int = 7, daily: bool = False) -> DataFrame:
    """All features of each observation. Activity stays NULL without a log day, transactions become 0.

    Members are joined on the entity; everything else meets on one timeline, without joins. ``daily`` says that the
    logs have one row per entity and day.
    """
    base = members_asof(members, within(observations(snaps), (start, end)), start, end, how="left")
    feats = observation_features(base, logs, txn, Activity(wide=wide, narrow=narrow, daily=daily), Payments(),
                                 bounds=(start, end))
    return feats.drop(*DAILY_SUMS)


def label_store(snaps: DataFrame, txn: DataFrame, horizon: int = 30, bounds: Bounds | None = None) -> DataFrame:
    """Labels of the observations; with ``bounds`` the scan of the transactions is cut to their reach."""
    return churn_label(snaps, txn, horizon, bounds=bounds)


def _registered(members: DataFrame, start: str, end: str) -> DataFrame:
    kept = members.select("msno", "city_clean", "registered_via", "registration_date")
    base = registered_asof(snapshot_grid(kept, start, end, "registration_date"), F.col("snapshot_date"))
    return coalesce_category(base, ["registered_via", "city_clean"])


def inference_features(members: DataFrame, txn: DataFrame, logs: DataFrame, start: str, end: str) -> DataFrame:
    """Features of every registered member on every day of the range, in one job instead of one per day."""
    feats = observation_features(_registered(members, start, end), logs, txn, Activity(include_today=True), Payments(),
                                 keep_inactive=True, bounds=(start, end))
    return feats.drop(*DAILY_SUMS, "num_unq_w30_sum").na.fill(0)


def extend_inference(members: DataFrame, txn: DataFrame, logs: DataFrame, out: str, date: str) -> DataFrame:
    """Add one date to the inference table: the facts since the last stored state are read, the history is not.

    Returns the date's rows. The state lies beside the table; a rerun of a date replaces both. ``members`` are read on
    every date, so they should be a stored table.
    """
    spec = WindowState(Activity(include_today=True))
    state = bring_forward(spec, f"{out}/window_state", logs, txn, date)
    feats = spec.features(_registered(members, date, date), state, date, keep_inactive=True)
    feats = feats.drop(*DAILY_SUMS, "num_unq_w30_sum").na.fill(0)
    write_table(feats, f"{out}/inference_store", ["snapshot_date"], "overwrite_partitions", gather=False)
    return members.sparkSession.read.parquet(f"{out}/inference_store").where(F.col("snapshot_date") == F.lit(date).cast("date"))


def _features_by_day(snaps: DataFrame, s: Silver, out: str, start: str, end: str) -> None:
    """Feature store, date by date from the carried state."""
    spec, day = WindowState(), dt.date.fromisoformat(start)
    while day.isoformat() <= end:
        date = day.isoformat()
        state = bring_forward(spec, f"{out}/window_state", s.user_logs, s.transactions, date)
        base = members_asof(s.members, within(observations(snaps), (date, date)), date, date, how="left")
        replace_dates(spec.features(base, state, date).drop(*DAILY_SUMS), f"{out}/feature_store", ["snapshot_date"], "snapshot_date", date, date)
        day += dt.timedelta(days=1)


def build_gold(s: Silver, out: str, start: str, end: str, horizon: int = 30, daily: bool = False, incremental: bool = False) -> None:
    """Write the snapshot, latest-transaction, feature and label tables.

    A run for some dates replaces those dates only; the latest-transaction table is rebuilt whole. ``daily`` says that the
    logs have one row per entity and day. ``incremental`` takes the features date by date from the state of the day before
    (``window_state`` beside the tables), so that each date reads its own facts only."""
    snaps = with_year_month(expiry_snapshots(s.transactions, start, end), "snapshot_date", numeric=False)
    replace_dates(snaps, f"{out}/max_expiry_transactions", ["year", "month"], "snapshot_date", start, end)
    latest = with_year_month(latest_transaction(s.transactions), "snapshot_date", numeric=False)
    write_table(latest, f"{out}/latest_transactions", ["year", "month"])
    spark = snaps.sparkSession
    snaps = spark.read.parquet(f"{out}/max_expiry_transactions").where(
        F.col("snapshot_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if incremental:
        _features_by_day(snaps, s, out, start, end)
    else:
        features = feature_store(snaps, s.members, s.transactions, s.user_logs, start, end, daily=daily)
        replace_dates(features, f"{out}/feature_store", ["snapshot_date"], "snapshot_date", start, end)
    labels = label_store(snaps, s.transactions, horizon, (start, end))
    replace_dates(labels, f"{out}/label_store", ["snapshot_date"], "snapshot_date", start, end)


def bucket_gold(spark: SparkSession, out: str, start: str, end: str, buckets: int, prefix: str = "gold") -> tuple[DataFrame, DataFrame]:
    """The dates start..end of the feature and label tables, brought into buckets of (entity, date); both tables, whole.

    Worth its one shuffle where several trainings or evaluations join them: they meet bucket by bucket, unshuffled.
    """
    tables = []
    for name in ("feature_store", "label_store"):
        rows = spark.read.parquet(f"{out}/{name}").where(
            F.col("snapshot_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        tables.append(write_bucketed(rows, f"{prefix}_{name}", f"{out}/{name}_bucketed", buckets, span=(start, end)))
    return tables[0], tables[1]
