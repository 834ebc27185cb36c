"""Top-1 selections per key.

``row_number() = 1`` is planned with a partial group limit before the shuffle, so each map task sends
only its own best rows per key, whatever the size of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import days_between


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order. Give a total order to make the choice unique."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def total(df: DataFrame, first: Sequence[str] = ()) -> list[Column]:
    """Descending order by the given columns, then by all others: the choice never depends on the order of rows."""
    return [F.desc(c) for c in [*first, *[c for c in df.columns if c not in set(first)]]]


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the winner being the first in ``order``."""
    return latest_per_key(df, keys, order)


def max_by_key(df: DataFrame, key: str, value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(name or f"max_{value}"))


def any_flag(df: DataFrame, key: str, flag: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(flag).alias(name))


def with_plan_days(txn: DataFrame) -> DataFrame:
    return txn.withColumn("total_plan_days", days_between("transaction_date", "membership_expire_date"))


def _upto(txn: DataFrame, snapshot: str | None) -> DataFrame:
    txn = with_plan_days(txn).where(F.col("transaction_date").isNotNull())
    if snapshot is None:
        return txn
    # plain date comparison, so the filter reaches the scan
    return txn.where(F.col("transaction_date") <= F.lit(snapshot).cast("date"))


def latest_transaction(
    txn: DataFrame, snapshot: str | None = None, tie_break: Sequence[str] = (), key: str = "msno"
) -> DataFrame:
    """The transaction that decides an entity's status, with priority for a cancellation.

    Among the rows of the entity's last date the longest plan wins, unless exactly one row has the
    longest plan and a row of the second-longest is a cancellation: then that cancellation wins.
    Ordered by date, plan length and cancellation, both candidates are among the first two rows, so
    two rows per entity are all that is needed. Without a snapshot, the entity's own last date is used.
    ``tie_break`` columns count descending, then all others.
    """
    order = [F.desc("transaction_date"), F.desc_nulls_last("total_plan_days"), F.desc("is_cancel"), *total(txn, tie_break)]
    two = (
        _upto(txn, snapshot)
        .withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
        .where("_rn <= 2")
    )
    # same partitioning and order as above: no further shuffle
    following = Window.partitionBy(key).orderBy("_rn")
    ahead = {c: F.lead(c).over(following) for c in ("transaction_date", "total_plan_days", "is_cancel")}
    cancelled_second = (
        (ahead["transaction_date"] == F.col("transaction_date"))
        & (ahead["total_plan_days"] < F.col("total_plan_days"))
        & (ahead["is_cancel"] == 1)
    )
    marked = two.withColumn(
        "_pick",
        F.when(F.col("_rn") == 1, F.coalesce(cancelled_second, F.lit(False))),
    ).withColumn("_second", F.max("_pick").over(Window.partitionBy(key)))
    chosen = marked.where(F.col("_rn") == F.when(F.col("_second"), 2).otherwise(1))
    date = F.col("transaction_date") if snapshot is None else F.lit(snapshot).cast("date")
    return chosen.drop("_rn", "_pick", "_second").withColumns({
        "max_transaction_date": F.col("transaction_date"), "snapshot_date": date})


def tied_transactions(txn: DataFrame, snapshot: str | None = None, key: str = "msno") -> DataFrame:
    """All rows of each entity's last date, with plan rank, cancellation flag and explicit priority.

    Rows of one plan length and cancellation flag rank alike, so they are counted by these before any window.
    Without a cancellation the rows of the longest plan have priority 1; with one, those of the longest plan that are
    not cancelled and the cancellations that rank second.
    """
    newest = Window.partitionBy(key).orderBy(F.desc("transaction_date"))
    dated = _upto(txn, snapshot)
    last = dated.groupBy(key, "transaction_date", "total_plan_days").agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.max("is_cancel"), F.lit(0)).alias("_cancel"))
    last = last.withColumn("_r", F.rank().over(newest)).where("_r = 1")
    plans = Window.partitionBy(key)
    longer = plans.orderBy(F.desc_nulls_last("total_plan_days")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = last.select(
        F.col(key).alias("_key"), F.col("transaction_date").alias("_date"), F.col("total_plan_days").alias("_plan"),
        (F.coalesce(F.sum("_n").over(longer), F.lit(0)) + 1).cast("int").alias("plan_days_rank"),
        F.max("_cancel").over(plans).alias("cancellation_in_group"))
    same = (F.col(key) == F.col("_key")) & (F.col("transaction_date") == F.col("_date")) & (
        F.col("total_plan_days").eqNullSafe(F.col("_plan")))
    chosen = F.col("is_cancel") == 1
    longest, second = F.col("plan_days_rank") == 1, F.col("plan_days_rank") == 2
    priority = F.when(F.col("cancellation_in_group") == 1, (chosen & second) | (~chosen & longest)).otherwise(longest)
    return dated.join(ranks, same).drop("_key", "_date", "_plan").withColumns({
        "max_transaction_date": F.col("transaction_date"), "final_priority": F.coalesce(priority, F.lit(False)).cast("int")})


def expiry_snapshots(
    txn: DataFrame,
    start: str,
    end: str,
    tie_break: Sequence[str] = ("transaction_date",),
    key: str = "msno",
) -> DataFrame:
    """One observation per entity and expiry date in the range, carrying the expiring transaction.

    A row that expires on day d is always the latest expiry on or before d, so the users-by-days grid
    is not needed: the work is linear in the transactions. ``tie_break`` columns count descending, then all others.
    """
    d = F.col("membership_expire_date")
    in_range = txn.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return latest_per_key(
        in_range, [key, "membership_expire_date"], total(txn, tie_break)).withColumn("snapshot_date", d)
