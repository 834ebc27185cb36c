"""Feature state that is carried from date to date.

One row per entity holds what features of the next date need: the log days of the widest window with their measures, the
last log day, the latest transaction, and running transaction counts. A build for a date reads the facts dated since the
state and the state itself, never the history; facts and state meet in one shuffle by entity, and the row of an entity is
bounded by the window. Features equal those of ``timeline.observation_features`` over all facts up to the date.

Facts that arrive later than the state they belong to are not seen; rebuild the state with :meth:`WindowState.start` then.
Facts without an entity are left out.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import partition_values, write_table
from .timeline import Activity, Payments, latest_row

DATE = "state_date"


@dataclass
class WindowState:
    """How state rows are built, advanced and turned into features."""

    activity: Activity = field(default_factory=Activity)
    payments: Payments = field(default_factory=Payments)
    key: str = "msno"
    log_date: str = "date"
    txn_date: str = "transaction_date"

    def _dated(self, facts: DataFrame, column: str, after: str | None, date: str) -> DataFrame:
        """Facts dated in (after, date]; the limits reach the scan, and a timestamp keeps its last day."""
        d = F.col(column)
        facts = facts.where(F.col(self.key).isNotNull() & (d < F.date_add(F.lit(date).cast("date"), 1)))
        return facts if after is None else facts.where(d >= F.date_add(F.lit(after).cast("date"), 1))

    def _kept(self, days: Column, date: str) -> Column:
        """Log days that a window ending on the date, or on the day before the next one, can reach."""
        first = (dt.date.fromisoformat(date) - dt.date(1970, 1, 1)).days - self.activity.wide
        return F.filter(days, lambda x: x["day"] >= first)

    def _facts(self, logs: DataFrame, txn: DataFrame, after: str | None, date: str) -> DataFrame:
        """State rows of the facts alone."""
        day = F.unix_date(F.col(self.log_date).cast("date"))
        daily = self._dated(logs, self.log_date, after, date).groupBy(self.key, day.alias("day")).agg(
            *[F.sum(m).alias(m) for m in self.activity.metrics])
        listened = daily.groupBy(self.key).agg(
            F.max("day").alias("last_log"),
            F.array_sort(F.collect_list(F.when(
                F.col("day") >= F.unix_date(F.lit(date).cast("date")) - self.activity.wide,
                F.struct("day", *self.activity.metrics)))).alias("days"))
        paid = self._dated(txn, self.txn_date, after, date).groupBy(self.key).agg(
            latest_row(self.txn_date, self.payments.tie_break, ["is_auto_renew", "plan_list_price"]).alias("latest"),
            F.sum(F.when(F.col("is_auto_renew") == 1, 1).otherwise(0)).alias("renewing"), F.count(F.lit(1)).alias("payments"))
        return listened.join(paid, self.key, "full")

    def start(self, logs: DataFrame, txn: DataFrame, date: str) -> DataFrame:
        """State at the end of ``date`` from all facts up to it: one pass over the history."""
        return self._stamped(self._facts(logs, txn, None, date), date)

    def advance(self, state: DataFrame, logs: DataFrame, txn: DataFrame, after: str, date: str) -> DataFrame:
        """State at the end of ``date`` from the state at the end of ``after`` and the facts dated between."""
        new = self._facts(logs, txn, after, date)
        names = ["last_log", "days", "latest", "renewing", "payments"]
        both = state.select(self.key, *names).join(
            new.select(self.key, *[F.col(n).alias(f"_{n}") for n in names]), self.key, "full")
        added = lambda n: F.when(F.col(n).isNotNull() | F.col(f"_{n}").isNotNull(), F.coalesce(n, F.lit(0)) + F.coalesce(f"_{n}", F.lit(0)))
        none = F.array().cast(dict(state.dtypes)["days"])
        return self._stamped(both.select(
            self.key, F.coalesce("_last_log", "last_log").alias("last_log"),
            F.concat(F.coalesce("days", none), F.coalesce("_days", none)).alias("days"),
            F.coalesce("_latest", "latest").alias("latest"), added("renewing").alias("renewing"), added("payments").alias("payments")), date)

    def _stamped(self, rows: DataFrame, date: str) -> DataFrame:
        return rows.select(
            self.key, "last_log", self._kept("days", date).alias("days"), "latest", "renewing", "payments",
            F.lit(date).cast("date").alias(DATE))

    def features(self, base: DataFrame, state: DataFrame, date: str, keep_inactive: bool = False) -> DataFrame:
        """Activity and transaction features of ``base`` rows, all dated ``date``, from the state at the end of that date."""
        act = self.activity
        # a state's compressed file is a tenth of its rows: never broadcast, so that the arrays are worked through by all tasks
        known = state.drop(DATE).withColumnRenamed(self.key, "_key").hint("merge")
        rows = base.join(known, base[self.key] == known["_key"], "left")
        today = (dt.date.fromisoformat(date) - dt.date(1970, 1, 1)).days
        last = today + act.end

        def between(first: int) -> Column:
            return F.coalesce(F.filter("days", lambda x: x["day"].between(first, last)), F.array().cast(dict(state.dtypes)["days"]))

        rows = rows.withColumns({"_wide": between(last - act.wide + 1), "_short": between(last - act.narrow + 1)})

        def total(of: str, value) -> Column:
            """Sum that ignores NULL and is NULL without values, as a window sum is."""
            values = F.transform(of, value)
            start = F.nullif(F.get(values, F.lit(0)), F.get(values, F.lit(0)))  # a NULL of the values' type
            return F.aggregate(values, start, lambda a, v: F.coalesce(a + v, a, v))

        heard = lambda x: x["total_secs"].isNotNull()
        rows = rows.withColumns({
            **{f"_w_{m}": total("_wide", _field(m)) for m in act.metrics},
            "_n": F.size("_wide").cast("long"),
            "_ny": F.size(F.filter("_wide", heard)).cast("long"),
            "_first": F.lit(1).cast("long"),
            "_sum_rank_secs": total("_wide", lambda x, i: x["total_secs"] * (i + 1)),
            "_sum_rank_y": total("_wide", lambda x, i: F.when(heard(x), (i + 1).cast("long"))),
            "_narrow": total("_short", _field("total_secs")),
            "_last_log": F.col("last_log"),
            "_hit": F.col("latest"),
            "_renewing_sum": F.col("renewing"),
            "_payment_sum": F.col("payments"),
        })
        feats = act.columns(keep_inactive) | self.payments.columns()
        return rows.select(*[base[c] for c in base.columns], *[c.alias(n) for n, c in feats.items()])


def _field(name: str):
    return lambda x: x[name]


def state_dates(spark: SparkSession, path: str) -> list[str]:
    """Dates of the stored states, oldest first."""
    return partition_values(spark, path, DATE)


def bring_forward(spec: WindowState, path: str, logs: DataFrame, txn: DataFrame, date: str) -> DataFrame:
    """The stored state at the end of ``date``: advanced from the latest earlier one, or started where there is none.

    A rerun replaces the date's own partition. Later states are left as they are.
    """
    spark = logs.sparkSession
    earlier = [d for d in state_dates(spark, path) if d < date]
    if earlier:
        before = spark.read.parquet(path).where(F.col(DATE) == F.lit(earlier[-1]).cast("date"))
        state = spec.advance(before, logs, txn, earlier[-1], date)
    else:
        state = spec.start(logs, txn, date)
    write_table(state, path, [DATE], "overwrite_partitions", gather=False)
    return spark.read.parquet(path).where(F.col(DATE) == F.lit(date).cast("date"))
