"""Facts and observation dates on one timeline per entity.

Every temporal feature follows the same plan: facts are pre-aggregated to one row per (entity, day),
observation rows are added, and sliding frames over the day number give the values. The
pre-aggregation is map-side combined, so an entity that holds a third of the raw facts reaches the
shuffle as at most one row per calendar day and map task, and its window partition is bounded by the
length of the calendar. No pairs of facts and observations are produced.

Facts are also cut to what the observations can see: days after the last observation are dropped, and
days before the reach of the first one collapse to a single row per entity, which keeps the running
totals. A run for one date therefore shuffles a window of facts, not the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio

# The activity measures of the user-log table.
METRICS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]

DAY = "_day"
EVER = Window.unboundedPreceding


def observations(snaps: DataFrame, keep: Sequence[str] = (), key: str = "msno") -> DataFrame:
    """Distinct (entity, snapshot_date) rows, with any further columns given in ``keep``."""
    return snaps.select(key, F.col("snapshot_date").cast("date").alias("snapshot_date"), *keep).distinct()


Bounds = tuple[str, str]


def within(obs: DataFrame, bounds: Bounds | None) -> DataFrame:
    """Observations dated inside ``bounds``; the facts are cut to the same range, so others could not be answered."""
    if bounds is None:
        return obs
    first, last = (F.lit(b).cast("date") for b in bounds)
    return obs.where(F.col("snapshot_date").between(first, last))


def visible(facts: DataFrame, date: str, obs: DataFrame, floor: int = 0, ahead: int = 0, bounds: Bounds | None = None,
            collapse: bool = True) -> DataFrame:
    """Facts the observations can see, with their day number.

    ``floor`` is relative to the first observation: earlier days become that day (or are dropped when
    ``collapse`` is off); days more than ``ahead`` after the last observation are dropped. The range of
    observation dates is ``bounds`` when known, else it is looked up.
    """
    day = F.unix_date(F.col(date).cast("date"))
    if bounds is not None:
        first, last = (F.lit(b).cast("date") for b in bounds)
        d = F.col(date)
        # strictly before the next day, so a timestamp column keeps its last day
        facts = facts.where(d < F.date_add(last, ahead + 1))
        if not collapse:
            facts = facts.where(d >= F.date_add(first, floor))
        return facts.withColumn(DAY, F.greatest(day, F.unix_date(F.date_add(first, floor))))
    span = obs.agg(F.struct(F.min(F.unix_date("snapshot_date")).alias("lo"),
                            F.max(F.unix_date("snapshot_date")).alias("hi"))).scalar()
    facts = facts.withColumn("_span", span)
    lo, hi = F.col("_span.lo") + floor, F.col("_span.hi") + ahead
    seen = facts.where((day <= hi) if collapse else day.between(lo, hi))
    return seen.withColumn(DAY, F.greatest(day, lo)).drop("_span")


def merged_timeline(obs: DataFrame, *facts: DataFrame) -> DataFrame:
    """Union of daily fact rows and observation rows on one day number."""
    line = obs.withColumn(DAY, F.unix_date("snapshot_date"))
    for rows in facts:
        line = line.unionByName(rows, allowMissingColumns=True)
    return line


def frame(lo: int, hi: int, key: str = "msno"):
    """Frame of days ``lo`` .. ``hi`` relative to the current row, both ends included."""
    return Window.partitionBy(key).orderBy(DAY).rangeBetween(lo, hi)


def is_observation() -> Column:
    return F.col("snapshot_date").isNotNull()


class Activity:
    """Listening features over a wide and a narrow window ending the day before, or on, the observation."""

    def __init__(self, metrics: Sequence[str] = METRICS, wide: int = 30, narrow: int = 7, include_today: bool = False,
                 daily: bool = False):
        """``daily`` says that the logs have one row per entity and day; they are then shuffled once, by entity.

        Without it they are first added up by entity and day, which also keeps a hot entity's raw rows apart.
        """
        self.metrics, self.wide, self.narrow, self.daily = list(metrics), wide, narrow, daily
        self.end = 0 if include_today else -1

    def facts(self, logs: DataFrame, obs: DataFrame, key: str, date: str, bounds: Bounds | None = None) -> DataFrame:
        # everything before the first window only matters for the last log day
        seen = visible(logs, date, obs, floor=self.end - self.wide, bounds=bounds)
        log_day = F.unix_date(F.col(date).cast("date"))
        if self.daily:
            # days that collapse before the first window lie outside every frame but the last log day's
            rows = seen.select(key, DAY, *self.metrics, log_day.alias("_log_day"))
        else:
            rows = seen.groupBy(key, DAY).agg(*[F.sum(m).alias(m) for m in self.metrics], F.max(log_day).alias("_log_day"))
        return rows.withColumn("_logged", F.lit(1))

    def windows(self, line: DataFrame, key: str) -> DataFrame:
        wide = frame(self.end - self.wide + 1, self.end, key)
        narrow = frame(self.end - self.narrow + 1, self.end, key)
        so_far = frame(EVER, 0, key)
        # Rank of the log day in the history; inside a window, rank - first rank + 1 is the day index.
        line = line.withColumn("_rank", F.when(F.col("_logged") == 1, F.sum("_logged").over(so_far)))
        line = line.withColumns({
            "_rank_secs": F.col("_rank") * F.col("total_secs"),
            "_rank_y": F.when(F.col("total_secs").isNotNull(), F.col("_rank")),
        })
        return line.withColumns({
            **{f"_w_{m}": F.sum(m).over(wide) for m in self.metrics},
            "_n": F.count("_logged").over(wide),
            "_ny": F.count("total_secs").over(wide),
            "_first": F.min("_rank").over(wide),
            "_sum_rank_secs": F.sum("_rank_secs").over(wide),
            "_sum_rank_y": F.sum("_rank_y").over(wide),
            "_narrow": F.sum("total_secs").over(narrow),
            "_last_log": F.max("_log_day").over(so_far),
        })

    def columns(self, keep_inactive: bool = False) -> dict[str, Column]:
        """Feature columns: NULL without a log day in the wide window, or 0 with ``keep_inactive``."""
        n, ny, secs = F.col("_n"), F.col("_ny"), F.col("_w_total_secs")
        # slope of total_secs over the day index; the index counts every log day
        shift = F.col("_first") - 1
        mean_xy = (F.col("_sum_rank_secs") - shift * secs) / ny
        mean_x = (F.col("_sum_rank_y") - shift * ny) / ny
        trend = (mean_xy - mean_x * secs / ny) / ((n * n - 1) / F.lit(12.0))
        w, nr = self.wide, self.narrow
        cols = {f"{m}_w{w}_sum": F.col(f"_w_{m}") for m in self.metrics if m != "total_secs"}
        cols |= {
            f"sum_secs_w{w}": F.coalesce(secs, F.lit(0.0)),
            f"active_days_w{w}": n,
            f"complete_rate_w{w}": F.coalesce(safe_ratio("_w_num_100", "_w_num_unq"), F.lit(0.0)),
            f"sum_secs_w{nr}": F.coalesce("_narrow", F.lit(0.0)),
            f"engagement_ratio_{nr}_{w}": F.coalesce(safe_ratio("_narrow", secs), F.lit(0.0)),
            "days_since_last_play": F.unix_date("snapshot_date") - F.col("_last_log"),
            f"trend_secs_w{w}": F.when((n > 1) & (ny > 0), trend).otherwise(F.lit(0.0)),
        }
        if keep_inactive:
            return {c: F.coalesce(v, F.lit(0)) for c, v in cols.items()}
        return {c: F.when(n > 0, v) for c, v in cols.items()}


def latest_row(date: str, tie_break: Sequence[str], values: Sequence[str]) -> Column:
    """Aggregate: date (``_on``) and values of the latest fact, ties broken by ``tie_break``, then the values."""
    ties = [F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_break)]
    return F.max(F.struct(F.col(date).cast("date").alias("_on"), *ties, *values))


class Payments:
    """Latest transaction on or before the observation and the share of auto-renewals so far.

    Among transactions of one day the greatest ``tie_break`` tuple wins, then flag and price.
    """

    def __init__(self, tie_break: Sequence[str] = ("membership_expire_date",)):
        self.tie_break = list(tie_break)

    def facts(self, txn: DataFrame, obs: DataFrame, key: str, date: str = "transaction_date",
              bounds: Bounds | None = None) -> DataFrame:
        return visible(txn, date, obs, bounds=bounds).groupBy(key, DAY).agg(
            latest_row(date, self.tie_break, ["is_auto_renew", "plan_list_price"]).alias("_row"),
            F.sum(F.when(F.col("is_auto_renew") == 1, 1).otherwise(0)).alias("_renewing"),
            F.count(F.lit(1)).alias("_payments"),
        )

    def windows(self, line: DataFrame, key: str) -> DataFrame:
        so_far = frame(EVER, 0, key)
        return line.withColumns({
            "_hit": F.last("_row", ignorenulls=True).over(so_far),
            "_renewing_sum": F.sum("_renewing").over(so_far),
            "_payment_sum": F.sum("_payments").over(so_far),
        })

    def columns(self) -> dict[str, Column]:
        return {
            "tenure_days": F.coalesce(F.datediff("_hit._on", "registration_date"), F.lit(0)),
            "last_is_auto_renew": F.coalesce("_hit.is_auto_renew", F.lit(0)),
            "last_plan_list_price": F.coalesce("_hit.plan_list_price", F.lit(0)),
            "auto_renew_share": F.coalesce(safe_ratio("_renewing_sum", "_payment_sum"), F.lit(0.0)),
        }


def activity_features(
    logs: DataFrame,
    snaps: DataFrame,
    metrics: Sequence[str] = METRICS,
    wide: int = 30,
    narrow: int = 7,
    include_today: bool = False,
    keep_inactive: bool = False,
    key: str = "msno",
    date: str = "date",
    bounds: Bounds | None = None,
    daily: bool = False,
) -> DataFrame:
    """Windowed sums, active days, completion rate, narrow/wide ratio, recency and trend in one pass.

    The training form looks at [d-wide, d-1]; ``include_today`` shifts both windows to end on d.
    Observations without any log day in the wide window are left out, as the feature block starts
    from the wide aggregate; ``keep_inactive`` keeps them with zeros. Observations outside ``bounds`` are left out.
    """
    act = Activity(metrics, wide, narrow, include_today, daily)
    obs = within(observations(snaps, key=key), bounds)
    line = act.windows(merged_timeline(obs, act.facts(logs, obs, key, date, bounds)), key)
    rows = line.where(is_observation() if keep_inactive else is_observation() & (F.col("_n") > 0))
    return rows.select(key, "snapshot_date", *[c.alias(n) for n, c in act.columns(keep_inactive).items()])


def transaction_features(
    txn: DataFrame,
    registered: DataFrame,
    tie_break: Sequence[str] = ("membership_expire_date",),
    key: str = "msno",
) -> DataFrame:
    """Tenure to the latest transaction, its renewal flag and price, and the auto-renew share.

    ``registered`` holds (entity, snapshot_date, registration_date). Every observation is kept, with
    zeros where there is no transaction yet. One shuffle of daily rows serves all four features.
    """
    pay = Payments(tie_break)
    obs = observations(registered, ["registration_date"], key)
    line = merged_timeline(obs, pay.facts(txn, obs, key))
    rows = pay.windows(line, key).where(is_observation())
    return rows.select(key, "snapshot_date", *[c.alias(n) for n, c in pay.columns().items()])


def observation_features(
    base: DataFrame,
    logs: DataFrame,
    txn: DataFrame,
    activity: Activity,
    payments: Payments,
    keep_inactive: bool = False,
    key: str = "msno",
    date: str = "date",
    bounds: Bounds | None = None,
) -> DataFrame:
    """Activity and transaction features of ``base`` rows on one common timeline.

    ``base`` has one row per (entity, snapshot_date); all its columns travel along, so the blocks
    need no joins: logs, transactions and observations meet in a single shuffle by entity. Rows dated
    outside ``bounds`` are left out.
    """
    base = within(base, bounds)
    line = merged_timeline(
        base, activity.facts(logs, base, key, date, bounds), payments.facts(txn, base, key, bounds=bounds))
    rows = payments.windows(activity.windows(line, key), key).where(is_observation())
    feats = activity.columns(keep_inactive) | payments.columns()
    return rows.select(*base.columns, *[c.alias(n) for n, c in feats.items()])


def recency(facts: DataFrame, snaps: DataFrame, date: str = "date", key: str = "msno") -> DataFrame:
    """Days since the last fact on or before each observation; observations without one are left out."""
    obs = observations(snaps, key=key)
    days = visible(facts, date, obs).groupBy(key, DAY).agg(F.max(F.unix_date(F.col(date).cast("date"))).alias("_on"))
    return (
        merged_timeline(obs, days)
        .withColumn("_last", F.max("_on").over(frame(EVER, 0, key)))
        .where(is_observation() & F.col("_last").isNotNull())
        .select(key, "snapshot_date", (F.unix_date("snapshot_date") - F.col("_last")).alias("days_since_last"))
    )


def asof_latest(
    facts: DataFrame,
    snaps: DataFrame,
    values: Sequence[str],
    date: str = "transaction_date",
    tie_break: Sequence[str] = (),
    key: str = "msno",
) -> DataFrame:
    """Latest fact on or before each observation.

    Among facts of the same day the greatest ``tie_break`` tuple wins, then the greatest values, so the
    outcome never depends on row order. Observations without a fact are left out.
    """
    obs = observations(snaps, key=key)
    daily = visible(facts, date, obs).groupBy(key, DAY).agg(latest_row(date, tie_break, values).alias("_row"))
    return (
        merged_timeline(obs, daily)
        .withColumn("_hit", F.last("_row", ignorenulls=True).over(frame(EVER, 0, key)))
        .where(is_observation() & F.col("_hit").isNotNull())
        .select(key, "snapshot_date", F.col("_hit._on").alias(f"latest_{date}"),
                *[F.col(f"_hit.{v}").alias(v) for v in values])
    )


def history_totals(
    facts: DataFrame,
    snaps: DataFrame,
    sums: dict[str, Column],
    date: str = "transaction_date",
    key: str = "msno",
) -> DataFrame:
    """Totals over all facts on or before each observation, without building the joined pairs."""
    obs = observations(snaps, key=key)
    daily = visible(facts, date, obs).groupBy(key, DAY).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).withColumn(
        "_fact", F.lit(1))
    so_far = frame(EVER, 0, key)
    return (
        merged_timeline(obs, daily)
        .withColumns({n: F.sum(n).over(so_far) for n in sums} | {"_seen": F.count("_fact").over(so_far)})
        .where(is_observation() & (F.col("_seen") > 0))
        .select(key, "snapshot_date", *sums)
    )


def auto_renew_share(txn: DataFrame, snaps: DataFrame, key: str = "msno") -> DataFrame:
    """Share of auto-renewing transactions among all up to the observation date."""
    totals = history_totals(txn, snaps, {
        "auto_renew_count": F.when(F.col("is_auto_renew") == 1, 1).otherwise(0),
        "total_tx_before_expire": F.lit(1),
    }, key=key)
    return totals.withColumn("auto_renew_share", safe_ratio("auto_renew_count", "total_tx_before_expire"))


def latest_table_features(txn: DataFrame, latest: DataFrame, registered: DataFrame, key: str = "msno") -> DataFrame:
    """Transaction block that takes tenure, price and flag from a latest-transaction table.

    ``latest`` has one row per entity. Where it lies after the observation date, the latest transaction
    on or before that date is taken from ``txn``; among several of one day the latest expiry wins, then flag and price.
    """
    last = latest.select(
        key, F.col("transaction_date").alias("_date"),
        F.col("is_auto_renew").alias("_renew"), F.col("plan_list_price").alias("_price"))
    obs = observations(registered, ["registration_date"], key)
    known = F.col("_date") <= F.col("snapshot_date")
    past = asof_latest(txn, registered, ["is_auto_renew", "plan_list_price"], tie_break=["membership_expire_date"], key=key)
    joined = obs.join(last, key, "left").join(past, [key, "snapshot_date"], "left")

    def either(of_table: str, of_past: str) -> Column:
        return F.when(known, F.col(of_table)).otherwise(F.col(of_past))

    tenure = F.datediff(either("_date", "latest_transaction_date"), F.col("registration_date"))
    block = joined.select(
        key, "snapshot_date",
        F.coalesce(tenure, F.lit(0)).alias("tenure_days"),
        F.coalesce(either("_renew", "is_auto_renew"), F.lit(0)).alias("last_is_auto_renew"),
        F.coalesce(either("_price", "plan_list_price"), F.lit(0)).alias("last_plan_list_price"),
    )
    share = auto_renew_share(txn, registered, key).select(key, "snapshot_date", "auto_renew_share")
    return block.join(share, [key, "snapshot_date"], "left").na.fill({"auto_renew_share": 0.0})


def window_join(
    facts: DataFrame,
    snaps: DataFrame,
    lo: int,
    hi: int,
    date: str = "date",
    include_today: bool = False,
    key: str = "msno",
) -> DataFrame:
    """Facts dated within [snapshot + lo, snapshot + hi], one row per match.

    ``include_today`` shifts both bounds by one day, as the inference windows do. Besides the entity,
    rows meet on a calendar block as long as the window, so an entity's history is spread over many
    tasks and each observation meets only the one or two blocks its window touches.
    """
    if include_today:
        lo, hi = lo + 1, hi + 1
    width = hi - lo + 1
    day = F.unix_date(F.col(date).cast("date"))
    f = facts.withColumn("_block", F.floor(day / F.lit(width)))
    d = F.unix_date("snapshot_date")
    s = observations(snaps, key=key).withColumn(
        "_block", F.explode(F.sequence(F.floor((d + lo) / F.lit(width)), F.floor((d + hi) / F.lit(width)))))
    joined = f.join(s, [key, "_block"], "inner")
    return joined.where(day.between(d + lo, d + hi)).drop("_block")


def window_sums(joined: DataFrame, metrics: Sequence[str], date: str = "date", key: str = "msno") -> DataFrame:
    """Sums and active days of a :func:`window_join` result."""
    return joined.groupBy(key, "snapshot_date").agg(
        *[F.sum(m).alias(f"{m}_sum") for m in metrics], F.countDistinct(date).alias("active_days"))


def trend(daily: DataFrame, y: str, keys: Sequence[str] = ("msno",), date: str = "date") -> DataFrame:
    """Slope of ``y`` over the day index 1..n of a daily table; a single day gives 0."""
    idx = F.row_number().over(Window.partitionBy(*keys).orderBy(date))
    per_day = daily.groupBy(*keys, date).agg(F.sum(y).alias("_y")).withColumn("_x", idx)
    var = F.var_pop("_x")
    return per_day.groupBy(*keys).agg(
        (F.covar_pop("_x", "_y") / F.when(var > 0, var).otherwise(F.lit(1.0))).alias("trend"))
