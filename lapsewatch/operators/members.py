"""Member attributes: cleaning, category frequencies, dated member rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import normalise_key, null_if, parse_yyyymmdd
from ..sources.writers import materialise
from .snapshots import snapshot_grid

# The columns of the member table and the names of its shares.
KEEP = ["msno", "city_clean", "registered_via", "registration_date"]
SHARES = {"registered_via": "registered_via_freq", "city_clean": "city_freq"}

#: Daily shares (categories times days, 8 bytes each) that are broadcast; more are joined by date and category.
BROADCAST_SHARES = 1_000_000


def clean_members(raw: DataFrame, lower: bool = False) -> DataFrame:
    """Trimmed key, typed codes, non-positive city as NULL, parsed registration date."""
    city = F.col("city").try_cast("int")
    return raw.select(
        normalise_key("msno", lower).alias("msno"),
        null_if(city, city <= 0).alias("city_clean"),
        F.col("registered_via").try_cast("int").alias("registered_via"),
        parse_yyyymmdd("registration_init_time").alias("registration_date"),
    )


def category_freq(df: DataFrame, cat: str, by: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Share of each category among all rows, overall or within ``by``. NULL is a category here."""
    name = name or f"{cat}_freq"
    counts = df.groupBy(*by, cat).agg(F.count(F.lit(1)).alias("_n"))
    if not by:
        # one row per category
        return counts.select(cat, (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias(name))
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    return counts.join(totals, list(by), "inner").select(*by, cat, (F.col("_n") / F.col("_total")).alias(name))


def add_category_freq(df: DataFrame, cats: Sequence[str]) -> DataFrame:
    """Overall category shares on every row. NULL categories get 0.0."""
    for cat in cats:
        df = df.join(category_freq(df, cat), cat, "left")
    return df.na.fill(0.0, subset=[f"{c}_freq" for c in cats])


def running_category_freq(members: DataFrame, cat: str, start: str, end: str) -> DataFrame:
    """Category share among the members registered by each day. Size: categories x days.

    Registrations are counted per (category, day) first; days before the range fall on its first day.
    Each running count holds until the category's next registration day, so it expands to those days.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    daily = (
        members.where(F.col("registration_date") <= last)
        .groupBy(cat, F.greatest(first, "registration_date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_new"))
    )
    in_time = Window.partitionBy(cat).orderBy("_day")
    until = F.coalesce(F.date_sub(F.lead("_day").over(in_time), 1), last)
    dense = daily.withColumns({
        "_count": F.sum("_new").over(in_time), "_until": until,
    }).select(cat, "_count", F.explode(F.sequence("_day", "_until", F.expr("interval 1 day"))).alias("snapshot_date"))
    total = F.sum("_count").over(Window.partitionBy("snapshot_date"))
    return dense.select("snapshot_date", cat, (F.col("_count") / total).alias(f"{cat}_freq"))


def share_series(members: DataFrame, cats: Sequence[str], start: str, end: str) -> DataFrame:
    """Running shares as one row per category: (_cat, _value as text, _first day, _shares from that day to ``end``).

    A NULL category counts in the totals and has no row of its own.
    """
    parts = [
        running_category_freq(members, c, start, end).where(F.col(c).isNotNull()).select(
            F.lit(c).alias("_cat"), F.col(c).cast("string").alias("_value"), "snapshot_date", F.col(f"{c}_freq").alias("_share"))
        for c in cats
    ]
    by_day = F.array_sort(F.collect_list(F.struct("snapshot_date", "_share")))
    return reduce(DataFrame.unionByName, parts).groupBy("_cat", "_value").agg(
        F.min("snapshot_date").alias("_first"), F.transform(by_day, lambda s: s["_share"]).alias("_shares"))


def add_running_shares(dated: DataFrame, members: DataFrame, names: dict[str, str], start: str, end: str,
                       limit: int = BROADCAST_SHARES) -> DataFrame:
    """Running share of each row's category on its snapshot date, NULL where there is none.

    A few categories hold all rows, so rows are not shuffled by category: the series of all categories are computed
    once, their size is counted, and up to ``limit`` shares are broadcast. More are joined by date and category.
    """
    series = materialise(share_series(members, list(names), start, end))
    if (series.agg(F.sum(F.size("_shares"))).first()[0] or 0) > limit:
        for cat, name in names.items():
            freq = running_category_freq(members, cat, start, end).withColumnRenamed(f"{cat}_freq", name)
            dated = dated.join(freq, ["snapshot_date", cat], "left")
        return dated
    for cat, name in names.items():
        mine = F.broadcast(series.where(F.col("_cat") == cat).drop("_cat"))
        share = F.get("_shares", F.datediff("snapshot_date", "_first"))
        dated = dated.join(mine, F.col(cat).cast("string") == F.col("_value"), "left").withColumn(name, share).drop(
            "_value", "_first", "_shares")
    return dated


def _finish(dated: DataFrame, members: DataFrame, start: str, end: str) -> DataFrame:
    out = dated.withColumn("tenure_days_at_snapshot", F.datediff("snapshot_date", "registration_date"))
    out = add_running_shares(out, members, SHARES, start, end)
    known = F.col("registration_date").isNotNull()
    out = out.withColumns({n: F.when(known, F.coalesce(F.col(n), F.lit(0.0))) for n in SHARES.values()})
    return out.select(
        "snapshot_date", "msno", "city_clean", "registered_via", "registration_date",
        "tenure_days_at_snapshot", "registered_via_freq", "city_freq")


def member_snapshots(members: DataFrame, start: str, end: str) -> DataFrame:
    """The full member grid: every registered member on every day of the range."""
    grid = snapshot_grid(members.select(*KEEP), start, end, "registration_date")
    return _finish(grid, members, start, end)


def members_asof(members: DataFrame, pairs: DataFrame, start: str, end: str, how: str = "inner") -> DataFrame:
    """Member rows only for the (msno, snapshot_date) pairs asked for, all dated within start..end.

    A member not yet registered on the date is left out, or kept with NULLs when ``how`` is ``left``.
    The pairs are taken as unique.
    """
    m = members.select(*KEEP).withColumnRenamed("msno", "_msno")
    known = (F.col("msno") == F.col("_msno")) & (F.col("registration_date") <= F.col("snapshot_date"))
    dated = pairs.select("msno", "snapshot_date").join(m, known, how).drop("_msno")
    return _finish(dated, members, start, end)
