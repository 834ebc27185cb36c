"""Mergeable distinct counts, bucketed gold tables, shares without a shuffle by category."""

import random

import pytest
from pyspark.sql import functions as F

from lapsewatch import catalog
from lapsewatch.operators import distinct_state, members
from lapsewatch.plans.medallion import bucket_gold
from lapsewatch.sources import buckets
from lapsewatch.sources.writers import shared_folder, write_table
from helpers import day, plus


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def facts(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(f"m{rng.randrange(90)}" if rng.random() > 0.05 else None, plus("2024-01-01", rng.randrange(40)), rng.choice([None, 1, 2, 3]))
            for _ in range(n)]
    return rows, spark.createDataFrame(rows, "msno string, date date, x int")


def test_counts_from_stored_days(spark):
    rows, df = facts(spark)
    path = shared_folder(spark)
    for start, end in (("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-02-20"), ("2024-01-15", "2024-02-20")):
        distinct_state.store_days(df, path, ["msno", "x"], start, end)
    state = spark.read.parquet(path)
    assert state.count() == len({r[1] for r in rows}) and state.agg(F.sum("rows")).first()[0] == len(rows)
    for h in distinct_state.window_coverage(state, "2024-02-05", (30, 7, 400)).collect():
        inside = [r for r in rows if plus("2024-02-05", 1 - h.horizon) <= r[1] <= day("2024-02-05")]
        assert (h.actual_start, h.actual_end) == (min(r[1] for r in inside), max(r[1] for r in inside))
        assert h.entities == len({r[0] for r in inside} - {None})
    got = distinct_state.distinct_by(state, {"month": F.month("date")}, "msno").collect()
    assert {r["month"]: (r["count"], r.distinct_msno) for r in got} == {
        m: (sum(r[1].month == m for r in rows), len({r[0] for r in rows if r[1].month == m} - {None})) for m in (1, 2)}
    nulls = {r["column"]: (r.nulls, r["distinct"]) for r in distinct_state.null_profile(state, ["msno", "x"]).collect()}
    assert nulls == {"msno": (sum(r[0] is None for r in rows), len({r[0] for r in rows})), "x": (sum(r[2] is None for r in rows), 4)}
    got = distinct_state.retention(state, "2024-01-20", 10).first()
    of = lambda a, b: {r[0] for r in rows if day(a) <= r[1] <= day(b)} - {None}
    a, b = of("2024-01-01", "2024-01-10"), of("2024-01-11", "2024-01-20")
    assert (got.before, got.now, got.retained, got.lost, got.won) == (len(a), len(b), len(a & b), len(a - b), len(b - a))


def test_a_corrected_day_replaces_its_counts(spark):
    _, df = facts(spark)
    path = shared_folder(spark)
    distinct_state.store_days(df, path, ["msno"], "2024-01-01", "2024-02-20")
    fixed = df.where("date = DATE'2024-01-05'").limit(1)
    distinct_state.store_days(fixed, path, ["msno"], "2024-01-05", "2024-01-06")
    state = spark.read.parquet(path)
    assert [r["rows"] for r in state.where("date BETWEEN DATE'2024-01-05' AND DATE'2024-01-06'").collect()] == [1]
    assert state.agg(F.sum("rows")).first()[0] == 1 + df.where("date NOT IN (DATE'2024-01-05', DATE'2024-01-06')").count()


def test_stored_values_count_as_the_sketches_do(spark):
    _, df = facts(spark)
    sketched, exact = shared_folder(spark), shared_folder(spark)
    for start, end in (("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-02-20"), ("2024-01-15", "2024-02-20")):
        distinct_state.store_days(df, sketched, ["msno", "x"], start, end)
        distinct_state.store_values(df, exact, ["msno", "x"], start, end)
    a, b = spark.read.parquet(sketched), spark.read.parquet(exact)
    none = distinct_state.day_state(df.limit(0), ["msno", "x"]), distinct_state.day_values(df.limit(0), ["msno", "x"])
    rows = lambda x: sorted(map(str, x.collect()))
    for s, e in ((a, b), none):
        month = {"month": F.month("date")}
        assert rows(distinct_state.distinct_by(s, month, "msno")) == rows(distinct_state.distinct_by_exact(e, month, "msno"))
        assert rows(distinct_state.null_profile(s, ["msno", "x"])) == rows(distinct_state.null_profile_exact(e, ["msno", "x"]))
        for of, h in (("2024-02-05", (30, 7, 400)), ("2024-03-05", (7,))):
            assert rows(distinct_state.window_coverage(s, of, h)) == rows(distinct_state.window_coverage_exact(e, of, h))
        assert rows(distinct_state.retention(s, "2024-01-20", 10)) == rows(distinct_state.retention_exact(e, "2024-01-20", 10))


def test_state_queries_are_exact_beyond_the_sketch(spark, tmp_path):
    """More customers and users than a sketch holds: 70 000 in one month and in both retention windows."""
    n = 70_000
    spark.range(2 * n + 1).selectExpr(
        "id AS o_orderkey", f"id % {n} AS o_custkey", "'O' AS o_orderstatus", "1.0D AS o_totalprice", "'1-URGENT' AS o_orderpriority",
        f"if(id = {2 * n}, timestamp_ntz'1995-01-01', timestamp_ntz'1997-03-10' + make_dt_interval(CAST(id DIV {n} * 60 AS INT))) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n + 1).selectExpr(
        "id AS event_id", f"id % {n} AS user_id", f"if(id = {n}, timestamp_ntz'2024-01-02', timestamp_ntz'2024-01-18') AS ts", "'view' AS event_type", "1.0D AS value").write.parquet(f"{tmp_path}/events.parquet")
    run = lambda name: catalog.queries()[name](spark, str(tmp_path)).collect()
    assert sorted(r.distinct_msno for r in run("count_by_month_from_state")) == [1, n, n]
    assert {r["column"]: r["distinct"] for r in run("null_profile_from_state")}["msno"] == n
    assert [r.entities for r in run("window_coverage_from_state")] == [n, n]
    r = run("retention_from_state")[0]
    assert (r.before, r.now, r.retained, r.lost, r.won) == (n, n, n, 0, 0)


def test_error_beyond_the_exact_range_and_without_rows(spark):
    df = spark.range(40_000).select(F.col("id").alias("msno"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("date"))
    state = distinct_state.day_state(df, ["msno"], lg=10)
    n = distinct_state.window_coverage(state, "2024-01-20", (20,), lg=10).first().entities
    assert n != 40_000 and abs(n / 40_000 - 1) < 4 / 2 ** 5
    empty = distinct_state.day_state(df.limit(0), ["msno"])
    row = distinct_state.window_coverage(empty, "2024-01-20", (7,)).first()
    assert (row.actual_start, row.actual_end, row.entities) == (None, None, 0)
    assert distinct_state.null_profile(empty, ["msno"]).first()["distinct"] == 0
    assert distinct_state.retention(empty, "2024-01-20", 7).first().retained == 0


def observations(spark, days, value):
    rows = [(f"m{i}", plus("2024-01-01", d), value) for i in range(30) for d in days if (i + d) % 3]
    return spark.createDataFrame(rows, "msno string, snapshot_date date, v int")


def test_buckets_join_without_exchange_and_replace_dates(spark, no_broadcast):
    path = shared_folder(spark)
    a, b = (f"{name}_{path.rsplit('/', 1)[1]}" for name in "ab")
    first = observations(spark, range(5), 1)
    buckets.write_bucketed(first, a, f"{path}/a", 4)
    # columns in another order, one date only
    left = buckets.write_bucketed(observations(spark, [2], 2).select("v", "snapshot_date", "msno"), a, f"{path}/a", 4)
    right = buckets.write_bucketed(first.withColumnRenamed("v", "w"), b, f"{path}/b", 4)
    joined = left.drop("day").join(right.drop("day"), ["msno", "snapshot_date"])
    assert "Exchange" not in plan(joined)
    got = {(r.msno, r.snapshot_date): (r.v, r.w) for r in joined.collect()}
    assert got == {(r.msno, r.snapshot_date): (2 if r.snapshot_date == day("2024-01-03") else 1, 1) for r in first.collect()}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    # another session knows the layout once it is described again
    spark.sql(f"DROP TABLE {a}")
    buckets.register(spark, a, f"{path}/a", "msno string, snapshot_date date, v int", 4)
    assert spark.table(a).count() == first.count()
    assert "Exchange" not in plan(spark.table(a).drop("day").join(right.drop("day"), ["msno", "snapshot_date"], "left"))


def test_bucketed_gold_follows_the_stores(spark):
    out = shared_folder(spark)
    prefix = f"g_{out.rsplit('/', 1)[1]}"
    for name, value in (("feature_store", 1), ("label_store", 0)):
        write_table(observations(spark, range(4), value), f"{out}/{name}", ["snapshot_date"])
    feats, labels = bucket_gold(spark, out, "2024-01-01", "2024-01-04", 4, prefix)
    assert feats.count() == labels.count() == observations(spark, range(4), 1).count()
    # a date that the stores lost is lost here as well, dates outside the range stay
    for name, value in (("feature_store", 5), ("label_store", 5)):
        write_table(observations(spark, [0, 1, 3], value), f"{out}/{name}", ["snapshot_date"])
    feats, _ = bucket_gold(spark, out, "2024-01-02", "2024-01-03", 4, prefix)
    assert {(r.day, r.v) for r in feats.select("day", "v").distinct().collect()} == {("2024-01-01", 1), ("2024-01-02", 5), ("2024-01-04", 1)}


def test_shares_move_no_rows_by_category(spark, no_broadcast):
    rng = random.Random(4)
    rows = [(f"m{i}", rng.choice([1, 2, None]), rng.choice(["3", "3", "4", None]), plus("2024-01-20", rng.randrange(40))) for i in range(80)]
    rows += [("late", 9, "9", day("2024-05-01")), ("undated", 1, "3", None)]
    m = spark.createDataFrame(rows, "msno string, city_clean int, registered_via string, registration_date date")
    grid = members.member_snapshots(m, "2024-02-01", "2024-02-20")
    assert "Exchange hashpartitioning" not in plan(grid)
    dated = grid.drop(*members.SHARES.values())
    by_join = members.add_running_shares(dated, m, members.SHARES, "2024-02-01", "2024-02-20", limit=0)
    assert "Exchange hashpartitioning" in plan(by_join)
    by_join = by_join.na.fill(0.0, list(members.SHARES.values())).select(*grid.columns)
    assert sorted(map(str, grid.collect())) == sorted(map(str, by_join.collect()))
    assert members.member_snapshots(m.limit(0), "2024-02-01", "2024-02-20").count() == 0
