import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewatch.operators import timeline
from helpers import day, plus, records

D = "2024-03-01"
LOG = "msno string, date date, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, total_secs double"
TXN = "msno string, transaction_date date, membership_expire_date date, is_auto_renew int, plan_list_price int"


def logs(spark, rows):
    return spark.createDataFrame([(m, d, 1, 0, 0, 0, full, unq, secs) for m, d, full, unq, secs in rows], LOG)


def snaps(spark, rows):
    return spark.createDataFrame(rows, "msno string, snapshot_date date")


def test_window_edges(spark):
    offsets = [-31, -30, -8, -7, -1, 0, 1]
    df = logs(spark, [("a", plus(D, o), 1, 2, 10.0 ** i) for i, o in enumerate(offsets)])
    out = timeline.activity_features(df, snaps(spark, [("a", day(D)), ("a", day(D))])).first()
    assert out.sum_secs_w30 == 10 + 100 + 1000 + 10000
    assert out.active_days_w30 == 4
    assert out.sum_secs_w7 == 1000 + 10000
    assert out.days_since_last_play == 0
    assert out.complete_rate_w30 == pytest.approx(0.5)
    today = timeline.activity_features(df, snaps(spark, [("a", day(D))]), include_today=True).first()
    assert today.sum_secs_w30 == 100 + 1000 + 10000 + 100000
    assert today.sum_secs_w7 == 10000 + 100000


def test_no_logs_single_day_and_zero_denominator(spark):
    df = logs(spark, [("one", plus(D, -3), 5, 0, 0.0), ("old", plus(D, -60), 1, 1, 9.0)])
    obs = snaps(spark, [("one", day(D)), ("none", day(D)), ("old", day(D))])
    out = {r.msno: r for r in timeline.activity_features(df, obs).collect()}
    assert set(out) == {"one"}
    assert out["one"].trend_secs_w30 == 0 and out["one"].complete_rate_w30 == 5 and out["one"].engagement_ratio_7_30 == 0
    kept = {r.msno: r for r in timeline.activity_features(df, obs, keep_inactive=True).collect()}
    assert set(kept) == {"one", "none", "old"}
    assert kept["none"].sum_secs_w30 == 0 and kept["none"].days_since_last_play == 0
    assert kept["old"].days_since_last_play == 60 and kept["old"].active_days_w30 == 0


def test_activity_against_brute_force(spark):
    rng = random.Random(7)
    rows, obs = [], set()
    for _ in range(600):
        # one hot entity holds most rows
        m = "hot" if rng.random() < 0.6 else f"u{rng.randrange(8)}"
        secs = None if rng.random() < 0.05 else round(rng.uniform(0, 500), 2)
        rows.append((m, plus(D, rng.randrange(-70, 10)), rng.randrange(3), rng.randrange(4), secs))
        obs.add((m, plus(D, rng.randrange(-40, 10))))
    got = {(r.msno, r.snapshot_date): r for r in timeline.activity_features(logs(spark, rows), snaps(spark, list(obs))).collect()}
    for m, d in obs:
        inside = [r for r in rows if r[0] == m and d - dt.timedelta(30) <= r[1] <= d - dt.timedelta(1)]
        if not inside:
            assert (m, d) not in got
            continue
        g = got[(m, d)]
        secs = [r[4] for r in inside if r[4] is not None]
        assert g.sum_secs_w30 == pytest.approx(sum(secs))
        assert g.sum_secs_w7 == pytest.approx(sum(r[4] for r in inside if r[4] is not None and r[1] >= d - dt.timedelta(7)))
        days = sorted({r[1] for r in inside})
        assert g.active_days_w30 == len(days)
        assert g.num_unq_w30_sum == sum(r[3] for r in inside)
        assert g.days_since_last_play == (d - max(r[1] for r in rows if r[0] == m and r[1] <= d)).days
        pts = [(i + 1, [r[4] for r in inside if r[1] == x and r[4] is not None]) for i, x in enumerate(days)]
        xy = [(i, sum(v)) for i, v in pts if v]
        var = np.var([i for i, _ in pts])
        cov = np.mean([i * v for i, v in xy]) - np.mean([i for i, _ in xy]) * np.mean([v for _, v in xy]) if xy else 0
        assert g.trend_secs_w30 == pytest.approx(cov / (var or 1) if var else 0, abs=1e-7)


def test_asof_and_share_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"u{rng.randrange(5)}", plus(D, rng.randrange(-20, 5)),
             plus(D, rng.randrange(0, 30)), rng.randrange(2), rng.randrange(100)) for _ in range(300)]
    obs = list({(r[0], plus(D, rng.randrange(-25, 6))) for r in rows for _ in range(3)})
    txn = spark.createDataFrame(rows, TXN)
    reg = snaps(spark, obs).withColumn("registration_date", F.lit("2023-01-01").cast("date"))
    got = {(r.msno, r.snapshot_date): r for r in timeline.transaction_features(txn, reg).collect()}
    asof = {(r.msno, r.snapshot_date): r for r in timeline.asof_latest(
        txn, snaps(spark, obs), ["is_auto_renew", "plan_list_price"], tie_break=["membership_expire_date"]).collect()}
    assert set(got) == set(obs)
    for m, d in obs:
        past = [r for r in rows if r[0] == m and r[1] <= d]
        g = got[(m, d)]
        if not past:
            assert (g.tenure_days, g.last_is_auto_renew, g.last_plan_list_price, g.auto_renew_share) == (0, 0, 0, 0)
            assert (m, d) not in asof
            continue
        last = max(past, key=lambda r: (r[1], r[2], r[3], r[4]))
        assert (g.last_is_auto_renew, g.last_plan_list_price) == last[3:]
        assert (asof[(m, d)].is_auto_renew, asof[(m, d)].plan_list_price) == last[3:]
        assert g.tenure_days == (last[1] - day("2023-01-01")).days
        assert g.auto_renew_share == pytest.approx(sum(r[3] for r in past) / len(past))


def test_window_join_equals_plain_join(spark):
    rng = random.Random(5)
    facts = spark.createDataFrame(
        [(f"u{rng.randrange(3)}", plus(D, rng.randrange(-60, 20)), i) for i in range(200)], "msno string, date date, i int")
    obs = snaps(spark, [(f"u{k}", plus(D, o)) for k in range(3) for o in (-20, -3, 0, 5)])
    for lo, hi in ((-30, -1), (-7, -1), (0, 30), (-1, 0)):
        got = timeline.window_join(facts, obs, lo, hi).select("msno", "snapshot_date", "i")
        want = facts.join(obs, "msno").where(F.datediff("date", "snapshot_date").between(lo, hi)).select(
            "msno", "snapshot_date", "i")
        assert sorted(got.collect()) == sorted(want.collect())


def test_recency_and_null_dates(spark):
    facts = spark.createDataFrame([("a", day(D)), ("a", None), ("b", plus(D, 1))], "msno string, date date")
    obs = snaps(spark, [("a", plus(D, 4)), ("b", day(D)), ("b", plus(D, 1))])
    assert records(timeline.recency(facts, obs), "msno", "snapshot_date") == [
        {"msno": "a", "snapshot_date": plus(D, 4), "days_since_last": 4},
        {"msno": "b", "snapshot_date": plus(D, 1), "days_since_last": 0},
    ]


def test_latest_table_row_after_observation_is_ignored(spark):
    txn = spark.createDataFrame([("a", plus(D, 3), plus(D, 30), 1, 50)], TXN)
    reg = snaps(spark, [("a", day(D)), ("a", plus(D, 5))]).withColumn("registration_date", F.lit("2024-02-01").cast("date"))
    out = records(timeline.latest_table_features(txn, txn, reg), "snapshot_date")
    assert [r["last_plan_list_price"] for r in out] == [0, 50]
    assert [r["tenure_days"] for r in out] == [0, 32]
    assert [r["auto_renew_share"] for r in out] == [0.0, 1.0]


def test_known_bounds_reach_the_scan_and_change_nothing(spark, tmp_path):
    rng = random.Random(13)
    rows = [(f"u{rng.randrange(4)}", plus(D, rng.randrange(-90, 40)), 1, 2, 5.0) for _ in range(300)]
    path = str(tmp_path / "logs")
    logs(spark, rows).write.parquet(path)
    table = spark.read.parquet(path)
    obs = snaps(spark, [(f"u{k}", plus(D, o)) for k in range(4) for o in (0, 3, 9)])
    bounded = timeline.activity_features(table, obs, bounds=(D, str(plus(D, 9))))
    assert sorted(bounded.collect()) == sorted(timeline.activity_features(table, obs).collect())
    assert "LessThan(date" in bounded._jdf.queryExecution().executedPlan().toString()
    stamped = table.withColumn("date", F.col("date").cast("timestamp") + F.expr("INTERVAL 20 HOURS"))
    assert sorted(timeline.activity_features(stamped, obs, bounds=(D, str(plus(D, 9)))).collect()) == sorted(bounded.collect())


def test_daily_logs_need_no_first_aggregate(spark):
    rng = random.Random(4)
    rows = [(f"u{u}", day("2024-01-01") + dt.timedelta(days=d), *[rng.randrange(9) for _ in range(6)], float(rng.randrange(99)))
            for u in range(4) for d in range(60) if rng.random() < 0.5]
    logs = spark.createDataFrame(rows, "msno string, date date, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, total_secs double")
    snaps = spark.createDataFrame([(f"u{u}", day(d)) for u in range(4) for d in ("2024-02-10", "2024-02-20", "2024-02-28")], "msno string, snapshot_date date")
    for bounds in (None, ("2024-02-10", "2024-02-28")):
        once = timeline.activity_features(logs, snaps, bounds=bounds, daily=True)
        assert records(once, "msno", "snapshot_date") == records(timeline.activity_features(logs, snaps, bounds=bounds), "msno", "snapshot_date")
