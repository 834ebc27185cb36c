import datetime as dt
import glob
import random

import pytest

from lapsewatch.catalog import base
from lapsewatch.catalog.base import REGISTRY
from lapsewatch.operators.timeline import METRICS, Activity, Payments, observation_features
from lapsewatch.operators.window_state import WindowState, bring_forward, state_dates
from lapsewatch.plans import medallion
from lapsewatch.sources.writers import write_table

FIRST = dt.date(2024, 3, 1)


def tables(spark, seed):
    rng = random.Random(seed)
    logs, txn = [], []
    for u in range(12):
        for d in range(60):
            if u and rng.random() < 0.35:
                day = FIRST + dt.timedelta(days=d - 45)
                for _ in range(rng.randrange(1, 3)):
                    logs.append((f"u{u}", day, *[rng.randrange(9) for _ in METRICS[:-1]], None if rng.random() < 0.1 else rng.random() * 100))
            if u != 3 and rng.random() < 0.06:
                day = FIRST + dt.timedelta(days=d - 45)
                txn.append((f"u{u}", day, day + dt.timedelta(days=rng.choice([7, 30])), rng.randrange(2), rng.randrange(200)))
    logs.append((None, FIRST, *[1] * 6, 1.0))
    kind = "msno string, date date, " + ", ".join(f"{m} long" for m in METRICS[:-1]) + ", total_secs double"
    return spark.createDataFrame(logs, kind), spark.createDataFrame(
        txn, "msno string, transaction_date date, membership_expire_date date, is_auto_renew int, plan_list_price int")


@pytest.mark.parametrize("today,keep", [(False, False), (True, True)])
def test_features_from_state_equal_those_from_all_facts(spark, tmp_path, today, keep):
    logs, txn = tables(spark, 7)
    act, path = Activity(wide=10, narrow=3, include_today=today), str(tmp_path / "state")
    spec = WindowState(act)
    users = [(f"u{u}", dt.date(2024, 1, 1)) for u in range(13)]
    for step in (0, 1, 2, 6, 7):  # days without a build in between are caught up
        date = FIRST + dt.timedelta(days=step)
        base = spark.createDataFrame([(u, date, r) for u, r in users], "msno string, snapshot_date date, registration_date date")
        state = bring_forward(spec, path, logs, txn, date.isoformat())
        got = {r["msno"]: r.asDict() for r in spec.features(base, state, date.isoformat(), keep).collect()}
        want = {r["msno"]: r.asDict() for r in observation_features(base, logs, txn, act, Payments(), keep).collect()}
        assert got.keys() == want.keys()
        for u in want:
            assert list(got[u]) == list(want[u])
            for name, value in want[u].items():
                assert got[u][name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (u, name, step)
    assert len(state_dates(spark, path)) == 5
    before = sorted(map(str, state.collect()))
    assert sorted(map(str, bring_forward(spec, path, logs, txn, date.isoformat()).collect())) == before


def test_an_advance_reads_only_new_facts(spark, tmp_path):
    logs, txn = tables(spark, 8)
    spec = WindowState(Activity(wide=10, narrow=3))
    a, b = FIRST.isoformat(), (FIRST + dt.timedelta(days=1)).isoformat()
    state = spec.start(logs, txn, a)
    logs.write.parquet(f"{tmp_path}/logs")
    old = spark.read.parquet(f"{tmp_path}/logs")
    plan = spec.advance(state, old, txn, a, b)._jdf.queryExecution().executedPlan().toString()
    assert any("GreaterThanOrEqual(date" in line for line in plan.splitlines() if "PushedFilters" in line)
    new = logs.where(f"date > '{a}'")  # the history may be gone
    assert sorted(map(str, spec.advance(state, new, txn, a, b).collect())) == sorted(map(str, spec.advance(state, logs, txn, a, b).collect()))


def test_entities_without_history(spark):
    logs, txn = tables(spark, 9)
    spec, date = WindowState(), FIRST.isoformat()
    state = spec.start(logs.limit(0), txn.limit(0), date)
    base = spark.createDataFrame([("x", FIRST, FIRST)], "msno string, snapshot_date date, registration_date date")
    row = spec.features(base, state, date).first().asDict()
    assert row["active_days_w30"] is None and row["auto_renew_share"] == 0 and row["tenure_days"] == 0


def test_a_build_neither_counts_nor_broadcasts_the_state(spark, tmp_path):
    logs, txn = tables(spark, 10)
    path = str(tmp_path / "state")
    dates = [FIRST + dt.timedelta(days=d) for d in (0, 3)]
    for date in dates:
        state = bring_forward(WindowState(Activity(wide=10, narrow=3)), path, logs, txn, date.isoformat())
    users = spark.createDataFrame([("u1", dates[-1], FIRST)], "msno string, snapshot_date date, registration_date date")
    plan = WindowState(Activity(wide=10, narrow=3)).features(users, state, dates[-1].isoformat())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    group = "dates-of-the-states"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert state_dates(spark, path) == [d.isoformat() for d in dates]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)  # folders, no job
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert state_dates(spark, str(tmp_path / "none")) == []


def test_one_partition_value_is_written_where_it_was_made(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "DATE '2024-03-01' AS state_date")
    files = {}
    for gather in (True, False):
        write_table(rows, f"{tmp_path}/{gather}", ["state_date"], "overwrite_partitions", gather=gather)
        files[gather] = len(glob.glob(f"{tmp_path}/{gather}/state_date=2024-03-01/*.parquet"))
    assert files == {True: 1, False: 4}


def test_the_query_stores_the_members(spark, monkeypatch):
    given = []
    monkeypatch.setattr(medallion, "extend_inference", lambda members, *a: given.append(members.inputFiles()) or spark.range(1))
    REGISTRY["inference_features_from_state"].build(base.Tables(spark, "/root/testdata/sf0.001"))
    assert len(given) == 7 and not any("events" in f for files in given for f in files)
