import itertools
import random

from pyspark.sql import functions as F

from lapsewatch.functions.columns import with_row_id
from lapsewatch.operators import labels, latest, snapshots, timeline
from helpers import day, plus, records

D = "2024-03-01"
TXN = "msno string, transaction_date date, membership_expire_date date, is_cancel int, row_id int"


def reference_choice(rows):
    """Rank the rows of the last date by plan length; a cancellation of rank 2 wins, else the longest plan."""
    last = max(r[1] for r in rows)
    tied = [r for r in rows if r[1] == last]
    plan = {r[4]: (r[2] - r[1]).days for r in tied}
    rank = {r[4]: 1 + sum(plan[o[4]] > plan[r[4]] for o in tied) for r in tied}
    return max(tied, key=lambda r: (r[3] == 1 and rank[r[4]] == 2, plan[r[4]], r[3], r[4]))


def test_latest_transaction_all_small_cases(spark):
    rows, n = [], 0
    for case, combo in enumerate(itertools.product([(5, 0), (5, 1), (9, 0), (9, 1), (12, 1)], repeat=3)):
        for plan, cancel in combo:
            n += 1
            rows.append((f"c{case}", day(D), plus(D, plan), cancel, n))
        n += 1
        rows.append((f"c{case}", plus(D, -1), plus(D, 90), 1, n))
    got = {r.msno: r.row_id for r in latest.latest_transaction(spark.createDataFrame(rows, TXN), tie_break=["row_id"]).collect()}
    for m, group in itertools.groupby(rows, key=lambda r: r[0]):
        assert got[m] == reference_choice(list(group))[4], m


def test_latest_transaction_snapshot_bound(spark):
    df = spark.createDataFrame([("a", day(D), plus(D, 5), 0, 1), ("a", plus(D, 1), plus(D, 9), 0, 2)], TXN)
    row = latest.latest_transaction(df, D).first()
    assert row.row_id == 1 and row.snapshot_date == day(D) and row.total_plan_days == 5
    assert latest.latest_transaction(df).first().snapshot_date == plus(D, 1)
    assert latest.latest_transaction(df.limit(0)).count() == 0


def test_tied_rank_and_flags(spark):
    df = spark.createDataFrame([
        ("a", day(D), plus(D, 9), 0, 1), ("a", day(D), plus(D, 9), 0, 2), ("a", day(D), plus(D, 5), 1, 3),
        ("b", day(D), plus(D, 9), 0, 4), ("b", day(D), plus(D, 5), 1, 5), ("b", plus(D, -1), plus(D, 50), 1, 6)], TXN)
    out = {r.row_id: (r.plan_days_rank, r.cancellation_in_group, r.final_priority)
           for r in latest.tied_transactions(df).collect()}
    assert out == {1: (1, 1, 1), 2: (1, 1, 1), 3: (3, 1, 0), 4: (1, 1, 1), 5: (2, 1, 1)}


def test_expiry_snapshots_equal_literal_grid(spark):
    rng = random.Random(11)
    rows = [(f"u{rng.randrange(6)}", plus(D, rng.randrange(-20, 20)), plus(D, rng.randrange(-10, 25)), 0, i) for i in range(150)]
    df = spark.createDataFrame(rows, TXN)
    got = {(r.msno, r.snapshot_date): r.row_id for r in latest.expiry_snapshots(
        df, D, str(plus(D, 14)), ["transaction_date", "row_id"]).collect()}
    want = {}
    for m in {r[0] for r in rows}:
        for o in range(15):
            upto = [r for r in rows if r[0] == m and r[2] <= plus(D, o)]
            if upto:
                top = max(upto, key=lambda r: (r[2], r[1], r[4]))
                if top[2] == plus(D, o):
                    want[(m, plus(D, o))] = top[4]
    assert got == want


def test_label_window_edges(spark):
    cases = {"before": (-1, 0, 1), "same": (0, 0, 0), "last": (30, 0, 0), "after": (31, 0, 1), "cancelled": (5, 1, 1)}
    txn = spark.createDataFrame([(k, plus(D, o), plus(D, 60), c, 1) for k, (o, c, _) in cases.items()], TXN)
    obs = spark.createDataFrame([(k, day(D)) for k in [*cases, "none"]], "msno string, snapshot_date date")
    got = {r.msno: r.is_churn for r in labels.churn_label(obs, txn).collect()}
    assert got == {**{k: v for k, (_, _, v) in cases.items()}, "none": 1}
    shifted = {r.msno: r.is_churn for r in labels.churn_label(obs, txn, offset=1).collect()}
    assert shifted["same"] == 1 and shifted["last"] == 0


def test_label_stats_of_empty_table(spark):
    empty = spark.createDataFrame([], "snapshot_date date, msno string, is_churn int")
    assert labels.label_stats(empty).first().churn_rate == 0
    assert labels.label_rate(empty, ["snapshot_date"]).count() == 0


def test_grid_starts_at_registration(spark):
    m = spark.createDataFrame([("a", day("2024-01-30")), ("b", day("2024-02-02")), ("c", day("2024-03-09")), ("d", None)],
                              "msno string, registration_date date")
    grid = snapshots.snapshot_grid(m, "2024-02-01", "2024-02-03", "registration_date")
    got = records(grid.groupBy("msno").count(), "msno")
    assert got == [{"msno": "a", "count": 3}, {"msno": "b", "count": 2}]


def test_select_and_new_snapshots(spark):
    df = spark.createDataFrame([(day(D),), (plus(D, 1),), (plus(D, 2),)], "snapshot_date date")
    built = df.where(F.col("snapshot_date") == day(D))
    pick = lambda *a, **k: [r[0] for r in snapshots.select_snapshots(df, *a, **k).orderBy("snapshot_date").collect()]
    assert len(pick()) == 3
    assert pick("date", D) == [day(D)]
    assert pick("range", D, str(plus(D, 1))) == [day(D), plus(D, 1)]
    assert pick("incremental", existing=built) == [plus(D, 1), plus(D, 2)]
    assert [str(r[0]) for r in snapshots.month_starts(spark, "2023-11-15", "2024-02-01").collect()] == [
        "2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]


def test_defaults_do_not_depend_on_row_order(spark):
    rows = [("a", day("2024-01-01"), day("2024-01-31"), 0, p) for p in range(20)]
    df = spark.createDataFrame(rows, "msno string, transaction_date date, membership_expire_date date, is_cancel int, price int")
    for part in (df, df.orderBy("price"), df.repartition(5)):
        assert latest.expiry_snapshots(part, "2024-01-01", "2024-02-28").first().price == 19
        assert latest.latest_transaction(part).first().price == 19


def test_observations_outside_bounds_are_left_out(spark):
    txn = spark.createDataFrame([("a", day("2024-03-05"), 0)], "msno string, transaction_date date, is_cancel int")
    obs = spark.createDataFrame([("a", day("2024-01-05")), ("a", day("2024-03-01"))], "msno string, snapshot_date date")
    out = labels.churn_label(obs, txn, 10, bounds=("2024-01-01", "2024-01-31")).collect()
    assert [(r.snapshot_date, r.is_churn) for r in out] == [(day("2024-01-05"), 1)]


def test_row_ids_do_not_collide(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("1:x", None), (None, "1:x"), ("", None), (None, ""), ("\\N", None)], "x string, y string")
    assert with_row_id(df, ["x", "y"]).select("row_id").distinct().count() == 7


def test_latest_table_falls_back_to_the_past(spark):
    txn = spark.createDataFrame(
        [("a", day("2024-01-01"), day("2024-02-01"), 1, 10), ("a", day("2024-03-01"), day("2024-04-01"), 0, 20)],
        "msno string, transaction_date date, membership_expire_date date, is_auto_renew int, plan_list_price int")
    table = txn.where("plan_list_price = 20").withColumn("is_cancel", F.lit(0))
    reg = spark.createDataFrame([("a", day("2024-02-01"), day("2023-12-31")), ("a", day("2024-03-02"), day("2023-12-31"))],
                                "msno string, snapshot_date date, registration_date date")
    out = {str(r.snapshot_date): (r.tenure_days, r.last_is_auto_renew, r.last_plan_list_price)
           for r in timeline.latest_table_features(txn, table, reg).collect()}
    assert out == {"2024-02-01": (1, 1, 10), "2024-03-02": (61, 0, 20)}
