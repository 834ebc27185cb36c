"""Splits, sampling and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, splits
from .base import TRAIN_DATE, query

WINDOWS = f"""
    SELECT 'train' AS split, CAST(DATE '{TRAIN_DATE}' - INTERVAL 14 MONTH AS DATE) AS start_date, CAST(DATE '{TRAIN_DATE}' - INTERVAL 6 MONTH AS DATE) - 1 AS end_date
    UNION ALL SELECT 'val', CAST(DATE '{TRAIN_DATE}' - INTERVAL 6 MONTH AS DATE), CAST(DATE '{TRAIN_DATE}' - INTERVAL 4 MONTH AS DATE) - 1
    UNION ALL SELECT 'test', CAST(DATE '{TRAIN_DATE}' - INTERVAL 4 MONTH AS DATE), CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE) - 1
    UNION ALL SELECT 'oot', CAST(DATE '{TRAIN_DATE}' - INTERVAL 2 MONTH AS DATE), DATE '{TRAIN_DATE}' - 1"""
TAGGED = f"(SELECT l.*, w.split FROM o_label l JOIN ({WINDOWS}) w ON l.snapshot_date BETWEEN w.start_date AND w.end_date)"


# The windows of a training date that the data supplies: the day after the last observation.
@query("M1", """
    SELECT split, CAST(d - to_months(s) AS DATE) AS start_date, CAST(d - to_months(e) AS DATE) - 1 AS end_date
    FROM (SELECT max(transaction_date) + 1 AS d FROM o_txn) x
    CROSS JOIN (VALUES ('train', 14, 6), ('val', 6, 4), ('test', 4, 2), ('oot', 2, 0)) v(split, s, e)""")
def split_windows(t):
    last = t.o_txn.agg(F.date_add(F.max("transaction_date"), 1)).first()[0]
    return splits.split_windows(t.spark, str(last))


@query("M2", f"SELECT snapshot_date, msno, is_churn, split FROM {TAGGED} x")
def temporal_split(t):
    return splits.temporal_split(t.o_label, TRAIN_DATE)


@query("M7", f"SELECT split, count(*) AS n, avg(CAST(is_churn AS DOUBLE)) AS label_mean FROM {TAGGED} x GROUP BY split",
       ["label_mean"])
def split_stats(t):
    return splits.split_stats(splits.temporal_split(t.o_label, TRAIN_DATE), "is_churn")


HASH = "md5(concat_ws('|', '42', CAST(msno AS VARCHAR), CAST(snapshot_date AS VARCHAR)))"


@query("M3", f"""SELECT * FROM o_label WHERE
    CAST(CAST('0x' || substr({HASH}, 1, 7) AS BIGINT) AS DOUBLE) / 268435456 < 0.3""")
def stratified_sample(t):
    return splits.stratified_sample(t.o_label, "is_churn", 0.3, keys=splits.KEYS)


@query("M3", None)
def stratified_sample_random(t):
    return splits.stratified_sample(t.o_label, "is_churn", 0.3)


@query("M4", None)
def random_sample(t):
    return splits.random_sample(t.o_txn, 0.1)


@query("M5", f"""
    SELECT snapshot_date, msno, is_churn, CASE WHEN row_number() OVER (PARTITION BY is_churn ORDER BY {HASH}, msno, snapshot_date) - 1
             < floor(count(*) OVER (PARTITION BY is_churn) * 0.8 + 0.5) THEN 'train' ELSE 'test' END AS part FROM o_label""")
def stratified_split(t):
    return splits.stratified_split(t.o_label, "is_churn", 0.8)


@query("M6", f"""
    SELECT snapshot_date, msno, is_churn, CAST((row_number() OVER (PARTITION BY is_churn ORDER BY {HASH}, msno, snapshot_date) - 1) % 5 AS INTEGER)
      AS fold FROM o_label""")
def assign_folds(t):
    return splits.assign_folds(t.o_label, "is_churn", 5)


GAPPY = """(SELECT m.msno, m.city_clean, m.registered_via, m.registration_date, a.paid, a.n FROM o_members m
    LEFT JOIN (SELECT msno, CAST(sum(plan_list_price) AS BIGINT) AS paid, count(*) AS n FROM o_txn WHERE is_cancel = 1 GROUP BY msno) a ON a.msno = m.msno)"""


def gappy(t):
    paid = t.o_txn.where("is_cancel = 1").groupBy("msno").agg(
        F.sum("plan_list_price").alias("paid"), F.count(F.lit(1)).alias("n"))
    return t.o_members.join(paid, "msno", "left")


@query("E1", f"""SELECT msno, coalesce(city_clean, 0) AS city_clean, registered_via, registration_date, coalesce(paid, 0) AS paid, coalesce(n, 0) AS n,
    CASE WHEN city_clean IS NULL OR paid IS NULL OR n IS NULL THEN 1 ELSE 0 END AS missing_any FROM {GAPPY} g""")
def missing_flag_fill(t):
    return prep.missing_flag_fill(gappy(t), ["city_clean", "paid", "n"])


@query("E2", f"""SELECT msno, coalesce(city_clean, 0) AS city_clean, registered_via, registration_date, coalesce(paid, 0) AS paid, coalesce(n, 0) AS n,
    CASE WHEN paid IS NULL OR n IS NULL THEN 1 ELSE 0 END AS is_missing_activity,
    CASE WHEN city_clean IS NULL THEN 1 ELSE 0 END AS is_missing_demo FROM {GAPPY} g""")
def missing_flags(t):
    return prep.missing_flags(gappy(t), {"is_missing_activity": ["paid", "n"], "is_missing_demo": ["city_clean"]},
                              ["city_clean", "paid", "n"])


@query("E3", "SELECT msno, " + ", ".join(
    f"CASE WHEN registered_via = {v} THEN 1 ELSE 0 END AS registered_via_{v}" for v in range(1, 5)) + ", " + ", ".join(
    f"CASE WHEN city_clean = {v} THEN 1 ELSE 0 END AS city_clean_{v}" for v in range(2, 8)) + " FROM f_members")
def one_hot(t):
    m = t.f_members.select("msno", "registered_via", "city_clean")
    return prep.OneHot.fit(m, ["registered_via", "city_clean"]).transform(m)


@query("E4", None)
def category_pipeline(t):
    m = t.o_members.select("msno", F.col("city_clean").cast("string").alias("city_clean"), "registered_via")
    out = prep.category_pipeline(["city_clean", "registered_via"]).fit(m).transform(m)
    return out.select("msno", "city_clean_idx", "registered_via_idx", F.col("city_clean_oh").cast("string").alias("city_oh"),
                      F.col("registered_via_oh").cast("string").alias("via_oh"))


SCALED = ", ".join(f"({c} - (SELECT avg({c}) FROM f_logs)) / (SELECT stddev_pop({c}) FROM f_logs) AS {c}"
                   for c in ("num_25", "num_100", "total_secs"))


@query("E5", f"SELECT msno, date, {SCALED} FROM f_logs", ["num_25", "num_100", "total_secs"])
def standardise(t):
    logs = t.f_logs.select("msno", "date", "num_25", "num_100", "total_secs")
    return prep.Scaler.fit(logs, ["num_25", "num_100", "total_secs"]).transform(logs)


@query("E6", """SELECT msno, row_id, is_cancel, is_auto_renew,
    (plan_list_price - (SELECT avg(plan_list_price) FROM o_txn)) / (SELECT stddev_pop(plan_list_price) FROM o_txn) AS plan_list_price FROM o_txn""",
       ["plan_list_price"])
def standardise_numeric_only(t):
    txn = t.o_txn.select("msno", "row_id", "is_cancel", "is_auto_renew", "plan_list_price")
    scaler = prep.Scaler.fit(txn, ["is_cancel", "is_auto_renew", "plan_list_price"], exclude=["is_cancel", "is_auto_renew"])
    return scaler.transform(txn)


@query("E7", """SELECT l.snapshot_date, l.msno, l.is_churn, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY is_churn)) AS weight
    FROM o_label l""", ["weight"])
def class_weights(t):
    return prep.class_weights(t.o_label, "is_churn")


@query("E8", """SELECT CAST(count(*) FILTER (WHERE is_churn = 0) AS DOUBLE) / count(*) FILTER (WHERE is_churn = 1) AS scale_pos_weight FROM o_label""",
       ["scale_pos_weight"])
def pos_weight(t):
    return prep.pos_weight(t.o_label, "is_churn")


@query("E8", """SELECT *, CASE WHEN is_churn = 1 THEN (SELECT CAST(count(*) FILTER (WHERE is_churn = 0) AS DOUBLE) / count(*) FILTER (WHERE is_churn = 1)
    FROM o_label) ELSE 1 END AS weight FROM o_label""", ["weight"])
def pos_weight_rows(t):
    return prep.with_pos_weight(t.o_label, "is_churn")


@query("E9 P16", """SELECT msno, row_id, CAST(plan_list_price AS DOUBLE) AS plan_list_price, CAST(0 AS DOUBLE) AS city_clean_9,
    CAST(is_cancel AS DOUBLE) AS is_cancel FROM o_txn""")
def align_features(t):
    df = t.o_txn.withColumn("plan_list_price", F.col("plan_list_price").cast("string"))
    chosen = prep.features_with_prefix(df, ["plan_list", "is_can"])
    return prep.align_features(df, [*chosen, "city_clean_9"], ["msno", "row_id"])
