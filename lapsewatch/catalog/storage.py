"""Readers and writers: each query writes tables made from the given ones and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import with_year_month
from ..operators import clean, models, monitor
from ..sources import merge, readers, writers
from .base import START_SQL, query

CSV = "row_id bigint, msno bigint, plan_list_price int, transaction_date date"
CSV_COLS = ["row_id", "msno", "plan_list_price", "transaction_date"]


def _dated(t):
    return with_year_month(t.o_txn, "transaction_date", numeric=False)


@query("S1 S12 S10", "SELECT row_id, msno, plan_list_price, transaction_date FROM o_txn")
def csv_round_trip(t):
    path = writers.shared_folder(t.spark)
    writers.write_csv(t.o_txn.select(*CSV_COLS), path, files=2)
    return readers.read_csv(t.spark, path, CSV)


@query("S2 S12", "SELECT row_id, msno, plan_list_price, transaction_date FROM o_txn UNION ALL SELECT row_id, msno, plan_list_price, transaction_date FROM f_txn")
def csv_two_files(t):
    a, b = writers.shared_folder(t.spark), writers.shared_folder(t.spark)
    writers.write_csv(t.o_txn.select(*CSV_COLS), a)
    writers.write_csv(t.f_txn.select(*CSV_COLS), b)
    return readers.read_csv(t.spark, [a, b], CSV)


@query("S12", "SELECT row_id, CAST(year(transaction_date) AS INTEGER) AS year FROM o_txn")
def csv_partitioned(t):
    path = writers.shared_folder(t.spark)
    writers.write_csv(_dated(t).select("row_id", "year"), path, ["year"])
    return readers.read_csv(t.spark, path, "row_id bigint, year int")


@query("S3", "SELECT * FROM orders")
def table_scan(t):
    return readers.read_table(t.spark, f"{t.dir}/orders.parquet")


@query("S4 S8", """SELECT row_id, msno, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month
    FROM o_txn WHERE year(transaction_date) = 1997 AND month(transaction_date) = 4""")
def partition_scan(t):
    path = writers.shared_folder(t.spark)
    writers.write_table(_dated(t).select("row_id", "msno", "year", "month"), path, ["year", "month"])
    return readers.read_table(t.spark, path, where="year = 1997 AND month = 4")


@query("S5 S8", "SELECT msno, is_churn, snapshot_date FROM f_label WHERE snapshot_date = DATE '2024-01-10'")
def snapshot_scan(t):
    path = writers.shared_folder(t.spark)
    writers.write_table(t.f_label, path, ["snapshot_date"])
    return readers.read_snapshot(t.spark, path, "2024-01-10")


@query("S6", "SELECT row_id, msno FROM o_txn UNION ALL SELECT row_id, msno FROM f_txn")
def multi_path_scan(t):
    a, b = writers.shared_folder(t.spark), writers.shared_folder(t.spark)
    writers.write_table(t.o_txn.select("row_id", "msno"), a)
    writers.write_table(t.f_txn.select("row_id", "msno"), b)
    return readers.read_table(t.spark, [a, b])


@query("S7 P14", """SELECT msno, CAST(NULL AS INTEGER) AS city_clean, row_id FROM f_txn
    UNION ALL SELECT msno, city_clean, NULL FROM f_members""")
def merge_schema_scan(t):
    a, b = writers.shared_folder(t.spark), writers.shared_folder(t.spark)
    writers.write_table(t.f_txn.select("msno", "row_id"), a)
    writers.write_table(t.f_members.select("msno", "city_clean"), b)
    return readers.read_table(t.spark, [a, b], merge_schema=True).select("msno", "city_clean", "row_id")


@query("S9", """SELECT row_id, CAST(year(transaction_date) AS INTEGER) AS year,
    CASE WHEN year(transaction_date) = 1998 THEN 2 ELSE 1 END AS v FROM o_txn WHERE year(transaction_date) <> 1998 OR is_cancel = 1""")
def overwrite_partitions(t):
    path = writers.shared_folder(t.spark)
    rows = _dated(t).select("row_id", "is_cancel", "year")
    writers.write_table(rows.drop("is_cancel").withColumn("v", F.lit(1)), path, ["year"])
    again = rows.where("year = 1998 AND is_cancel = 1").drop("is_cancel").withColumn("v", F.lit(2))
    writers.write_table(again, path, ["year"], "overwrite_partitions")
    return readers.read_table(t.spark, path)


@query("S10", "SELECT * FROM o_members")
def bounded_files_table(t):
    path = writers.shared_folder(t.spark)
    writers.write_table(t.o_members, path, files=3)
    return readers.read_table(t.spark, path)


@query("S11 Q12", """SELECT msno, transaction_date AS snapshot_date, row_id, plan_list_price / CAST(1000 AS DOUBLE) AS churn_proba,
    'a' AS model_file FROM f_txn WHERE transaction_date = DATE '2024-01-10'""", ["churn_proba"])
def predictions_table(t):
    path = writers.shared_folder(t.spark)
    scored = t.f_txn.select("msno", F.col("transaction_date").alias("snapshot_date"), "row_id",
                            (F.col("plan_list_price") / 1000.0).alias("churn_proba"))
    for model in ("a", "b", "a"):  # the second run of a replaces the first
        writers.write_predictions(scored.withColumn("model_file", F.lit(model)), path)
    return monitor.read_predictions(t.spark, path, "a", "2024-01-10")


@query("S11", "SELECT row_id, msno FROM f_txn UNION ALL SELECT row_id, msno FROM o_txn")
def append_table(t):
    path = writers.shared_folder(t.spark)
    writers.write_table(t.f_txn.select("row_id", "msno"), path)
    writers.write_table(t.o_txn.select("row_id", "msno"), path, mode="append")
    return readers.read_table(t.spark, path)


@query("S13 Q2", """SELECT CAST(i AS INTEGER) AS decile, b[i + 1] AS base, c[i + 1] AS current FROM (SELECT unnest(range(11)) AS i,
    (SELECT quantile_cont(score, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]) FROM f_score WHERE side = 'base') AS b,
    (SELECT quantile_cont(score, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]) FROM f_score WHERE side = 'cur') AS c)""", ["base", "current"])
def decile_report_files(t):
    path, table = writers.shared_folder(t.spark), writers.shared_folder(t.spark)
    shift = monitor.decile_shift(t.base, t.cur, "score").select("decile", "base", "current")
    writers.write_report(shift, path)
    as_json = t.spark.read.schema("decile int, base double, current double").json(path)
    writers.write_report(as_json, table, "csv")
    return readers.read_csv(t.spark, table, "decile int, base double, current double")


@query("S14 J10", "SELECT msno, snapshot_date, CASE WHEN snapshot_date < DATE '2024-01-16' THEN 1 ELSE 2 END AS v FROM f_snap")
def write_if_absent(t):
    path = writers.shared_folder(t.spark)
    first = t.f_snap.where("snapshot_date < DATE'2024-01-16'").withColumn("v", F.lit(1))
    writers.write_if_absent(first, path)
    for v in (2, 3):  # new dates only; the last run adds nothing
        writers.write_if_absent(t.f_snap.withColumn("v", F.lit(v)), path)
    return readers.read_table(t.spark, path)


@query("I1 S9 A21", """
    SELECT row_id, msno, v, year, month FROM (SELECT *, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
           CASE WHEN transaction_date >= DATE '2001-01-01' AND row_id % 2 = 0 THEN 2 ELSE 1 END AS v FROM o_txn)""")
def bronze_merge_on_disk(t):
    path = writers.shared_folder(t.spark)
    rows = _dated(t).select("row_id", "msno", "transaction_date", "year", "month")
    writers.write_table(rows.withColumn("v", F.lit(1)), path, ["year", "month"])
    new = rows.where("transaction_date >= DATE'2001-01-01' AND row_id % 2 = 0").withColumn("v", F.lit(2))
    for _ in range(2):  # merging twice changes nothing
        merge.merge_into(new, path, ["year", "month"], ["row_id"], [F.desc("v")])
    return readers.read_table(t.spark, path).select("row_id", "msno", "v", "year", "month")


@query("I1", "SELECT row_id, msno, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month FROM o_txn")
def streaming_merge(t):
    from ..streaming.ingest import ingest

    source, target, state = (writers.shared_folder(t.spark) for _ in range(3))
    writers.write_csv(t.o_txn.select(*CSV_COLS), source)
    for _ in range(2):  # the second run finds no new file
        run = ingest(t.spark, source, CSV, target, state,
                     lambda b: with_year_month(b, "transaction_date", numeric=False), ["year", "month"], ["row_id"],
                     [F.desc("transaction_date")])
        run.awaitTermination()
    return readers.read_table(t.spark, target).select("row_id", "msno", "year", "month")


@query("T10 Q12 S11", f"""SELECT msno, transaction_date AS snapshot_date, 1 / (1 + exp(-(-1.0 + plan_list_price * 0.001))) AS churn_proba, 'linear' AS model_file
    FROM f_txn WHERE transaction_date >= {START_SQL}""", ["churn_proba"], digits=9)
def backfill_linear(t):
    path = writers.shared_folder(t.spark)
    feats = t.f_txn.withColumn("snapshot_date", F.col("transaction_date")).where(f"snapshot_date >= DATE'{t.span[0]}'")
    writers.write_predictions(models.score_linear(feats, {"plan_list_price": 0.001}, -1.0), path)
    return clean.project(readers.read_table(t.spark, path), order=["msno", "snapshot_date", "churn_proba", "model_file"])


@query("P2 S2", """SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source_folder, true AS dated FROM o_txn""")
def audited_files(t):
    path = writers.shared_folder(t.spark)
    for n, name in enumerate(("even", "odd")):
        writers.write_table(t.o_txn.where(F.col("row_id") % 2 == n).select("row_id"), f"{path}/{name}")
    rows = readers.read_with_files(t.spark, [f"{path}/even", f"{path}/odd"])
    return rows.select("row_id", F.element_at(F.split("_source_file", "/"), -2).alias("source_folder"),
                       (F.col("_source_modified") > F.lit("2020-01-01").cast("timestamp")).alias("dated"))
