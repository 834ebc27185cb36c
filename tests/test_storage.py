import pytest
from pyspark.sql import functions as F

from lapsewatch import schema
from lapsewatch.functions.columns import with_year_month
from lapsewatch.plans import medallion
from lapsewatch.sources import merge, readers, writers
from lapsewatch.streaming.ingest import ingest
from helpers import day, records

SPEC = "msno string, transaction_date int, price int, v int"
PART, KEYS = ["year", "month"], ["msno", "transaction_date"]


def batch(spark, rows):
    return with_year_month(spark.createDataFrame(rows, SPEC), "transaction_date")


def content(spark, path):
    return sorted((r.msno, r.transaction_date, r.price, r.v) for r in spark.read.parquet(path).collect())


def test_merge_is_idempotent_and_touches_few_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    order = [F.desc("v")]
    merge.merge_into(batch(spark, [("a", 20160401, 1, 1), ("b", 20160501, 1, 1), ("b", 20160501, 9, 0)]), path, PART, KEYS, order)
    assert content(spark, path) == [("a", 20160401, 1, 1), ("b", 20160501, 1, 1)]
    april = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "bronze" / "year=2016" / "month=4").glob("*.parquet")}
    new = batch(spark, [("b", 20160501, 2, 2), ("c", 20160510, 3, 2), ("d", 20160601, 4, 2)])
    for _ in range(2):
        merge.merge_into(new, path, PART, KEYS, order)
        assert content(spark, path) == [
            ("a", 20160401, 1, 1), ("b", 20160501, 2, 2), ("c", 20160510, 3, 2), ("d", 20160601, 4, 2)]
    assert april == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "bronze" / "year=2016" / "month=4").glob("*.parquet")}


def test_touched_partitions_of_any_number(spark):
    days = spark.range(2000).select(F.date_add(F.lit("2015-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
    old = days.unionByName(spark.createDataFrame([(None, -1)], "d date, id long"))
    new = days.where("id % 2 = 1")
    assert merge.touched(old, new, ["d"]).agg(F.count("*"), F.sum("id")).first() == (1000, 1000 * 1000)
    null = spark.createDataFrame([(None, 5)], "d date, id long")
    assert [r.id for r in merge.touched(old, null, ["d"]).collect()] == [-1]
    assert merge.touched(old, new.limit(0), ["d"]).count() == 0


def test_touched_casts_to_the_stored_type(spark):
    old = spark.createDataFrame([(9, "a"), (10, "b"), (11, "c")], "p int, v string")
    new = spark.createDataFrame([("9", "x"), ("10", "y")], "p string, v string")
    assert sorted(r.v for r in merge.touched(old, new, ["p"]).collect()) == ["a", "b"]


@pytest.mark.parametrize("part", [["year", "month"], ["snapshot_date"]])
def test_replace_dates_removes_emptied_partitions(spark, tmp_path, part):
    path = str(tmp_path / "snap")
    rows = [("a", "2024-01-30"), ("b", "2024-02-01"), ("c", "2024-03-20")]
    df = with_year_month(spark.createDataFrame(rows, "msno string, d string").select(
        "msno", F.to_date("d").alias("snapshot_date")), "snapshot_date", numeric=False)
    merge.replace_dates(df, path, part, "snapshot_date", "2024-01-01", "2024-03-31")
    again = df.where("msno = 'a'").withColumn("msno", F.lit("z"))
    for _ in range(2):
        merge.replace_dates(again, path, part, "snapshot_date", "2024-01-01", "2024-02-29")
        assert sorted(r.msno for r in spark.read.parquet(path).collect()) == ["c", "z"]


def test_merge_adds_missing_columns(spark):
    old = batch(spark, [("a", 20160401, 1, 1)]).drop("price")
    new = batch(spark, [("b", 20160401, 5, 2)])
    out = merge.merge_partitions(new, old, PART, KEYS, [F.desc("v")]).collect()
    assert sorted((r.msno, r.price) for r in out) == [("a", None), ("b", 5)]


def test_replace_dates_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = [("a", "2024-01-30"), ("a", "2024-02-01"), ("b", "2024-02-20")]
    df = with_year_month(spark.createDataFrame(rows, "msno string, d string").select(
        "msno", F.to_date("d").alias("snapshot_date")), "snapshot_date", numeric=False)
    merge.replace_dates(df, path, PART, "snapshot_date", "2024-01-01", "2024-02-29")
    only = df.where("msno = 'b'").withColumn("msno", F.lit("z"))
    merge.replace_dates(only, path, PART, "snapshot_date", "2024-02-10", "2024-02-29")
    assert sorted(r.msno for r in spark.read.parquet(path).collect()) == ["a", "a", "z"]


def test_predictions_rerun_replaces(spark, tmp_path):
    path = str(tmp_path / "preds")
    preds = spark.createDataFrame([("a", day("2024-01-01"), 0.5, "m1"), ("a", day("2024-01-02"), 0.6, "m1")], schema.PREDICTIONS)
    for _ in range(2):
        writers.write_predictions(preds, path)
    assert spark.read.parquet(path).count() == 2


def test_absent_snapshot_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.createDataFrame([("a", day("2024-01-01"))], "msno string, snapshot_date date"), path, ["snapshot_date"])
    assert readers.read_snapshot(spark, path, "2024-01-01").count() == 1
    with pytest.raises(ValueError):
        readers.read_snapshot(spark, path, "2024-01-09")


def test_shared_folder_honours_the_session(spark):
    assert writers.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stream_merges_new_files_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    raw = "msno string, transaction_date int, price int, v int"

    def run():
        ingest(spark, source, raw, target, state, lambda b: with_year_month(b, "transaction_date"), PART, KEYS,
               [F.desc("v")]).awaitTermination()

    writers.write_csv(spark.createDataFrame([("a", 20160401, 1, 1)], SPEC), source, mode="append")
    run()
    writers.write_csv(spark.createDataFrame([("a", 20160401, 2, 2), ("b", 20160501, 1, 1)], SPEC), source, mode="append")
    run()
    run()
    assert content(spark, target) == [("a", 20160401, 2, 2), ("b", 20160501, 1, 1)]


def test_raw_to_gold(spark, tmp_path):
    members = spark.createDataFrame([("a", 1, 20, "male", 7, 20151201), ("b", 0, 30, None, 9, 20160105)], schema.MEMBERS_RAW)
    txn = spark.createDataFrame([
        ("a", 41, 30, 149, 149, 1, 20160101, 20160131, 0), ("a", 41, 30, 149, 149, 1, 20160131, 20160301, 0),
        ("b", 41, 30, 99, 99, 0, 20160110, 20160209, 0), ("b", 41, 30, 99, 99, 0, 20161399, 20160209, 0)],
        schema.TRANSACTIONS_RAW)
    logs = spark.createDataFrame([("a", 20160120 + i, 1, 1, 1, 1, 2, 4, 100.0) for i in range(5)], schema.USER_LOGS_RAW)
    s = medallion.silver(members, txn, logs)
    out = str(tmp_path / "gold")
    for _ in range(2):
        medallion.build_gold(s, out, "2016-01-01", "2016-02-29")
    labels = {(r.msno, str(r.snapshot_date)): r.is_churn for r in spark.read.parquet(f"{out}/label_store").collect()}
    assert labels == {("a", "2016-01-31"): 0, ("b", "2016-02-09"): 1}
    feats = {r.msno: r for r in spark.read.parquet(f"{out}/feature_store").collect()}
    assert feats["a"].sum_secs_w30 == 500 and feats["a"].active_days_w30 == 5 and feats["a"].complete_rate_w30 == 0.5
    assert feats["b"].sum_secs_w30 is None and feats["b"].city_clean is None and feats["b"].tenure_days_at_snapshot == 35
    assert feats["a"].last_plan_list_price == 149 and feats["a"].auto_renew_share == 1
    latest = records(spark.read.parquet(f"{out}/latest_transactions").select("msno", "snapshot_date"), "msno")
    assert [str(r["snapshot_date"]) for r in latest] == ["2016-01-31", "2016-01-10"]
    for _ in range(2):  # the same features, date by date from the carried state
        medallion.build_gold(s, f"{tmp_path}/daily", "2016-01-31", "2016-02-09", incremental=True)
    daily = {r.msno: r.asDict() for r in spark.read.parquet(f"{tmp_path}/daily/feature_store").collect()}
    assert daily == {k: r.asDict() for k, r in feats.items()}
