import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewatch import schema
from lapsewatch.functions import columns
from lapsewatch.operators import clean, members, outliers, profile
from helpers import day, records


def test_parse_dates(spark):
    df = spark.createDataFrame([(20160131,), (20161399,), (None,), (1010101,)], "d int")
    got = [r[0] for r in df.select(columns.parse_yyyymmdd("d")).collect()]
    assert got[0] == day("2016-01-31") and got[1] is None and got[2] is None and got[3] == day("0101-01-01")


def test_transactions_typed_and_filtered(spark):
    rows = [(" A ", 1, 30, 149, 149, 1, 20160101, 20160131, 0), ("b", 2, 30, 99, 99, 0, 20161399, 20160131, 0),
            (None, 2, 30, 99, 99, 0, 20160101, 20160131, 0)]
    out = clean.clean_transactions(spark.createDataFrame(rows, schema.TRANSACTIONS_RAW))
    assert out.count() == 1
    row = out.first()
    assert (row.transaction_date, row.year, row.month, row.payment_method_id) == (day("2016-01-01"), 2016, 1, "1")


def test_members_codes_and_case(spark):
    rows = [(" Ab ", c, 20, "male", 7, 20160101) for c in (0, -1, None, 3)] + [("ab", 1, 20, "male", 7, 20160101)]
    out = members.clean_members(spark.createDataFrame(rows, schema.MEMBERS_RAW)).collect()
    assert [r.city_clean for r in out] == [None, None, None, 3, 1]
    assert {r.msno for r in out} == {"Ab", "ab"}


def test_validity_and_rejects(spark):
    df = spark.createDataFrame(
        [(30, 1, 1, day("2024-01-01"), day("2024-01-31")), (-1, 1, 1, day("2024-01-01"), day("2023-01-31")),
         (30, None, 1, day("2024-01-01"), day("2024-01-01"))],
        "payment_plan_days int, plan_list_price int, actual_amount_paid int, transaction_date date, membership_expire_date date")
    rules = clean.validity_rules()
    assert clean.keep_valid(df, rules).count() == 1
    assert sorted(r.broken_rules for r in clean.rejects(df, rules).collect()) == ["list_price", "plan_days,expiry_order"]


def test_enum_and_frequent(spark):
    df = spark.createDataFrame([(" Male",), ("female",), ("x",), (None,)], "gender string")
    out = columns.normalise_enum(df, "gender", ["male", "female"]).collect()
    assert [r.gender_norm for r in out] == ["male", "female", "unknown", "unknown"]
    assert [(r.gender_male, r.gender_female, r.gender_unknown) for r in out] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1)]
    ages = spark.createDataFrame([(13,)] * 5 + [(20,)] * 3 + [(30,)] * 2 + [(None,)], "bd int")
    kept = records(clean.keep_frequent(ages, "bd", 14, 68, 3).groupBy("bd_clean").count(), "bd_clean")
    assert kept == [{"bd_clean": 20, "count": 3}, {"bd_clean": None, "count": 8}]


def test_name_resolution(spark):
    df = spark.createDataFrame([("a", "0.5", 3)], "Member_ID string, my_churn_proba string, other int")
    assert clean.canonical_id(df).columns[0] == "msno"
    assert clean.score_column(df) == "my_churn_proba"
    assert clean.canonical_score(df).first().prediction_proba == 0.5
    assert clean.score_column(df.select("other")) == "other"
    assert clean.score_column(spark.createDataFrame([(1.0, 2.0)], "pred_x double, score double")) == "score"
    with pytest.raises(KeyError):
        clean.score_column(df.select("Member_ID"))
    with pytest.raises(KeyError):
        clean.canonical_id(df.select("other"))
    with pytest.raises(ValueError):
        clean.canonical_score(spark.createDataFrame([("x",)], "score string"))
    assert clean.resolve_label(spark.createDataFrame([(1,)], "is_churn int"), "label") == "is_churn"
    with pytest.raises(ValueError):
        clean.resolve_label(df, "label")


def test_alignment(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2.5, 2)], "v double, k int")
    both = clean.union_aligned(a, b)
    assert sorted(map(tuple, both.select("k", "s", "v").collect()), key=str) == [(1, "x", None), (2, None, 2.5)]
    fixed = clean.align(b, T.StructType.fromDDL("s string, k bigint"))
    assert fixed.columns == ["s", "k"] and fixed.first().k == 2
    with pytest.raises(ValueError):
        schema.check(a, schema.LABELS)


def test_row_id_and_numbers(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "1.5"), ("b", "x")], "k string, v string")
    ids = [r.row_id for r in columns.with_row_id(df, ["k", "v"]).collect()]
    assert len(set(ids)) == 4
    assert [r.v for r in columns.to_number(df, ["v"]).collect()] == [0.0, 0.0, 1.5, 0.0]


def test_iqr_per_month(spark):
    rows = [("u", 20240101 + i, 1, 1, 1, 1, 1, 1, float(i)) for i in range(20)]
    rows += [("u", 20240125, 1, 1, 1, 1, 1, 1, 1000.0), ("u", 20240126, 1, 1, 1, 1, 1, 1, -5.0)]
    rows += [("u", 20240201 + i, 1, 1, 1, 1, 1, 1, 1000.0 + i) for i in range(20)]
    raw = spark.createDataFrame(rows, schema.USER_LOGS_RAW)
    out = outliers.clean_user_logs(raw, exact=True)
    assert out.count() == 40 and out.where("total_secs = 1000 AND month = 1").count() == 0
    assert dict(out.dtypes)["date"] == "date"
    assert outliers.clean_user_logs(raw).count() == 40


def test_running_frequencies_equal_literal_counts(spark):
    rng = random.Random(2)
    rows = [(f"m{i}", rng.choice([1, 2, None]), rng.choice([3, 3, 3, 4]),
             day(f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d}")) for i in range(60)]
    m = spark.createDataFrame(rows, "msno string, city_clean int, registered_via int, registration_date date")
    grid = members.member_snapshots(m, "2024-02-01", "2024-02-20")
    for r in grid.collect():
        seen = [x for x in rows if x[3] <= r.snapshot_date]
        assert r.registered_via_freq == pytest.approx(sum(x[2] == r.registered_via for x in seen) / len(seen))
        city = 0 if r.city_clean is None else sum(x[1] == r.city_clean for x in seen) / len(seen)
        assert r.city_freq == pytest.approx(city)
    pairs = grid.select("msno", "snapshot_date")
    again = members.members_asof(m, pairs, "2024-02-01", "2024-02-20")
    assert sorted(map(str, again.collect())) == sorted(map(str, grid.collect()))
    assert grid.count() == sum(1 for x in rows for d in range(1, 21) if x[3] <= day(f"2024-02-{d:02d}"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, None), (None, "b")], "x int, s string")
    nulls = {r["column"]: (r.nulls, r["distinct"]) for r in profile.null_profile(df).collect()}
    assert nulls == {"x": (1, 3), "s": (1, 3)}
    p = profile.profile(df, ["x"]).first()
    assert (p["count"], p.mean, p.min, p.max) == (3, pytest.approx(5 / 3), 1, 2)
    rep = profile.duplicate_report(df, ["x"]).first()
    assert (rep.total_rows, rep.unique_rows, rep.duplicate_rows) == (4, 3, 1)
    assert profile.duplicate_report(df.limit(0), ["x"]).first().total_rows == 0
    shares = {r.s: r.percentage for r in profile.distribution(df, "s").collect()}
    assert shares == {"a": 50.0, "b": 25.0, None: 25.0}
    assert profile.qc(df, {"n_null": F.col("x").isNull()}).first().n_null == 1
