"""Cleaning, outliers, projections, set operations and incremental merge."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns
from ..operators import clean, latest, outliers, snapshots
from ..operators.timeline import METRICS
from ..sources import merge
from .base import query


@query("P1 P2", """
    SELECT row_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
           'orders' AS _source_file, TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_timestamp FROM o_txn""")
def audited_bronze(t):
    raw = t.o_txn.withColumn("transaction_date", F.date_format("transaction_date", "yyyyMMdd").cast("int"))
    df = columns.with_year_month(raw, "transaction_date")
    return columns.with_source(df, "orders", "2024-02-01 00:00:00").select(
        "row_id", "year", "month", "_source_file", "_ingestion_timestamp")


# Every seventh date is spoilt (month 13): such rows must vanish and must not fail the job.
@query("P3 P4 P5 P10", """
    SELECT msno, row_id, transaction_date, membership_expire_date, payment_plan_days, plan_list_price,
           plan_list_price AS actual_amount_paid, is_auto_renew, is_cancel, payment_method_id,
           CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month
    FROM o_txn WHERE row_id % 7 <> 0""")
def silver_transactions(t):
    day = lambda c: F.date_format(c, "yyyyMMdd").cast("int")
    raw = t.o_txn.withColumns({
        "transaction_date": F.when(F.col("row_id") % 7 == 0, 20161399).otherwise(day("transaction_date")),
        "membership_expire_date": day("membership_expire_date"),
        "actual_amount_paid": F.col("plan_list_price"), "is_cancel": F.col("is_cancel").cast("string"),
    })
    return clean.clean_transactions(raw)


@query("P6 P4", """SELECT c_custkey, trim('  ' || c_name || ' ') AS msno, lower(c_name) AS msno_lower FROM customer""")
def normalise_key(t):
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    return t.raw("customer").select(
        "c_custkey", columns.normalise_key(padded).alias("msno"),
        columns.normalise_key(padded, lower=True).alias("msno_lower"))


@query("P7 P3 P8", """
    SELECT msno, city_clean, registered_via, registration_date,
           CAST(DATE '2024-01-31' - registration_date AS INTEGER) AS tenure FROM f_members""")
def clean_members(t):
    return t.f_members.withColumn("tenure", columns.days_between("registration_date", F.lit("2024-01-31").cast("date")))


@query("P9", """
    SELECT c_custkey, CASE WHEN c_nationkey > 0 THEN c_nationkey ELSE -1 END AS city,
           CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS balance FROM customer""")
def null_fill(t):
    df = t.raw("customer").select(
        "c_custkey", columns.null_if("c_nationkey", F.col("c_nationkey") <= 0).alias("city"),
        columns.null_if("c_acctbal", F.col("c_acctbal") <= 0).alias("balance"))
    return columns.fill(columns.fill(df, {"city": -1}))


@query("P11", """
    SELECT row_id, CAST(year(transaction_date) AS INTEGER) AS year, lpad(CAST(month(transaction_date) AS VARCHAR), 2, '0') AS month,
           CAST(day(transaction_date) AS INTEGER) AS day FROM o_txn""")
def calendar_columns(t):
    return columns.with_calendar(t.o_txn, "transaction_date").select("row_id", "year", "month", "day")


@query("P12", """SELECT * FROM o_snap WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def select_snapshots(t):
    return snapshots.select_snapshots(t.o_snap, "range", "1996-01-01", "1996-12-31")




def _with_refunds(t):
    paid = F.col("plan_list_price") - 60000
    return t.o_txn.withColumn("actual_amount_paid", paid).withColumn(
        "membership_expire_date", F.when(F.col("row_id") % 11 == 0, F.date_sub("transaction_date", 1))
        .otherwise(F.col("membership_expire_date")))


@query("P13", """SELECT row_id, plan_list_price - 60000 AS actual_amount_paid FROM o_txn
    WHERE plan_list_price >= 60000 AND row_id % 11 <> 0""")
def keep_valid(t):
    return clean.keep_valid(_with_refunds(t), clean.validity_rules()).select("row_id", "actual_amount_paid")


@query("P13", """SELECT row_id, concat_ws(',', CASE WHEN plan_list_price < 60000 THEN 'amount_paid' END,
      CASE WHEN row_id % 11 = 0 THEN 'expiry_order' END) AS broken_rules
    FROM o_txn WHERE plan_list_price < 60000 OR row_id % 11 = 0""")
def rejects(t):
    return clean.rejects(_with_refunds(t), clean.validity_rules()).select("row_id", "broken_rules")


@query("P14 U1", """
    SELECT msno, row_id, plan_list_price, CAST(NULL AS INTEGER) AS is_cancel FROM f_txn
    UNION ALL SELECT msno, row_id, NULL, is_cancel FROM o_txn""")
def aligned_union(t):
    return clean.union_aligned(t.f_txn.select("msno", "row_id", "plan_list_price"),
                               t.o_txn.select("is_cancel", "row_id", "msno"))


@query("P14", "SELECT CAST(row_id AS VARCHAR) AS row_id, CAST(NULL AS DOUBLE) AS missing, msno FROM o_txn")
def align_to_schema(t):
    return clean.align(t.o_txn, T.StructType.fromDDL("row_id string, missing double, msno bigint"))


ROW_PARTS = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), ':')"
                        for c in ("msno", "transaction_date", "row_id"))


@query("P15", f"SELECT row_id, sha256({ROW_PARTS}) AS transaction_id FROM o_txn")
def row_ids(t):
    return columns.with_row_id(t.o_txn, ["msno", "transaction_date", "row_id"], "transaction_id").select(
        "row_id", "transaction_id")


@query("P16", """SELECT event_id, coalesce(TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE), 0) AS k,
    CAST(0 AS DOUBLE) AS event_type FROM events""")
def numeric_coercion(t):
    raw = t.raw("events").select("event_id", F.regexp_replace("props", r"[^0-9.]", "").alias("k"), "event_type")
    return columns.to_number(raw, ["k", "event_type"])


@query("P17 P10", "SELECT event_id, user_id AS msno, value FROM events")
def canonical_id(t):
    return clean.canonical_id(t.raw("events").select("event_id", "user_id", "value"))


@query("P18", "SELECT row_id, score AS prediction_proba FROM f_score")
def canonical_score(t):
    return clean.canonical_score(t.f_score.select("row_id", F.col("score").cast("string").alias("churn_score")))


@query("P19", "SELECT msno, snapshot_date, is_churn AS label FROM f_label")
def resolve_label(t):
    df = t.f_label
    return clean.project(df, rename={clean.resolve_label(df, "label"): "label"})


@query("P20", """
    SELECT c_custkey, CASE WHEN m IN ('building', 'machinery') THEN m ELSE 'unknown' END AS c_mktsegment_norm,
           CAST(m = 'building' AS INTEGER) AS c_mktsegment_building, CAST(m = 'machinery' AS INTEGER) AS c_mktsegment_machinery,
           CAST(m NOT IN ('building', 'machinery') AS INTEGER) AS c_mktsegment_unknown
    FROM (SELECT c_custkey, lower(trim(c_mktsegment)) AS m FROM customer) c""")
def normalise_enum(t):
    return columns.normalise_enum(t.raw("customer"), "c_mktsegment", ["building", "machinery"]).drop(
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("P21", "SELECT msno, registered_via, registration_date, coalesce(city_clean, 0) AS city_clean_oh FROM o_members")
def coalesce_category(t):
    return columns.coalesce_category(t.o_members, ["city_clean"])


@query("P23", "SELECT *, DATE '2000-01-01' AS snapshot_date FROM o_members")
def stamp_snapshot(t):
    return columns.stamp_snapshot(t.o_members, "2000-01-01")


@query("A24", """
    SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 14 AND 40 AND count(*) OVER (PARTITION BY p_size) >= 40
           THEN p_size END AS p_size_clean FROM part""")
def keep_frequent(t):
    return clean.keep_frequent(t.raw("part").select("p_partkey", "p_size"), "p_size", 14, 40, 40)


@query("A21", """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def dedup(t):
    order = [F.desc("l_shipdate"), *[F.col(c) for c in (
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]]
    return latest.dedup(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], order)


@query("J9", "SELECT * FROM f_txn WHERE msno IN (SELECT msno FROM f_members WHERE city_clean IS NOT NULL)")
def keep_known(t):
    return snapshots.keep_known(t.f_txn, t.f_members.where("city_clean IS NOT NULL"))


@query("J10 I2 P12", """SELECT * FROM o_snap WHERE snapshot_date NOT IN (
    SELECT DISTINCT transaction_date FROM o_txn WHERE row_id % 3 = 0)""")
def new_snapshots(t):
    built = t.o_txn.where("row_id % 3 = 0").select(F.col("transaction_date").alias("snapshot_date"))
    return snapshots.select_snapshots(t.o_snap, "incremental", existing=built)


@query("I4", """SELECT CAST(m AS DATE) AS snapshot_date FROM (SELECT unnest(generate_series(
    date_trunc('month', (SELECT min(transaction_date) FROM o_txn)), (SELECT max(transaction_date) FROM o_txn), INTERVAL 1 MONTH)) AS m)""")
def month_starts(t):
    first, last = t.o_txn.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    return snapshots.month_starts(t.spark, str(first), str(last))


@query("U1 U3 S2", """
    SELECT msno, row_id, transaction_date, source_file FROM (
      SELECT *, 'first' AS source_file FROM o_txn WHERE row_id % 3 <> 0 OR row_id % 2 = 1
      UNION ALL SELECT *, 'second' AS source_file FROM o_txn WHERE row_id % 2 = 0)
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY source_file DESC) = 1""")
def union_tagged_dedup(t):
    both = clean.union_tagged({"first": t.o_txn.where("row_id % 3 <> 0 OR row_id % 2 = 1"), "second": t.o_txn.where("row_id % 2 = 0")})
    return latest.dedup(both, ["row_id"], [F.desc("source_file")]).select(
        "msno", "row_id", "transaction_date", "source_file")


PART = "CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month"
MERGE_KEYS = ["msno", "transaction_date", "payment_method_id", "plan_list_price"]


@query("I1 A21 S9 J10", f"""
    SELECT row_id, msno, transaction_date, plan_list_price, payment_method_id, v, year, month FROM (
      SELECT *, 1 AS v, {PART} FROM o_txn WHERE transaction_date < DATE '1998-01-01'
      UNION ALL SELECT *, 2 AS v, {PART} FROM o_txn WHERE transaction_date >= DATE '1997-06-01') u
    QUALIFY CASE WHEN transaction_date < DATE '1997-06-01' AND (year, month) NOT IN (
              SELECT DISTINCT CAST(year(transaction_date) AS INTEGER), CAST(month(transaction_date) AS INTEGER) FROM o_txn
              WHERE transaction_date >= DATE '1997-06-01') THEN 1
            ELSE row_number() OVER (PARTITION BY msno, transaction_date, payment_method_id, plan_list_price
                                    ORDER BY v DESC, row_id DESC) END = 1""")
def bronze_merge(t):
    dated = columns.with_year_month(t.o_txn, "transaction_date", numeric=False).select(
        "row_id", *MERGE_KEYS, "year", "month")
    old = dated.where("transaction_date < DATE'1998-01-01'").withColumn("v", F.lit(1))
    new = dated.where("transaction_date >= DATE'1997-06-01'").withColumn("v", F.lit(2))
    return merge.merge_view(new, old, ["year", "month"], MERGE_KEYS, [F.desc("v"), F.desc("row_id")])


FENCES = "quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3"
MONTHLY = "(SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM f_logs)"


def _fence_sql(cols, src, by=""):
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    union = " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS \"column\", {FENCES.format(c=c)} FROM {src} s {group}" for c in cols)
    return (f'SELECT {lead}"column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, '
            f"q3 + 1.5 * (q3 - q1) AS upper FROM ({union}) f")


FENCE_DOUBLES = ["q1", "q3", "iqr", "lower", "upper"]


@query("O2 O1", _fence_sql(METRICS, MONTHLY, "year, month"), FENCE_DOUBLES)
def iqr_fences(t):
    logs = columns.with_year_month(t.f_logs, "date", numeric=False)
    return outliers.iqr_fences(logs, METRICS, ["year", "month"], exact=True)


@query("O2", _fence_sql(["l_quantity", "l_extendedprice", "l_discount"], "lineitem", "l_returnflag"), FENCE_DOUBLES)
def iqr_fences_by_group(t):
    return outliers.iqr_fences(t.raw("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"],
                               exact=True)


def _inside(cols, alias):
    return " AND ".join(
        f"l.{c} BETWEEN {alias}.{c}_q1 - 1.5 * ({alias}.{c}_q3 - {alias}.{c}_q1) AND {alias}.{c}_q3 + 1.5 * ({alias}.{c}_q3 - {alias}.{c}_q1)"
        for c in cols)


def _quartiles(cols):
    return ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_q3"
                     for c in cols)


@query("O1 S15 P3", f"""
    SELECT l.* FROM {MONTHLY} l JOIN (SELECT year, month, {_quartiles(METRICS)} FROM {MONTHLY} s WHERE total_secs >= 0 GROUP BY year, month) q
      ON q.year = l.year AND q.month = l.month WHERE l.total_secs >= 0 AND {_inside(METRICS, 'q')}""")
def iqr_clean(t):
    raw = t.f_logs.withColumn("date", F.date_format("date", "yyyyMMdd").cast("int"))
    return outliers.clean_user_logs(raw, exact=True)


@query("O3", f"""
    SELECT l.msno, l.date, 'total_secs' AS "column", l.total_secs AS value FROM f_logs l
    CROSS JOIN (SELECT {_quartiles(["total_secs"])} FROM f_logs) q WHERE NOT ({_inside(["total_secs"], "q")})
    UNION ALL SELECT l.msno, l.date, 'num_unq', CAST(l.num_unq AS DOUBLE) FROM f_logs l
    CROSS JOIN (SELECT {_quartiles(["num_unq"])} FROM f_logs) q WHERE NOT ({_inside(["num_unq"], "q")})""")
def iqr_outliers(t):
    return outliers.iqr_outliers(t.f_logs, ["total_secs", "num_unq"], ["msno", "date"], exact=True)


@query("O3 O1", f"""
    SELECT l.msno, l.date, 'total_secs' AS "column", l.total_secs AS value FROM {MONTHLY} l
    JOIN (SELECT year, month, {_quartiles(["total_secs"])} FROM {MONTHLY} s GROUP BY year, month) q
      ON q.year = l.year AND q.month = l.month WHERE NOT ({_inside(["total_secs"], "q")})""")
def iqr_outliers_by_month(t):
    logs = columns.with_year_month(t.f_logs, "date", numeric=False)
    return outliers.iqr_outliers(logs, ["total_secs"], ["msno", "date"], ["year", "month"], exact=True)


@query("O1", None)
def iqr_clean_sketch(t):
    """The one-pass form with sketches: no SQL gives the same approximate fences."""
    raw = t.f_logs.withColumn("date", F.date_format("date", "yyyyMMdd").cast("int"))
    return outliers.clean_user_logs(raw)
