"""Registry, and the churn tables derived from the given tables in Spark and in SQL.

Dense tables (``f_*``) come from ``events``, long tables (``o_*``) from ``orders`` and ``customer``.
Both derivations cover the whole input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Label horizon (days) on the dense tables and on the long ones.
HORIZON, LONG_HORIZON = 3, 90
# Observations on the dense tables run from the first transaction day to the last one whose label the data can answer.
START_SQL = "(SELECT min(transaction_date) FROM f_txn)"
END_SQL = f"(SELECT max(transaction_date) - {HORIZON} FROM f_txn)"
TRAIN_DATE = "2000-01-01"
CUT = "2024-01-16"

CTES = {
    "f_txn": f"""
        SELECT user_id AS msno, event_id AS row_id, CAST(ts AS DATE) AS transaction_date,
               CAST(1 + event_id % 7 AS INTEGER) AS payment_plan_days,
               CAST(ts AS DATE) + CAST(1 + event_id % 7 AS INTEGER) AS membership_expire_date,
               CAST(floor(value) AS INTEGER) AS plan_list_price, CAST(event_id % 2 AS INTEGER) AS is_auto_renew,
               CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_cancel,
               CAST(event_id % 4 AS INTEGER) AS payment_method_id
        FROM events WHERE event_type = 'purchase'""",
    "f_logs": """
        SELECT user_id AS msno, CAST(ts AS DATE) AS date,
               sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS num_25,
               sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS num_50,
               sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)::BIGINT AS num_75,
               sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS num_985,
               sum(CASE WHEN value > 100 THEN 1 ELSE 0 END)::BIGINT AS num_100,
               count(*) AS num_unq, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_secs
        FROM events WHERE event_type <> 'purchase' GROUP BY user_id, CAST(ts AS DATE)""",
    "f_members": """
        SELECT user_id AS msno, CASE WHEN user_id % 8 <= 0 THEN NULL ELSE CAST(user_id % 8 AS INTEGER) END AS city_clean,
               CAST(user_id % 5 AS INTEGER) AS registered_via,
               DATE '2023-06-01' + CAST(user_id % 220 AS INTEGER) AS registration_date
        FROM (SELECT DISTINCT user_id FROM events) u""",
    "f_snap": f"""
        SELECT DISTINCT msno, membership_expire_date AS snapshot_date FROM f_txn
        WHERE membership_expire_date BETWEEN {START_SQL} AND {END_SQL}""",
    "f_label": f"""
        SELECT s.snapshot_date, s.msno, CASE WHEN EXISTS (
                 SELECT 1 FROM f_txn t WHERE t.msno = s.msno AND t.is_cancel = 0
                 AND t.transaction_date BETWEEN s.snapshot_date AND s.snapshot_date + {HORIZON})
               THEN 0 ELSE 1 END AS is_churn FROM f_snap s""",
    "f_score": f"""
        SELECT event_id AS row_id, user_id AS msno, CAST(ts AS DATE) AS snapshot_date, value / 500 AS score,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
               CASE WHEN ts < TIMESTAMP '{CUT}' THEN 'base' ELSE 'cur' END AS side FROM events""",
    "o_txn": """
        SELECT o_custkey AS msno, o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS transaction_date,
               CAST(CASE o_orderkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 60 WHEN 2 THEN 90 ELSE 180 END AS INTEGER)
                 AS payment_plan_days,
               CAST(o_orderdate AS DATE) + CAST(CASE o_orderkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 60 WHEN 2 THEN 90
                 ELSE 180 END AS INTEGER) AS membership_expire_date,
               CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS is_cancel,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_auto_renew,
               CAST(floor(o_totalprice) AS INTEGER) AS plan_list_price, o_orderpriority AS payment_method_id
        FROM orders""",
    "o_members": """
        SELECT c_custkey AS msno, CASE WHEN c_nationkey <= 0 THEN NULL ELSE c_nationkey END AS city_clean,
               c_mktsegment AS registered_via, DATE '1994-01-01' + CAST(c_custkey % 700 AS INTEGER) AS registration_date
        FROM customer""",
    "o_snap": "SELECT DISTINCT msno, membership_expire_date AS snapshot_date FROM o_txn",
    "o_label": f"""
        SELECT s.snapshot_date, s.msno, CASE WHEN EXISTS (
                 SELECT 1 FROM o_txn t WHERE t.msno = s.msno AND t.is_cancel = 0
                 AND t.transaction_date BETWEEN s.snapshot_date AND s.snapshot_date + {LONG_HORIZON})
               THEN 0 ELSE 1 END AS is_churn FROM o_snap s""",
}
NEEDS = {"f_snap": ["f_txn"], "f_label": ["f_txn", "f_snap"], "o_snap": ["o_txn"], "o_label": ["o_txn", "o_snap"]}


class Tables:
    """The derived tables as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def f_txn(self) -> DataFrame:
        return self.raw("events").where("event_type = 'purchase'").selectExpr(
            "user_id AS msno", "event_id AS row_id", "to_date(ts) AS transaction_date",
            "CAST(1 + event_id % 7 AS INT) AS payment_plan_days",
            "date_add(to_date(ts), CAST(1 + event_id % 7 AS INT)) AS membership_expire_date",
            "CAST(floor(value) AS INT) AS plan_list_price", "CAST(event_id % 2 AS INT) AS is_auto_renew",
            "CAST(event_id % 5 = 0 AS INT) AS is_cancel", "CAST(event_id % 4 AS INT) AS payment_method_id")

    @cached_property
    def span(self) -> tuple[str, str]:
        """First and last observation day, by one aggregate; an empty table has an empty range."""
        first, last = self.f_txn.agg(
            F.min("transaction_date"), F.date_sub(F.max("transaction_date"), HORIZON)).first()
        return (first.isoformat(), last.isoformat()) if first else ("1970-01-02", "1970-01-01")

    @property
    def f_logs(self) -> DataFrame:
        counts = {"num_25": "event_type = 'click'", "num_50": "event_type = 'view'", "num_75": "event_type = 'signup'",
                  "num_985": "event_type = 'error'", "num_100": "value > 100", "num_unq": "true"}
        return self.raw("events").where("event_type <> 'purchase'").groupBy(
            F.col("user_id").alias("msno"), F.expr("to_date(ts) AS date")
        ).agg(
            *[F.expr(f"count_if({cond}) AS {name}") for name, cond in counts.items()],
            F.expr("CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_secs"))

    @property
    def f_members_raw(self) -> DataFrame:
        u = F.col("user_id")
        return self.raw("events").select("user_id").distinct().select(
            u.alias("msno"), (u % 8).cast("int").alias("city"), (u % 5).cast("int").alias("registered_via"),
            F.date_format(F.date_add(F.lit("2023-06-01").cast("date"), (u % 220).cast("int")), "yyyyMMdd")
            .cast("int").alias("registration_init_time"))

    @property
    def f_members(self) -> DataFrame:
        from ..operators.members import clean_members

        return clean_members(self.f_members_raw).withColumn("msno", F.col("msno").cast("long"))

    @property
    def f_snap(self) -> DataFrame:
        from ..operators.latest import expiry_snapshots

        return expiry_snapshots(self.f_txn, *self.span, ["transaction_date", "row_id"]).select(
            "msno", "snapshot_date")

    @property
    def f_label(self) -> DataFrame:
        from ..operators.labels import churn_label

        return churn_label(self.f_snap, self.f_txn, HORIZON, bounds=self.span)

    @property
    def f_score(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("row_id"), F.col("user_id").alias("msno"), F.to_date("ts").alias("snapshot_date"),
            (F.col("value") / 500).alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label"),
            F.when(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"), "base").otherwise("cur").alias("side"))

    @property
    def base(self) -> DataFrame:
        return self.f_score.where("side = 'base'")

    @property
    def cur(self) -> DataFrame:
        return self.f_score.where("side = 'cur'")

    @property
    def o_txn(self) -> DataFrame:
        plan = "CASE o_orderkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 60 WHEN 2 THEN 90 ELSE 180 END"
        return self.raw("orders").selectExpr(
            "o_custkey AS msno", "o_orderkey AS row_id", "to_date(o_orderdate) AS transaction_date",
            f"{plan} AS payment_plan_days", f"date_add(to_date(o_orderdate), {plan}) AS membership_expire_date",
            "CAST(o_orderkey % 10 = 0 AS INT) AS is_cancel", "CAST(o_orderstatus = 'O' AS INT) AS is_auto_renew",
            "CAST(floor(o_totalprice) AS INT) AS plan_list_price", "o_orderpriority AS payment_method_id")

    @property
    def o_members(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").select(
            c.alias("msno"), F.when(F.col("c_nationkey") > 0, F.col("c_nationkey")).alias("city_clean"),
            F.col("c_mktsegment").alias("registered_via"),
            F.date_add(F.lit("1994-01-01").cast("date"), (c % 700).cast("int")).alias("registration_date"))

    @property
    def o_snap(self) -> DataFrame:
        return self.o_txn.select("msno", F.col("membership_expire_date").alias("snapshot_date")).distinct()

    @property
    def o_label(self) -> DataFrame:
        from ..operators.labels import churn_label

        return churn_label(self.o_snap, self.o_txn, LONG_HORIZON)


@dataclass
class Query:
    build: Callable[[Tables], DataFrame]
    ops: Sequence[str]
    sql: str | None
    doubles: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Tables(spark, sf_dir))
        return df.withColumns({c: F.round(c, d) for c, d in self.doubles.items()}) if self.doubles else df

    def full_sql(self) -> str:
        used: list[str] = []

        def need(name: str) -> None:
            for dep in NEEDS.get(name, []):
                need(dep)
            if name not in used:
                used.append(name)

        for name in CTES:
            if name in self.sql:
                need(name)
        ctes = ", ".join(f"{n} AS ({CTES[n]})" for n in used)
        body = self.sql.strip()
        if self.doubles:
            rounded = ", ".join(f"round({c}, {d}) + CAST(0 AS DOUBLE) AS {c}" for c, d in self.doubles.items())
            body = f"SELECT * REPLACE ({rounded}) FROM ({body}) AS q"
        elif used and body.startswith("WITH "):
            return f"WITH {ctes}, {body[5:]}"
        return f"WITH {ctes} {body}" if used else body


REGISTRY: dict[str, Query] = {}


def query(ops: str, sql: str | None = None, doubles: Sequence[str] | dict[str, int] = (), digits: int = 6):
    """Register a query. ``doubles`` are rounded alike on both sides: sums in another order differ in the last bits."""
    if not isinstance(doubles, dict):
        doubles = {c: digits for c in doubles}

    def register(fn: Callable[[Tables], DataFrame]):
        REGISTRY[fn.__name__] = Query(fn, ops.split(), sql, doubles)
        return fn

    return register
