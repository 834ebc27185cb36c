"""Observations, labels, temporal features and feature stores."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import labels, latest, members, snapshots, timeline
from ..plans import medallion
from ..sources import buckets
from ..sources.writers import materialise, shared_folder
from .base import END_SQL, HORIZON, LONG_HORIZON, REGISTRY, START_SQL, query

ROW_ID = ["row_id"]


@query("W8 J5 A10 A13", """
    SELECT snapshot_date, count(*) AS n_labels, CAST(sum(is_churn) AS BIGINT) AS n_positive,
           100 * avg(CAST(is_churn AS DOUBLE)) AS positive_pct
    FROM f_label GROUP BY snapshot_date""", ["positive_pct"], digits=2)
def churn_rate_by_snapshot(t):
    return labels.label_rate(t.f_label, ["snapshot_date"])


@query("J5 A10 U2", "SELECT snapshot_date, msno, is_churn FROM f_label")
def churn_labels(t):
    return labels.churn_label(t.f_snap, t.f_txn, HORIZON, bounds=t.span)


@query("J5 A10 U2", "SELECT snapshot_date, msno, is_churn FROM o_label")
def churn_labels_long(t):
    return labels.churn_label(t.o_snap, t.o_txn, LONG_HORIZON)


@query("A26 P23", f"""
    SELECT s.snapshot_date, s.msno, CASE WHEN count(r.msno) > 0 THEN 0 ELSE 1 END AS is_churn
    FROM (SELECT DISTINCT msno, DATE '2024-01-16' AS snapshot_date FROM f_txn) s
    LEFT JOIN (SELECT * FROM f_txn WHERE is_cancel = 0) r ON r.msno = s.msno
      AND r.transaction_date BETWEEN s.snapshot_date + 1 AND s.snapshot_date + {HORIZON}
    GROUP BY s.snapshot_date, s.msno""")
def churn_labels_next_day(t):
    one = snapshots_of_day(t.f_txn)
    return labels.churn_label(one, t.f_txn, HORIZON, offset=1)


def snapshots_of_day(txn):
    from ..functions.columns import stamp_snapshot

    return stamp_snapshot(txn.select("msno").distinct(), "2024-01-16")


@query("A14", """
    SELECT msno, count(*) AS n_labels, CAST(sum(is_churn) AS BIGINT) AS n_positive,
           100 * avg(CAST(is_churn AS DOUBLE)) AS positive_pct
    FROM o_label GROUP BY msno""", ["positive_pct"], digits=2)
def label_rate_by_entity(t):
    return labels.label_rate(t.o_label, ["msno"])


@query("A15", """
    SELECT count(*) AS total_records, CAST(sum(is_churn) AS BIGINT) AS churned,
           CAST(count(*) - sum(is_churn) AS BIGINT) AS retained,
           100 * avg(CAST(is_churn AS DOUBLE)) AS churn_rate FROM o_label""", ["churn_rate"], digits=2)
def label_stats(t):
    return labels.label_stats(t.o_label)


@query("A16 W6", """
    SELECT corr(i, churn_rate) AS corr FROM (
      SELECT CAST(row_number() OVER (ORDER BY snapshot_date) AS DOUBLE) AS i, churn_rate FROM (
        SELECT snapshot_date, round(100 * avg(CAST(is_churn AS DOUBLE)), 2) AS churn_rate
        FROM o_label GROUP BY snapshot_date))""", ["corr"])
def label_trend_corr(t):
    return labels.label_trend(t.o_label)


@query("W8 W1", f"""
    SELECT *, membership_expire_date AS snapshot_date FROM f_txn
    WHERE membership_expire_date BETWEEN {START_SQL} AND {END_SQL}
    QUALIFY row_number() OVER (PARTITION BY msno, membership_expire_date
                               ORDER BY transaction_date DESC, row_id DESC) = 1""")
def expiry_snapshots(t):
    return latest.expiry_snapshots(t.f_txn, *t.span, ["transaction_date", *ROW_ID])


# The users-by-days grid the above replaces, as SQL only: for each day the latest expiry up to it, kept if it is that day.
@query("W8 J8", f"""
    SELECT msno, snapshot_date, membership_expire_date, row_id FROM (
      SELECT t.*, d.snapshot_date, row_number() OVER (PARTITION BY t.msno, d.snapshot_date
               ORDER BY membership_expire_date DESC, transaction_date DESC, row_id DESC) AS rn
      FROM f_txn t JOIN (SELECT CAST(unnest(generate_series({START_SQL}, {END_SQL}, INTERVAL 1 DAY)) AS DATE)
                         AS snapshot_date) d ON t.membership_expire_date <= d.snapshot_date)
    WHERE rn = 1 AND membership_expire_date = snapshot_date""")
def expiry_snapshots_vs_grid(t):
    return latest.expiry_snapshots(t.f_txn, *t.span, ["transaction_date", *ROW_ID]).select(
        "msno", "snapshot_date", "membership_expire_date", "row_id")


LATEST_SQL = """
    SELECT * EXCLUDE (rk, rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY msno ORDER BY CASE WHEN is_cancel = 1 AND rk = 2 THEN 1 ELSE 0 END DESC,
                 total_plan_days DESC, is_cancel DESC, row_id DESC) AS rn
      FROM (SELECT *, CAST(membership_expire_date - transaction_date AS INTEGER) AS total_plan_days,
                   transaction_date AS max_transaction_date, {snap} AS snapshot_date,
                   rank() OVER (PARTITION BY msno ORDER BY membership_expire_date - transaction_date DESC) AS rk
            FROM (SELECT *, max(transaction_date) OVER (PARTITION BY msno) AS mx FROM {src}) m
            WHERE transaction_date = mx)) WHERE rn = 1"""


@query("W2 W3 W4 P8", "SELECT * EXCLUDE (mx) FROM (" + LATEST_SQL.format(snap="transaction_date", src="f_txn") + ") z")
def latest_transaction(t):
    return latest.latest_transaction(t.f_txn, tie_break=ROW_ID)


@query("W4 P23", "SELECT * EXCLUDE (mx) FROM (" + LATEST_SQL.format(
    snap="DATE '1999-06-30'", src="(SELECT * FROM o_txn WHERE transaction_date <= DATE '1999-06-30')") + ") z")
def latest_transaction_upto(t):
    return latest.latest_transaction(t.o_txn, "1999-06-30", ROW_ID)


@query("W2 W3 W7 A29", """
    SELECT row_id, msno, total_plan_days, plan_days_rank, cancellation_in_group,
           CASE WHEN cancellation_in_group = 1 AND is_cancel = 1 AND plan_days_rank = 2 THEN 1
                WHEN cancellation_in_group = 0 AND plan_days_rank = 1 THEN 1
                WHEN cancellation_in_group = 1 AND plan_days_rank = 1 AND is_cancel <> 1 THEN 1 ELSE 0 END AS final_priority
    FROM (SELECT *, CAST(rank() OVER (PARTITION BY msno ORDER BY total_plan_days DESC) AS INTEGER) AS plan_days_rank,
                 max(is_cancel) OVER (PARTITION BY msno) AS cancellation_in_group
          FROM (SELECT *, CAST(membership_expire_date - transaction_date AS INTEGER) AS total_plan_days,
                       max(transaction_date) OVER (PARTITION BY msno) AS mx FROM f_txn) a
          WHERE transaction_date = mx) b""")
def tied_transactions(t):
    return latest.tied_transactions(t.f_txn).select(
        "row_id", "msno", "total_plan_days", "plan_days_rank", "cancellation_in_group", "final_priority")


@query("A25", "SELECT msno, max(membership_expire_date) AS max_expiry FROM o_txn GROUP BY msno")
def max_expiry_per_user(t):
    return latest.max_by_key(t.o_txn, "msno", "membership_expire_date", "max_expiry")


@query("A29", "SELECT msno, max(is_cancel) AS any_cancel FROM o_txn GROUP BY msno")
def any_cancellation(t):
    return latest.any_flag(t.o_txn, "msno", "is_cancel", "any_cancel")


ACTIVITY_SQL = """
    SELECT a.*, CAST(a.snapshot_date - (SELECT max(l.date) FROM f_logs l WHERE l.msno = a.msno AND l.date <= a.snapshot_date)
                     AS INTEGER) AS days_since_last_play,
           coalesce(tr.slope, 0) AS trend_secs_w30 FROM (
      SELECT s.msno, s.snapshot_date, CAST(sum(num_25) AS BIGINT) AS num_25_w30_sum, CAST(sum(num_50) AS BIGINT) AS num_50_w30_sum,
             CAST(sum(num_75) AS BIGINT) AS num_75_w30_sum, CAST(sum(num_985) AS BIGINT) AS num_985_w30_sum,
             CAST(sum(num_100) AS BIGINT) AS num_100_w30_sum, CAST(sum(num_unq) AS BIGINT) AS num_unq_w30_sum,
             sum(total_secs) AS sum_secs_w30, count(DISTINCT l.date) AS active_days_w30,
             CAST(sum(num_100) AS DOUBLE) / CASE WHEN sum(num_unq) > 0 THEN sum(num_unq) ELSE 1 END AS complete_rate_w30,
             coalesce(sum(CASE WHEN l.date >= s.snapshot_date + ({lo7}) THEN total_secs END), 0) AS sum_secs_w7,
             coalesce(sum(CASE WHEN l.date >= s.snapshot_date + ({lo7}) THEN total_secs END), 0)
               / CASE WHEN sum(total_secs) > 0 THEN sum(total_secs) ELSE 1 END AS engagement_ratio_7_30
      FROM {snap} s JOIN f_logs l ON l.msno = s.msno
        AND l.date BETWEEN s.snapshot_date + ({lo30}) AND s.snapshot_date + ({hi})
      GROUP BY s.msno, s.snapshot_date) a
    LEFT JOIN (
      SELECT msno, snapshot_date, covar_pop(total_secs, i) / CASE WHEN var_pop(i) > 0 THEN var_pop(i) ELSE 1 END AS slope
      FROM (SELECT s.msno, s.snapshot_date, l.total_secs,
                   CAST(row_number() OVER (PARTITION BY s.msno, s.snapshot_date ORDER BY l.date) AS DOUBLE) AS i
            FROM {snap} s JOIN f_logs l ON l.msno = s.msno
              AND l.date BETWEEN s.snapshot_date + ({lo30}) AND s.snapshot_date + ({hi})) d
      GROUP BY msno, snapshot_date) tr ON tr.msno = a.msno AND tr.snapshot_date = a.snapshot_date"""
TRAIN_ACTIVITY = ACTIVITY_SQL.format(snap="f_snap", lo7="-7", lo30="-30", hi="-1")
DOUBLES = {"sum_secs_w30": 4, "complete_rate_w30": 6, "sum_secs_w7": 4, "engagement_ratio_7_30": 6, "trend_secs_w30": 7}


@query("J2 J3 J7 A1 A2 A3 A4 A5 A6 W5 P9", TRAIN_ACTIVITY, DOUBLES)
def activity_features(t):
    return timeline.activity_features(t.f_logs, t.f_snap, bounds=t.span, daily=True)


@query("J4 A1 A2 A3 A4 A5 A6", ACTIVITY_SQL.format(snap="f_snap", lo7="-6", lo30="-29", hi="0"), DOUBLES)
def activity_features_inclusive(t):
    return timeline.activity_features(t.f_logs, t.f_snap, include_today=True, bounds=t.span, daily=True)


@query("J3 A1 A2", """
    SELECT s.msno, s.snapshot_date, CAST(sum(num_100) AS BIGINT) AS num_100_sum, sum(total_secs) AS total_secs_sum,
           count(DISTINCT l.date) AS active_days
    FROM f_snap s JOIN f_logs l ON l.msno = s.msno AND l.date BETWEEN s.snapshot_date - 7 AND s.snapshot_date - 1
    GROUP BY s.msno, s.snapshot_date""", ["total_secs_sum"], digits=4)
def window_join_sums(t):
    joined = timeline.window_join(t.f_logs, t.f_snap, -7, -1)
    return timeline.window_sums(joined, ["num_100", "total_secs"])


@query("J4", """
    SELECT s.msno, s.snapshot_date, l.date, l.num_unq
    FROM f_snap s JOIN f_logs l ON l.msno = s.msno AND l.date BETWEEN s.snapshot_date - 6 AND s.snapshot_date""")
def window_join_inclusive(t):
    return timeline.window_join(t.f_logs, t.f_snap, -7, -1, include_today=True).select(
        "msno", "snapshot_date", "date", "num_unq")


@query("A5 J7", """
    SELECT s.msno, s.snapshot_date, CAST(s.snapshot_date - max(l.transaction_date) AS INTEGER) AS days_since_last
    FROM o_snap s JOIN o_txn l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
    GROUP BY s.msno, s.snapshot_date""")
def recency(t):
    return timeline.recency(t.o_txn, t.o_snap, "transaction_date")


@query("A6 W5", """
    SELECT msno, covar_pop(total_secs, i) / CASE WHEN var_pop(i) > 0 THEN var_pop(i) ELSE 1 END AS trend
    FROM (SELECT msno, total_secs, CAST(row_number() OVER (PARTITION BY msno ORDER BY date) AS DOUBLE) AS i FROM f_logs) d
    GROUP BY msno""", ["trend"], digits=7)
def trend_slope(t):
    return timeline.trend(t.f_logs, "total_secs")


ASOF_SQL = """
    SELECT s.msno, s.snapshot_date, l.transaction_date AS latest_transaction_date, l.is_auto_renew, l.plan_list_price
    FROM {snap} s JOIN {txn} l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
    QUALIFY row_number() OVER (PARTITION BY s.msno, s.snapshot_date ORDER BY l.transaction_date DESC,
                               l.membership_expire_date DESC, l.row_id DESC) = 1"""


@query("J6 W1", ASOF_SQL.format(snap="f_snap", txn="f_txn"))
def asof_latest(t):
    return timeline.asof_latest(t.f_txn, t.f_snap, ["is_auto_renew", "plan_list_price"],
                                tie_break=["membership_expire_date", "row_id"])


@query("J6 W1", ASOF_SQL.format(snap="o_snap", txn="o_txn"))
def asof_latest_long(t):
    return timeline.asof_latest(t.o_txn, t.o_snap, ["is_auto_renew", "plan_list_price"],
                                tie_break=["membership_expire_date", "row_id"])


SHARE_SQL = """
    SELECT s.msno, s.snapshot_date, CAST(sum(l.is_auto_renew) AS BIGINT) AS auto_renew_count, count(*) AS total_tx_before_expire,
           CAST(sum(l.is_auto_renew) AS DOUBLE) / count(*) AS auto_renew_share
    FROM f_snap s JOIN f_txn l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
    GROUP BY s.msno, s.snapshot_date"""


@query("A7 J7 A3", SHARE_SQL, ["auto_renew_share"])
def auto_renew_share(t):
    return timeline.auto_renew_share(t.f_txn, t.f_snap)


TXN_SQL = f"""
    SELECT s.msno, s.snapshot_date, CAST(coalesce(l.latest_transaction_date - m.registration_date, 0) AS INTEGER) AS tenure_days,
           coalesce(l.is_auto_renew, 0) AS last_is_auto_renew, coalesce(l.plan_list_price, 0) AS last_plan_list_price,
           coalesce(h.auto_renew_share, 0) AS auto_renew_share
    FROM f_snap s LEFT JOIN f_members m ON m.msno = s.msno
    LEFT JOIN ({ASOF_SQL.format(snap="f_snap", txn="f_txn")}) l ON l.msno = s.msno AND l.snapshot_date = s.snapshot_date
    LEFT JOIN ({SHARE_SQL}) h ON h.msno = s.msno AND h.snapshot_date = s.snapshot_date"""


@query("J6 J7 A7 P8 P9", TXN_SQL, ["auto_renew_share"])
def transaction_features(t):
    reg = t.f_snap.join(t.f_members.select("msno", "registration_date"), "msno", "left")
    return timeline.transaction_features(t.f_txn, reg, ["membership_expire_date", "row_id"])


@query("J15", f"""
    SELECT s.msno, s.snapshot_date,
           CAST(coalesce(CASE WHEN l.transaction_date <= s.snapshot_date THEN l.transaction_date ELSE p.transaction_date END
                         - m.registration_date, 0) AS INTEGER) AS tenure_days,
           coalesce(CASE WHEN l.transaction_date <= s.snapshot_date THEN l.is_auto_renew ELSE p.is_auto_renew END, 0) AS last_is_auto_renew,
           coalesce(CASE WHEN l.transaction_date <= s.snapshot_date THEN l.plan_list_price ELSE p.plan_list_price END, 0) AS last_plan_list_price,
           coalesce(h.auto_renew_share, 0) AS auto_renew_share
    FROM f_snap s LEFT JOIN f_members m ON m.msno = s.msno
    LEFT JOIN ({LATEST_SQL.format(snap="transaction_date", src="f_txn")}) l ON l.msno = s.msno
    LEFT JOIN (SELECT s2.msno, s2.snapshot_date, t.transaction_date, t.is_auto_renew, t.plan_list_price
               FROM f_snap s2 JOIN f_txn t ON t.msno = s2.msno AND t.transaction_date <= s2.snapshot_date
               QUALIFY row_number() OVER (PARTITION BY s2.msno, s2.snapshot_date ORDER BY t.transaction_date DESC,
                 t.membership_expire_date DESC, t.is_auto_renew DESC, t.plan_list_price DESC) = 1) p
      ON p.msno = s.msno AND p.snapshot_date = s.snapshot_date
    LEFT JOIN ({SHARE_SQL}) h ON h.msno = s.msno AND h.snapshot_date = s.snapshot_date""", ["auto_renew_share"])
def latest_table_features(t):
    reg = t.f_snap.join(t.f_members.select("msno", "registration_date"), "msno", "left")
    return timeline.latest_table_features(t.f_txn, latest.latest_transaction(t.f_txn, tie_break=ROW_ID), reg)


@query("J7 A7", """
    SELECT s.msno, s.snapshot_date, CAST(sum(l.plan_list_price) AS BIGINT) AS paid, count(*) AS n
    FROM o_snap s JOIN o_txn l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
    GROUP BY s.msno, s.snapshot_date""")
def history_totals(t):
    return timeline.history_totals(t.o_txn, t.o_snap, {"paid": F.col("plan_list_price"), "n": F.lit(1)})


MEMBER_SQL = """
    SELECT g.snapshot_date, g.msno, g.city_clean, g.registered_via, g.registration_date,
           CAST(g.snapshot_date - g.registration_date AS INTEGER) AS tenure_days_at_snapshot,
           CASE WHEN g.registered_via IS NULL THEN 0 ELSE CAST(count(*) OVER (PARTITION BY g.snapshot_date, g.registered_via) AS DOUBLE)
             / count(*) OVER (PARTITION BY g.snapshot_date) END AS registered_via_freq,
           CASE WHEN g.city_clean IS NULL THEN 0 ELSE CAST(count(*) OVER (PARTITION BY g.snapshot_date, g.city_clean) AS DOUBLE)
             / count(*) OVER (PARTITION BY g.snapshot_date) END AS city_freq
    FROM (SELECT m.*, d.snapshot_date FROM {m} m JOIN (
            SELECT CAST(unnest(generate_series({a}, {b}, INTERVAL 1 DAY)) AS DATE) AS snapshot_date) d
          ON m.registration_date <= d.snapshot_date) g"""
FREQS = ["registered_via_freq", "city_freq"]


@query("J8 J11 A8 P6 P3 P7 P8", MEMBER_SQL.format(m="f_members", a="DATE '2023-09-01'", b="DATE '2024-01-20'"), FREQS)
def member_snapshot(t):
    return members.member_snapshots(t.f_members, "2023-09-01", "2024-01-20")


@query("J8 J14 A8", f"""
    SELECT x.* FROM ({MEMBER_SQL.format(m="o_members", a="DATE '1995-06-01'", b="DATE '1996-06-30'")}) x
    JOIN o_snap s ON s.msno = x.msno AND s.snapshot_date = x.snapshot_date""", FREQS)
def members_asof(t):
    pairs = snapshots.select_snapshots(t.o_snap, "range", "1995-06-01", "1996-06-30")
    return members.members_asof(t.o_members, pairs, "1995-06-01", "1996-06-30")


@query("A8 J8", """
    SELECT d.snapshot_date, m.registered_via, CAST(count(*) AS DOUBLE) / max(t.n) AS registered_via_freq
    FROM o_members m JOIN (SELECT CAST(unnest(generate_series(DATE '1994-06-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS DATE) AS snapshot_date) d
      ON m.registration_date <= d.snapshot_date
    JOIN (SELECT e.snapshot_date, count(*) AS n FROM o_members m2 JOIN (
            SELECT CAST(unnest(generate_series(DATE '1994-06-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS DATE) AS snapshot_date) e
            ON m2.registration_date <= e.snapshot_date GROUP BY e.snapshot_date) t ON t.snapshot_date = d.snapshot_date
    GROUP BY d.snapshot_date, m.registered_via""", ["registered_via_freq"])
def running_category_freq(t):
    return members.running_category_freq(t.o_members, "registered_via", "1994-06-01", "1995-12-31")


@query("A9", """SELECT city_clean, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM o_members) AS city_clean_freq
    FROM o_members GROUP BY city_clean""", ["city_clean_freq"])
def category_freq(t):
    return members.category_freq(t.o_members, "city_clean")


@query("A8", """
    SELECT is_cancel, payment_method_id, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY is_cancel)
           AS payment_method_id_freq FROM o_txn GROUP BY is_cancel, payment_method_id""", ["payment_method_id_freq"])
def category_freq_within(t):
    return members.category_freq(t.o_txn, "payment_method_id", ["is_cancel"])


@query("A9 J11", """
    SELECT m.*, CASE WHEN city_clean IS NULL THEN 0 ELSE CAST(count(*) OVER (PARTITION BY city_clean) AS DOUBLE) / count(*) OVER () END AS city_clean_freq,
           CAST(count(*) OVER (PARTITION BY registered_via) AS DOUBLE) / count(*) OVER () AS registered_via_freq
    FROM o_members m""", ["city_clean_freq", "registered_via_freq"])
def member_freq_enriched(t):
    return members.add_category_freq(t.o_members, ["city_clean", "registered_via"])


@query("P22", """SELECT *, CAST(DATE '1995-01-01' - registration_date AS INTEGER) AS tenure_days_at_snapshot
    FROM o_members WHERE registration_date <= DATE '1995-01-01'""")
def registered_asof(t):
    return snapshots.registered_asof(t.o_members, "1995-01-01")


@query("J8", """
    SELECT m.msno, d.snapshot_date FROM f_members m JOIN (
      SELECT CAST(unnest(generate_series(DATE '2023-12-01', DATE '2024-01-10', INTERVAL 1 DAY)) AS DATE) AS snapshot_date) d
      ON m.registration_date <= d.snapshot_date""")
def snapshot_grid(t):
    return snapshots.snapshot_grid(t.f_members, "2023-12-01", "2024-01-10", "registration_date").select(
        "msno", "snapshot_date")


STORE_SQL = f"""
    SELECT s.msno, s.snapshot_date, m.city_clean, m.registered_via, m.registration_date, m.tenure_days_at_snapshot,
           m.registered_via_freq, m.city_freq, a.num_unq_w30_sum, a.sum_secs_w30, a.active_days_w30, a.complete_rate_w30, a.sum_secs_w7,
           a.engagement_ratio_7_30, a.days_since_last_play, a.trend_secs_w30,
           x.tenure_days, x.last_is_auto_renew, x.last_plan_list_price, x.auto_renew_share
    FROM f_snap s
    LEFT JOIN ({MEMBER_SQL.format(m="f_members", a=START_SQL, b=END_SQL)}) m ON m.msno = s.msno AND m.snapshot_date = s.snapshot_date
    LEFT JOIN ({TRAIN_ACTIVITY}) a ON a.msno = s.msno AND a.snapshot_date = s.snapshot_date
    LEFT JOIN (SELECT s.msno, s.snapshot_date, CAST(coalesce(l.latest_transaction_date - m.registration_date, 0) AS INTEGER) AS tenure_days,
                      coalesce(l.is_auto_renew, 0) AS last_is_auto_renew, coalesce(l.plan_list_price, 0) AS last_plan_list_price,
                      coalesce(h.auto_renew_share, 0) AS auto_renew_share
               FROM f_snap s LEFT JOIN f_members m ON m.msno = s.msno AND m.registration_date <= s.snapshot_date
               LEFT JOIN (SELECT s.msno, s.snapshot_date, l.transaction_date AS latest_transaction_date, l.is_auto_renew, l.plan_list_price
                          FROM f_snap s JOIN f_txn l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
                          QUALIFY row_number() OVER (PARTITION BY s.msno, s.snapshot_date ORDER BY l.transaction_date DESC,
                            l.membership_expire_date DESC, l.is_auto_renew DESC, l.plan_list_price DESC) = 1) l
                 ON l.msno = s.msno AND l.snapshot_date = s.snapshot_date
               LEFT JOIN ({SHARE_SQL}) h ON h.msno = s.msno AND h.snapshot_date = s.snapshot_date) x
      ON x.msno = s.msno AND x.snapshot_date = s.snapshot_date"""
STORE_DOUBLES = {**DOUBLES, "registered_via_freq": 6, "city_freq": 6, "auto_renew_share": 6}


@query("J3 J6 J7 A1 A8 P9 P10", STORE_SQL, STORE_DOUBLES)
def feature_store(t):
    return medallion.feature_store(t.f_snap, t.f_members, t.f_txn, t.f_logs, *t.span, daily=True)


@query("J2 J14 P9 P10", STORE_SQL, STORE_DOUBLES)
def assembled_features(t):
    """The same table from separately built blocks joined together."""
    base = snapshots.attach_members(t.f_snap, members.member_snapshots(t.f_members, *t.span))
    activity = timeline.activity_features(t.f_logs, t.f_snap, bounds=t.span, daily=True).drop(*medallion.DAILY_SUMS)
    return snapshots.assemble(base, [activity, timeline.transaction_features(t.f_txn, base)])


@query("J1", f"""SELECT f.*, l.is_churn FROM ({STORE_SQL}) f JOIN f_label l
    ON l.msno = f.msno AND l.snapshot_date = f.snapshot_date""", STORE_DOUBLES)
def training_set(t):
    from ..operators.splits import training_set as join

    return join(feature_store(t), t.f_label)


@query("J1 J2 J13", REGISTRY["training_set"].sql, STORE_DOUBLES)
def training_set_bucketed(t):
    """The same rows from tables stored in buckets; one date is written a second time."""
    from ..operators.splits import training_set as join

    path, tables = shared_folder(t.spark), []
    for name, rows in (("features", feature_store(t)), ("labels", t.f_label)):
        table = f"{name}_{path.rsplit('/', 1)[1]}"
        whole = buckets.write_bucketed(rows, table, f"{path}/{name}", 8)
        again = whole.where(F.col(buckets.DAY) == t.span[0]).drop(buckets.DAY)
        tables.append(buckets.write_bucketed(materialise(again), table, f"{path}/{name}", 8).drop(buckets.DAY))
    return join(*tables)


@query("J13", """
    SELECT l.msno, l.snapshot_date, l.is_churn, CAST(sum(t.plan_list_price) AS BIGINT) AS paid
    FROM o_label l LEFT JOIN o_txn t ON t.msno = l.msno AND t.transaction_date = l.snapshot_date
    GROUP BY l.msno, l.snapshot_date, l.is_churn""")
def training_set_from_labels(t):
    from ..operators.splits import training_set as join

    feats = t.o_txn.groupBy("msno", F.col("transaction_date").alias("snapshot_date")).agg(
        F.sum("plan_list_price").alias("paid"))
    return join(feats, t.o_label, "left_from_labels")


INF_DAYS = ("2024-01-10", "2024-01-16")
INF_SNAP = f"""(SELECT m.msno, d.snapshot_date FROM f_members m JOIN (
    SELECT CAST(unnest(generate_series(DATE '{INF_DAYS[0]}', DATE '{INF_DAYS[1]}', INTERVAL 1 DAY)) AS DATE) AS snapshot_date) d
    ON m.registration_date <= d.snapshot_date)"""


INFERENCE = f"""
    SELECT s.msno, s.snapshot_date, m.registration_date, CAST(s.snapshot_date - m.registration_date AS INTEGER) AS tenure_days_at_snapshot,
           coalesce(m.registered_via, 0) AS registered_via_oh, coalesce(m.city_clean, 0) AS city_clean_oh,
           coalesce(a.sum_secs_w30, 0) AS sum_secs_w30, coalesce(a.active_days_w30, 0) AS active_days_w30,
           coalesce(a.complete_rate_w30, 0) AS complete_rate_w30, coalesce(a.sum_secs_w7, 0) AS sum_secs_w7,
           coalesce(a.engagement_ratio_7_30, 0) AS engagement_ratio_7_30,
           CAST(coalesce(s.snapshot_date - (SELECT max(l.date) FROM f_logs l WHERE l.msno = s.msno AND l.date <= s.snapshot_date), 0) AS INTEGER)
             AS days_since_last_play,
           coalesce(a.trend_secs_w30, 0) AS trend_secs_w30,
           CAST(coalesce(l.latest_transaction_date - m.registration_date, 0) AS INTEGER) AS tenure_days,
           coalesce(l.is_auto_renew, 0) AS last_is_auto_renew, coalesce(l.plan_list_price, 0) AS last_plan_list_price,
           coalesce(l.share, 0) AS auto_renew_share
    FROM {INF_SNAP} s JOIN f_members m ON m.msno = s.msno
    LEFT JOIN ({ACTIVITY_SQL.format(snap=INF_SNAP, lo7="-6", lo30="-29", hi="0")}) a ON a.msno = s.msno AND a.snapshot_date = s.snapshot_date
    LEFT JOIN (SELECT s.msno, s.snapshot_date, l.transaction_date AS latest_transaction_date, l.is_auto_renew, l.plan_list_price,
                      avg(CAST(l.is_auto_renew AS DOUBLE)) OVER (PARTITION BY s.msno, s.snapshot_date) AS share
               FROM {INF_SNAP} s JOIN f_txn l ON l.msno = s.msno AND l.transaction_date <= s.snapshot_date
               QUALIFY row_number() OVER (PARTITION BY s.msno, s.snapshot_date ORDER BY l.transaction_date DESC,
                 l.membership_expire_date DESC, l.is_auto_renew DESC, l.plan_list_price DESC) = 1) l
      ON l.msno = s.msno AND l.snapshot_date = s.snapshot_date"""


@query("J4 J15 I3 P21 P22 P9", INFERENCE, {**DOUBLES, "auto_renew_share": 6})
def inference_features(t):
    return medallion.inference_features(t.f_members, t.f_txn, t.f_logs, *INF_DAYS)


@query("I2 I3 J4 J15", INFERENCE, {**DOUBLES, "auto_renew_share": 6})
def inference_features_from_state(t):
    """The same rows, one date after the other, each from the state of the date before."""
    out, day, rows, known = shared_folder(t.spark), dt.date.fromisoformat(INF_DAYS[0]), [], materialise(t.f_members)
    while day.isoformat() <= INF_DAYS[1]:
        rows.append(medallion.extend_inference(known, t.f_txn, t.f_logs, out, day.isoformat()))
        day += dt.timedelta(days=1)
    return reduce(DataFrame.unionByName, rows)
