import numpy as np
import pytest

from lapsewatch.operators import monitor, score_counts

KIND = "model_file string, snapshot_date string, churn_proba double, label int"


def scored(spark, rows):
    return spark.createDataFrame(rows, KIND).withColumn("snapshot_date", monitor.F.to_date("snapshot_date"))


def rows(n, seed):
    rng = np.random.default_rng(seed)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    return [("m" if i % 5 else "other", days[i % 3], None if i % 17 == 0 else float(rng.integers(0, 40) / 40), [0, 1, None][i % 3 if i % 7 else 2])
            for i in range(n)]


def test_report_from_state_equals_report_from_rows(spark, tmp_path):
    data = rows(900, 0)
    df, path = scored(spark, data), str(tmp_path / "counts")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):  # one run a day, the last one twice
        score_counts.write_counts(df.where(f"snapshot_date = '{day}'"), path)
    score_counts.write_counts(df.where("snapshot_date = '2024-01-03'"), path, label="label")
    got = score_counts.monitor_counts(spark, path, "m", "2024-01-03", ("2024-01-01", "2024-01-02"))
    assert got.columns == ["model_file", "snapshot_date", "baseline_start", "baseline_end", "section", "metric", "value"]
    mine = df.where("model_file = 'm'")
    base, cur = mine.where("snapshot_date < '2024-01-03'"), mine.where("snapshot_date = '2024-01-03'")
    counted = score_counts.count_scores(cur, "churn_proba", (), "label")
    want = score_counts.report(score_counts.compared(score_counts.count_scores(base, "churn_proba", ()), counted))
    assert sorted(map(str, got.select("section", "metric", "value").collect())) == sorted(map(str, want.collect()))
    values = {(r["section"], r["metric"]): r["value"] for r in want.collect()}
    x = np.array([r[2] for r in data if r[0] == "m" and r[1] == "2024-01-03" and r[2] is not None])
    assert values["current_summary", "count"] == len(x) and values["current_summary", "std"] == pytest.approx(x.std())
    assert values["current_summary", "median"] == pytest.approx(np.median(x))
    known = [r for r in data if r[0] == "m" and r[1] == "2024-01-03"]
    assert values["label_metrics", "matched"] == sum(r[3] is not None for r in known)
    assert values["label_metrics", "unmatched"] == sum(r[3] is None for r in known)


def test_another_date_reads_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "counts")
    score_counts.write_counts(scored(spark, rows(300, 1)), path)
    one = score_counts.read_counts(spark, path, "m", "2024-01-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "snapshot_date" in filters and "model_file" in filters


def test_empty_sides_and_rounding(spark):
    none, some = scored(spark, []), scored(spark, rows(60, 2))
    for base, cur in ((none, some), (some, none), (none, none)):
        got = {(r["section"], r["metric"]): r["value"] for r in monitor.monitor(base, cur, "churn_proba").collect()}
        assert got["drift", "psi"] is None and got["drift", "ks_stat"] is None and got["drift", "code"] == 0
    tiny = scored(spark, [("m", "2024-01-01", 0.5 + i * 1e-9, 1) for i in range(50)])
    assert score_counts.count_scores(tiny, "churn_proba", digits=6).count() == 1
    assert score_counts.count_scores(tiny, "churn_proba").count() == 50
