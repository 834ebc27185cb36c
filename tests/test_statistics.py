import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewatch.functions import ordering
from lapsewatch.operators import monitor, prep, splits
from helpers import day, plus, records


def frame(spark, values, name="score"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def np_psi(expected, actual, bins=10, eps=1e-8):
    cuts = np.unique(np.quantile(expected, np.linspace(0, 1, bins + 1)))
    if len(cuts) == 1:
        cuts = np.linspace(cuts[0], cuts[0], bins + 1)
    e, a = np.histogram(expected, cuts)[0], np.histogram(actual, cuts)[0]
    e, a = e / (e.sum() + eps), a / (a.sum() + eps)
    e, a = np.where(e == 0, eps, e), np.where(a == 0, eps, a)
    return float(np.sum((e - a) * np.log(e / a)))


def np_ks(a, b):
    at = np.sort(np.concatenate([a, b]))
    f = lambda x: np.searchsorted(np.sort(x), at, side="right") / len(x)
    return float(np.max(np.abs(f(a) - f(b))))


RNG = np.random.default_rng(1)
SAMPLES = {
    "continuous": RNG.normal(size=997),
    "hot": np.concatenate([np.full(400, 0.25), RNG.random(600), [-1e15, 1e15]]),
    "few": RNG.integers(0, 4, 500).astype(float),
    "one": np.array([3.5]),
    "pair": np.array([1.0, 2.0]),
}


@pytest.mark.parametrize("name", list(SAMPLES))
def test_exact_quantiles_match_numpy(spark, name):
    x = SAMPLES[name]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r.prob: r.value for r in ordering.exact_quantiles(frame(spark, x), ["score"], probs, buckets=16).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_by_group_with_nulls(spark):
    rows = [("a" if i % 3 else None, float(i * 7 % 100), None if i % 4 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r.g, r["column"]): r.value for r in ordering.exact_quantiles(df, ["x", "y"], [0.5], ["g"], buckets=8).collect()}
    for g in ("a", None):
        assert got[(g, "x")] == pytest.approx(np.quantile([r[1] for r in rows if r[0] == g], 0.5))
        assert got[(g, "y")] == pytest.approx(np.quantile([r[2] for r in rows if r[0] == g and r[2] is not None], 0.5))


def test_sketch_is_close(spark):
    x = RNG.random(5000)
    got = {r.prob: r.value for r in ordering.sketch_quantiles(frame(spark, x), ["score"], [0.25, 0.75]).collect()}
    assert got[0.25] == pytest.approx(0.25, abs=0.02) and got[0.75] == pytest.approx(0.75, abs=0.02)


def test_running_sums_over_buckets(spark):
    vals = list(range(300)) + [50] * 100
    counts = frame(spark, vals, "v").groupBy("v").count()
    out = ordering.running_sums(ordering.value_buckets(counts, "v", 8), [], ["v"], {"n": F.col("count")}).collect()
    for r in out:
        assert r.n_before == sum(x < r.v for x in vals) and r.n_total == 400


@pytest.mark.parametrize("base,cur", [
    ("continuous", "hot"), ("hot", "few"), ("few", "few"), ("continuous", "continuous"), ("one", "one"), ("one", "pair"),
])
def test_drift_statistics_match_numpy(spark, base, cur):
    a, b = SAMPLES[base], SAMPLES[cur]
    fa, fb = frame(spark, a), frame(spark, b)
    got = monitor.psi(fa, fb, "score").first().psi
    assert got == pytest.approx(np_psi(a, b), rel=1e-6, abs=1e-6)
    ks = monitor.ks(fa, fb, "score").first()
    assert ks.ks_stat == pytest.approx(np_ks(a, b), abs=1e-12)
    assert 0 <= ks.ks_pvalue <= 1
    if base == cur:
        assert got == pytest.approx(0, abs=1e-6) and ks.ks_stat == 0 and ks.ks_pvalue == 1
    rep = {(r.section, r.metric): r.value for r in monitor.monitor(fa, fb, "score").collect()}
    assert rep[("drift", "psi")] == pytest.approx(got, abs=1e-9) and rep[("drift", "ks_stat")] == pytest.approx(ks.ks_stat)
    assert rep[("current_summary", "p30")] == pytest.approx(np.quantile(b, 0.3))
    assert rep[("baseline_summary", "std")] == pytest.approx(np.std(a), rel=1e-9)


def test_empty_sides(spark):
    full, none = frame(spark, [0.1, 0.2]), frame(spark, [])
    assert monitor.psi(full, none, "score").first().psi is None
    assert monitor.ks(full, none, "score").first().ks_stat is None
    assert monitor.drift_status(monitor.psi(full, none, "score")).first().status == "unknown"


def test_sketch_report_has_the_same_lines(spark):
    a, b = frame(spark, SAMPLES["continuous"]), frame(spark, SAMPLES["hot"])
    names = lambda exact: {(r.section, r.metric) for r in monitor.monitor(a, b, "score", exact=exact).collect()}
    assert names(True) == names(False)


def test_auc_with_ties_and_one_class(spark):
    rng = np.random.default_rng(4)
    s, y = np.round(rng.random(300), 1), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(float(a), int(b), "x") for a, b in zip(s, y)] + [(0.3, 1, "y")], "s double, y int, g string")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    got = {r.g: r.roc_auc for r in monitor.roc_auc(df, "s", "y", ["g"]).collect()}
    assert got["x"] == pytest.approx(want) and got["y"] is None


def test_threshold_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "s double, y int")
    m = monitor.classification_metrics(df, "s", "y").first()
    assert (m.precision, m.recall, m.f1) == (0.5, 0.5, 0.5)
    none = monitor.classification_metrics(df.where("s < 0.5"), "s", "y").first()
    assert (none.precision, none.recall, none.f1) == (0, 0, 0)
    curve = [(r.threshold, r.fpr, r.tpr) for r in monitor.roc_curve(df, "s", "y").orderBy("threshold").collect()]
    assert curve == [(None, 0, 0), (0.1, 1, 1), (0.4, 0.5, 1), (0.5, 0.5, 0.5), (0.9, 0, 0.5)]


def test_unmatched_labels_are_reported(spark):
    preds = spark.createDataFrame([("a", day("2024-01-01"), 0.2), ("b", day("2024-01-01"), 0.8)],
                                  "msno string, snapshot_date date, score double")
    labels = spark.createDataFrame([("b", day("2024-01-01"), 1)], "msno string, snapshot_date date, is_churn int")
    rep = {r.metric: r.value for r in monitor.monitor(preds, preds, "score", labels).where("section = 'label_metrics'").collect()}
    assert rep["matched"] == 1 and rep["unmatched"] == 1 and rep["roc_auc"] is None and rep["recall"] == 1


def labelled(spark, n=1000):
    rng = np.random.default_rng(9)
    return spark.createDataFrame(
        [(f"u{i}", plus("2023-01-01", i % 420), int(rng.random() < 0.7)) for i in range(n)],
        "msno string, snapshot_date date, is_churn int")


def test_split_calendar(spark):
    w = {r.split: (str(r.start_date), str(r.end_date)) for r in splits.split_windows(spark, "2016-12-31").collect()}
    assert w == {"oot": ("2016-10-31", "2016-12-30"), "test": ("2016-08-31", "2016-10-30"),
                 "val": ("2016-06-30", "2016-08-30"), "train": ("2015-10-30", "2016-06-29")}
    tagged = splits.temporal_split(labelled(spark), "2024-02-01")
    assert tagged.where("split IS NULL").count() == 0
    assert {r.split for r in tagged.select("split").distinct().collect()} == {"train", "val", "test", "oot"}


def test_stratified_choices(spark):
    df = labelled(spark)
    sizes = {r.is_churn: r["count"] for r in df.groupBy("is_churn").count().collect()}
    parts = {(r.is_churn, r.part): r["count"] for r in
             splits.stratified_split(df, "label", 0.8).groupBy("is_churn", "part").count().collect()}
    for y, n in sizes.items():
        assert parts[(y, "train")] == math.floor(n * 0.8 + 0.5) and parts[(y, "train")] + parts[(y, "test")] == n
    folds = splits.assign_folds(df, "label", 5).groupBy("is_churn", "fold").count().collect()
    for y in sizes:
        per = [r["count"] for r in folds if r.is_churn == y]
        assert len(per) == 5 and max(per) - min(per) <= 1
    one = splits.stratified_sample(df, "label", 0.3, keys=splits.KEYS)
    assert sorted(one.collect()) == sorted(splits.stratified_sample(df, "label", 0.3, keys=splits.KEYS).collect())
    assert 0.2 < one.count() / 1000 < 0.4


def test_encoders_fit_on_train_only(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 3.0), (None, 3.0), (3, 5.0)], "c int, x double")
    other = spark.createDataFrame([(3, 1.0), (9, 3.0)], "c int, x double")
    hot = prep.OneHot.fit(train, ["c"])
    assert hot.columns() == ["c_2", "c_3"]
    assert [tuple(r) for r in hot.transform(other).collect()] == [(1.0, 0, 1), (3.0, 0, 0)]
    with pytest.raises(ValueError):
        prep.OneHot.fit(train, ["c"], limit=2)
    z = [r.x for r in prep.Scaler.fit(train, ["x"]).transform(train).collect()]
    assert np.mean(z) == pytest.approx(0) and np.std(z) == pytest.approx(1)
    flat = train.withColumn("x", F.lit(4.0))
    assert {r.x for r in prep.Scaler.fit(flat, ["x"]).transform(flat).collect()} == {0.0}


def test_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert sorted(r.weight for r in prep.class_weights(df, "y").collect()) == pytest.approx([2 / 3, 2 / 3, 2 / 3, 2])
    assert prep.pos_weight(df, "y").first()[0] == 3
    assert prep.pos_weight(df.where("y = 0"), "y").first()[0] is None
    filled = prep.missing_flag_fill(spark.createDataFrame([(None, 1.0), (2.0, 2.0)], "a double, b double"), ["a", "b"])
    assert records(filled) == [{"a": 0.0, "b": 1.0, "missing_any": 1}, {"a": 2.0, "b": 2.0, "missing_any": 0}]
