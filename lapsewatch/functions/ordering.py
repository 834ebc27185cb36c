"""Running sums and exact quantiles over one global order, spread over many tasks.

A window without a partition (or with a partition that holds a third of the rows) sorts in a single
task. Here the order is cut into buckets at approximate quantiles; each bucket is one window
partition, and the bucket totals, a table of at most groups x buckets rows, carry the sums across.
The result is exact: the sketch only decides where the cuts lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.writers import materialise

BUCKETS = 1024
#: Rank error of the sketch that brackets a quantile (one part in so many), and how far brackets may reach, nearest first.
ACCURACY = 1000
REACH = (0.005, 0.02, 0.1, 0.3)
#: Counted values that are ranked by one window per group; more are cut into buckets first.
ONE_TASK = 1_000_000


def value_buckets(df: DataFrame, value: str, buckets: int = BUCKETS, name: str = "_bucket") -> DataFrame:
    """Add a bucket number that grows with ``value`` and holds about equally many rows.

    ``buckets`` is a power of two. The number of cuts below a value is found by halving, one projection
    per step, so the whole search is compiled.
    """
    probs = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    cuts = df.agg(F.expr(f"percentile_approx(`{value}`, array({probs}), {buckets * 4}) AS c"))
    out = df.withColumns({"_cuts": cuts.scalar(), name: F.lit(0)})
    step = buckets // 2
    while step:
        above = F.col(value) > F.get("_cuts", F.col(name) + (step - 1))
        out = out.withColumn(name, F.col(name) + F.when(above, step).otherwise(0))
        step //= 2
    return out.drop("_cuts")


def hash_buckets(df: DataFrame, hex_digest: str, digits: int = 3, name: str = "_bucket") -> DataFrame:
    """Bucket by the leading hex digits of a digest: 16 ** digits even buckets in digest order."""
    return df.withColumn(name, F.substring(hex_digest, 1, digits))


def running_sums(
    bucketed: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    sums: dict[str, Column],
    bucket: str = "_bucket",
) -> DataFrame:
    """Running sums before each row (``<name>_before``) and over the group (``<name>_total``).

    ``order`` must refine the bucket order and be total inside a group. Group columns may be NULL.
    """
    src = bucketed.withColumns({f"_v_{n}": c for n, c in sums.items()})
    totals = src.groupBy(*by, bucket).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    group = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = totals.withColumns({
        **{f"_o_{n}": F.coalesce(F.sum(f"_t_{n}").over(earlier), zero) for n in sums},
        **{f"{n}_total": F.sum(f"_t_{n}").over(group) for n in sums},
    }).drop(*[f"_t_{n}" for n in sums])

    keys = [*by, bucket]
    renamed = offsets.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = src.join(renamed, same, "inner").drop(*[f"_k_{k}" for k in keys])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumns({
        f"{n}_before": F.col(f"_o_{n}") + F.coalesce(F.sum(f"_v_{n}").over(inside), zero) for n in sums
    }).drop(bucket, *[f"_o_{n}" for n in sums], *[f"_v_{n}" for n in sums])


def running_counts(counts: DataFrame, by: Sequence[str], value: str, sums: dict[str, Column]) -> DataFrame:
    """:func:`running_sums` of a table with one row per distinct value, which is written first.

    Up to ONE_TASK rows one window per group is enough; more are cut into buckets of the value. Both give the same rows.
    """
    counts = materialise(counts)
    if counts.count() > ONE_TASK:
        return running_sums(value_buckets(counts, value), by, [value], sums)
    order = Window.partitionBy(*by).orderBy(value)
    before, zero = order.rowsBetween(Window.unboundedPreceding, -1), F.lit(0)
    return counts.withColumns({
        **{f"{n}_before": F.coalesce(F.sum(c).over(before), zero) for n, c in sums.items()},
        **{f"{n}_total": F.sum(c).over(Window.partitionBy(*by)) for n, c in sums.items()}})


def holds_rank(rank: Column, n: Column, before: Column) -> Column:
    """Whether a run of ``n`` equal values with ``before`` smaller ones covers a zero-based rank."""
    return (rank >= before) & (rank < before + n)


def position(p: float | Column, total: Column) -> Column:
    """Where the p-quantile lies among ``total`` sorted values; between two ranks it is interpolated."""
    return p * (total - 1)


def interpolate(lo: Column, hi: Column, frac: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(lo * (1 - frac) + hi * frac)


def _picked(ranked: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles of counted values (``v`` with ``n`` rows, ``n_before`` smaller ones of ``n_total``): by..., prob, value."""
    n, before, total = F.col("n"), F.col("n_before"), F.col("n_total")

    def sides(p):
        pos = position(p, total)
        return holds_rank(F.floor(pos), n, before), holds_rank(F.ceil(pos), n, before)

    wanted = F.lit(False)
    for p in probs:
        lo, hi = sides(F.lit(float(p)))
        wanted = wanted | lo | hi
    # few rows remain: at most two per quantile and group
    few = ranked.where(wanted).withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    lo, hi = sides(F.col("prob"))
    pos = position(F.col("prob"), total)
    found = few.groupBy(*by, "prob").agg(
        F.max(F.when(lo, F.col("v"))).alias("lo"), F.max(F.when(hi, F.col("v"))).alias("hi"),
        F.max(pos - F.floor(pos)).alias("frac"))
    return found.select(*by, "prob", interpolate(F.col("lo"), F.col("hi"), F.col("frac")).alias("value"))


def ranked_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Quantiles by ranking all distinct values, in the form of :func:`exact_quantiles`; nothing runs before the result is used."""
    counts = (
        df.select(*by, *[F.col(c).cast("double").alias(f"_c_{c}") for c in cols])
        .unpivot(list(by), [f"_c_{c}" for c in cols], "column", "v")
        .where(F.col("v").isNotNull())
        .groupBy(*by, F.substring("column", 4, 1000).alias("column"), "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = [*by, "column"]
    return _picked(running_sums(value_buckets(counts, "v", buckets), group, ["v"], {"n": F.col("n")}), probs, group)


def _once(df: DataFrame) -> DataFrame:
    """``df`` itself where it only scans, filters and projects; else a written copy, so that several passes compute it once."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialise(df) if any(node in plan for node in ("Aggregate", "Join", "Window", "Generate")) else df


def _number(x: float | None) -> str:
    """A double as SQL text."""
    return "CAST(NULL AS DOUBLE)" if x is None else f"double('{x!r}')"


def _brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """One row per group with two values around each quantile (``_lo<column>_<prob>``, ``_hi...``), by number.

    The values come from a sketch in one pass; NULL leaves a side open. A sketch may be off by 1 / ACCURACY of the rows and a
    rank by one row, so the bracket reaches out by at least twice both.
    """
    grid = sorted({round(p + s, 12) for p in probs for r in REACH for s in (-r, r) if 0 < p + s < 1})
    asked = f"array({', '.join(map(str, grid))})"
    aggs = [f for j, c in enumerate(cols) for f in (
        F.expr(f"count(`{c}`) AS _n{j}"), F.expr(f"percentile_approx(CAST(`{c}` AS DOUBLE), {asked}, {ACCURACY}) AS _e{j}"))]

    def end(j: int, p: float, sign: int) -> str:
        cases = []
        for r in REACH:
            at = round(p + sign * r, 12)
            value = f"get(_e{j}, {grid.index(at)})" if 0 < at < 1 else _number(None)
            cases.append(f"WHEN {2 / ACCURACY}D + 2D / nullif(_n{j}, 0) <= {r}D THEN {value}")
        return f"CASE {' '.join(cases)} END"

    ends = [f"{end(j, p, s)} AS _{name}{j}_{i}" for j in range(len(cols)) for i, p in enumerate(probs)
            for name, s in (("lo", -1), ("hi", 1))]
    sketches = materialise(df.groupBy(*by).agg(*aggs))
    return sketches.selectExpr(*[f"`{b}` AS `_k_{b}`" for b in by], *[f"_n{j}" for j in range(len(cols))], *ends)


def _inside(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counted values inside each bracket (by..., j, i, v, n), and per group how many values lie below each
    (``_below<j>_<i>``) or, where a bracket is one value, are equal to it (``_at<j>_<i>``, ``_v<j>_<i>``)."""
    if by:
        same = [F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in by]
        at, rows = str, df.join(ends, same, "inner")
    else:
        row = ends.first()  # one row
        at, rows = (lambda name: _number(row[name])), df
    below, hits = [], []
    for j, c in enumerate(cols):
        v = f"CAST(`{c}` AS DOUBLE)"
        below.append(F.expr(f"max({at(f'_n{j}')}) AS _n{j}"))
        for i in range(len(probs)):
            lo, hi = at(f"_lo{j}_{i}"), at(f"_hi{j}_{i}")
            one = f"{lo} = {hi}"  # a bracket of one value needs no more than two counts
            below += [F.expr(f"count_if({v} < {lo}) AS _below{j}_{i}"), F.expr(f"count_if({one} AND {v} = {lo}) AS _at{j}_{i}"),
                      F.expr(f"max({lo}) AS _v{j}_{i}")]
            hits.append(f"CASE WHEN {v} IS NOT NULL AND ({lo} IS NULL OR {v} >= {lo}) AND ({hi} IS NULL OR {v} <= {hi}) "
                        f"AND NOT coalesce({one}, false) THEN struct({j} AS j, {i} AS i, {v} AS v) END")
    counted = rows.select(*by, F.expr(f"explode(array({', '.join(hits)})) AS q")).where("q IS NOT NULL").groupBy(*by, "q.j", "q.i", "q.v").agg(
        F.count(F.lit(1)).alias("n"))
    return counted, rows.groupBy(*by).agg(*below)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Linear-interpolation quantiles, long form: by..., column, prob, value.

    Selection by refinement: a sketch puts a narrow bracket around each wanted rank in one pass; then the values below each
    bracket are counted, and those inside are counted one by one, so only about a hundredth of the rows is shuffled and
    ranked. The counts are exact whatever the sketch says, and a rank outside its bracket would be seen: such a call ranks all
    values (:func:`ranked_quantiles`). The passes run at once; the result is a small written table.
    """
    by, probs = list(by), [float(p) for p in probs]
    df = _once(df.select(*by, *dict.fromkeys(c for c in cols if c not in by)))
    ends = _brackets(df, cols, probs, by)
    counts, below = _inside(df, cols, probs, by, ends)
    counts, group = materialise(counts), [*by, "j", "i"]
    if counts.count() <= ONE_TASK:
        order = Window.partitionBy(*group).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("n_before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    else:
        ranked = running_sums(value_buckets(counts, "v", buckets), group, ["v"], {"n": F.col("n")})
    items = ", ".join(f"struct({j} AS _j, {i} AS _i, {j} AS _c, {p}D AS prob, _n{j} AS total, _below{j}_{i} AS below, "
                      f"_at{j}_{i} AS same, _v{j}_{i} AS value)" for j in range(len(cols)) for i, p in enumerate(probs))
    wanted = below.selectExpr(*[f"`{b}` AS `_k_{b}`" for b in by], f"inline(array({items}))").where("total > 0")
    wanted = wanted.withColumn("column", F.get(F.array(*map(F.lit, cols)), "_c"))
    same = [F.col(b).eqNullSafe(F.col(f"_k_{b}")) for b in by] + [F.col("j") == F.col("_j"), F.col("i") == F.col("_i")]
    pos, before = position(F.col("prob"), F.col("total")), F.col("below") + F.col("n_before")
    pick = lambda rank: F.max(F.when(holds_rank(rank, F.col("n"), before), F.col("v")).when(
        holds_rank(rank, F.col("same"), F.col("below")), F.col("value")))
    found = materialise(
        wanted.join(ranked, same, "left").groupBy(*[F.col(f"_k_{b}").alias(b) for b in by], "column", "prob")
        .agg(pick(F.floor(pos)).alias("lo"), pick(F.ceil(pos)).alias("hi"), F.max(pos - F.floor(pos)).alias("frac"))
        .select(*by, "column", "prob", interpolate(F.col("lo"), F.col("hi"), F.col("frac")).alias("value")))
    if found.where(F.col("value").isNull()).isEmpty():
        return found
    return ranked_quantiles(df, cols, probs, by, buckets)


def sketch_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 1000,
) -> DataFrame:
    """Approximate form of :func:`exact_quantiles` in one pass with mergeable sketches.

    Relative rank error is 1/accuracy.
    """
    aggs = [F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in cols]
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
        for c in cols
        for i, p in enumerate(probs)
    ]
    return (
        df.groupBy(*by).agg(*aggs)
        .select(*by, F.explode(F.array(*entries)).alias("q"))
        .select(*by, "q.column", "q.prob", "q.value")
    )


def quantiles(df, cols, probs, by=(), exact=True, accuracy=1000) -> DataFrame:
    if exact:
        return exact_quantiles(df, cols, probs, by)
    return sketch_quantiles(df, cols, probs, by, accuracy)
