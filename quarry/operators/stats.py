"""Aggregations and statistics.

Each statistic is one aggregate pass (partial aggregation map-side, a
single small row or a bins-sized table shuffled). Where a second pass is
needed (fences after quartiles, density after bandwidth) the first
result is a handful of literals, never data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config as C
from quarry.functions.columns import bias_verdict, nan_to_null, number, q, significance_verdict, to_numeric
from quarry.operators.quantile import exact_quantiles


def lit_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stack_row(df_one_row: DataFrame, pairs, key: str = "feature", value: str = "value") -> DataFrame:
    """Turn named columns of a one-row aggregate into ``(key, value)`` rows."""
    if not pairs:
        return df_one_row.sparkSession.createDataFrame([], f"{key} string, {value} double")
    args = ", ".join(f"{lit_str(name)}, {q(col)}" for name, col in pairs)
    return df_one_row.select(F.expr(f"stack({len(pairs)}, {args}) AS ({key}, {value})"))


def _norm_value(f: T.StructField) -> Column:
    c = F.col(q(f.name))
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        c = F.when(F.isnan(c), F.lit(None)).otherwise(c + F.lit(0.0))  # -0.0 and 0.0 are one value
    return c.cast("string")


def n_unique(df: DataFrame, cols=None) -> DataFrame:
    """A1: distinct non-null count per column, as ``(column, n_unique)``.

    Unpivot once, then two aggregations: (column, value) distinct with a
    map-side partial aggregate, then a count per column.
    """
    cols = list(cols or df.columns)
    spark = df.sparkSession
    fields = [df.schema[c] for c in cols]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), _norm_value(f).alias("value")) for f in fields])).alias("kv")) \
        .select("kv.column", "kv.value").filter(F.col("value").isNotNull())
    counts = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos int")
    return (names.join(counts, "column", "left")
            .select("column", F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"), "pos")
            .orderBy("pos").drop("pos"))


def fit_means(df: DataFrame, cols, only_if_null: bool = True) -> dict:
    """A2 (fit): column means, in one aggregate. With ``only_if_null``
    only columns that actually hold a null get a fill value."""
    cols = list(cols)
    if not cols:
        return {}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.avg(number(q(c))).alias(f"m{i}"), F.count(number(q(c))).alias(f"c{i}")]
    r = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        if r[f"m{i}"] is None:
            continue
        if only_if_null and r[f"c{i}"] == r["_n"]:
            continue
        out[c] = r[f"m{i}"]
    return out


def fill_numbers(df: DataFrame, values: dict) -> DataFrame:
    """Missing numbers (null or NaN) of the given columns become their value;
    the column is then a double, so that an integer column keeps a fraction."""
    return df.select(*[F.coalesce(number(q(c)), F.lit(float(values[c]))).alias(c) if c in values else F.col(q(c)) for c in df.columns])


def impute_mean(df: DataFrame, cols, only_if_null: bool = True) -> DataFrame:
    """A2: numeric nulls → column mean."""
    means = fit_means(df, cols, only_if_null)
    return fill_numbers(df, means) if means else df


def fit_medians(df: DataFrame, cols, approx: bool = False, accuracy: int = 100_000) -> dict:
    """A3 (fit): exact medians of several columns in one narrowing run
    (columns become groups of an unpivoted frame); ``approx`` uses one
    ``percentile_approx`` pass instead (rank error ≤ n/accuracy)."""
    cols = list(cols)
    if not cols:
        return {}
    if approx:
        r = df.agg(*[F.percentile_approx(number(q(c)), 0.5, accuracy).alias(f"m{i}")
                     for i, c in enumerate(cols)]).first()
        return {c: r[f"m{i}"] for i, c in enumerate(cols) if r[f"m{i}"] is not None}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), number(q(c)).alias("x")) for c in cols])).alias("kv")) \
        .select("kv.column", "kv.x")
    res = exact_quantiles(long, "x", [0.5], by=["column"]).collect()
    return {r["column"]: r["value"] for r in res}


def impute_median(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """A3: numeric nulls → median (exact by default)."""
    med = fit_medians(df, cols, approx)
    return fill_numbers(df, med) if med else df


def sample_skewness(c) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``; Spark's is population)."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.try_divide(F.sqrt(n * (n - 1)), n - 2) * F.skewness(c))


def describe_target(df: DataFrame, col: str) -> DataFrame:
    """A4 + C12: n, mean, median, sample std, sample skew and verdicts."""
    x = number(col)
    med = exact_quantiles(df, col, [0.5]).first()
    base = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                  sample_skewness(x).alias("skew"))
    base = base.withColumn("median", F.lit(med["value"] if med else None).cast("double"))
    mv, sv = bias_verdict("mean", "skew")
    return base.select("n", "mean", "median", "std", "skew", mv.alias("mean_verdict"), sv.alias("skew_verdict"))


def value_counts(df: DataFrame, col: str, value_name: str | None = None) -> DataFrame:
    """A5: rows per value, most frequent first (value as tiebreak)."""
    name = value_name or col
    return (df.groupBy(F.col(col).alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(name)))


def class_distribution(splits: dict, label: str = "label") -> DataFrame:
    """Counts per (split, label) over several labelled frames."""
    frames = [d.select(F.lit(name).alias("split"), F.col(label).alias("label")) for name, d in splits.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("split", "label")


def class_distribution_from_split(df: DataFrame, label: str = "label", split_col: str = "split",
                                  balanced: DataFrame | None = None) -> DataFrame:
    """A6 in one pass over a split table: every row counts for 'original'
    and for its own split; training rows also for 'train_after_balancing'
    unless a balanced training frame is given."""
    names = F.when(F.col(split_col) == "train",
                   F.array(F.lit("original"), F.lit("train_before_balancing"),
                           *([] if balanced is not None else [F.lit("train_after_balancing")])))
    names = names.otherwise(F.array(F.lit("original"), F.col(split_col)))
    u = df.select(F.explode(names).alias("split"), F.col(label).alias("label"))
    if balanced is not None:
        u = u.unionByName(balanced.select(F.lit("train_after_balancing").alias("split"), F.col(label).alias("label")))
    return u.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("split", "label")


def min_max(df: DataFrame, col: str) -> DataFrame:
    """Column range (NaN is missing)."""
    return nan_to_null(df.select(col)).agg(F.min(col).alias("min"), F.max(col).alias("max"))


def histogram(df: DataFrame, col: str, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed."""
    x = number(col)
    r = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn, mx = r["mn"], r["mx"]
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    if mn == mx:
        mn, mx = mn - 0.5, mx + 0.5
    b = F.least(F.lit(bins), F.width_bucket(x, F.lit(mn), F.lit(mx), F.lit(bins))).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = (mx - mn) / bins
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(F.broadcast(counts), "bin", "left")
            .select("bin", (F.lit(mn) + (F.col("bin") - 1) * F.lit(w)).alias("bin_lo"),
                    (F.lit(mn) + F.col("bin") * F.lit(w)).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .orderBy("bin"))


#: Bins per bandwidth of the density's bin table.
KDE_BINS_PER_BANDWIDTH = 20_000


def kde(df: DataFrame, col: str, grid=None, n_grid: int = 200) -> DataFrame:
    """Gaussian density on a grid with Scott's bandwidth h.

    One pass for (n, sample std, min, max); one that shares each row between
    the two bins beside it (linear binning, added up before the shuffle); the
    kernel is then evaluated over the occupied bins, whose number depends on
    range / h and not on the rows. With bins of width h / b the density is off by at most
    1 / (8 b² h √(2π)): the kernel is replaced by its chords, and its second
    derivative is at most 1. b is KDE_BINS_PER_BANDWIDTH, so that is 3e-10 of the kernel's height.
    """
    x = number(q(col))
    r = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("mn"),
               F.max(x).alias("mx")).first()
    n, sd = r["n"], r["sd"]
    if not n or not sd:
        return df.sparkSession.createDataFrame([], "gx double, density double")
    bw = sd * n ** (-0.2)
    if grid is None:
        grid = [r["mn"] + (r["mx"] - r["mn"]) * i / (n_grid - 1) for i in range(n_grid)]
    grid = [float(g) for g in grid]
    norm = n * bw * math.sqrt(2 * math.pi)
    width = bw / KDE_BINS_PER_BANDWIDTH
    at = df.select(((x - F.lit(r["mn"])) / F.lit(width)).alias("at")).filter(F.col("at").isNotNull())
    low, share = F.floor("at"), F.col("at") - F.floor("at")
    halves = at.select(F.explode(F.array(F.struct(low.alias("bin"), (1 - share).alias("w")), F.struct((low + 1).alias("bin"), share.alias("w")))).alias("h"))
    bins = halves.filter("h.w > 0").groupBy("h.bin").agg(F.sum("h.w").alias("w"))
    centre = F.lit(r["mn"]) + F.col("bin") * F.lit(width)
    sums = bins.agg(*[F.sum(F.col("w") * F.exp(-0.5 * F.pow((F.lit(g) - centre) / F.lit(bw), 2))).alias(f"g{i}")
                      for i, g in enumerate(grid)])
    args = ", ".join(f"CAST({g!r} AS DOUBLE), g{i}" for i, g in enumerate(grid))
    return sums.select(F.expr(f"stack({len(grid)}, {args}) AS (gx, s)")) \
        .select("gx", (F.col("s") / F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """A10: quartiles, whiskers (extreme data within 1.5·IQR) and outliers.

    Quartiles come from the exact narrowing operator; the whisker pass
    joins the per-group quartile table (one row per group).
    """
    by = list(by or [])
    qs = exact_quantiles(df, col, [0.25, 0.5, 0.75], by=by)
    qw = (qs.groupBy(*by).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
          .withColumnRenamed("0.25", "q1").withColumnRenamed("0.5", "median").withColumnRenamed("0.75", "q3"))
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    src = df.select(*by, number(col).alias("_x")).filter(F.col("_x").isNotNull())
    if by:  # null is a group like any other
        keys = qw.select(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)], "q1", "median", "q3")
        same = [F.col(b).eqNullSafe(F.col(f"_g{i}")) for i, b in enumerate(by)]
        joined = src.join(keys, same).drop(*[f"_g{i}" for i in range(len(by))])
    else:  # one row of quartiles → literals
        r = qw.first()
        joined = src.select("_x", *[F.lit(r[c] if r else None).cast("double").alias(c) for c in ("q1", "median", "q3")])
    inside = (F.col("_x") >= lo) & (F.col("_x") <= hi)
    agg = joined.groupBy(*by, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("_x"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("_x"))).alias("upper_whisker"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))
    return agg.select(*by, "n", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                      "lower_whisker", "upper_whisker", "n_outliers")


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson correlation; undefined (constant) → null."""
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def feature_target_corr(df: DataFrame, target: str, features=None, k: int | None = C.N_TOP_CORR) -> DataFrame:
    """|Pearson| of every feature with the target, top ``k``.

    One aggregate computes all correlations; ``stack`` turns the single
    row into ``(feature, corr, abs_corr)`` rows.
    """
    features = [c for c in (features or df.columns) if c != target]
    y = number(target)
    one = df.agg(*[pearson(number(q(c)), y).alias(f"c{i}") for i, c in enumerate(features)])
    long = stack_row(one, [(c, f"c{i}") for i, c in enumerate(features)], "feature", "corr")
    out = long.select("feature", "corr", F.abs("corr").alias("abs_corr")) \
        .orderBy(F.desc_nulls_last("abs_corr"), F.asc("feature"))
    return out.limit(k) if k else out


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    if t is None or dof is None or dof <= 0 or math.isnan(t):
        return float("nan")
    return betainc_reg(dof / 2.0, 0.5, dof / (dof + t * t))


def paired_ttest(df: DataFrame, a: str, b: str, alpha: float = C.SIGNIFICANCE_ALPHA) -> DataFrame:
    """A12 + C12: paired t test of ``a`` against ``b`` after coercion.

    One aggregate gives n, mean and sample sd of the difference; the
    p-value is a scalar function of that single row.
    """
    d = (to_numeric(a) - to_numeric(b))
    r = df.select(d.alias("d")).filter(F.col("d").isNotNull()) \
        .agg(F.count("d").alias("n"), F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("sd")).first()
    n, mean, sd = r["n"], r["mean_diff"], r["sd"]
    t = mean / (sd / math.sqrt(n)) if n and sd else None
    p = t_two_sided_p(t, n - 1) if t is not None else None
    spark = df.sparkSession
    out = spark.createDataFrame([(int(n), mean, t, p)],
                                "n long, mean_diff double, t_statistic double, p_value double")
    sig, direction = significance_verdict("p_value", "t_statistic", alpha)
    return out.select("*", sig.alias("significance"), direction.alias("direction"))


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """OLS line; zero-variance x gives null slope/intercept."""
    xx, yy = number(x), number(y)
    return df.agg(F.regr_count(yy, xx).alias("n"), F.regr_slope(yy, xx).alias("slope"),
                  F.regr_intercept(yy, xx).alias("intercept"), F.regr_r2(yy, xx).alias("r2"))


def _replicate_sums(n_boot: int, cx: float, cy: float):
    """Weighted sums (1, x, y, xx, xy) of every replicate, one row per task and
    replicate: rows are never repeated per replicate."""
    import numpy as np
    import pyarrow as pa
    from quarry.operators.assoc import replicate_weights

    def run(batches):
        total = np.zeros((n_boot, 5))
        for b in batches:
            bits = np.asarray(b.column("_kb")).astype(np.uint64)
            x, y = np.asarray(b.column("_x")) - cx, np.asarray(b.column("_y")) - cy
            terms = np.stack([np.ones_like(x), x, y, x * x, x * y], axis=1)
            for lo in range(0, len(x), 1024):
                own = bits[lo : lo + 1024]
                for first in range(0, n_boot, 250):
                    run_no = np.arange(first, min(first + 250, n_boot))
                    total[run_no] += replicate_weights(own, run_no) @ terms[lo : lo + 1024]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_boot, dtype=np.int32)), *(pa.array(total[:, i].copy()) for i in range(5))],
                                         ["b", "sw", "sx", "sy", "sxx", "sxy"])
    return run


def trend_band(df: DataFrame, x: str, y: str, key: str = "row_id", n_boot: int = 1000,
               n_grid: int = 100, level: float = 0.95, seed: str = C.SEED_TEXT) -> DataFrame:
    """Bootstrap band of the OLS line (Poisson bootstrap).

    Each row gets a Poisson(1) weight per replicate from a hash of
    (key, replicate); a task multiplies its weight matrix by the terms of
    its rows and hands on ``n_boot`` rows of sums. The band is the
    percentile of replicate predictions per grid point (``n_boot`` values
    per point: a bounded group).
    """
    xx, yy = number(x), number(y)
    r = df.agg(F.min(xx).alias("mn"), F.max(xx).alias("mx")).first()
    if r["mn"] is None:
        return df.sparkSession.createDataFrame([], "gx double, lower double, upper double")
    grid = [r["mn"] + (r["mx"] - r["mn"]) * i / max(n_grid - 1, 1) for i in range(n_grid)]
    from quarry.functions.columns import key_bits
    from quarry.session import ship_package
    ship_package(df.sparkSession)
    mid = df.agg(F.avg(xx).alias("x"), F.avg(yy).alias("y")).first()
    cx, cy = mid["x"] or 0.0, mid["y"] or 0.0  # centred sums stay accurate far from the origin
    rep = df.select(key_bits(key, seed).alias("_kb"), xx.alias("_x"), yy.alias("_y")).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull())
    sums = rep.mapInArrow(_replicate_sums(n_boot, cx, cy), "b int, sw double, sx double, sy double, sxx double, sxy double") \
        .groupBy("b").agg(*[F.sum(c).alias(c) for c in ("sw", "sx", "sy", "sxx", "sxy")])
    slope = F.try_divide(F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy"),
                         F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx"))
    lines = sums.select("b", slope.alias("m"), F.col("sx"), F.col("sy"), F.col("sw")) \
        .select("b", "m", (F.try_divide(F.col("sy") - F.col("m") * F.col("sx"), F.col("sw"))
                           + F.lit(cy) - F.col("m") * F.lit(cx)).alias("c"))
    gl = F.array(*[F.lit(float(g)) for g in grid])
    pts = lines.select("b", "m", "c", F.explode(gl).alias("gx")) \
        .select("gx", (F.col("m") * F.col("gx") + F.col("c")).alias("yhat"))
    a = (1 - level) / 2
    return pts.groupBy("gx").agg(F.percentile("yhat", a).alias("lower"),
                                 F.percentile("yhat", 1 - a).alias("upper")).orderBy("gx")


def actual_vs_predicted(scored: dict, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(combo_key, actual, predicted, residual) rows of several scored frames."""
    frames = [d.select(F.lit(k).alias("combo_key"), F.col(label).cast("double").alias("actual"),
                       F.col(prediction).cast("double").alias("predicted")) for k, d in scored.items()]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.withColumn("residual", F.col("actual") - F.col("predicted"))


def axis_range(avp: DataFrame) -> DataFrame:
    """The identity line's range per combo (min/max of the actual values)."""
    return avp.groupBy("combo_key").agg(F.min("actual").alias("min_actual"), F.max("actual").alias("max_actual"))
