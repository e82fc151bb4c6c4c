import math

import numpy as np
import pytest

from quarry.operators.quantile import exact_quantiles
from quarry.operators.stats import (box_stats, describe_target, histogram, kde, n_unique, paired_ttest,
                                    t_two_sided_p)


def test_sample_skewness(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9)], "x double")
    r = describe_target(df, "x").first()
    assert r["skew"] == pytest.approx(1.3312, abs=1e-3)
    assert r["median"] == 3.0 and r["skew_verdict"] == "positive"


@pytest.mark.parametrize("limit,bins", [(10**6, 1024), (40, 4)])
def test_exact_quantiles_match_numpy(spark, limit, bins):
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=500), np.full(300, 2.5), rng.exponential(size=200)])
    groups = np.array(["a"] * 600 + ["b"] * 400)
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, vals)], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["value"] for r in exact_quantiles(df, "x", probs, by=["g"], limit=limit,
                                                                      bins=bins).collect()}
    for g in ("a", "b"):
        want = np.percentile(vals[groups == g], [p * 100 for p in probs])
        for p, w in zip(probs, want):
            assert got[(g, p)] == pytest.approx(w, abs=1e-12)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = histogram(df, "x", 10).collect()
    assert [r["n"] for r in h] == [1] * 9 + [2]


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=400)], "x double")
    grid = list(np.linspace(-6, 6, 241))
    d = sorted((r["gx"], r["density"]) for r in kde(df, "x", grid=grid).collect())
    area = np.trapezoid([v for _, v in d], [g for g, _ in d])
    assert area == pytest.approx(1.0, abs=1e-3)


def test_box_stats(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    r = box_stats(df, "x").first()
    assert (r["q1"], r["median"], r["q3"]) == (3.0, 5.0, 7.0)
    assert r["upper_whisker"] == 8.0 and r["n_outliers"] == 1


def test_t_pvalue_known_values():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.073388, abs=1e-6)
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)
    for t, nu in ((-3.5, 30.0), (1.2, 7.0), (0.26, 14116.0)):
        x = np.linspace(0, abs(t), 20001)
        pdf = np.exp(math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi)
                     - (nu + 1) / 2 * np.log1p(x * x / nu))
        assert t_two_sided_p(t, nu) == pytest.approx(1 - 2 * np.trapezoid(pdf, x), abs=1e-8)


def test_paired_ttest(spark):
    a = [5.1, 4.9, 6.2, 5.8, 6.0, 5.5, 5.3, 6.1]
    b = [4.8, 4.7, 5.9, 5.9, 5.6, 5.2, 5.4, 5.7]
    df = spark.createDataFrame([(str(x), y) for x, y in zip(a, b)] + [("bad", 1.0)], "a string, b double")
    r = paired_ttest(df, "a", "b").first()
    d = np.array(a) - np.array(b)
    t = d.mean() / (d.std(ddof=1) / math.sqrt(len(d)))
    assert r["n"] == 8 and r["t_statistic"] == pytest.approx(t)
    assert r["direction"] in ("first higher", "none")


def test_n_unique_zero_sign(spark):
    df = spark.createDataFrame([(0.0, "a"), (-0.0, None), (1.0, "a")], "x double, s string")
    got = {r["column"]: r["n_unique"] for r in n_unique(df).collect()}
    assert got == {"x": 2, "s": 1}
