import itertools
import math

import numpy as np
import pytest

from quarry.operators.assoc import (association_distance, association_matrix, cluster_features,
                                    cluster_representatives, mutual_information_binned)


def _plugin_mi(a, b):
    n = len(a)
    joint = {}
    for x, y in zip(a, b):
        joint[(x, y)] = joint.get((x, y), 0) + 1
    pa = {x: sum(v for (i, _), v in joint.items() if i == x) for x in set(a)}
    pb = {y: sum(v for (_, j), v in joint.items() if j == y) for y in set(b)}
    return sum(v / n * math.log(v * n / (pa[x] * pb[y])) for (x, y), v in joint.items())


def test_binned_mi_matches_plugin(spark):
    rng = np.random.default_rng(0)
    cat = rng.choice(["a", "b", "c"], size=300)
    y = np.where(cat == "a", 0.0, 5.0) + rng.normal(size=300)
    df = spark.createDataFrame([(str(c), float(v)) for c, v in zip(cat, y)], "c string, y double")
    got = mutual_information_binned(df, "y", ["c"], bins=4).first()["mi"]
    lo, hi = y.min(), y.max()
    yb = np.minimum(4, np.floor((y - lo) / (hi - lo) * 4).astype(int) + 1)
    assert got == pytest.approx(_plugin_mi(list(cat), list(yb)))


def _cramers_v_bias_corrected(a, b):
    ra, rb = sorted(set(a)), sorted(set(b))
    t = np.array([[sum(1 for x, y in zip(a, b) if x == i and y == j) for j in rb] for i in ra], float)
    n = t.sum()
    e = t.sum(1, keepdims=True) * t.sum(0, keepdims=True) / n
    if t.shape == (2, 2):
        d = e - t
        t = t + np.minimum(0.5, np.abs(d)) * np.sign(d)
    chi2 = ((t - e) ** 2 / e).sum()
    r, k = len(ra), len(rb)
    phi2 = max(0, chi2 / n - (k - 1) * (r - 1) / (n - 1))
    rc, kc = r - (r - 1) ** 2 / (n - 1), k - (k - 1) ** 2 / (n - 1)
    return math.sqrt(phi2 / min(kc - 1, rc - 1))


def test_association_kinds(spark):
    rng = np.random.default_rng(2)
    a = rng.choice(["x", "y"], size=200)
    b = np.where(rng.random(200) < 0.8, a, rng.choice(["x", "y"], size=200))
    c = rng.choice(["p", "q", "r"], size=200)
    v = np.where(a == "x", 1.0, 3.0) + rng.normal(size=200)
    w = 2 * v + rng.normal(size=200)
    df = spark.createDataFrame([(str(i), str(j), str(k), float(p), float(q)) for i, j, k, p, q in zip(a, b, c, v, w)],
                               "a string, b string, c string, v double, w double")
    m = {(r["feature_a"], r["feature_b"]): r["assoc"] for r in association_matrix(df).collect()}
    assert m[("a", "a")] == 1.0 and m[("v", "w")] == pytest.approx(np.corrcoef(v, w)[0, 1])
    assert m[("a", "b")] == pytest.approx(_cramers_v_bias_corrected(list(a), list(b)))
    assert m[("c", "a")] == pytest.approx(_cramers_v_bias_corrected(list(a), list(c)))
    mu = v.mean()
    num = sum((a == g).sum() * (v[a == g].mean() - mu) ** 2 for g in ("x", "y"))
    assert m[("a", "v")] == pytest.approx(math.sqrt(num / ((v - mu) ** 2).sum()))
    assert m[("v", "a")] == m[("a", "v")]
    d = {(r["feature_a"], r["feature_b"]): r["distance"] for r in association_distance(association_matrix(df)).collect()}
    assert d[("v", "v")] == 0.0 and d[("v", "w")] == pytest.approx(1 - abs(m[("v", "w")]))


def _upgma(D, t):
    clusters = {i: [i] for i in range(len(D))}
    while len(clusters) > 1:
        best = None
        for p, q in itertools.combinations(sorted(clusters), 2):
            dd = np.mean([D[i, j] for i in clusters[p] for j in clusters[q]])
            if best is None or dd < best[0]:
                best = (dd, p, q)
        if best[0] > t:
            break
        clusters[best[1]] += clusters.pop(best[2])
    return sorted(sorted(v) for v in clusters.values())


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_clustering_matches_sequential_average_linkage(spark, seed):
    rng = np.random.default_rng(seed)
    n = 8
    base = rng.normal(size=(300, 3))
    X = np.column_stack([base[:, i % 3] + rng.normal(scale=0.3 + 0.3 * i, size=300) for i in range(n)])
    names = [f"f{i}" for i in range(n)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], ", ".join(f"{c} double" for c in names))
    assoc = association_matrix(df)
    A = np.zeros((n, n))
    for r in assoc.collect():
        A[names.index(r["feature_a"]), names.index(r["feature_b"])] = r["assoc"]
    D = 1 - np.abs(A)
    np.fill_diagonal(D, 0)
    t = 0.6
    cl = cluster_features(assoc, names, t).collect()
    groups = {}
    for r in cl:
        groups.setdefault(r["cluster"], []).append(names.index(r["feature"]))
    assert sorted(sorted(v) for v in groups.values()) == _upgma(D, t)
    reps = [r["feature"] for r in cluster_representatives(assoc, cluster_features(assoc, names, t), names).collect()]
    assert len(reps) == len(groups) and reps == sorted(reps)


def test_pearson_of_wide_frames_with_nulls_and_offsets(spark):
    """30 columns, 10 % missing (null or NaN), offsets up to 1e9: pairwise complete."""
    import pandas as pd

    from quarry.operators.assoc import association_matrix
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 30))
    x[:, 1] += x[:, 0]
    x[:, 5] = 3.25
    shift = np.where(np.arange(30) % 3 == 0, 1e9, 0.0)
    hole = rng.random(x.shape) < 0.1
    rows = [tuple((None if rng.random() < 0.5 else float("nan")) if h else float(v + s) for v, h, s in zip(r, hr, shift))
            for r, hr in zip(x, hole)]
    names = [f"c.{i}" for i in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    got = {(r["feature_a"], r["feature_b"]): r["assoc"] for r in association_matrix(df).collect()}
    want = pd.DataFrame(np.where(hole, np.nan, x), columns=names).corr().fillna(0.0)
    for a in names:
        for b in names:
            assert abs(got[a, b] - (1.0 if a == b else want.loc[a, b])) < 1e-5, (a, b)
