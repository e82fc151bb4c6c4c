"""Association, mutual information and feature clustering
(A13-A17, M9).

Pairwise statistics are computed from one unpivoted pass: rows become
(pair, value_a, value_b) records, partially aggregated map-side, so the
shuffle carries contingency cells, not rows. The association and
distance tables are long ``(feature_a, feature_b, ...)`` DataFrames.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config as C
from quarry.operators.project import NUMERIC_TYPES
from quarry.functions.columns import number, q
from quarry.session import cut_lineage


def pairwise_pearson(df: DataFrame, num) -> DataFrame:
    """Pearson of every pair of numeric columns over the rows where both are
    present, as ``(feature_a, feature_b, assoc)``; undefined → null.

    Columns are centred and scaled by their own mean and deviation first, so
    a large offset costs no digits; each task then adds up, for its rows, the
    products of the value and presence matrices, and only d² sums per task
    are shuffled, whatever the width."""
    import pyarrow as pa

    from quarry.session import ship_package
    ship_package(df.sparkSession)
    d = len(num)
    x = [number(q(c)) for c in num]
    r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
    mean = np.array([r[f"m{i}"] if r[f"m{i}"] is not None else 0.0 for i in range(d)])
    scale = np.array([r[f"s{i}"] or 1.0 for i in range(d)])
    up = np.triu_indices(d, 1)

    def sums(batches):
        n, sx, sxx, sxy = (np.zeros((d, d)) for _ in range(4))
        for b in batches:
            v = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(d)], axis=1)
            here = ~np.isnan(v)
            v = np.where(here, (v - mean) / scale, 0.0)
            m = here.astype(float)
            n += m.T @ m
            sx += v.T @ m
            sxx += (v * v).T @ m
            sxy += v.T @ v
        cols = [up[0], up[1], n[up], sx[up], sx.T[up], sxx[up], sxx.T[up], sxy[up]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)) for c in cols[:2]] + [pa.array(c) for c in cols[2:]],
                                         ["i", "j", "n", "si", "sj", "sii", "sjj", "sij"])

    part = df.select(*[c.alias(f"x{i}") for i, c in enumerate(x)]).mapInArrow(
        sums, "i int, j int, n double, si double, sj double, sii double, sjj double, sij double")
    t = part.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])

    def spread(one, two):  # n² times the variance; rounding noise of a constant counts as none
        v = F.col("n") * F.col(two) - F.col(one) * F.col(one)
        return F.when(v > F.col("n") * F.col(two) * F.lit(1e-13), v)

    r_ = F.try_divide(F.col("n") * F.col("sij") - F.col("si") * F.col("sj"), F.sqrt(spread("si", "sii")) * F.sqrt(spread("sj", "sjj")))
    names = df.sparkSession.createDataFrame(list(enumerate(num)), "k int, name string")  # one row per column
    return (t.select("i", "j", r_.alias("assoc"))
            .join(F.broadcast(names.select(F.col("k").alias("i"), F.col("name").alias("feature_a"))), "i")
            .join(F.broadcast(names.select(F.col("k").alias("j"), F.col("name").alias("feature_b"))), "j")
            .select("feature_a", "feature_b", "assoc"))


def _kind(df: DataFrame, c: str) -> str:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.StringType, T.BooleanType)):
        return "nominal"
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    return "nominal"


# ---------------------------------------------------------------- A13 binned
def bin_expr(df: DataFrame, cols, bins: int, as_int: bool = False):
    """Equal-width bin per numeric column (range from one aggregate);
    nominal columns keep their value as the bin. ``as_int`` keeps numeric
    bins as integers (cheaper cell keys)."""
    num = [c for c in cols if _kind(df, c) == "numeric"]
    rng = {}
    if num:
        r = df.agg(*[F.min(number(q(c))).alias(f"a{i}") for i, c in enumerate(num)],
                   *[F.max(number(q(c))).alias(f"b{i}") for i, c in enumerate(num)]).first()
        rng = {c: (r[f"a{i}"], r[f"b{i}"]) for i, c in enumerate(num)}
    out = {}
    for c in cols:
        if c in rng:
            lo, hi = rng[c]
            t = "int" if as_int else "string"
            if lo is None:
                out[c] = F.lit(None).cast(t)
            elif lo == hi:
                out[c] = F.when(number(q(c)).isNotNull(), F.lit(1)).cast(t)
            else:
                x = number(q(c))
                out[c] = F.least(F.lit(bins), F.floor((x - F.lit(lo)) / F.lit(hi - lo) * bins).cast("int") + 1).cast(t)
        else:
            out[c] = F.col(c).cast("string")
    return out


def _mi_from_cells(cells: DataFrame, by=("feature",), phi2: bool = True) -> DataFrame:
    """MI (nats) and, if asked for, phi² per group from weighted contingency
    cells (a, b, n).

    With N the total, MI = (Σ n ln n − Σ n_a ln n_a − Σ n_b ln n_b + N ln N) / N:
    plain aggregates of the cell table; phi² joins the margins. The cells of
    a feature with very many values are never gathered in one task."""
    by = list(by)
    cells = cells.filter(F.col("n") > 0)
    xlogx = F.sum(F.col("n") * F.log("n"))
    left = cells.groupBy(*by, "a").agg(F.sum("n").alias("na"))
    right = cells.groupBy(*by, "b").agg(F.sum("n").alias("nb"))
    t = cells.groupBy(*by).agg(xlogx.alias("hab"), F.sum("n").alias("nn")) \
        .join(left.groupBy(*by).agg(F.sum(F.col("na") * F.log("na")).alias("ha")), by) \
        .join(right.groupBy(*by).agg(F.sum(F.col("nb") * F.log("nb")).alias("hb")), by)
    t = t.select(*by, ((F.col("hab") - F.col("ha") - F.col("hb")) / F.col("nn") + F.log("nn")).alias("mi"))
    if not phi2:
        return t
    each = cells.join(left, [*by, "a"]).join(right, [*by, "b"])
    share = each.groupBy(*by).agg((F.sum(F.col("n") * F.col("n") / (F.col("na") * F.col("nb"))) - 1).alias("phi2"))
    return t.join(share, by)


def mutual_information_binned(df: DataFrame, target: str, features=None, bins: int = 10,
                              k: int | None = None) -> DataFrame:
    """A13 (binned plug-in estimate): MI of each feature with the target.

    Unpivot once to (feature, x_bin, y_bin), count cells with map-side
    partial aggregation, then reduce the (checkpointed) cell table.
    """
    features = [c for c in (features or df.columns) if c != target]
    be = bin_expr(df, features + [target], bins)
    long = df.select(be[target].alias("b"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), be[c].alias("a")) for c in features])).alias("kv")) \
        .select("kv.feature", "kv.a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    cells = cut_lineage(long.groupBy("feature", "a", "b").agg(F.count(F.lit(1)).cast("double").alias("n")))
    out = _mi_from_cells(cells, phi2=False).select("feature", "mi").orderBy(F.desc("mi"), "feature")
    return out.limit(k) if k else out


def mutual_information(df: DataFrame, target: str, features=None, method: str = "binned",
                       k: int | None = C.N_TOP_MI, **kw) -> DataFrame:
    """MI ranking, top ``k`` (binned or k-NN)."""
    from quarry.operators.mi_knn import mutual_information_knn
    if method == "binned":
        return mutual_information_binned(df, target, features, k=k, **kw)
    out = mutual_information_knn(df, target, features, **kw).groupBy("feature").agg(F.avg("mi").alias("mi")) \
        .orderBy(F.desc("mi"), "feature")
    return out.limit(k) if k else out


def _poisson_weight_sql(u: str, kmax: int = 12) -> str:
    cdf = poisson1_cdf(kmax)
    return "CASE " + " ".join(f"WHEN {u} < {c!r} THEN {i}" for i, c in enumerate(cdf)) + f" ELSE {kmax} END"


def poisson1_cdf(kmax: int = 12) -> list[float]:
    """Cumulative probabilities of Poisson(1), for draws by inversion."""
    cdf, p, acc = [], math.exp(-1.0), 0.0
    for i in range(kmax):
        acc += p
        cdf.append(acc)
        p /= (i + 1)
    return cdf


def replicate_weights(bits: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Poisson(1) weight of each (run, row): ``stream_uniform`` of the row's key
    bits, by inversion."""
    mask, mult, golden = np.uint64(0xFFFFFFFF), np.uint64(73244475), np.uint64(2654435761)
    h = (bits[None, :] + runs.astype(np.uint64)[:, None] * golden) & mask
    for _ in range(2):
        h = (((h >> np.uint64(16)) ^ h) * mult) & mask
    return np.searchsorted(poisson1_cdf(), ((h >> np.uint64(16)) ^ h) / 4294967296.0, side="right")


def _replicate_cells(n_features: int, runs: int, limit: int = 20_000):
    """Per cell (feature, a, b) the replicate weights summed over a task's
    rows; a table of more than ``limit`` cells is handed on and begun anew."""
    import pyarrow as pa

    def out(found):
        if found:
            keys = np.array(list(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1]), pa.array(keys[:, 2]), pa.array(list(found.values()), pa.list_(pa.float64()))],
                ["fi", "a", "b", "w"])
            found.clear()

    def run(batches):
        found: dict = {}
        for whole in batches:
            for lo in range(0, len(whole), 8192):
                part = whole.slice(lo, 8192)
                b = np.asarray(part.column("b"))
                w = replicate_weights(np.asarray(part.column("kb")).astype(np.uint64), np.arange(runs)).astype(float)
                for f in range(n_features):
                    a = part.column(f"f{f}")
                    here = np.flatnonzero(np.asarray(a.is_valid()))
                    if not len(here):
                        continue
                    pair = np.stack([a.drop_null().to_numpy(), b[here]], axis=1)
                    cell, at = np.unique(pair, axis=0, return_inverse=True)
                    order = np.argsort(at.ravel(), kind="stable")
                    cuts = np.searchsorted(at.ravel()[order], np.arange(len(cell)))
                    sums = np.add.reduceat(w[:, here[order]], cuts, axis=1)
                    for n, (x, y) in enumerate(cell.tolist()):
                        k = (f, x, y)
                        found[k] = found[k] + sums[:, n] if k in found else sums[:, n]
                if len(found) > limit:
                    yield from out(found)
        yield from out(found)
    return run


def mi_repeated_binned(df: DataFrame, target: str, features=None, key: str = "row_id", runs: int = C.N_MI_RUNS,
                       bins: int = 10, seed: str = C.SEED_TEXT) -> DataFrame:
    """A14 (binned variant): MI per (run, feature) on Poisson-bootstrap
    replicates (weight from md5 bits of the key mixed with the run number).

    A task holds, per cell, one sum for each run; rows are never repeated
    per run. Nominal features are label-encoded first, so every cell key is
    a fixed-width integer."""
    from quarry.functions.columns import key_bits
    from quarry.operators.features import label_encode
    from quarry.session import ship_package
    features = [c for c in (features or df.columns) if c not in (target, key)]
    nom = [c for c in features if _kind(df, c) == "nominal"]
    be = bin_expr(df, [c for c in features if c not in nom] + [target], bins, as_int=True)
    src = label_encode(df.select(key, target, *features), nom) if nom else df
    code = {c: (F.col(c).cast("int") if c in nom else be[c]) for c in features}
    ship_package(df.sparkSession)
    rows = src.select(key_bits(key, seed).alias("kb"), be[target].cast("long").alias("b"),
                      *[code[c].cast("long").alias(f"f{i}") for i, c in enumerate(features)]).filter(F.col("b").isNotNull())
    cells = rows.mapInArrow(_replicate_cells(len(features), runs), "fi int, a long, b long, w array<double>")
    cells = cells.select("fi", "a", "b", F.posexplode("w").alias("run", "w")).groupBy("run", "fi", "a", "b").agg(F.sum("w").alias("n"))
    cells = cut_lineage(cells)
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "fi int, feature string")
    mi = _mi_from_cells(cells, by=("run", "fi"), phi2=False)
    return mi.join(F.broadcast(names), "fi").select("run", "feature", "mi")


def mi_summary(mi_runs: DataFrame, k: int | None = C.N_TOP_MI_MEDIAN) -> DataFrame:
    """Per feature median over runs (+ quartiles for the box table),
    top ``k`` by median. Groups hold ``runs`` values: bounded."""
    out = mi_runs.groupBy("feature").agg(
        F.percentile("mi", 0.5).alias("median_mi"), F.percentile("mi", 0.25).alias("q1_mi"),
        F.percentile("mi", 0.75).alias("q3_mi"), F.min("mi").alias("min_mi"), F.max("mi").alias("max_mi"),
        F.count(F.lit(1)).alias("runs")).orderBy(F.desc("median_mi"), "feature")
    return out.limit(k) if k else out


# ---------------------------------------------------------------- A15
#: Values of a chunk of rows handled at once, and the categories up to which a column joins the dense product.
CHUNK_VALUES, FEW_CATEGORIES = 1 << 21, 64


def _incidence_products(n_nom: int, n_num: int, mean: np.ndarray, scale: np.ndarray):
    """Per chunk of rows the contingency cells of all nominal pairs and, for every
    category and numeric column, count, sum and sum of squares.

    Columns with few categories form one incidence matrix X whose product X'X
    holds the cells of all their pairs; the others are counted pair by pair."""
    import pyarrow as pa

    def cells(kind, i, j, a, b, n, s=None, ss=None):
        zero = np.zeros(len(n))
        cols = (np.full(len(n), kind, np.int32), i, j, a, b, n, zero if s is None else s, zero if ss is None else ss)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(c), k) for c, k in zip(cols, kinds, strict=True)],
                                          ["kind", "i", "j", "a", "b", "n", "s", "ss"])

    def chunk(b):
        rows = len(b)
        values, codes = [], []
        for c in range(n_nom):
            col = b.column(c)
            here = np.asarray(col.is_valid())
            code = np.full(rows, -1)
            found, code[here] = np.unique(col.drop_null().to_numpy(), return_inverse=True)
            values.append(found)
            codes.append(code)
        few = [c for c in range(n_nom) if len(values[c]) <= FEW_CATEGORIES]
        many = [c for c in range(n_nom) if c not in set(few)]
        offset = np.cumsum([0, *(len(values[c]) for c in few)])
        width = int(offset[-1])
        x = np.zeros((rows, width), dtype=np.float32)
        for c, o in zip(few, offset, strict=False):
            on = np.flatnonzero(codes[c] >= 0)
            x[on, o + codes[c][on]] = 1
        column = np.repeat(np.array(few, dtype=np.int32), np.diff(offset))
        hashes = np.concatenate([values[c] for c in few]) if few else np.zeros(0, np.int64)
        if width:  # chunks have fewer than 2^24 rows, so counts are exact
            for lo in range(0, width, 1024):
                n = x[:, lo : lo + 1024].T @ x
                p, q_ = np.nonzero(n)
                on = column[lo + p] < column[q_]
                p, q_ = p[on], q_[on]
                yield cells(0, column[lo + p], column[q_], hashes[lo + p], hashes[q_], n[p, q_].astype(float))
        for c in many:
            for d in range(n_nom):
                if d == c or (d in many and d < c):
                    continue
                both = (codes[c] >= 0) & (codes[d] >= 0)
                k = len(values[d])
                pair, n = np.unique(codes[c][both] * k + codes[d][both], return_counts=True)
                one, two = (c, values[c][pair // k]), (d, values[d][pair % k])
                first, second = (one, two) if c < d else (two, one)
                yield cells(0, np.full(len(n), first[0], np.int32), np.full(len(n), second[0], np.int32), first[1], second[1], n.astype(float))
        if not n_num:
            return
        v = np.stack([b.column(n_nom + c).to_numpy(zero_copy_only=False).astype(float) for c in range(n_num)], axis=1)
        here = ~np.isnan(v)
        v = np.where(here, (v - mean) / scale, 0.0)
        sums = [x.T.astype(float) @ m for m in (here.astype(float), v, v * v)] if width else []
        if width:
            p, j = np.nonzero(sums[0])
            yield cells(1, column[p], j.astype(np.int32), hashes[p], np.zeros(len(p), np.int64), *(m[p, j] for m in sums))
        for c in many:
            on, k = codes[c] >= 0, len(values[c])
            for j in range(n_num):
                got = [np.bincount(codes[c][on], weights=m[on, j].astype(float), minlength=k) for m in (here, v, v * v)]
                p = np.flatnonzero(got[0])
                yield cells(1, np.full(len(p), c, np.int32), np.full(len(p), j, np.int32), values[c][p], np.zeros(len(p), np.int64), *(m[p] for m in got))

    def run(batches):
        step = max(1, CHUNK_VALUES // max(1, n_nom + n_num))
        for b in batches:
            for lo in range(0, len(b), step):
                yield from chunk(b.slice(lo, step))
    return run


def nominal_associations(df: DataFrame, nom, num, bias_correction: bool = True) -> DataFrame:
    """Cramér's V of every nominal pair and the correlation ratio of every nominal
    and numeric column, as ``(feature_a, feature_b, assoc, kind)``, over the rows where both are present.

    Rows are read once: tasks hand on contingency cells and sums per category
    (categories as 64-bit hashes of their text), which are added up with
    map-side combine; margins are aggregates of the cells. Nothing is
    repeated per pair, and no pair's cells meet in one task."""
    from quarry.session import ship_package
    spark = df.sparkSession
    ship_package(spark)
    x = [number(q(c)) for c in num]
    mean, scale = np.zeros(len(num)), np.ones(len(num))
    if num:
        r = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
        mean = np.array([r[f"m{i}"] if r[f"m{i}"] is not None else 0.0 for i in range(len(num))])
        scale = np.array([r[f"s{i}"] or 1.0 for i in range(len(num))])
    hashed = [F.when(F.col(q(c)).isNotNull(), F.xxhash64(F.col(q(c)).cast("string"))).alias(f"n{i}") for i, c in enumerate(nom)]
    parts = df.select(*hashed, *[c.alias(f"x{i}") for i, c in enumerate(x)]).mapInArrow(
        _incidence_products(len(nom), len(num), mean, scale), "kind int, i int, j int, a long, b long, n double, s double, ss double")
    cells = cut_lineage(parts.groupBy("kind", "i", "j", "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]))
    two = cells.where("kind = 0").select("i", "j", "a", "b", "n")
    rows, cols = (two.groupBy("i", "j", c).agg(F.sum("n").alias(f"n{c}")) for c in "ab")
    across = rows.groupBy("i", "j").agg(F.sum("na").alias("t"), F.count(F.lit(1)).alias("r"), F.sum(F.log("na")).alias("la"))
    down = cols.groupBy("i", "j").agg(F.count(F.lit(1)).alias("k"), F.sum(F.log("nb")).alias("lb"))
    each = two.join(rows, ["i", "j", "a"]).join(cols, ["i", "j", "b"])
    # 2 x 2 tables: |ad - bc| is the same for every cell, |n t - na nb|
    g = each.groupBy("i", "j").agg(F.sum(F.col("n") * F.col("n") / (F.col("na") * F.col("nb"))).alias("s"),
                                   F.max(F.struct("n", "na", "nb")).alias("any"))
    g = g.join(across, ["i", "j"]).join(down, ["i", "j"])
    n, any_ = F.col("t"), F.col("any")
    adbc = F.abs(any_["n"] * n - any_["na"] * any_["nb"])
    yates = F.pow(F.greatest(adbc - n / 2, F.lit(0.0)), 2) / F.exp(F.col("la") + F.col("lb"))
    phi2 = F.when((F.col("r") == 2) & (F.col("k") == 2), yates).otherwise(F.col("s") - 1)
    r_, k_ = F.col("r"), F.col("k")
    if bias_correction:
        phi2 = F.greatest(F.lit(0.0), phi2 - F.try_divide((k_ - 1) * (r_ - 1), n - 1))
        r_, k_ = r_ - F.try_divide(F.pow(r_ - 1, F.lit(2)), n - 1), k_ - F.try_divide(F.pow(k_ - 1, F.lit(2)), n - 1)
    den = F.least(k_ - 1, r_ - 1)
    v = F.when(den <= 0, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(phi2, den)))
    nominal = g.select("i", "j", v.alias("assoc"), F.lit("cramer").alias("kind"))
    # between and total sum of squares of the centred values, per category and altogether
    t = cells.where("kind = 1").groupBy("i", "j").agg(
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    centre = F.col("s") * F.col("s") / F.col("n")
    between, total = F.col("b") - centre, F.col("ss") - centre
    noise = F.lit(1e-13) * (F.col("ss") + F.abs(centre))
    eta = F.when((between <= noise) | (total <= noise), F.lit(0.0)).otherwise(F.sqrt(F.least(F.lit(1.0), F.try_divide(between, total))))
    mixed = t.select("i", "j", eta.alias("assoc"), F.lit("correlation_ratio").alias("kind"))
    first = spark.createDataFrame(list(enumerate(nom)), "i int, feature_a string")  # one row per column
    out = []
    for table, names in ((nominal, nom), (mixed, num)):
        if names:
            second = spark.createDataFrame(list(enumerate(names)), "j int, feature_b string")
            out.append(table.join(F.broadcast(first), "i").join(F.broadcast(second), "j").select("feature_a", "feature_b", "assoc", "kind"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def association_matrix(df: DataFrame, cols=None, bias_correction: bool = True) -> DataFrame:
    """Pairwise association as ``(feature_a, feature_b, assoc, kind)``.

    numeric×numeric: Pearson; nominal×nominal: Cramér's V (bias-corrected,
    Yates for 2×2); nominal×numeric: correlation ratio. Undefined → 0,
    diagonal 1, both orders present.
    """
    cols = list(cols or df.columns)
    spark = df.sparkSession
    kinds = {c: _kind(df, c) for c in cols}
    num = [c for c in cols if kinds[c] == "numeric"]
    nom = [c for c in cols if kinds[c] == "nominal"]
    parts = []
    if len(num) > 1:
        parts.append(pairwise_pearson(df, num).withColumn("kind", F.lit("pearson")))
    if nom and len(cols) > 1:
        parts.append(nominal_associations(df, nom, num, bias_correction))
    diag = spark.createDataFrame([(c, c, 1.0, "self") for c in cols], "feature_a string, feature_b string, assoc double, kind string")
    if not parts:
        return diag
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # a pair without a row where both are present is undefined as well
    every = [(a, b, "pearson" if kinds[a] == kinds[b] == "numeric" else "cramer" if kinds[a] == kinds[b] else "correlation_ratio")
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    every = [(a, b, k) if k != "correlation_ratio" or kinds[a] == "nominal" else (b, a, k) for a, b, k in every]
    pairs = spark.createDataFrame(every, "feature_a string, feature_b string, kind string")
    u = pairs.join(F.broadcast(u.drop("kind")), ["feature_a", "feature_b"], "left")  # both are d² rows
    u = u.select("feature_a", "feature_b", F.coalesce(F.when(~F.isnan("assoc"), F.col("assoc")), F.lit(0.0)).alias("assoc"), "kind")
    # both orientations from one evaluation of the pair table
    both = u.select(F.explode(F.array(
        F.struct(F.col("feature_a"), F.col("feature_b"), F.col("assoc"), F.col("kind")),
        F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), F.col("assoc"),
                 F.col("kind")))).alias("p")).select("p.*")
    return both.unionByName(diag)


def association_distance(assoc: DataFrame) -> DataFrame:
    """1 − |assoc|, zero on the diagonal."""
    return assoc.select("feature_a", "feature_b",
                        F.when(F.col("feature_a") == F.col("feature_b"), F.lit(0.0))
                        .otherwise(1 - F.abs("assoc")).alias("distance"))


# ---------------------------------------------------------------- M9
def _position_table(spark, features) -> DataFrame:
    return spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, pos int")


def cluster_round(dist: DataFrame, clusters: DataFrame, threshold: float) -> DataFrame:
    """One reciprocal-nearest-neighbour round of average linkage.

    Returns the mutual nearest cluster pairs ``(ca, cb, d)`` with
    average distance ≤ threshold (ca < cb)."""
    a = clusters.select(F.col("feature").alias("feature_a"), F.col("cluster").alias("ca"))
    b = clusters.select(F.col("feature").alias("feature_b"), F.col("cluster").alias("cb"))
    cd = (dist.join(F.broadcast(a), "feature_a").join(F.broadcast(b), "feature_b")
          .filter(F.col("ca") < F.col("cb"))
          .groupBy("ca", "cb").agg(F.round(F.avg("distance"), 12).alias("d")))
    # both orientations of one number, so that a nearest pair is nearest from either side
    cd = cd.unionByName(cd.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"), "d"))
    w = Window.partitionBy("ca").orderBy("d", "cb")
    nn = cd.withColumn("r", F.row_number().over(w)).filter("r = 1").select("ca", F.col("cb").alias("nb"), "d")
    back = nn.select(F.col("ca").alias("nb"), F.col("nb").alias("ca"))
    return (nn.join(back, ["ca", "nb"]).filter((F.col("ca") < F.col("nb")) & (F.col("d") <= threshold))
            .select("ca", F.col("nb").alias("cb"), "d"))


def cluster_features(assoc: DataFrame, features, threshold: float | None,
                     linkage: str = "average", max_rounds: int = 10_000) -> DataFrame:
    """M9: agglomerative clustering on A16 cut at ``threshold``.

    The sequential algorithm merges the pair of clusters with the least
    (distance, smaller label, larger label) each time, a cluster's label being its
    smallest member's position. Average linkage is reducible: a merge elsewhere
    can bring no cluster nearer than the nearer of its parts, and its label is
    one of theirs, so a pair that is mutually nearest in that order stays so until
    it is merged. Merging all such pairs each round therefore gives the same
    clusters, ties included (distances are compared after rounding to 12 digits).
    Returns ``(feature, cluster)`` with cluster = smallest member position.
    """
    if linkage != "average":
        raise ValueError("only average linkage is supported")
    spark = assoc.sparkSession
    features = list(features)
    clusters = _position_table(spark, features).select("feature", F.col("pos").alias("cluster"))
    if threshold is None:
        return clusters
    dist = association_distance(assoc).filter(F.col("feature_a") != F.col("feature_b"))
    dist = cut_lineage(dist.filter(F.col("feature_a").isin(features) & F.col("feature_b").isin(features)))
    for i in range(max_rounds):
        pairs = cluster_round(dist, clusters, threshold).collect()
        if not pairs:
            break
        remap = {}
        for p in pairs:
            remap[p["cb"]] = p["ca"]
        m = spark.createDataFrame(list(remap.items()), "old int, new int")
        clusters = (clusters.join(F.broadcast(m), clusters.cluster == m.old, "left")
                    .select("feature", F.coalesce("new", "cluster").alias("cluster")))
        if i % 4 == 3:
            clusters = cut_lineage(clusters)
    return clusters


def cluster_representatives(assoc: DataFrame, clusters: DataFrame, features) -> DataFrame:
    """Per cluster the feature with the largest sum of |assoc| with
    the cluster's members (diagonal included); first position on a tie.
    Returns the representatives as sorted distinct ``feature`` rows."""
    spark = assoc.sparkSession
    pos = _position_table(spark, features)
    a = clusters.select(F.col("feature").alias("feature_a"), F.col("cluster").alias("ca"))
    b = clusters.select(F.col("feature").alias("feature_b"), F.col("cluster").alias("cb"))
    s = (assoc.join(F.broadcast(a), "feature_a").join(F.broadcast(b), "feature_b")
         .filter(F.col("ca") == F.col("cb"))
         .groupBy("ca", "feature_a").agg(F.sum(F.abs("assoc")).alias("score"))
         .join(F.broadcast(pos.withColumnRenamed("feature", "feature_a")), "feature_a"))
    w = Window.partitionBy("ca").orderBy(F.desc("score"), "pos")
    return (s.withColumn("r", F.row_number().over(w)).filter("r = 1")
            .select(F.col("feature_a").alias("feature")).distinct().orderBy("feature"))


def select_by_clustering(assoc: DataFrame, features, threshold, linkage: str = C.CLUSTERING_LINKAGE_METHOD) -> list[str]:
    """Feature list chosen by M9 + A17 (all features when threshold is None)."""
    if threshold is None or (isinstance(threshold, float) and math.isnan(threshold)):
        return list(features)
    assoc = cut_lineage(assoc)  # small (d² rows); read by every clustering round and the representatives
    cl = cluster_features(assoc, features, threshold, linkage)
    return [r["feature"] for r in cluster_representatives(assoc, cl, features).collect()]
