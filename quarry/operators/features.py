"""Feature engineering: split, folds, scaling, encoding, balancing
(M1-M5, M8, M10).

Row order does not exist in Spark, so shuffles are defined by a hash of
an explicit unique key plus a seed. A global rank would put every row
in one task if written as an unpartitioned window; ``hash_rank`` ranks
in two phases instead: counts per md5-prefix bucket (≤16^5 rows, a
bounded table), running offsets over that small table, then a
``row_number`` inside each bucket.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config as C
from quarry.functions.columns import number, q
from quarry.operators.project import columns_by_type


def hash_key(key: str, seed: str) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))


def hash_rank(df: DataFrame, key: str, seed: str = C.SEED_TEXT, partition_by=(),
              rank_col: str = "_rank", count_col: str = "_n", prefix_len: int = C.RANK_BUCKET_HEX) -> DataFrame:
    """1-based rank of each row ordered by (md5(key‖seed), key) within
    ``partition_by`` groups, plus the group size — equal to
    ``row_number() OVER (PARTITION BY g ORDER BY md5(..), key)``."""
    pb = list(partition_by)
    d = df.withColumn("_h", hash_key(key, seed)).withColumn("_b", F.substring("_h", 1, prefix_len))
    counts = d.groupBy(*pb, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy(*pb).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*pb, "_b", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy(*pb)).alias(count_col))
    bound = 16 ** prefix_len
    if not pb and bound <= C.BROADCAST_ROW_LIMIT:
        offs = F.broadcast(offs)  # at most 16^prefix_len rows: a proven bound
    wr = Window.partitionBy(*pb, "_b").orderBy("_h", key)
    return (d.join(offs, [*pb, "_b"])
            .withColumn(rank_col, F.col("_off") + F.row_number().over(wr))
            .drop("_h", "_b", "_off"))


def hash_threshold(df: DataFrame, key: str, seed: str, rank: int, prefix_len: int = C.RANK_BUCKET_HEX):
    """The (md5, key) pair at 1-based position ``rank`` of the hash order,
    found without ranking all rows: bucket counts (≤16^prefix_len rows)
    give the bucket holding the rank; only that bucket's rows (≈ n/16^5)
    are ordered. Returns None when rank < 1."""
    if rank < 1:
        return None
    d = df.select(F.col(key).alias("_k"), hash_key(key, seed).alias("_h")) \
        .withColumn("_b", F.substring("_h", 1, prefix_len))
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over ≤16^5 bucket rows
    hit = counts.select("_b", "_c", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off")) \
        .filter((F.col("_off") < rank) & (F.col("_off") + F.col("_c") >= rank)).first()
    if hit is None:
        return None
    need = rank - hit["_off"]
    row = d.filter(F.col("_b") == hit["_b"]).orderBy("_h", "_k").limit(need).orderBy(F.desc("_h"), F.desc("_k")).first()
    return row["_h"], row["_k"]


def train_test_split(df: DataFrame, key: str = "row_id", test_size: float = C.TEST_SIZE,
                     seed: str = C.SEED_TEXT, split_col: str = "split") -> DataFrame:
    """M1: exact-size shuffled split; test = first ceil(test_size·n) rows
    of the (md5(key‖seed), key) order.

    Only the threshold pair at that rank is computed (``hash_threshold``:
    two small aggregations); the split itself is a projection comparing
    each row with it, so the data is never shuffled."""
    import math
    n = df.count()
    n_test = int(math.ceil(float(test_size) * n))
    thr = hash_threshold(df, key, seed, n_test)
    if thr is None:
        return df.withColumn(split_col, F.lit("train"))
    h, k = thr
    hk = hash_key(key, seed)
    is_test = (hk < F.lit(h)) | ((hk == F.lit(h)) & (F.col(key) <= F.lit(k)))
    return df.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def kfold(df: DataFrame, key: str = "row_id", k: int = C.N_SPLITS_CV, seed: str = C.SEED_TEXT,
          stratify_by: str | None = None, fold_col: str = "fold") -> DataFrame:
    """Shuffled folds whose sizes differ by at most one (per stratum
    when ``stratify_by`` is given): contiguous slices of the hash order.

    Only the k − 1 (md5, key) pairs at the slice ends are computed, per
    stratum; the fold itself is a projection that counts the pairs before a
    row, so the data is never shuffled."""
    from quarry.session import cut_lineage
    stratum = F.coalesce(F.col(stratify_by).cast("string"), F.lit("\u0000")) if stratify_by else F.lit("")
    d = df.select(stratum.alias("_s"), F.col(key).alias("_k"), hash_key(key, seed).alias("_h")) \
        .withColumn("_b", F.substring("_h", 1, C.RANK_BUCKET_HEX))
    counts = cut_lineage(d.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c")))  # at most 16^5 rows per stratum
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_s", "_b", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy("_s")).alias("_n"))
    i = F.col("_i")
    ends = offs.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(k - 1)))) \
        .withColumn("_r", i * F.floor(F.col("_n") / k) + F.least(i, F.col("_n") % k) - F.col("_off")) \
        .filter((F.col("_r") >= 1) & (F.col("_r") <= F.col("_c"))).select("_s", "_b", "_i", "_r")
    ends = cut_lineage(ends)  # k − 1 rows per stratum
    place = F.row_number().over(Window.partitionBy("_s", "_b", "_i").orderBy("_h", "_k"))
    cuts = d.join(ends, ["_s", "_b"]).withColumn("_p", place).filter("_p = _r") \
        .groupBy("_s").agg(F.sort_array(F.collect_list(F.struct("_h", "_k"))).alias("_cuts"))
    cuts = cut_lineage(cuts)
    marked = df.withColumn("_s", stratum)
    if cuts.count() <= C.BROADCAST_ROW_LIMIT // 1000:
        cuts = F.broadcast(cuts)  # one row per stratum, measured
    own = F.struct(hash_key(key, seed).alias("_h"), F.col(key).alias("_k"))
    out = marked.join(cuts, "_s", "left").withColumn("_own", own)
    fold = F.size(F.filter(F.coalesce("_cuts", F.array().cast(cuts.schema["_cuts"].dataType)), lambda t: t < F.col("_own")))
    return out.withColumn(fold_col, fold.cast("int")).select(*df.columns, fold_col)


@dataclass
class ScalerModel:
    """M2 state: mean and population std per column (fitted on train)."""
    means: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)

    def exprs(self, prefix: str = "") -> list[Column]:
        return [((number(q(c)) - F.lit(m)) / F.lit(self.scales[c])).alias(prefix + c)
                for c, m in self.means.items()]


def fit_standard_scaler(df: DataFrame, cols) -> ScalerModel:
    """M2 (fit): one aggregate of avg and stddev_pop; zero std → scale 1."""
    cols = list(cols)
    if not cols:
        return ScalerModel()
    aggs = []
    for i, c in enumerate(cols):
        x = number(q(c))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    r = df.agg(*aggs).first()
    means = {c: r[f"m{i}"] for i, c in enumerate(cols)}
    scales = {c: (r[f"s{i}"] if r[f"s{i}"] else 1.0) for i, c in enumerate(cols)}
    return ScalerModel(means, scales)


def standard_scale(df: DataFrame, cols, fit_on: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """M2: z-score with population std, fitted on ``fit_on`` (train)."""
    m = fit_standard_scaler(fit_on if fit_on is not None else df, cols)
    return df.select(*[F.col(q(c)) for c in df.columns if c not in m.means], *m.exprs(prefix))


def distinct_values(df: DataFrame, cols, max_per_column: int = C.MAX_CATEGORIES) -> dict:
    """Sorted distinct non-null values per string column (bounded, checked)."""
    cols = list(cols)
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("string").alias("value")) for c in cols])).alias("kv")) \
        .select("kv.column", "kv.value").filter(F.col("value").isNotNull()).distinct()
    sizes = {r["column"]: r["n"] for r in long.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    big = {c: n for c, n in sizes.items() if n > max_per_column}
    if big:
        raise ValueError(f"columns with more than {max_per_column} categories: {big}")
    out = {c: [] for c in cols}
    for r in long.collect():
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


@dataclass
class OneHotModel:
    """M3 state: sorted categories per column (fitted on train)."""
    categories: dict = field(default_factory=dict)

    def names(self, prefix: str = "cat__") -> list[str]:
        return [f"{prefix}{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def exprs(self, prefix: str = "cat__") -> list[Column]:
        return [(F.col(q(c)).cast("string") == F.lit(v)).cast("double").alias(f"{prefix}{c}_{v}")
                for c, vs in self.categories.items() for v in vs]


def fit_one_hot(df: DataFrame, cols) -> OneHotModel:
    return OneHotModel(distinct_values(df, cols))


def one_hot(df: DataFrame, cols, fit_on: DataFrame | None = None, prefix: str = "cat__") -> DataFrame:
    """M3: one column per training category; unseen or null → all zeros."""
    m = fit_one_hot(fit_on if fit_on is not None else df, cols)
    exprs = [F.coalesce(e, F.lit(0.0)).alias(n) for e, n in zip(m.exprs(prefix), m.names(prefix))]
    return df.select(*[F.col(q(c)) for c in df.columns if c not in m.categories], *exprs)


@dataclass
class ColumnTransformerModel:
    """M4 state: scaled numeric block, one-hot block, passthrough block."""
    numeric: ScalerModel = field(default_factory=ScalerModel)
    onehot: OneHotModel = field(default_factory=OneHotModel)
    remainder: list = field(default_factory=list)

    @property
    def output_names(self) -> list[str]:
        return ([f"num__{c}" for c in self.numeric.means] + self.onehot.names("cat__")
                + [f"remainder__{c}" for c in self.remainder])

    @property
    def categorical_columns(self) -> list[str]:
        return list(self.onehot.categories)

    def exprs(self) -> list[Column]:
        oh = [F.coalesce(e, F.lit(0.0)).alias(n) for e, n in zip(self.onehot.exprs("cat__"), self.onehot.names("cat__"))]
        rem = [F.col(c).cast("double").alias(f"remainder__{c}") for c in self.remainder]
        return self.numeric.exprs("num__") + oh + rem

    def transform(self, df: DataFrame, keep=("row_id", "split", "label")) -> DataFrame:
        return df.select(*[k for k in keep if k in df.columns], *self.exprs())

    def name_table(self, spark) -> DataFrame:
        """Feature-name table (idx, name, kind, source_column, category)."""
        rows = [(i, n, "num", c, None) for i, (n, c) in enumerate(zip(
            [f"num__{c}" for c in self.numeric.means], self.numeric.means))]
        for c, vs in self.onehot.categories.items():
            for v in vs:
                rows.append((len(rows), f"cat__{c}_{v}", "cat", c, v))
        for c in self.remainder:
            rows.append((len(rows), f"remainder__{c}", "remainder", c, None))
        return spark.createDataFrame(rows, "idx int, name string, kind string, source_column string, category string")

    def to_dict(self) -> dict:
        return {"numeric": asdict(self.numeric), "onehot": asdict(self.onehot), "remainder": self.remainder}

    @staticmethod
    def from_dict(d: dict) -> "ColumnTransformerModel":
        return ColumnTransformerModel(ScalerModel(**d["numeric"]), OneHotModel(**d["onehot"]), d["remainder"])


def fit_column_transformer(train: DataFrame, exclude=("row_id", "split", "label")) -> ColumnTransformerModel:
    """M4 (fit) on the training rows: numeric → M2, string → M3, rest passthrough."""
    num = columns_by_type(train, "numeric", exclude)
    cat = columns_by_type(train, "string", exclude)
    rem = columns_by_type(train, "other", exclude)
    return ColumnTransformerModel(fit_standard_scaler(train, num), fit_one_hot(train, cat), rem)


def category_codes(df: DataFrame, cols) -> DataFrame:
    """M5 (fit): ``(column, value, code)`` with 0-based codes in sorted order
    of each column's distinct non-null values, however many there are.

    The distinct values are sorted by range; a code is the value's place in
    its partition plus the number of the column's values in partitions before
    (one small row per partition and column)."""
    from quarry.session import cut_lineage
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(q(c)).cast("string").alias("value")) for c in cols])).alias("kv")) \
        .select("kv.column", "kv.value").filter(F.col("value").isNotNull()).distinct()
    ranged = long.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    ranged = cut_lineage(ranged.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    runs = ranged.groupBy("column", part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"), F.min("_m").alias("_first"))
    before = Window.partitionBy("column").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    coded = ranged.withColumn("_p", part).join(F.broadcast(runs), ["column", "_p"])
    return cut_lineage(coded.select("column", "value", (F.col("_off") + F.col("_m") - F.col("_first")).alias("code")))


def label_encode(df: DataFrame, cols) -> DataFrame:
    """M5: category → index in sorted order (0-based), per column; null stays null.

    Each column is joined with its code table, which is broadcast if its
    measured size is small and shuffled otherwise."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    codes = category_codes(df, cols)
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = df
    for i, c in enumerate(cols):
        t = codes.filter(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
        if sizes.get(c, 0) <= C.BROADCAST_ROW_LIMIT // 10:
            t = F.broadcast(t)
        out = out.join(t, F.col(q(c)).cast("string") == F.col(f"_v{i}"), "left")
    return out.select(*[F.col(f"_c{cols.index(c)}").alias(c) if c in cols else F.col(q(c)) for c in df.columns])


@dataclass
class SparseMatrixModel:
    """M4 state for wide matrices: numeric scaling, and one code table (a
    DataFrame) for all text columns with the number of codes per column."""
    numeric: ScalerModel
    codes: DataFrame | None
    sizes: dict

    def transform(self, df: DataFrame, keep=("row_id", "split", "label"), out: str = "features") -> DataFrame:
        """The kept columns and one vector per row: scaled numbers, then a
        sparse block of 0/1 per text column. Unseen values and nulls are all
        zeros, like in the dense form; names never become columns, so their
        number and spelling do not matter to the plan."""
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler
        kept = [k for k in keep if k in df.columns]
        src = df.select(*kept, *[F.col(q(c)).cast("string").alias(f"_t{i}") for i, c in enumerate(self.sizes)],
                        *[e.cast("double").alias(f"_n{i}") for i, e in enumerate(self.numeric.exprs())])
        for i, (c, n) in enumerate(self.sizes.items()):
            t = self.codes.filter(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias(f"_c{i}"))
            if n <= C.BROADCAST_ROW_LIMIT // 10:
                t = F.broadcast(t)  # measured size
            src = src.join(t, F.col(f"_t{i}") == F.col("_v"), "left").drop("_v").withColumn(
                f"_c{i}", F.coalesce(F.col(f"_c{i}"), F.lit(n)).cast("double"))
        ins = [f"_c{i}" for i in range(len(self.sizes))]
        if ins:
            # the size of each block comes from the fitted codes, with one place for "none" that is dropped
            sizes = df.sparkSession.createDataFrame([tuple(float(n) for n in self.sizes.values())], ", ".join(f"{c} double" for c in ins))
            enc = OneHotEncoder(inputCols=ins, outputCols=[f"_o{i}" for i in range(len(ins))], dropLast=True).fit(sizes)
            src = enc.transform(src)
        blocks = [f"_n{i}" for i in range(len(self.numeric.means))] + [f"_o{i}" for i in range(len(ins))]
        return VectorAssembler(inputCols=blocks, outputCol=out, handleInvalid="keep").transform(src).select(*kept, out)


def fit_sparse_matrix(train: DataFrame, exclude=("row_id", "split", "label")) -> SparseMatrixModel:
    """M4 (fit) without a column per category: any number of categories."""
    num, cat = columns_by_type(train, "numeric", exclude), columns_by_type(train, "string", exclude)
    codes = category_codes(train, cat) if cat else None
    found = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()} if cat else {}
    return SparseMatrixModel(fit_standard_scaler(train, num), codes, {c: found.get(c, 0) for c in cat})


def smote(df: DataFrame, features, label: str = "label", key: str = "row_id", k: int = 5,
          seed: str = C.SEED_TEXT, block_rows: int = 4096) -> DataFrame:
    """M8: oversample every minority class to the majority size.

    Exact k nearest neighbours (Euclidean, same class) come from
    ``operators.knn``: blocks around centres, of which a row visits only
    those that can hold a neighbour.
    Synthetic row j of class c: base row chosen by hash, neighbour chosen
    by hash among its k, ``x + u·(nb − x)`` with a hashed u.
    """
    feats = list(features)
    spark = df.sparkSession
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return df.withColumn("synthetic", F.lit(False))
    n_major = max(counts.values())
    alone = [c for c, n in counts.items() if n == 1 and n < n_major]
    if alone:
        raise ValueError(f"classes with one row have no neighbour to interpolate with: {alone}")
    minority = sorted((c for c, n in counts.items() if n < n_major), key=str)
    base = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in feats])
    if not minority:
        return base.withColumn("synthetic", F.lit(False))
    few = spark.createDataFrame([(c,) for c in minority], f"{label} {df.schema[label].dataType.simpleString()}")
    minority_rows = base.join(F.broadcast(few), label)
    # the neighbour table (k rows per minority row) is used twice: write it once to the
    # shared checkpoint folder instead of recomputing it
    from quarry.operators.knn import knn_within_class
    from quarry.session import cut_lineage
    nbrs = cut_lineage(knn_within_class(minority_rows, feats, label, key, k, block_rows, seed, {c: counts[c] for c in minority}))
    ranked = hash_rank(minority_rows, key, seed + "#smote", partition_by=[label])
    # synthetic ids come from a partitioned range per class (never one task exploding all of them)
    syn_ids = None
    for ci, c in enumerate(minority):
        part = spark.range(n_major - counts[c]).select(F.lit(c).cast(df.schema[label].dataType).alias(label),
                                                       F.lit(counts[c]).alias("_nc"), F.col("id").alias("s"),
                                                       F.lit(ci).alias("_ci"))
        syn_ids = part if syn_ids is None else syn_ids.unionByName(part)
    def draw(kind: str) -> Column:  # 32 bits of md5, the same in any engine
        text = F.concat_ws("#", F.col("s").cast("string"), F.col(label).cast("string"), F.lit(seed + kind))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")

    pick = syn_ids.select(label, "s", "_ci", (draw("row") % F.col("_nc") + 1).alias("_rank"),
                          (draw("nb") % F.lit(k)).cast("int").alias("j"), (draw("") / F.lit(4294967296.0)).alias("u"))
    b = ranked.select(label, "_rank", F.col(key).alias("_base"), *[F.col(f).alias(f"_x_{f}") for f in feats])
    chosen = pick.join(b, [label, "_rank"])
    kcount = nbrs.groupBy(key).agg(F.count(F.lit(1)).alias("_kn"))
    chosen = chosen.join(kcount.withColumnRenamed(key, "_base"), "_base") \
        .withColumn("j", F.pmod(F.col("j"), F.col("_kn")))
    chosen = chosen.join(nbrs.select(F.col(key).alias("_base"), "j", F.col("nb").alias("_nbk")), ["_base", "j"])
    nbv = base.select(F.col(key).alias("_nbk"), *[F.col(f).alias(f"_n_{f}") for f in feats])
    syn = chosen.join(nbv, "_nbk").select(
        (-(F.col("s") * F.lit(len(minority)) + F.col("_ci") + 1)).cast(df.schema[key].dataType).alias(key), label,
        *[(F.col(f"_x_{f}") + F.col("u") * (F.col(f"_n_{f}") - F.col(f"_x_{f}"))).alias(f) for f in feats],
        F.lit(True).alias("synthetic"))
    return base.withColumn("synthetic", F.lit(False)).unionByName(syn)
