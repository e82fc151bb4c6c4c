"""Projections, filters and column selection.

Column decisions are made from ``df.columns`` / ``df.schema`` on the
driver (names only, never data), so they are pure projections that
Catalyst prunes down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.columns import number, q

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def drop_null_rows(df: DataFrame, cols, how: str = "any") -> DataFrame:
    """Drop rows with null in the given columns (``any`` or ``all``)."""
    return df.dropna(how=how, subset=list(cols))


def columns_matching(columns, keywords) -> list[str]:
    kws = [k.lower() for k in keywords]
    return [c for c in columns if any(k in c.lower() for k in kws)]


def drop_columns_matching(df: DataFrame, keywords) -> DataFrame:
    """Drop columns whose lower-cased name contains a lower-cased keyword."""
    return df.drop(*columns_matching(df.columns, keywords))


def drop_columns_if_present(df: DataFrame, names) -> DataFrame:
    """Exact-name drop; absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def superseded_columns(columns, old: str = "_o", new: str = "_u", match: str = "suffix") -> list[str]:
    cols = list(columns)
    out = []
    if match == "suffix":
        for c in cols:
            if c.endswith(new):
                cand = c[: -len(new)] + old
                if cand in cols and cand not in out:
                    out.append(cand)
    elif match == "anywhere":
        for c in cols:
            if new in c:
                cand = c.replace(new, old)
                if cand in cols and cand not in out:
                    out.append(cand)
    else:
        raise ValueError(match)
    return out


def drop_superseded_columns(df: DataFrame, old: str = "_o", new: str = "_u",
                            match: str = "suffix") -> DataFrame:
    """Drop ``x_o`` when ``x_u`` exists (suffix) or the every-occurrence variant."""
    return df.drop(*superseded_columns(df.columns, old, new, match))


def low_variation_columns(df: DataFrame, threshold: int = 1, cols=None) -> list[str]:
    """Columns with at most ``threshold`` distinct non-null values.

    threshold 1 needs only ``min <> max`` per column (one aggregate, no
    distinct shuffle); other thresholds use the exact distinct counts.
    """
    cols = list(cols or df.columns)
    if not cols:
        return []
    if threshold == 1:
        aggs = []
        for i, c in enumerate(cols):
            x = number(q(c)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(q(c))  # NaN is missing
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
        r = df.agg(*aggs).first()
        return [c for i, c in enumerate(cols)
                if r[f"a{i}"] is None or r[f"a{i}"] == r[f"b{i}"]]
    from quarry.operators.stats import n_unique
    counts = {row["column"]: row["n_unique"] for row in n_unique(df, cols).collect()}
    return [c for c in cols if c in counts and counts[c] <= threshold]


def drop_low_variation(df: DataFrame, threshold: int = 1, cols=None) -> DataFrame:
    """P5: keep columns with more than ``threshold`` distinct non-null values."""
    return df.drop(*low_variation_columns(df, threshold, cols))


def split_target(df: DataFrame, target: str, label: str = "label", keep=("row_id",)) -> DataFrame:
    """Target becomes ``label``; other columns are features."""
    keep = [k for k in keep if k in df.columns and k != target]
    feats = [c for c in df.columns if c != target and c not in keep]
    return df.select(*keep, F.col(target).alias(label), *feats)


def columns_by_type(df: DataFrame, kind: str, exclude=()) -> list[str]:
    """Numeric / string / other (bool and the rest) column lists."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        is_num = isinstance(f.dataType, NUMERIC_TYPES)
        is_str = isinstance(f.dataType, T.StringType)
        if (kind == "numeric" and is_num) or (kind == "string" and is_str) or \
           (kind == "other" and not is_num and not is_str) or \
           (kind == "numeric_or_bool" and (is_num or isinstance(f.dataType, T.BooleanType))):
            out.append(f.name)
    return out


def align_columns(df: DataFrame, columns, fill=0, keep=()) -> DataFrame:
    """Training columns in training order; missing ones as ``fill``; extras dropped."""
    have = set(df.columns)
    return df.select(*[F.col(k) for k in keep if k in have],
                     *[F.col(q(c)) if c in have else F.lit(fill).cast("double").alias(c) for c in columns])


def select_features(df: DataFrame, names, keep=("row_id", "label")) -> DataFrame:
    """Keep the chosen features (plus key/label columns)."""
    return df.select(*[k for k in keep if k in df.columns], *[F.col(q(n)) for n in names])


def filter_report(df: DataFrame, keep) -> DataFrame:
    """P10: rows before, after and dropped by the condition ``keep``, in one scan."""
    out = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count(F.when(keep, 1)).alias("rows_after"))
    return out.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
