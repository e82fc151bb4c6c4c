"""Registered queries: one per operator family, each with a Spark
callable ``(spark, sf_dir) -> DataFrame`` and, where the semantics are
SQL-expressible, an oracle statement for DuckDB over the same tables.

Floating results are rounded on both sides (``R`` digits) because
engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import config as C
from quarry.functions.columns import GOLDEN_32, MIX_MULT, TWO_32_INT
from quarry.plans.fixtures import D4_TEXTS, D4_TEXTS_SQL, D4_WIDE, D4_WIDE_SQL, d1, d2, d3, d4, d4_texts, d4_wide, duck_ctes
from quarry.session import cut_lineage

R = 6


@dataclass
class Query:
    name: str
    ops: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, ops, fn, (duck_ctes() + "\n" + sql) if sql else None)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = R, per_col: dict | None = None) -> DataFrame:
    per_col = per_col or {}
    return df.select(*[
        F.round(F.col(f.name), per_col.get(f.name, digits)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


# SQL fragments shared by oracle statements (DuckDB dialect)
UNIFORM_SQL = "CAST('0x' || substr(md5(concat(CAST({k} AS VARCHAR), '{s}')), 1, 8) AS BIGINT) / 4294967296.0"
WALL_SQL = ("CASE wall_thickness WHEN 'un' THEN NULL WHEN 'not_applicable' THEN 0e0 "
            "ELSE try_cast(trim(wall_thickness) AS DOUBLE) END")
BLANK_SQL = "coalesce(CASE WHEN regexp_matches({c}, '^\\s*$') THEN NULL ELSE {c} END, 'un')"

CLEAN_D1_SQL = f"""
, f AS (SELECT * FROM d1 WHERE Difference IS NOT NULL)
, m AS (SELECT avg({WALL_SQL}) AS wt, avg(building_area_m2) AS ba FROM f)
, c AS (
  SELECT row_id, Difference, estimated, simulated_damage,
    coalesce({WALL_SQL}, m.wt) AS wall_thickness,
    {BLANK_SQL.format(c='foundation_type_u')} AS foundation_type_u,
    roof_shape_u, coalesce(building_area_m2, m.ba) AS building_area_m2, is_even,
    {UNIFORM_SQL.format(k='row_id', s=C.SEED_TEXT)} AS random_feature
  FROM f, m)
"""


# --------------------------------------------------------------------------- M31 / flagship
def clean_d1(spark, sf_dir):
    from quarry.plans.clean import clean
    return clean(d1(spark, sf_dir))


@register("clean_table", "M31 P1 P5 P2 P3 P4 C1 C2 C3 C4 A2 C9", CLEAN_D1_SQL + """
SELECT row_id, round(Difference, 6) AS Difference, round(estimated, 6) AS estimated, simulated_damage,
  round(wall_thickness, 6) AS wall_thickness, foundation_type_u, roof_shape_u,
  round(building_area_m2, 6) AS building_area_m2, is_even, round(random_feature, 6) AS random_feature
FROM c""")
def q_clean_table(spark, sf_dir):
    return rounded(clean_d1(spark, sf_dir))


def corr_features(spark, sf_dir):
    """Cleaned D1 → exclusions → label-encoded strings (input of A11/A13)."""
    from quarry.operators.features import label_encode
    from quarry.operators.project import columns_by_type, drop_columns_if_present
    df = drop_columns_if_present(clean_d1(spark, sf_dir), C.MI_CORR_EXCLUDE)
    return label_encode(df, columns_by_type(df, "string"))


CORR_SQL = CLEAN_D1_SQL + """
, e AS (SELECT *, dense_rank() OVER (ORDER BY foundation_type_u) - 1 AS ft,
          dense_rank() OVER (ORDER BY roof_shape_u) - 1 AS rs FROM c)
, r AS (
  SELECT 'wall_thickness' AS feature, corr(wall_thickness, Difference) AS v FROM e UNION ALL
  SELECT 'foundation_type_u', corr(ft, Difference) FROM e UNION ALL
  SELECT 'roof_shape_u', corr(rs, Difference) FROM e UNION ALL
  SELECT 'building_area_m2', corr(building_area_m2, Difference) FROM e UNION ALL
  SELECT 'is_even', corr(CAST(is_even AS DOUBLE), Difference) FROM e UNION ALL
  SELECT 'random_feature', corr(random_feature, Difference) FROM e)
SELECT feature, round(v, 6) AS corr, round(abs(v), 6) AS abs_corr FROM r
ORDER BY abs(v) DESC, feature LIMIT 10"""


@register("feature_target_corr", "A11 M5 T1 (flagship)", CORR_SQL)
def q_feature_target_corr(spark, sf_dir):
    from quarry.operators.stats import feature_target_corr
    df = corr_features(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("row_id", C.TARGET_COLUMN)]
    return rounded(feature_target_corr(df, C.TARGET_COLUMN, feats, k=C.N_TOP_CORR))


def flagship(spark, sf_dir):
    return q_feature_target_corr(spark, sf_dir)


# --------------------------------------------------------------------------- sources
@register("typed_scan", "S1 S2 S3 S4", """
SELECT round(CAST(row_id AS DOUBLE), 6) AS row_id, round(Difference, 6) AS Difference,
  round(estimated, 6) AS estimated, simulated_damage, wall_thickness, foundation_type_u, roof_shape_o,
  roof_shape_u, const_col, round(building_area_m2, 6) AS building_area_m2,
  round(CAST(front_Photos AS DOUBLE), 6) AS front_Photos, CAST(NULL AS DOUBLE) AS notes, is_even
FROM d1""")
def q_typed_scan(spark, sf_dir):
    """D1 written as CSV (S4) and scanned back (S1) with NA spellings
    and per-column type decisions (S3), as a pandas CSV read would."""
    from quarry.session import scratch_path
    from quarry.sources.io import read_table, write_csv
    path = scratch_path(spark, "d1csv")
    write_csv(d1(spark, sf_dir), path)
    return rounded(read_table(spark, path))


# --------------------------------------------------------------------------- projections (P)
@register("drop_null_target", "P1", """
SELECT row_id, round(Difference, 6) AS Difference FROM d1 WHERE Difference IS NOT NULL""")
def q_drop_null_target(spark, sf_dir):
    from quarry.operators.project import drop_null_rows
    return rounded(drop_null_rows(d1(spark, sf_dir), [C.TARGET_COLUMN]).select("row_id", C.TARGET_COLUMN))


@register("filter_report", "P10", """
SELECT count(*) AS rows_before, count(Difference) AS rows_after, count(*) - count(Difference) AS rows_dropped FROM d1""")
def q_filter_report(spark, sf_dir):
    from quarry.operators.project import filter_report
    return filter_report(d1(spark, sf_dir), F.col(C.TARGET_COLUMN).isNotNull())


@register("drop_low_variation", "P5 P1", """
SELECT row_id, round(Difference, 6) AS Difference, round(estimated, 6) AS estimated, simulated_damage,
  wall_thickness, foundation_type_u, roof_shape_o, roof_shape_u, round(building_area_m2, 6) AS building_area_m2,
  front_Photos, is_even
FROM d1 WHERE Difference IS NOT NULL""")
def q_drop_low_variation(spark, sf_dir):
    from quarry.operators.project import drop_low_variation, drop_null_rows
    return rounded(drop_low_variation(drop_null_rows(d1(spark, sf_dir), [C.TARGET_COLUMN])))


@register("drop_by_name_rules", "P2 P3 P4", """
SELECT row_id, round(Difference, 6) AS Difference, round(estimated, 6) AS estimated, simulated_damage,
  wall_thickness, foundation_type_u, roof_shape_u, const_col, round(building_area_m2, 6) AS building_area_m2,
  is_even
FROM d1""")
def q_drop_by_name_rules(spark, sf_dir):
    from quarry.operators.project import drop_columns_if_present, drop_columns_matching, drop_superseded_columns
    df = drop_columns_matching(d1(spark, sf_dir), C.KEYWORDS_TO_DROP)
    df = drop_columns_if_present(df, C.SPECIFIC_COLUMNS_TO_DROP)
    return rounded(drop_superseded_columns(df, match="anywhere"))


@register("split_align_select", "P6 P7 P8 P9", """
SELECT row_id, round(value * 2e0 + CAST(user_bucket AS BIGINT), 6) AS label, round(value, 6) AS value,
  round(hour_of_day, 6) AS hour_of_day, 0e0 AS missing_feature
FROM (SELECT row_id, value, user_bucket, hour_of_day FROM d3)""")
def q_split_align_select(spark, sf_dir):
    """Target split (P6), numeric columns (P7), alignment to a training
    column list with a missing column filled by 0 (P8), selection (P9)."""
    from quarry.operators.project import align_columns, columns_by_type, select_features, split_target
    df = split_target(d3(spark, sf_dir), "label")
    num = columns_by_type(df, "numeric", exclude=("row_id", "label", "minority", "user_bucket"))
    df = select_features(df, num)
    return rounded(align_columns(df, ["value", "hour_of_day", "missing_feature"], keep=("row_id", "label")))


# --------------------------------------------------------------------------- statistics (A)
@register("n_unique", "A1", """
SELECT * FROM (VALUES (0, 'row_id'), (1, 'Difference'), (2, 'estimated'), (3, 'simulated_damage'),
  (4, 'wall_thickness'), (5, 'foundation_type_u'), (6, 'roof_shape_o'), (7, 'roof_shape_u'), (8, 'const_col'),
  (9, 'building_area_m2'), (10, 'front_Photos'), (11, 'notes'), (12, 'is_even')) AS t(pos, column_name)
JOIN (SELECT unnest([count(DISTINCT row_id), count(DISTINCT Difference), count(DISTINCT estimated),
  count(DISTINCT simulated_damage), count(DISTINCT wall_thickness), count(DISTINCT foundation_type_u),
  count(DISTINCT roof_shape_o), count(DISTINCT roof_shape_u), count(DISTINCT const_col),
  count(DISTINCT building_area_m2), count(DISTINCT front_Photos), count(DISTINCT notes),
  count(DISTINCT is_even)]) AS n_unique, unnest(range(13)) AS pos FROM d1) USING (pos)
""".replace("SELECT * FROM", "SELECT column_name AS \"column\", n_unique FROM"))
def q_n_unique(spark, sf_dir):
    from quarry.operators.stats import n_unique
    return n_unique(d1(spark, sf_dir))


@register("impute_mean", "A2", """
, m AS (SELECT avg(Difference) AS md, avg(building_area_m2) AS mb FROM d1)
SELECT row_id, round(coalesce(Difference, md), 6) AS Difference,
  round(coalesce(building_area_m2, mb), 6) AS building_area_m2, round(estimated, 6) AS estimated FROM d1, m""")
def q_impute_mean(spark, sf_dir):
    from quarry.operators.stats import impute_mean
    df = d1(spark, sf_dir).select("row_id", C.TARGET_COLUMN, "building_area_m2", "estimated")
    return rounded(impute_mean(df, [C.TARGET_COLUMN, "building_area_m2", "estimated"]))


@register("impute_median", "A3", """
, m AS (SELECT median(Difference) AS md, median(building_area_m2) AS mb FROM d1)
SELECT row_id, round(coalesce(Difference, md), 6) AS Difference,
  round(coalesce(building_area_m2, mb), 6) AS building_area_m2 FROM d1, m""")
def q_impute_median(spark, sf_dir):
    from quarry.operators.stats import impute_median
    df = d1(spark, sf_dir).select("row_id", C.TARGET_COLUMN, "building_area_m2")
    return rounded(impute_median(df, [C.TARGET_COLUMN, "building_area_m2"]))


@register("describe_target", "A4 C12", """
, s AS (SELECT count(Difference) AS n, avg(Difference) AS mean, median(Difference) AS median,
          stddev_samp(Difference) AS std, skewness(Difference) AS skew FROM d1)
SELECT n, round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS std, round(skew, 6) AS skew,
  CASE WHEN mean > 0.1 THEN 'underestimate' WHEN mean < -0.1 THEN 'overestimate' ELSE 'unbiased' END AS mean_verdict,
  CASE WHEN skew > 0.5 THEN 'positive' WHEN skew < -0.5 THEN 'negative' ELSE 'none' END AS skew_verdict
FROM s""")
def q_describe_target(spark, sf_dir):
    from quarry.operators.stats import describe_target
    return rounded(describe_target(d1(spark, sf_dir), C.TARGET_COLUMN))


@register("value_counts", "A5", CLEAN_D1_SQL + """
SELECT foundation_type_u, count(*) AS n FROM c GROUP BY 1""")
def q_value_counts(spark, sf_dir):
    from quarry.operators.stats import value_counts
    return value_counts(clean_d1(spark, sf_dir), "foundation_type_u")


SPLIT_D1_SQL = CLEAN_D1_SQL + f"""
, y AS (SELECT row_id, CAST(trunc(coalesce(Difference, 0e0)) AS INTEGER) AS label FROM c)
, k AS (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), row_id) AS r,
          count(*) OVER () AS n FROM y)
, s AS (SELECT row_id, label, CASE WHEN r <= ceil(0.2e0 * n) THEN 'test' ELSE 'train' END AS split FROM k)
"""


@register("class_distribution", "A6 C5 M1", SPLIT_D1_SQL + """
SELECT 'original' AS split, label, count(*) AS n FROM y GROUP BY 2 UNION ALL
SELECT 'train_before_balancing', label, count(*) FROM s WHERE split = 'train' GROUP BY 2 UNION ALL
SELECT 'train_after_balancing', label, count(*) FROM s WHERE split = 'train' GROUP BY 2 UNION ALL
SELECT 'test', label, count(*) FROM s WHERE split = 'test' GROUP BY 2""")
def q_class_distribution(spark, sf_dir):
    from quarry.operators.features import train_test_split
    from quarry.operators.stats import class_distribution_from_split
    from quarry.plans.clean import prepare_target
    y = prepare_target(clean_d1(spark, sf_dir)).select("row_id", "label")
    s = train_test_split(y, "row_id", C.TEST_SIZE, C.SEED_TEXT)
    return class_distribution_from_split(s)


@register("min_max", "A7", """
SELECT round(min(label), 6) AS "min", round(max(label), 6) AS "max" FROM d2""")
def q_min_max(spark, sf_dir):
    from quarry.operators.stats import min_max
    return rounded(min_max(d2(spark, sf_dir), "label"))


@register("histogram", "A8", """
, m AS (SELECT min(label) AS mn, max(label) AS mx FROM d2)
, b AS (SELECT least(10, CAST(floor((label - mn) / (mx - mn) * 10) AS INTEGER) + 1) AS bin FROM d2, m)
SELECT bin, round(mn + (bin - 1) * ((mx - mn) / 10), 6) AS bin_lo, round(mn + bin * ((mx - mn) / 10), 6) AS bin_hi,
  count(*) AS n FROM b, m GROUP BY bin, mn, mx""")
def q_histogram(spark, sf_dir):
    from quarry.operators.stats import histogram
    return rounded(histogram(d2(spark, sf_dir), "label", C.HISTOGRAM_BINS))


@register("kde", "A9", """
, g AS (SELECT CAST(v AS DOUBLE) * 5000 AS gx FROM range(0, 21) t(v))
, h AS (SELECT stddev_samp(label) * power(count(*), -0.2) AS bw, count(*) AS n FROM d2)
SELECT round(gx, 6) AS gx, round(sum(exp(-0.5 * power((gx - label) / bw, 2))) / (max(n) * max(bw) * sqrt(2 * pi())), 12) AS density
FROM d2, g, h GROUP BY gx""")
def q_kde(spark, sf_dir):
    from quarry.operators.stats import kde
    return rounded(kde(d2(spark, sf_dir), "label", grid=[5000.0 * i for i in range(21)]),
                   per_col={"density": 12})


@register("box_stats_by_category", "A10", """
, q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
          quantile_cont(value, 0.75) AS q3 FROM d3 GROUP BY 1)
SELECT q.event_type, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr,
  round(min(CASE WHEN value >= q1 - 1.5e0 * (q3 - q1) AND value <= q3 + 1.5e0 * (q3 - q1) THEN value END), 6) AS lower_whisker,
  round(max(CASE WHEN value >= q1 - 1.5e0 * (q3 - q1) AND value <= q3 + 1.5e0 * (q3 - q1) THEN value END), 6) AS upper_whisker,
  count(CASE WHEN NOT (value >= q1 - 1.5e0 * (q3 - q1) AND value <= q3 + 1.5e0 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM d3 JOIN q USING (event_type) GROUP BY q.event_type, q.n, q1, median, q3""")
def q_box_stats(spark, sf_dir):
    from quarry.operators.stats import box_stats
    return rounded(box_stats(d3(spark, sf_dir), "value", by=["event_type"]))


@register("box_stats_target", "A10 (global)", """
, q AS (SELECT quantile_cont(Difference, 0.25) AS q1, quantile_cont(Difference, 0.5) AS median,
          quantile_cont(Difference, 0.75) AS q3 FROM d1)
SELECT count(Difference) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  round(max(q3 - q1), 6) AS iqr,
  round(min(CASE WHEN Difference >= q1 - 1.5e0 * (q3 - q1) AND Difference <= q3 + 1.5e0 * (q3 - q1) THEN Difference END), 6) AS lower_whisker,
  round(max(CASE WHEN Difference >= q1 - 1.5e0 * (q3 - q1) AND Difference <= q3 + 1.5e0 * (q3 - q1) THEN Difference END), 6) AS upper_whisker,
  count(CASE WHEN NOT (Difference >= q1 - 1.5e0 * (q3 - q1) AND Difference <= q3 + 1.5e0 * (q3 - q1)) THEN 1 END) AS n_outliers
FROM d1, q""")
def q_box_stats_target(spark, sf_dir):
    from quarry.operators.stats import box_stats
    return rounded(box_stats(d1(spark, sf_dir), C.TARGET_COLUMN))


@register("paired_ttest", "A12 C2 C12", """
, p AS (SELECT try_cast(trim(simulated_damage) AS DOUBLE) - estimated AS d FROM d1)
, s AS (SELECT count(d) AS n, avg(d) AS mean_diff, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS t FROM p WHERE d IS NOT NULL)
, g AS (SELECT i * abs(t) / 2000.0 AS x, n - 1.0 AS nu,
          CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM s, range(0, 2001) r(i))
, a AS (SELECT sum(w * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2) - 0.5 * ln(nu * pi())
                      - (nu + 1) / 2 * ln(1 + x * x / nu))) * (max(x) / 2000.0) / 3 AS area FROM g)
SELECT n, round(mean_diff, 6) AS mean_diff, round(t, 6) AS t_statistic, round(1 - 2 * area, 6) AS p_value,
  CASE WHEN 1 - 2 * area < 0.05 THEN 'significant' ELSE 'not significant' END AS significance,
  CASE WHEN 1 - 2 * area >= 0.05 THEN 'none' WHEN t > 0 THEN 'first higher' ELSE 'second higher' END AS direction
FROM s, a""")
def q_paired_ttest(spark, sf_dir):
    from quarry.operators.stats import paired_ttest
    return rounded(paired_ttest(d1(spark, sf_dir), "simulated_damage", "estimated"))


@register("trend_line", "A20", """
SELECT CAST(regr_count(label, value) AS BIGINT) AS n, round(regr_slope(label, value), 6) AS slope,
  round(regr_intercept(label, value), 6) AS intercept, round(regr_r2(label, value), 6) AS r2 FROM d3""")
def q_trend_line(spark, sf_dir):
    from quarry.operators.stats import trend_line
    return rounded(trend_line(d3(spark, sf_dir), "value", "label"))


def _trend_band_sql() -> str:
    from quarry.operators.assoc import _poisson_weight_sql
    kb = f"CAST('0x' || substr(md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), 1, 8) AS BIGINT)"
    x = "((kb + b * 2654435761) % 4294967296)"
    for _ in range(2):
        x = f"((xor({x} >> 16, {x}) * 73244475) % 4294967296)"
    return f""", m AS (SELECT avg(value) AS cx, avg(label) AS cy, min(value) AS mn, max(value) AS mx FROM d3)
, k AS (SELECT {kb} AS kb, value - cx AS x, label - cy AS y FROM d3, m)
, w AS (SELECT b, x, y, CAST({_poisson_weight_sql(f"(xor({x} >> 16, {x}) / 4294967296.0)")} AS DOUBLE) AS w FROM k, range(0, 1000) r(b))
, t AS (SELECT b, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY b)
, l AS (SELECT b, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS m, sx, sy, sw FROM t)
, g AS (SELECT mn + (mx - mn) * i / 99 AS gx FROM m, range(0, 100) r(i))
, p AS (SELECT gx, l.m * (gx - cx) + (sy - l.m * sx) / sw + cy AS yhat FROM l, m, g)
SELECT round(gx, 6) AS gx, round(quantile_cont(yhat, 0.025), 4) AS lower, round(quantile_cont(yhat, 0.975), 4) AS upper FROM p GROUP BY gx"""


@register("trend_band", "A21", _trend_band_sql())
def q_trend_band(spark, sf_dir):
    from quarry.operators.stats import trend_band
    out = trend_band(d3(spark, sf_dir), "value", "label", "row_id", n_boot=1000, n_grid=100)
    return rounded(out, per_col={"lower": 4, "upper": 4})


# --------------------------------------------------------------------------- scalar functions (C)
@register("replace_to_numeric", "C1 C2", f"""
SELECT row_id, round({WALL_SQL}, 6) AS wall_thickness FROM d1""")
def q_replace_to_numeric(spark, sf_dir):
    from quarry.functions.columns import replace_values, to_numeric
    df = replace_values(d1(spark, sf_dir).select("row_id", "wall_thickness"), C.COLUMNS_FOR_VALUE_REPLACEMENT)
    return rounded(df.select("row_id", to_numeric("wall_thickness").alias("wall_thickness")))


@register("blank_fill", "C3 C4", f"""
SELECT row_id, {BLANK_SQL.format(c='foundation_type_u')} AS foundation_type_u FROM d1""")
def q_blank_fill(spark, sf_dir):
    from quarry.functions.columns import blank_to_null, fill_constant
    return d1(spark, sf_dir).select("row_id", fill_constant(blank_to_null("foundation_type_u"), "un")
                                    .alias("foundation_type_u"))


@register("truncate_map_classes", "C5 C6", """
, y AS (SELECT row_id, CAST(trunc(coalesce(Difference, 0e0)) AS INTEGER) AS label FROM d1)
SELECT row_id, label, CAST(CASE label WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 2
  WHEN 5 THEN 3 END AS DOUBLE) AS label_a FROM y""")
def q_truncate_map_classes(spark, sf_dir):
    from quarry.functions.columns import map_classes, truncate_int
    y = d1(spark, sf_dir).select("row_id", truncate_int(F.coalesce(F.col(C.TARGET_COLUMN), F.lit(0.0))).alias("label"))
    return y.select("row_id", "label", map_classes("label", C.CLASS_MAPPINGS["A"]).cast("double").alias("label_a"))


@register("as_category", "C7", """
SELECT row_id, coalesce(CAST(building_area_m2 AS VARCHAR), 'nan') AS building_area_m2 FROM d1""")
def q_as_category(spark, sf_dir):
    from quarry.functions.columns import as_category
    return d1(spark, sf_dir).select("row_id", as_category("building_area_m2").alias("building_area_m2"))


@register("abs_if_negative", "C8", """
, m AS (SELECT min(Difference) AS mn FROM d1)
SELECT row_id, round(CASE WHEN mn < 0 THEN abs(Difference) ELSE Difference END, 6) AS Difference FROM d1, m""")
def q_abs_if_negative(spark, sf_dir):
    from quarry.functions.columns import abs_if_negative
    return rounded(abs_if_negative(d1(spark, sf_dir).select("row_id", C.TARGET_COLUMN), C.TARGET_COLUMN))


@register("random_feature", "C9", f"""
SELECT row_id, round({UNIFORM_SQL.format(k='row_id', s=C.SEED_TEXT)}, 6) AS random_feature FROM d3""")
def q_random_feature(spark, sf_dir):
    from quarry.functions.columns import add_random_feature
    return rounded(add_random_feature(d3(spark, sf_dir).select("row_id"), "row_id", C.SEED_TEXT))


@register("combo_key_slug", "C11", """
, m AS (SELECT DISTINCT event_type FROM d3)
SELECT event_type || '_Original Features' AS combo_key,
  replace(replace(replace(event_type || '_Original Features', ' ', '_'), '(', ''), ')', '') AS slug,
  lower(regexp_replace(event_type || ' vs Original Features', '[^0-9A-Za-z_]+', '_', 'g')) AS safe_name
FROM m""")
def q_combo_key_slug(spark, sf_dir):
    from quarry.functions.columns import combo_key, safe_name, slug
    m = d3(spark, sf_dir).select("event_type").distinct()
    k = combo_key("event_type", F.lit("Original Features"))
    return m.select(k.alias("combo_key"), slug(k).alias("slug"),
                    safe_name(F.concat(F.col("event_type"), F.lit(" vs Original Features"))).alias("safe_name"))


@register("plot_frame", "C13", """
, a AS (SELECT building_area_m2 AS x, estimated AS y, CAST(foundation_type_u AS VARCHAR) AS hue, Difference AS size
        FROM d1 WHERE foundation_type_u IS NOT NULL AND Difference IS NOT NULL)
, m AS (SELECT min(size) AS mn FROM a)
, b AS (SELECT x, y, hue, CASE WHEN mn < 0 THEN abs(size) ELSE size END AS size FROM a, m
        WHERE x IS NOT NULL AND y IS NOT NULL)
, h AS (SELECT count(DISTINCT hue) AS nh FROM b)
SELECT round(x, 6) AS x, round(y, 6) AS y, hue, round(size, 6) AS size,
  CASE WHEN nh <= 10 THEN 'tab10' WHEN nh <= 20 THEN 'tab20' ELSE 'hls' END AS palette FROM b, h""")
def q_plot_frame(spark, sf_dir):
    from quarry.operators.frames import plot_frame
    return rounded(plot_frame(d1(spark, sf_dir), "building_area_m2", "estimated", "foundation_type_u",
                              C.TARGET_COLUMN))


# --------------------------------------------------------------------------- top-k (T)
@register("first_distinct", "T2", """
SELECT event_type, min(row_id) AS first_pos FROM d3 GROUP BY 1 ORDER BY 2, 1 LIMIT 5""")
def q_first_distinct(spark, sf_dir):
    from quarry.operators.rank import first_distinct
    return first_distinct(d3(spark, sf_dir), "event_type", "row_id", 5)


@register("best_row", "T3", """
SELECT row_id, round(value, 6) AS value FROM d3 ORDER BY value DESC, row_id LIMIT 1""")
def q_best_row(spark, sf_dir):
    from quarry.operators.rank import best_row
    return rounded(best_row(d3(spark, sf_dir).select("row_id", "value"), "value", "row_id"))


@register("top_k", "T1", """
SELECT row_id, round(label, 6) AS label FROM d2r ORDER BY label DESC, row_id LIMIT 15""".replace(
    "FROM d2r", "FROM (SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS row_id, l_extendedprice AS label FROM lineitem)"))
def q_top_k(spark, sf_dir):
    from quarry.operators.rank import top_k
    from quarry.plans.fixtures import table
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey").cast("long") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.col("l_extendedprice").alias("label"))
    return rounded(top_k(li, "label", 15, tiebreak=("row_id",)))


# --------------------------------------------------------------------------- features
RANK_D3_SQL = f"""
, k AS (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), row_id) AS r,
          count(*) OVER () AS n FROM d3)
, s AS (SELECT *, CASE WHEN r <= ceil(0.2e0 * n) THEN 'test' ELSE 'train' END AS split FROM k)
"""


def split_d3(spark, sf_dir):
    from quarry.operators.features import train_test_split
    return train_test_split(d3(spark, sf_dir), "row_id", C.TEST_SIZE, C.SEED_TEXT)


@register("train_test_split", "M1", RANK_D3_SQL + "SELECT row_id, split FROM s")
def q_train_test_split(spark, sf_dir):
    return split_d3(spark, sf_dir).select("row_id", "split")


#: Slice of the hash order that rank r (from 0) of n rows falls into, of five slices.
FOLD_SQL = ("CAST(CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1) "
            "ELSE n % 5 + (r - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END AS INTEGER)")


@register("kfold", "M10", f"""
, r AS (SELECT row_id, row_number() OVER (ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), row_id) - 1 AS r,
          count(*) OVER () AS n FROM d3)
SELECT row_id, {FOLD_SQL} AS fold FROM r""")
def q_kfold(spark, sf_dir):
    from quarry.operators.features import kfold
    return kfold(d3(spark, sf_dir), "row_id", C.N_SPLITS_CV, C.SEED_TEXT).select("row_id", "fold")


@register("kfold_stratified", "M10 (stratified)", f"""
, r AS (SELECT row_id, minority, row_number() OVER (PARTITION BY minority
            ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), row_id) - 1 AS r,
          count(*) OVER (PARTITION BY minority) AS n FROM d3)
SELECT row_id, minority, {FOLD_SQL} AS fold FROM r""")
def q_kfold_stratified(spark, sf_dir):
    from quarry.operators.features import kfold
    return kfold(d3(spark, sf_dir), "row_id", C.N_SPLITS_CV, C.SEED_TEXT, stratify_by="minority") \
        .select("row_id", "minority", "fold")


@register("standard_scale", "M2 M1", RANK_D3_SQL + """
, f AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(hour_of_day) AS mh, stddev_pop(hour_of_day) AS sh
        FROM s WHERE split = 'train')
SELECT row_id, split, round((value - mv) / sv, 6) AS value, round((hour_of_day - mh) / sh, 6) AS hour_of_day FROM s, f""")
def q_standard_scale(spark, sf_dir):
    from quarry.operators.features import standard_scale
    s = split_d3(spark, sf_dir).select("row_id", "split", "value", "hour_of_day")
    return rounded(standard_scale(s, ["value", "hour_of_day"], fit_on=s.filter("split = 'train'")))


EVENT_TYPES_SQL = ["click", "error", "purchase", "signup", "view"]


@register("one_hot", "M3 M1", RANK_D3_SQL + """
SELECT row_id, split, """ + ", ".join(
    f"CASE WHEN event_type = '{v}' AND '{v}' IN (SELECT event_type FROM s WHERE split = 'train') THEN 1e0 ELSE 0e0 END "
    f"AS \"cat__event_type_{v}\"" for v in EVENT_TYPES_SQL) + " FROM s")
def q_one_hot(spark, sf_dir):
    from quarry.operators.features import one_hot
    s = split_d3(spark, sf_dir).select("row_id", "split", "event_type")
    return one_hot(s, ["event_type"], fit_on=s.filter("split = 'train'"))


COLUMN_TRANSFORMER_SQL = (RANK_D3_SQL + """
, f AS (SELECT avg(user_bucket) AS m1, stddev_pop(user_bucket) AS s1, avg(hour_of_day) AS m2, stddev_pop(hour_of_day) AS s2,
          avg(value) AS m3, stddev_pop(value) AS s3, avg(minority) AS m4, stddev_pop(minority) AS s4
        FROM s WHERE split = 'train')
SELECT row_id, split, round(label, 6) AS label, round((user_bucket - m1) / s1, 6) AS num__user_bucket,
  round((hour_of_day - m2) / s2, 6) AS num__hour_of_day, round((value - m3) / s3, 6) AS num__value,
  round((minority - m4) / s4, 6) AS num__minority, """ + ", ".join(
    f"CASE WHEN event_type = '{v}' THEN 1e0 ELSE 0e0 END AS \"cat__event_type_{v}\"" for v in EVENT_TYPES_SQL)
    + " FROM s, f")


@register("column_transformer", "M4 M2 M3 M1", COLUMN_TRANSFORMER_SQL)
def q_column_transformer(spark, sf_dir):
    from quarry.operators.features import fit_column_transformer
    s = split_d3(spark, sf_dir)
    m = fit_column_transformer(s.filter("split = 'train'"))
    return rounded(m.transform(s))


@register("sparse_matrix", "M3 M4 (sparse)", RANK_D3_SQL + """
, f AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv FROM s WHERE split = 'train')
, kc AS (SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM s WHERE split = 'train'))
SELECT row_id, round((value - mv) / sv, 6) AS scaled, CAST(coalesce(code, -1) AS BIGINT) AS active,
  CAST(1 + (SELECT count(*) FROM kc) AS INTEGER) AS width FROM s LEFT JOIN kc USING (event_type), f""")
def q_sparse_matrix(spark, sf_dir):
    """The vector form: scaled number, and the place of the one in the category block."""
    from pyspark.ml.functions import vector_to_array
    from quarry.operators.features import fit_sparse_matrix
    s = split_d3(spark, sf_dir).select("row_id", "split", "value", "event_type")
    m = fit_sparse_matrix(s.filter("split = 'train'"))
    v = m.transform(s).select("row_id", vector_to_array("features").alias("v"))
    return rounded(v.select("row_id", F.col("v")[0].alias("scaled"),
                            (F.array_position(F.slice("v", 2, F.size("v") - 1), 1.0) - 1).cast("long").alias("active"),
                            F.size("v").alias("width")))


@register("label_encode", "M5", """
SELECT row_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS BIGINT) AS event_type FROM d3""")
def q_label_encode(spark, sf_dir):
    from quarry.operators.features import label_encode
    return label_encode(d3(spark, sf_dir).select("row_id", "event_type"), ["event_type"])


def _smote_sql() -> str:
    def draw(kind):
        return f"CAST('0x' || substr(md5(concat_ws('#', CAST(s AS VARCHAR), '1', '{C.SEED_TEXT}{kind}')), 1, 8) AS BIGINT)"
    feats = ("value", "hour_of_day", "user_bucket")
    dist = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in feats)
    return RANK_D3_SQL + f"""
, tr AS (SELECT * FROM s WHERE split = 'train')
, mi AS (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}#smote')), row_id) AS pos,
           count(*) OVER () AS nc FROM tr WHERE minority = 1)
, nn AS (SELECT a.row_id, b.row_id AS nb, row_number() OVER (PARTITION BY a.row_id ORDER BY {dist}, b.row_id) - 1 AS j
         FROM mi a JOIN mi b ON a.row_id <> b.row_id)
, sy AS (SELECT s, {draw('row')} % (SELECT max(nc) FROM mi) + 1 AS pos, {draw('nb')} % 5 AS j, {draw('')} / 4294967296.0 AS u
         FROM range(0, (SELECT CAST(count(*) FILTER (minority = 0) - count(*) FILTER (minority = 1) AS BIGINT) FROM tr)) r(s))
SELECT row_id, minority, false AS synthetic, """ + ", ".join(f"round({f}, 6) AS {f}" for f in feats) + """ FROM tr
UNION ALL SELECT -(sy.s + 1), 1, true, """ + ", ".join(f"round(a.{f} + u * (b.{f} - a.{f}), 6)" for f in feats) + """
FROM sy JOIN mi a ON a.pos = sy.pos JOIN nn ON nn.row_id = a.row_id AND nn.j = sy.j JOIN tr b ON b.row_id = nn.nb"""


@register("smote", "M8", _smote_sql())
def q_smote(spark, sf_dir):
    """Minority oversampling on the D3 training rows (class = minority)."""
    from quarry.operators.features import smote
    s = split_d3(spark, sf_dir).filter("split = 'train'")
    feats = ["value", "hour_of_day", "user_bucket"]
    out = smote(s, feats, label="minority", key="row_id", k=5)
    return rounded(out.select("row_id", "minority", "synthetic", *feats))


# --------------------------------------------------------------------------- MI / association
MI_FEATURES = ["event_type", "user_bucket", "hour_of_day", "value", "minority"]
_NUMS = ["user_bucket", "hour_of_day", "value", "minority", "label"]
BIN_D3_SQL = (", rg AS (SELECT " + ", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in _NUMS) + " FROM d3)\n"
              ", bn AS (SELECT row_id, event_type AS f_event_type, " + ", ".join(
                  f"CAST(least(10, CAST(floor(({c} - a_{c}) / (b_{c} - a_{c}) * 10) AS INTEGER) + 1) AS VARCHAR) AS f_{c}"
                  for c in _NUMS) + " FROM d3, rg)\n")


def _mi_sql(weighted: bool) -> str:
    w = "w" if weighted else "1e0"
    run = "run, " if weighted else ""
    long = " UNION ALL ".join(f"SELECT {run}'{c}' AS feature, f_{c} AS a, f_label AS b, {w} AS w FROM src" for c in MI_FEATURES)
    return (f", lg AS ({long})\n"
            f", cells AS (SELECT {run}feature, a, b, sum(w) AS n FROM lg GROUP BY ALL HAVING sum(w) > 0)\n"
            f", t AS (SELECT *, sum(n) OVER (PARTITION BY {run}feature, a) AS na, sum(n) OVER (PARTITION BY {run}feature, b) AS nb,"
            f" sum(n) OVER (PARTITION BY {run}feature) AS nn FROM cells)\n"
            f", mi AS (SELECT {run}feature, sum(n / nn * ln(n * nn / (na * nb))) AS mi FROM t GROUP BY ALL)\n")


@register("mutual_information_binned", "A13 T1", BIN_D3_SQL + ", src AS (SELECT * FROM bn)\n" + _mi_sql(False) + """
SELECT feature, round(mi, 6) AS mi FROM mi ORDER BY mi DESC, feature LIMIT 15""")
def q_mi_binned(spark, sf_dir):
    from quarry.operators.assoc import mutual_information
    return rounded(mutual_information(d3(spark, sf_dir), "label", MI_FEATURES, method="binned", k=C.N_TOP_MI))


def _mi_rep_sql() -> str:
    from quarry.operators.assoc import _poisson_weight_sql
    kb = f"CAST('0x' || substr(md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), 1, 8) AS BIGINT)"
    x = "((kb + run * 2654435761) % 4294967296)"
    for _ in range(2):
        x = f"((xor({x} >> 16, {x}) * 73244475) % 4294967296)"
    u = f"(xor({x} >> 16, {x}) / 4294967296.0)"
    return (BIN_D3_SQL + f", bk AS (SELECT *, {kb} AS kb FROM bn)\n"
            f", rp AS (SELECT bk.*, run, {u} AS u FROM bk, range(0, {C.N_MI_RUNS}) r(run))\n"
            f", src AS (SELECT *, CAST({_poisson_weight_sql('u')} AS DOUBLE) AS w FROM rp)\n" + _mi_sql(True) + """
SELECT feature, round(quantile_cont(mi, 0.5), 6) AS median_mi, round(quantile_cont(mi, 0.25), 6) AS q1_mi,
  round(quantile_cont(mi, 0.75), 6) AS q3_mi, round(min(mi), 6) AS min_mi, round(max(mi), 6) AS max_mi, count(*) AS runs
FROM mi GROUP BY feature ORDER BY median_mi DESC, feature LIMIT 10""")


@register("mi_repeated_binned", "A14 T1", _mi_rep_sql())
def q_mi_repeated(spark, sf_dir):
    from quarry.operators.assoc import mi_repeated_binned, mi_summary
    runs = mi_repeated_binned(d3(spark, sf_dir), "label", MI_FEATURES, "row_id", runs=C.N_MI_RUNS)
    return rounded(mi_summary(runs, C.N_TOP_MI_MEDIAN))


def _mi_knn_sql() -> str:
    """One draw of the k-NN estimate by joining every pair of rows."""
    from quarry.operators.mi_knn import NOISE

    def noise(stream: str) -> str:
        x = f"((kb + ({stream}) * {GOLDEN_32}) % {TWO_32_INT})"
        for _ in range(2):
            x = f"((xor({x} >> 16, {x}) * {MIX_MULT}) % {TWO_32_INT})"
        return f"((xor({x} >> 16, {x}) / 4294967296e0 - 5e-1) * sqrt(12e0))"

    kb = f"CAST('0x' || substr(md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), 1, 8) AS BIGINT)"
    long = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, row_id, kb, CAST({c} AS DOUBLE) AS x, label AS y FROM src" for i, c in enumerate(MI_FEATURES))
    away = ("greatest(abs((b.x - a.x) + a.ax * (b.ex - a.ex)), abs((b.y - a.y) + a.ay * (b.ey - a.ey)))")
    return f"""
, src AS (SELECT row_id, {kb} AS kb, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type, user_bucket, hour_of_day, value, minority, label FROM d3)
, long AS ({long})
, st AS (SELECT f, count(*) AS n, CASE WHEN min(x) = max(x) THEN 1e0 ELSE stddev_pop(x) END AS dx, CASE WHEN min(y) = max(y) THEN 1e0 ELSE stddev_pop(y) END AS dy,
           avg(abs(x)) AS mx, avg(abs(y)) AS my FROM long GROUP BY f)
, z AS (SELECT long.f, feature, row_id, n, x / dx AS x, y / dy AS y, {NOISE!r} * greatest(1e0, mx / dx) AS ax, {NOISE!r} * greatest(1e0, my / dy) AS ay,
          {noise("long.f + 1")} AS ex, {noise("0")} AS ey FROM long JOIN st ON st.f = long.f)
, r AS (SELECT a.f, a.row_id, min({away}, 3)[3] AS r FROM z a JOIN z b ON a.f = b.f AND a.row_id <> b.row_id GROUP BY a.f, a.row_id)
, c AS (SELECT a.f, a.row_id, count(*) FILTER (abs((b.x - a.x) + a.ax * (b.ex - a.ex)) < r.r) AS nx, count(*) FILTER (abs((b.y - a.y) + a.ay * (b.ey - a.ey)) < r.r) AS ny
        FROM z a JOIN r ON r.f = a.f AND r.row_id = a.row_id JOIN z b ON a.f = b.f GROUP BY a.f, a.row_id)
, h AS (SELECT m, sum(1e0 / m) OVER (ORDER BY m) - 1e0 / m AS psi FROM range(1, (SELECT max(n) + 1 FROM st)) t(m))
SELECT any_value(z.feature) AS feature, round(greatest(0, any_value(hn.psi) + 15e-1 - avg(hx.psi) - avg(hy.psi)), 6) AS mi
FROM c JOIN z ON z.f = c.f AND z.row_id = c.row_id JOIN h hx ON hx.m = c.nx JOIN h hy ON hy.m = c.ny JOIN h hn ON hn.m = z.n
GROUP BY c.f ORDER BY mi DESC, feature LIMIT {C.N_TOP_MI}"""


def _encoded_d3(spark, sf_dir):
    from quarry.operators.features import label_encode
    return label_encode(d3(spark, sf_dir), ["event_type"])


@register("mutual_information_knn_once", "A13 (k-NN) T1", _mi_knn_sql())
def q_mi_knn_once(spark, sf_dir):
    from quarry.operators.assoc import mutual_information
    return rounded(mutual_information(_encoded_d3(spark, sf_dir), "label", MI_FEATURES, method="knn", key="row_id", k=C.N_TOP_MI))


@register("mutual_information_knn", "A14 (k-NN) T1")
def q_mi_knn(spark, sf_dir):
    from quarry.operators.assoc import mi_summary
    from quarry.operators.mi_knn import mutual_information_knn
    runs = mutual_information_knn(_encoded_d3(spark, sf_dir), "label", MI_FEATURES, "row_id", runs=C.N_MI_RUNS)
    return rounded(mi_summary(runs, C.N_TOP_MI_MEDIAN))


ASSOC_COLS = ["event_type", "hour_band", "minority_s", "user_bucket", "hour_of_day", "value", "label"]


def assoc_input(spark, sf_dir):
    return d3(spark, sf_dir).select(
        "event_type", F.when(F.col("hour_of_day") < 12, "am").otherwise("pm").alias("hour_band"),
        F.col("minority").cast("string").alias("minority_s"), "user_bucket", "hour_of_day", "value", "label")


def _assoc_sql() -> str:
    nom = ["event_type", "hour_band", "minority_s"]
    num = ["user_bucket", "hour_of_day", "value", "label"]
    x = (", x AS (SELECT event_type, CASE WHEN hour_of_day < 12 THEN 'am' ELSE 'pm' END AS hour_band, "
         "CAST(minority AS VARCHAR) AS minority_s, user_bucket, hour_of_day, value, label FROM d3)\n")
    pn = [(a, b) for i, a in enumerate(num) for b in num[i + 1:]]
    pc = [(a, b) for i, a in enumerate(nom) for b in nom[i + 1:]]
    pm = [(a, b) for a in nom for b in num]
    pear = " UNION ALL ".join(f"SELECT '{a}' AS fa, '{b}' AS fb, corr({a}, {b}) AS assoc FROM x" for a, b in pn)
    cr = " UNION ALL ".join(f"SELECT '{a}' AS fa, '{b}' AS fb, {a} AS a, {b} AS b FROM x" for a, b in pc)
    mx = " UNION ALL ".join(f"SELECT '{a}' AS fa, '{b}' AS fb, {a} AS cat, {b} AS x FROM x" for a, b in pm)
    return x + f""", pear AS ({pear})
, nomp AS ({cr})
, cells AS (SELECT fa, fb, a, b, CAST(count(*) AS DOUBLE) AS n FROM nomp GROUP BY ALL)
, t AS (SELECT *, sum(n) OVER (PARTITION BY fa, fb, a) AS na, sum(n) OVER (PARTITION BY fa, fb, b) AS nb,
          sum(n) OVER (PARTITION BY fa, fb) AS nn FROM cells)
, g AS (SELECT fa, fb, max(nn) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k, sum(n * n / (na * nb)) AS s,
          max(abs(n * nn - na * nb)) AS adbc FROM t GROUP BY fa, fb)
, pr AS (SELECT fa, fb, product(na) AS pr FROM (SELECT DISTINCT fa, fb, a, na FROM t) GROUP BY fa, fb)
, pc AS (SELECT fa, fb, product(nb) AS pc FROM (SELECT DISTINCT fa, fb, b, nb FROM t) GROUP BY fa, fb)
, chi AS (SELECT g.*, CASE WHEN r = 2 AND k = 2 THEN n * power(greatest(adbc - n / 2, 0), 2) / (pr * pc)
                      ELSE n * (s - 1) END / n AS phi2 FROM g JOIN pr USING (fa, fb) JOIN pc USING (fa, fb))
, cv AS (SELECT fa, fb, CASE WHEN least(k - power(k - 1, 2) / (n - 1) - 1, r - power(r - 1, 2) / (n - 1) - 1) <= 0 THEN 0e0
           ELSE sqrt(greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1))
                     / least(k - power(k - 1, 2) / (n - 1) - 1, r - power(r - 1, 2) / (n - 1) - 1)) END AS assoc FROM chi)
, mix AS ({mx})
, bc AS (SELECT fa, fb, cat, count(*) AS nk, avg(x) AS mk FROM mix GROUP BY ALL)
, tot AS (SELECT fa, fb, avg(x) AS mu, count(*) AS n, var_pop(x) AS vp FROM mix GROUP BY ALL)
, eta AS (SELECT fa, fb, CASE WHEN sum(nk * power(mk - mu, 2)) = 0 THEN 0e0
            ELSE sqrt(sum(nk * power(mk - mu, 2)) / max(n * vp)) END AS assoc
          FROM bc JOIN tot USING (fa, fb) GROUP BY fa, fb)
, au AS (SELECT fa, fb, coalesce(CASE WHEN isnan(assoc) THEN NULL ELSE assoc END, 0e0) AS assoc, 'pearson' AS kind FROM pear
         UNION ALL SELECT fa, fb, assoc, 'cramer' FROM cv UNION ALL SELECT fa, fb, assoc, 'correlation_ratio' FROM eta)
, am AS (SELECT fa, fb, assoc, kind FROM au UNION ALL SELECT fb, fa, assoc, kind FROM au UNION ALL
         SELECT c, c, 1e0, 'self' FROM (VALUES {', '.join(f"('{c}')" for c in ASSOC_COLS)}) v(c))
"""


ASSOC_SQL = _assoc_sql()


@register("association_matrix", "A15", ASSOC_SQL + """
SELECT fa AS feature_a, fb AS feature_b, round(assoc, 6) AS assoc, kind FROM am""")
def q_association_matrix(spark, sf_dir):
    from quarry.operators.assoc import association_matrix
    return rounded(association_matrix(assoc_input(spark, sf_dir), ASSOC_COLS))


@register("association_distance", "A16", ASSOC_SQL + """
SELECT fa AS feature_a, fb AS feature_b, round(CASE WHEN fa = fb THEN 0e0 ELSE 1 - abs(assoc) END, 6) AS distance FROM am""")
def q_association_distance(spark, sf_dir):
    from quarry.operators.assoc import association_distance, association_matrix
    return rounded(association_distance(association_matrix(assoc_input(spark, sf_dir), ASSOC_COLS)))


CLUSTER_THRESHOLD = 0.5


@register("cluster_one_round_representatives", "M9 (one round) A17", ASSOC_SQL + f"""
, pos AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(ASSOC_COLS))}) v(feature, pos))
, dd AS (SELECT pa.pos AS ca, pb.pos AS cb, 1 - abs(assoc) AS d FROM am JOIN pos pa ON am.fa = pa.feature
         JOIN pos pb ON am.fb = pb.feature WHERE fa <> fb)
, nn AS (SELECT ca, cb AS nb, d FROM (SELECT *, row_number() OVER (PARTITION BY ca ORDER BY d, cb) AS r FROM dd) WHERE r = 1)
, mp AS (SELECT a.ca, a.nb AS cb FROM nn a JOIN nn b ON a.ca = b.nb AND a.nb = b.ca WHERE a.ca < a.nb AND a.d <= {CLUSTER_THRESHOLD})
, cl AS (SELECT feature, pos, coalesce((SELECT min(mp.ca) FROM mp WHERE mp.cb = pos.pos), pos) AS cluster FROM pos)
, sc AS (SELECT ca.cluster, am.fa AS feature, sum(abs(assoc)) AS score FROM am JOIN cl ca ON am.fa = ca.feature
         JOIN cl cb ON am.fb = cb.feature WHERE ca.cluster = cb.cluster GROUP BY ca.cluster, am.fa)
, rp AS (SELECT feature, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, pos) AS r FROM sc JOIN pos USING (feature))
SELECT DISTINCT feature FROM rp WHERE r = 1""")
def q_cluster_one_round(spark, sf_dir):
    from quarry.operators.assoc import association_matrix, cluster_representatives, cluster_round
    from quarry.session import cut_lineage
    assoc = cut_lineage(association_matrix(assoc_input(spark, sf_dir), ASSOC_COLS))
    from quarry.operators.assoc import _position_table, association_distance
    dist = association_distance(assoc).filter(F.col("feature_a") != F.col("feature_b"))
    clusters = _position_table(spark, ASSOC_COLS).select("feature", F.col("pos").alias("cluster"))
    pairs = cluster_round(dist, clusters, CLUSTER_THRESHOLD)
    m = pairs.select(F.col("cb").alias("old"), F.col("ca").alias("new"))
    clusters = clusters.join(F.broadcast(m), clusters.cluster == m.old, "left") \
        .select("feature", F.coalesce("new", "cluster").alias("cluster"))
    return cluster_representatives(assoc, clusters, ASSOC_COLS)


def _merge_sql(dist: str, d: int, threshold: float) -> str:
    """Clusters of d positions by merging the least pair of clusters again and again."""
    return f""", merged AS (
  WITH RECURSIVE r(step, cl) AS (
    SELECT 0, CAST(range(0, {d}) AS BIGINT[])
    UNION ALL
    SELECT r.step + 1, list_transform(r.cl, lambda c: CASE WHEN c = m.cb THEN m.ca ELSE c END)
    FROM r, LATERAL (
      SELECT least(r.cl[i + 1], r.cl[j + 1]) AS ca, greatest(r.cl[i + 1], r.cl[j + 1]) AS cb, round(avg(distance), 12) AS dd
      FROM {dist} WHERE r.cl[i + 1] <> r.cl[j + 1] GROUP BY ALL ORDER BY dd, ca, cb LIMIT 1) m
    WHERE m.dd <= {threshold!r})
  SELECT cl FROM r ORDER BY step DESC LIMIT 1)
"""


@register("feature_clusters", "M9 A17", ASSOC_SQL + f""", pos AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i})" for i, c in enumerate(ASSOC_COLS))}) v(feature, p))
, ds AS (SELECT a.p AS i, b.p AS j, 1 - abs(assoc) AS distance FROM am JOIN pos a ON a.feature = fa JOIN pos b ON b.feature = fb WHERE fa <> fb)
""" + _merge_sql("ds", len(ASSOC_COLS), CLUSTER_THRESHOLD) + """
SELECT feature, CAST(cl[p + 1] AS INT) AS cluster FROM pos, merged""")
def q_feature_clusters(spark, sf_dir):
    from quarry.operators.assoc import association_matrix, cluster_features
    from quarry.session import cut_lineage
    assoc = cut_lineage(association_matrix(assoc_input(spark, sf_dir), ASSOC_COLS))
    return cluster_features(assoc, ASSOC_COLS, CLUSTER_THRESHOLD)


# --------------------------------------------------------------------------- models
TRAIN_STATS_SQL = RANK_D3_SQL + """
, tr AS (SELECT * FROM s WHERE split = 'train')
, st AS (SELECT count(*) AS n, avg(value) AS mx, avg(label) AS my, var_pop(value) * count(*) AS sxx,
           covar_pop(value, label) * count(*) AS sxy, stddev_pop(label) AS sdp, stddev_samp(label) AS sds FROM tr)
"""


def _one_feature_sql(w_expr: str) -> str:
    return TRAIN_STATS_SQL + f"""
, co AS (SELECT {w_expr} AS coef, mx, my FROM st)
, co2 AS (SELECT coef, my - coef * mx AS intercept FROM co)
, pr AS (SELECT label, intercept + coef * value AS p FROM s, co2 WHERE split = 'test')
, me AS (SELECT 1 - sum((label - p) * (label - p)) / (var_pop(label) * count(*)) AS r2,
           avg((label - p) * (label - p)) AS mse, avg(abs(label - p)) AS mae FROM pr)
SELECT round(coef, 6) AS coef, round(intercept, 6) AS intercept, round(r2, 6) AS r2, round(mse, 6) AS mse,
  round(mae, 6) AS mae FROM co2, me"""


def _fit_one_feature(spark, sf_dir, estimator):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from quarry.operators.models import regression_metrics
    s = cut_lineage(split_d3(spark, sf_dir).select("row_id", "split", "value", "label"))  # fit, score and metrics reuse it
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["value"], outputCol="features"), estimator])
    model = pipe.fit(s.filter("split = 'train'"))
    lm = model.stages[-1]
    pred = model.transform(s.filter("split = 'test'"))
    m = regression_metrics(pred)
    return rounded(m.select(F.lit(float(lm.coefficients[0])).alias("coef"), F.lit(float(lm.intercept)).alias("intercept"),
                            "r2", "mse", "mae"))


@register("linear_regression", "M14 M13 A18", _one_feature_sql("sxy / sxx"))
def q_linear_regression(spark, sf_dir):
    from pyspark.ml.regression import LinearRegression
    return _fit_one_feature(spark, sf_dir, LinearRegression(regParam=0.0, solver="normal", standardization=False))


@register("ridge_regression", "M15 M13 A18", _one_feature_sql("sxy / (sxx + 10.0)"))
def q_ridge(spark, sf_dir):
    from quarry.operators.models import Penalized
    return _fit_one_feature(spark, sf_dir, Penalized(kind="ridge", alpha=10.0))


@register("lasso_regression", "M16 M13 A18",
          _one_feature_sql("sign(sxy) * greatest(abs(sxy / n) - 10.0, 0) / (sxx / n)"))
def q_lasso(spark, sf_dir):
    from quarry.operators.models import Penalized
    return _fit_one_feature(spark, sf_dir, Penalized(kind="lasso", alpha=10.0))


@register("elasticnet_regression", "M17 M13 A18",
          _one_feature_sql("sign(sxy) * greatest(abs(sxy / n) - 1.0 * 0.5, 0) / (sxx / n + 1.0 * 0.5)"))
def q_elasticnet(spark, sf_dir):
    from quarry.operators.models import Penalized
    return _fit_one_feature(spark, sf_dir, Penalized(kind="elastic", alpha=1.0, l1_ratio=0.5))


def d3_matrix(spark, sf_dir):
    """D3 → split → column transformer fitted on train → folds on train."""
    from quarry.operators.features import fit_column_transformer, kfold
    s = split_d3(spark, sf_dir)
    m = fit_column_transformer(s.filter("split = 'train'").drop("minority"))
    x = m.transform(s)
    train = kfold(x.filter("split = 'train'"), "row_id", C.N_SPLITS_CV, C.SEED_TEXT)
    return train, x.filter("split = 'test'"), m.output_names, m


def _bench(spark, sf_dir, models):
    from quarry.operators.models import benchmark
    train, test, feats, _ = d3_matrix(spark, sf_dir)
    res, _ = benchmark(train, test, feats, models=models)
    return rounded(res)


@register("benchmark_linear", "M12 M11 M14 M15 M16 M17 M10 C14")
def q_bench_linear(spark, sf_dir):
    return _bench(spark, sf_dir, ["Linear Regression", "Ridge", "Lasso", "ElasticNet"])


@register("svr_fits", "M18 M13 A18")
def q_svr_fits(spark, sf_dir):
    """SVR re-aimed (huber; rbf via random Fourier features), the whole grid over five folds."""
    return _bench(spark, sf_dir, ["SVR"])


@register("benchmark_trees", "M12 M11 M19 M20")
def q_bench_trees(spark, sf_dir):
    return _bench(spark, sf_dir, ["Decision Tree", "Random Forest"])


@register("boosting_fits", "M21 M13 A18")
def q_boosting_fits(spark, sf_dir):
    """Boosted trees, the whole grid over five folds."""
    return _bench(spark, sf_dir, ["Gradient Boosting"])


# --------------------------------------------------------------------------- explanation
@register("linear_shap", "M26 A19", RANK_D3_SQL + """
, tr AS (SELECT * FROM s WHERE split = 'train')
, st AS (SELECT avg(value) AS m1, avg(hour_of_day) AS m2, var_pop(value) AS s11, var_pop(hour_of_day) AS s22,
           covar_pop(value, hour_of_day) AS s12, covar_pop(value, label) AS s1y, covar_pop(hour_of_day, label) AS s2y FROM tr)
, co AS (SELECT m1, m2, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
           (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM st)
, sh AS (SELECT 'value' AS feature, b1 * (value - m1) AS shap FROM s, co WHERE split = 'test' UNION ALL
         SELECT 'hour_of_day', b2 * (hour_of_day - m2) FROM s, co WHERE split = 'test')
SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap FROM sh GROUP BY feature""")
def q_linear_shap(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from quarry.operators.explain import linear_shap, mean_abs_shap
    s = split_d3(spark, sf_dir)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    feats = ["value", "hour_of_day"]
    lm = LinearRegression(regParam=0.0, solver="normal", standardization=False).fit(
        VectorAssembler(inputCols=feats, outputCol="features").transform(train))
    coefs = dict(zip(feats, [float(c) for c in lm.coefficients]))
    return rounded(mean_abs_shap(linear_shap(coefs, test, background=train), C.N_TOP_SHAP))


@register("tree_shap", "M25 A19 C10 M28")
def q_tree_shap(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    from quarry.operators.explain import shap_summary, tree_shap
    train, test, feats, m = d3_matrix(spark, sf_dir)
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             RandomForestRegressor(numTrees=20, maxDepth=5, seed=C.RANDOM_STATE,
                                                   featureSubsetStrategy="all")]).fit(train)
    shap, _ = tree_shap(model, test, feats)
    return rounded(shap_summary(shap, m.categorical_columns, C.N_TOP_SHAP))


@register("tree_shap_additivity", "M25 (additivity)", RANK_D3_SQL + "SELECT row_id, 0e0 AS gap FROM s WHERE split = 'test'")
def q_tree_shap_additivity(spark, sf_dir):
    """Base value plus a row's SHAP values, less the forest's prediction."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    from quarry.operators.explain import tree_shap
    train, test, feats, _ = d3_matrix(spark, sf_dir)
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             RandomForestRegressor(numTrees=5, maxDepth=4, seed=C.RANDOM_STATE, featureSubsetStrategy="all")]).fit(train)
    shap, base = tree_shap(model, test, feats)
    total = shap.groupBy("row_id").agg(F.sum("shap").alias("total"))
    gap = F.round(F.abs(F.col("total") + F.lit(base) - F.col("prediction")), 6)
    return model.transform(test).join(total, "row_id").select("row_id", gap.alias("gap"))


@register("feature_relationship", "M27 A20 A10", CLEAN_D1_SQL + """
, q AS (SELECT foundation_type_u, count(*) AS n, quantile_cont(Difference, 0.25) AS q1,
          quantile_cont(Difference, 0.5) AS median, quantile_cont(Difference, 0.75) AS q3 FROM c GROUP BY 1)
SELECT 'building_area_m2' AS feature, 'numeric' AS kind, CAST(NULL AS VARCHAR) AS category, CAST(regr_count(Difference, building_area_m2) AS BIGINT) AS n,
  round(regr_slope(Difference, building_area_m2), 6) AS slope, round(regr_intercept(Difference, building_area_m2), 6) AS intercept,
  round(regr_r2(Difference, building_area_m2), 6) AS r2, CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median,
  CAST(NULL AS DOUBLE) AS q3, CAST(NULL AS DOUBLE) AS lower_whisker, CAST(NULL AS DOUBLE) AS upper_whisker FROM c
UNION ALL
SELECT 'foundation_type_u', 'categorical', q.foundation_type_u, q.n, NULL, NULL, NULL, round(q1, 6), round(median, 6),
  round(q3, 6),
  round(min(CASE WHEN Difference >= q1 - 1.5e0 * (q3 - q1) AND Difference <= q3 + 1.5e0 * (q3 - q1) THEN Difference END), 6),
  round(max(CASE WHEN Difference >= q1 - 1.5e0 * (q3 - q1) AND Difference <= q3 + 1.5e0 * (q3 - q1) THEN Difference END), 6)
FROM c JOIN q USING (foundation_type_u) GROUP BY q.foundation_type_u, q.n, q1, median, q3""")
def q_feature_relationship(spark, sf_dir):
    from quarry.operators.frames import feature_relationship
    return rounded(feature_relationship(clean_d1(spark, sf_dir), C.TARGET_COLUMN,
                                        ["building_area_m2", "foundation_type_u", "not_a_column"]))


@register("actual_vs_predicted", "A22 M13 M14", TRAIN_STATS_SQL + """
, co AS (SELECT sxy / sxx AS coef, my - sxy / sxx * mx AS intercept FROM st)
SELECT 'Linear Regression_Original Features' AS combo_key, round(label, 6) AS actual,
  round(intercept + coef * value, 6) AS predicted, round(label - (intercept + coef * value), 6) AS residual
FROM s, co WHERE split = 'test'""")
def q_actual_vs_predicted(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from quarry.operators.stats import actual_vs_predicted
    s = split_d3(spark, sf_dir)
    model = Pipeline(stages=[VectorAssembler(inputCols=["value"], outputCol="features"),
                             LinearRegression(regParam=0.0, solver="normal", standardization=False)]) \
        .fit(s.filter("split = 'train'"))
    pred = model.transform(s.filter("split = 'test'"))
    return rounded(actual_vs_predicted({"Linear Regression_Original Features": pred}))


# --------------------------------------------------------------------------- selection (M6, M7) and pipeline
def d1_matrix(spark, sf_dir):
    """Cleaned D1 → target/leakage filter → split → column transformer (no elimination)."""
    from dataclasses import replace
    from quarry.config import PipelineConfig
    from quarry.plans.pipeline import preprocess
    x, feats, ct = preprocess(clean_d1(spark, sf_dir), replace(PipelineConfig(), perform_rfe=False))
    return x, feats, ct


@register("rfe", "M6")
def q_rfe(spark, sf_dir):
    """RFE with a forest classifier on the truncated target of D1's matrix.
    The fixture has fewer than 36 features, so 8 are kept (step 10%)."""
    from quarry.operators.selection import rfe
    x, feats, _ = d1_matrix(spark, sf_dir)
    return rfe(x.filter("split = 'train'"), feats, "label", n_select=8, step=C.RFE_STEP, num_trees=100)


@register("rfecv", "M7 M10")
def q_rfecv(spark, sf_dir):
    """RFECV curve (min 10 features, 5 folds, step 1) on D1's matrix."""
    from quarry.operators.features import kfold
    from quarry.operators.selection import rfecv
    x, feats, _ = d1_matrix(spark, sf_dir)
    train = kfold(x.filter("split = 'train'"), "row_id", C.RFECV_FOLDS, C.SEED_TEXT)
    curve, best, _ = rfecv(cut_lineage(train), feats, "label")
    return rounded(curve.withColumn("best", F.col("n_features") == F.lit(best)))


@register("run_pipeline", "M30 M31 M12 M25/M26 M27 A19 C10 T2 T3 S4 S5 S7")
def q_run_pipeline(spark, sf_dir):
    """The whole pipeline on D1 with all models."""
    from quarry.plans.pipeline import run_pipeline
    res = run_pipeline(spark, d1(spark, sf_dir))
    return rounded(res["results"])


@register("model_sweep_kfold", "M29")
def q_model_sweep(spark, sf_dir):
    """RMSE sweep with folds stratified by the integer target (D1 matrix)."""
    from quarry.plans.pipeline import model_sweep_kfold
    x, feats, _ = d1_matrix(spark, sf_dir)
    res, _ = model_sweep_kfold(x.filter("split = 'train'"), x.filter("split = 'test'"), feats)
    return rounded(res)


@register("original_feature", "C10 M4", CLEAN_D1_SQL + """
, n AS (SELECT 'num__wall_thickness' AS name UNION ALL SELECT 'num__building_area_m2' UNION ALL
        SELECT 'num__random_feature' UNION ALL SELECT 'remainder__is_even' UNION ALL
        SELECT DISTINCT 'cat__foundation_type_u_' || foundation_type_u FROM c UNION ALL
        SELECT DISTINCT 'cat__roof_shape_u_' || roof_shape_u FROM c)
, k AS (SELECT 'foundation_type_u' AS col UNION ALL SELECT 'roof_shape_u')
, lk AS (SELECT name, col, row_number() OVER (PARTITION BY name ORDER BY length(col) DESC) AS r
        FROM n LEFT JOIN k ON starts_with(substr(name, 6), col || '_') AND starts_with(name, 'cat__'))
SELECT name, coalesce(col, substr(name, instr(name, '__') + 2)) AS original_feature FROM lk WHERE r = 1""")
def q_original_feature(spark, sf_dir):
    """Generated matrix names of cleaned D1 rolled up to their source columns."""
    from quarry.functions.columns import original_feature
    from quarry.operators.features import fit_column_transformer
    from quarry.plans.clean import prepare_target
    ct = fit_column_transformer(prepare_target(clean_d1(spark, sf_dir)), exclude=("row_id", "label"))
    cats = spark.createDataFrame([(c,) for c in ct.categorical_columns], "column string")
    return original_feature(ct.name_table(spark).select("name"), cats)


@register("smote_neighbours", "M8 (neighbour step) M1", RANK_D3_SQL + """
, mi AS (SELECT row_id, value, hour_of_day, user_bucket FROM s WHERE split = 'train' AND minority = 1)
, pr AS (SELECT a.row_id, b.row_id AS nb,
           power(a.value - b.value, 2) + power(a.hour_of_day - b.hour_of_day, 2)
           + power(a.user_bucket - b.user_bucket, 2) AS d2
         FROM mi a JOIN mi b ON a.row_id <> b.row_id)
, rk AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, nb) - 1 AS j FROM pr)
SELECT row_id, CAST(j AS INTEGER) AS j, nb, round(d2, 6) AS d2 FROM rk WHERE j < 5""")
def q_smote_neighbours(spark, sf_dir):
    """Exact 5 nearest same-class neighbours of the minority training rows."""
    from quarry.operators.knn import knn_within_class
    s = split_d3(spark, sf_dir).filter("split = 'train' AND minority = 1")
    return rounded(knn_within_class(s, ["value", "hour_of_day", "user_bucket"], "minority", "row_id", k=5))


@register("shap_beeswarm", "M28 M26", RANK_D3_SQL + """
, tr AS (SELECT * FROM s WHERE split = 'train')
, st AS (SELECT avg(value) AS m1, avg(hour_of_day) AS m2, var_pop(value) AS s11, var_pop(hour_of_day) AS s22,
           covar_pop(value, hour_of_day) AS s12, covar_pop(value, label) AS s1y, covar_pop(hour_of_day, label) AS s2y FROM tr)
, co AS (SELECT m1, m2, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
           (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM st)
SELECT row_id, 'value' AS feature, round(b1 * (value - m1), 6) AS shap, round(value, 6) AS value FROM s, co WHERE split = 'test'
UNION ALL
SELECT row_id, 'hour_of_day', round(b2 * (hour_of_day - m2), 6), round(hour_of_day, 6) FROM s, co WHERE split = 'test'""")
def q_shap_beeswarm(spark, sf_dir):
    """(row, feature, SHAP, feature value) rows behind the beeswarm, linear model on two features."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from quarry.operators.explain import linear_shap
    from quarry.operators.frames import shap_beeswarm_frame
    s = cut_lineage(split_d3(spark, sf_dir).select("row_id", "split", "value", "hour_of_day", "label"))
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    feats = ["value", "hour_of_day"]
    lm = LinearRegression(regParam=0.0, solver="normal", standardization=False).fit(
        VectorAssembler(inputCols=feats, outputCol="features").transform(train))
    shap = linear_shap(dict(zip(feats, [float(c) for c in lm.coefficients])), test, background=train, with_value=True)
    return rounded(shap_beeswarm_frame(shap, test.select("row_id", *feats)))


# --------------------------------------------------------------------------- traps
CLEAN_D4_SQL = (", n4 AS (SELECT row_id, CASE WHEN isnan(x) THEN NULL ELSE x END AS x, CASE WHEN isnan(y) THEN NULL ELSE y END AS y, "
                "far, big, code, town FROM d4)\n")


@register("trap_impute_mean", "A2 (NaN)", CLEAN_D4_SQL + """
SELECT row_id, round(coalesce(x, (SELECT avg(x) FROM n4)), 6) AS x, round(coalesce(y, (SELECT avg(y) FROM n4)), 6) AS y FROM n4""")
def q_trap_impute_mean(spark, sf_dir):
    from quarry.operators.stats import impute_mean
    return rounded(impute_mean(d4(spark, sf_dir).select("row_id", "x", "y"), ["x", "y"]))


@register("trap_describe_target", "A4 C12 (NaN)", CLEAN_D4_SQL + """
, m AS (SELECT count(x) AS n, avg(x) AS mean, quantile_cont(x, 0.5) AS median, stddev_samp(x) AS std, skewness(x) AS skew FROM n4)
SELECT n, round(mean, 6) AS mean, round(median, 6) AS median, round(std, 6) AS std, round(skew, 6) AS skew,
  CASE WHEN mean > 0.1 THEN 'underestimate' WHEN mean < -0.1 THEN 'overestimate' ELSE 'unbiased' END AS mean_verdict,
  CASE WHEN skew > 0.5 THEN 'positive' WHEN skew < -0.5 THEN 'negative' ELSE 'none' END AS skew_verdict FROM m""")
def q_trap_describe(spark, sf_dir):
    from quarry.operators.stats import describe_target
    return rounded(describe_target(d4(spark, sf_dir), "x"))


@register("trap_feature_target_corr", "A11 (NaN, offset)", CLEAN_D4_SQL + """
, c AS (SELECT 'far' AS feature, corr(far, x) AS corr FROM n4 WHERE x IS NOT NULL
        UNION ALL SELECT 'y', corr(y, x) FROM n4 WHERE x IS NOT NULL AND y IS NOT NULL)
SELECT feature, round(corr, 5) AS corr, round(abs(corr), 5) AS abs_corr FROM c""")
def q_trap_corr(spark, sf_dir):
    from quarry.operators.stats import feature_target_corr
    return rounded(feature_target_corr(d4(spark, sf_dir).select("x", "y", "far"), "x", k=None), 5)


@register("trap_histogram_range", "A7 A8 (NaN)", CLEAN_D4_SQL + """
, r AS (SELECT min(x) AS a, max(x) AS b FROM n4)
, h AS (SELECT least(10, CAST(floor((x - a) / (b - a) * 10) AS INTEGER) + 1) AS bin FROM n4, r WHERE x IS NOT NULL)
SELECT CAST(i AS INTEGER) AS bin, round(a, 6) AS range_min, round(b, 6) AS range_max,
  CAST(coalesce((SELECT count(*) FROM h WHERE h.bin = i), 0) AS BIGINT) AS n FROM range(1, 11) t(i), r""")
def q_trap_histogram(spark, sf_dir):
    from quarry.operators.stats import histogram, min_max
    df = d4(spark, sf_dir)
    ends = min_max(df, "x").select(F.col("min").alias("range_min"), F.col("max").alias("range_max"))  # one row
    return rounded(histogram(df, "x").select("bin", "n").join(ends, F.lit(True)))


@register("trap_numeric_text", "C2 S3 (number texts)", """
SELECT row_id, CASE WHEN trim(code) IN ('7.5', '1e3') THEN CAST(trim(code) AS DOUBLE) END AS value FROM d4""")
def q_trap_numeric_text(spark, sf_dir):
    from quarry.functions.columns import to_numeric
    return d4(spark, sf_dir).select("row_id", to_numeric("code").alias("value"))


@register("trap_as_category", "C7 (large doubles, NaN)", CLEAN_D4_SQL + """
SELECT row_id, CAST(big AS VARCHAR) AS big, CASE WHEN y IS NULL THEN 'nan' ELSE CAST(y AS VARCHAR) END AS y FROM n4""")
def q_trap_as_category(spark, sf_dir):
    from quarry.functions.columns import as_category
    return d4(spark, sf_dir).select("row_id", as_category("big").alias("big"), as_category("y").alias("y"))


@register("trap_top_and_best", "T1 T3 (NaN)", CLEAN_D4_SQL + """
SELECT row_id, round(x, 6) AS x FROM n4 ORDER BY x DESC NULLS LAST, row_id LIMIT 15""")
def q_trap_top(spark, sf_dir):
    from quarry.operators.rank import top_k
    return rounded(top_k(d4(spark, sf_dir).select("row_id", "x"), "x", 15, tiebreak=("row_id",)))


@register("trap_wide_association", "A15 (nulls, offset, width)", ", w4 AS (" + D4_WIDE_SQL.format(d4="d4") + ")\n, p AS ("
          + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM w4 WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
                               for i, a in enumerate(D4_WIDE) for b in D4_WIDE[i + 1:]) + """)
SELECT feature_a, feature_b, round(coalesce(r, 0), 5) AS assoc FROM p UNION ALL SELECT feature_b, feature_a, round(coalesce(r, 0), 5) FROM p""")
def q_trap_wide(spark, sf_dir):
    from quarry.operators.assoc import association_matrix
    out = association_matrix(d4_wide(spark, sf_dir).drop("row_id")).filter("feature_a != feature_b")
    return rounded(out.select("feature_a", "feature_b", (F.col("assoc") + F.lit(0.0)).alias("assoc")), 5)


@register("trap_wide_nominal", "A15 (200 text columns, nulls)", ", tx AS (" + D4_TEXTS_SQL.format(orders="orders") + ")\n, l AS ("
          + " UNION ALL ".join(f"SELECT row_id, {i} AS i, {c} AS v FROM tx WHERE {c} IS NOT NULL" for i, c in enumerate(D4_TEXTS)) + """)
, cells AS (SELECT a.i AS i, b.i AS j, a.v AS a, b.v AS b, CAST(count(*) AS DOUBLE) AS n FROM l a JOIN l b ON a.row_id = b.row_id AND a.i < b.i GROUP BY ALL)
, t AS (SELECT *, sum(n) OVER (PARTITION BY i, j, a) AS na, sum(n) OVER (PARTITION BY i, j, b) AS nb, sum(n) OVER (PARTITION BY i, j) AS nn FROM cells)
, g AS (SELECT i, j, max(nn) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k, sum(n * n / (na * nb)) - 1 AS phi2, max(abs(n * nn - na * nb)) AS adbc,
          max(CASE WHEN n * nn <> 0 THEN na * nb END) AS x FROM t GROUP BY i, j)
, pr AS (SELECT i, j, product(na) AS pr FROM (SELECT DISTINCT i, j, a, na FROM t) GROUP BY i, j)
, pc AS (SELECT i, j, product(nb) AS pc FROM (SELECT DISTINCT i, j, b, nb FROM t) GROUP BY i, j)
, c AS (SELECT g.i, g.j, g.n, r, k, CASE WHEN r = 2 AND k = 2 THEN power(greatest(adbc - g.n / 2, 0), 2) / (pr * pc) ELSE phi2 END AS phi2
        FROM g JOIN pr USING (i, j) JOIN pc USING (i, j))
, v AS (SELECT i, j, CASE WHEN least(k - power(k - 1, 2) / (n - 1) - 1, r - power(r - 1, 2) / (n - 1) - 1) <= 0 THEN 0e0
          ELSE sqrt(greatest(0, phi2 - (k - 1) * (r - 1) / (n - 1)) / least(k - power(k - 1, 2) / (n - 1) - 1, r - power(r - 1, 2) / (n - 1) - 1)) END AS assoc FROM c)
, p AS (SELECT x.i, y.i AS j, coalesce(v.assoc, 0) AS assoc FROM range(0, 200) x(i) JOIN range(0, 200) y(i) ON x.i < y.i LEFT JOIN v ON v.i = x.i AND v.j = y.i)
SELECT concat('t', i) AS feature_a, concat('t', j) AS feature_b, round(assoc, 5) AS assoc FROM p
UNION ALL SELECT concat('t', j), concat('t', i), round(assoc, 5) FROM p""")
def q_trap_wide_nominal(spark, sf_dir):
    from quarry.operators.assoc import association_matrix
    out = association_matrix(d4_texts(spark, sf_dir).drop("row_id")).filter("feature_a != feature_b")
    return rounded(out.select("feature_a", "feature_b", (F.col("assoc") + F.lit(0.0)).alias("assoc")), 5)


@register("trap_mixed_association", "A15 A16 (NaN in a mixed pair, integers)", CLEAN_D4_SQL + """
, m AS (SELECT town, code, x, y, CAST(o_custkey % 7 AS DOUBLE) AS g FROM n4 JOIN orders ON o_orderkey = row_id)
, l AS (""" + " UNION ALL ".join(f"SELECT '{a}' AS fa, '{b}' AS fb, {a} AS c, {b} AS v FROM m WHERE {b} IS NOT NULL" for a in ("town", "code") for b in ("x", "y", "g")) + """)
, k AS (SELECT fa, fb, c, count(*) AS n, avg(v) AS mean FROM l GROUP BY ALL)
, t AS (SELECT fa, fb, avg(v) AS mean, var_pop(v) * count(*) AS total FROM l GROUP BY ALL)
SELECT k.fa AS feature_a, k.fb AS feature_b, round(sqrt(sum(n * (k.mean - t.mean) * (k.mean - t.mean)) / any_value(total)), 6) AS assoc,
  round(1 - sqrt(sum(n * (k.mean - t.mean) * (k.mean - t.mean)) / any_value(total)), 6) AS distance
FROM k JOIN t ON k.fa = t.fa AND k.fb = t.fb GROUP BY k.fa, k.fb""")
def q_trap_mixed(spark, sf_dir):
    from quarry.operators.assoc import association_distance, association_matrix
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("row_id"), (F.col("o_custkey") % 7).alias("g"))
    a = cut_lineage(association_matrix(d4(spark, sf_dir).join(orders, "row_id").select("town", "code", "x", "y", "g")))
    a = a.filter(F.col("feature_a").isin("town", "code") & F.col("feature_b").isin("x", "y", "g"))
    return rounded(a.select("feature_a", "feature_b", "assoc").join(association_distance(a), ["feature_a", "feature_b"]))


#: Distances between twelve columns that take five values, most of them many times; the number of orders shifts them.
_TIED_SQL = """, m AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS e FROM orders)
, ds AS (SELECT a.i AS i, b.i AS j, ((least(a.i, b.i) * 7 + greatest(a.i, b.i) * 3 + n + e) % 5) / 5e0 AS distance
         FROM range(0, 12) a(i) JOIN range(0, 12) b(i) ON a.i <> b.i, m)
"""


@register("trap_tied_clusters", "M9 (ties)", _TIED_SQL + _merge_sql("ds", 12, 0.5) + """
SELECT concat('c', i) AS feature, CAST(cl[i + 1] AS INT) AS cluster FROM range(0, 12) t(i), merged""")
def q_trap_clusters(spark, sf_dir):
    from quarry.operators.assoc import cluster_features
    n, e = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count("*"), F.count(F.when(F.col("o_orderkey") % 2 == 0, 1))).first()
    ids = spark.range(12).select(F.col("id").alias("i"))
    i, j = F.least("i", "j"), F.greatest("i", "j")
    pairs = ids.join(ids.select(F.col("i").alias("j")), F.col("i") != F.col("j"))
    assoc = pairs.select(F.concat(F.lit("c"), "i").alias("feature_a"), F.concat(F.lit("c"), "j").alias("feature_b"),
                         (1 - ((i * 7 + j * 3 + F.lit(n + e)) % 5) / F.lit(5.0)).alias("assoc"))
    return cluster_features(assoc, [f"c{k}" for k in range(12)], 0.5)


@register("trap_scale_missing", "M2 (NaN)", CLEAN_D4_SQL + """
SELECT row_id, round((x - (SELECT avg(x) FROM n4)) / (SELECT stddev_pop(x) FROM n4), 6) AS x, round((y - (SELECT avg(y) FROM n4)) / (SELECT stddev_pop(y) FROM n4), 6) AS y FROM n4""")
def q_trap_scale(spark, sf_dir):
    from quarry.operators.features import standard_scale
    return rounded(standard_scale(d4(spark, sf_dir).select("row_id", "x", "y"), ["x", "y"]))


_WHOLE_SQL = "SELECT o_orderkey AS row_id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 50 END AS INT) AS `a.b`, CAST(o_custkey % 2 AS INT) AS two FROM {orders}"


@register("trap_fill_whole_numbers", "A1 A2 A3 (integer columns, names with dots)", f"""
, w AS ({_WHOLE_SQL.format(orders="orders").replace("`a.b`", "ab")}), s AS (SELECT avg(ab) AS m, quantile_cont(ab, 0.5) AS q, count(DISTINCT ab) AS d FROM w)
SELECT row_id, round(coalesce(ab, m), 6) AS mean_filled, round(coalesce(ab, q), 6) AS median_filled, d AS n_unique FROM w, s""")
def q_trap_whole(spark, sf_dir):
    from quarry.operators.stats import impute_mean, impute_median, n_unique
    w = spark.sql(_WHOLE_SQL, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    n = n_unique(w, ["a.b"]).first()["n_unique"]
    mean = impute_mean(w, ["a.b", "two"]).toDF("row_id", "mean_filled", "two").drop("two")
    median = impute_median(w, ["a.b"]).toDF("row_id", "median_filled", "two").drop("two")
    return rounded(mean.join(median, "row_id").withColumn("n_unique", F.lit(n)))


@register("trap_low_variation", "P5 (NaN)", """
SELECT row_id, x FROM (SELECT row_id, CASE WHEN isnan(x) THEN NULL ELSE x END AS x FROM d4)""")
def q_trap_variation(spark, sf_dir):
    from quarry.functions.columns import nan_to_null
    from quarry.operators.project import drop_low_variation
    flat = d4(spark, sf_dir).select("row_id", "x", F.when(F.isnan("y"), F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("flat"))
    return nan_to_null(drop_low_variation(flat))


@register("trap_dotted_category", "M3 M4 P9 (names with dots)", """
SELECT row_id, CASE WHEN town = 'B' THEN 1e0 ELSE 0e0 END AS b, CASE WHEN town = 'St. A' THEN 1e0 ELSE 0e0 END AS st_a,
  CASE WHEN town = 'a.b' THEN 1e0 ELSE 0e0 END AS a_b FROM d4""")
def q_trap_dotted(spark, sf_dir):
    from quarry.operators.features import one_hot
    from quarry.operators.project import select_features
    hot = one_hot(d4(spark, sf_dir).select("row_id", "town"), ["town"])
    return select_features(hot, ["cat__town_B", "cat__town_St. A", "cat__town_a.b"], keep=("row_id",)).toDF("row_id", "b", "st_a", "a_b")


@register("trap_tied_neighbours", "M8 (ties)", """
, k AS (SELECT a.row_id, b.row_id AS nb, (a.bit1 - b.bit1) * (a.bit1 - b.bit1) + (a.bit2 - b.bit2) * (a.bit2 - b.bit2) AS d2
        FROM d4 a JOIN d4 b ON a.grp = b.grp AND a.row_id <> b.row_id)
, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, nb) - 1 AS j FROM k)
SELECT row_id, CAST(j AS INTEGER) AS j, nb, d2 FROM r WHERE j < 5""")
def q_trap_ties(spark, sf_dir):
    from quarry.operators.knn import knn_within_class
    return knn_within_class(d4(spark, sf_dir).select("row_id", "grp", "bit1", "bit2"), ["bit1", "bit2"], "grp", "row_id", 5)


# --------------------------------------------------------------------------- stores (S5-S8) and scoring sign (C14)
@register("matrix_round_trip", "S5 S8", """
SELECT returnflag, count(*) AS n, round(sum(label), 2) AS label FROM d2 GROUP BY returnflag""")
def q_matrix_round_trip(spark, sf_dir):
    from quarry.session import scratch_path
    from quarry.sources.io import load_matrix, require_columns, save_matrix
    path = scratch_path(spark, "matrix")
    save_matrix(d2(spark, sf_dir), path)
    m = load_matrix(spark, path)
    require_columns(m, ["returnflag", "label"])
    return rounded(m.groupBy("returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label")), 2)


@register("stored_models", "S6 S7 M14 M15", TRAIN_STATS_SQL + """
, co AS (SELECT 'Linear Regression_all' AS combo_key, sxy / sxx AS coef, my - sxy / sxx * mx AS intercept FROM st
         UNION ALL SELECT 'Ridge_all', sxy / (sxx + 10.0), my - sxy / (sxx + 10.0) * mx FROM st)
SELECT combo_key, round(coef, 6) AS coef, round(intercept, 6) AS intercept FROM co""")
def q_stored_models(spark, sf_dir):
    """Two fits put by two openings of one store, read back through its manifest."""
    from quarry.operators.linear import LinearExpressionModel, gram_stats, solve
    from quarry.session import scratch_path
    from quarry.sources.io import ModelStore
    root = scratch_path(spark, "store")
    st = gram_stats(split_d3(spark, sf_dir).filter("split = 'train'"), ["value"])[0]
    for name, params in (("Linear Regression", {}), ("Ridge", {"alpha": 10.0})):
        ModelStore(spark, root).put(f"{name}_all", name, "all", LinearExpressionModel(["value"], *solve(name, params, st)))
    store = ModelStore(spark, root)
    keys = [r["combo_key"] for r in store.manifest().collect()]  # one row per stored model
    found = [(k, store.get(k).coefficients[0], store.get(k).intercept) for k in keys]
    return rounded(spark.createDataFrame(found, "combo_key string, coef double, intercept double"))


_NOTES_SQL = """SELECT row_id, concat('a ', coalesce(foundation_type_u, '-'), '{nl}', roof_shape_u, ', "', wall_thickness, '"', CASE WHEN row_id % 4 = 0 THEN '{nl}{nl}' ELSE '' END, 'z') AS note,
  CASE WHEN row_id % 3 = 0 THEN NULL ELSE wall_thickness END AS wall, Difference AS diff FROM {d1}"""


@register("quoted_line_breaks", "S1 S4 (line breaks inside quotes)", ", n AS (" + _NOTES_SQL.format(d1="d1", nl="' || chr(10) || '") + """)
SELECT CAST(row_id AS DOUBLE) AS row_id, note, CASE WHEN wall IN ('') THEN NULL ELSE wall END AS wall, round(diff, 6) AS diff FROM n""")
def q_quoted_line_breaks(spark, sf_dir):
    """Text with line breaks, commas and quotes, written as CSV and read back in splits of 64 KB."""
    from quarry.session import scratch_path
    from quarry.sources.io import read_table, write_csv
    path = scratch_path(spark, "notes")
    notes = spark.sql(_NOTES_SQL.replace("{nl}", "\\n").format(d1="{d1}"), d1=d1(spark, sf_dir))
    write_csv(notes.coalesce(2), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        return rounded(cut_lineage(read_table(spark, path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@register("stored_transformer", "S6 M4 P8", COLUMN_TRANSFORMER_SQL)
def q_stored_transformer(spark, sf_dir):
    """The fitted transformer is written, read back and applied."""
    from quarry.operators.features import ColumnTransformerModel, fit_column_transformer
    from quarry.session import scratch_path
    from quarry.sources.io import load_json, save_json
    path = scratch_path(spark, "transformer")
    s = split_d3(spark, sf_dir)
    save_json(spark, fit_column_transformer(s.filter("split = 'train'")).to_dict(), path)
    return rounded(ColumnTransformerModel.from_dict(load_json(spark, path)).transform(s))


@register("stored_pipeline", "S6 S7 M13 M14", TRAIN_STATS_SQL + """
SELECT row_id, round(label, 6) AS label, round(my + sxy / sxx * (value - mx), 6) AS prediction FROM s, st WHERE split = 'test'""")
def q_stored_pipeline(spark, sf_dir):
    """A Spark ML pipeline put into a store, read back and used for scoring."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from quarry.operators.models import predict
    from quarry.session import scratch_path
    from quarry.sources.io import ModelStore
    s = split_d3(spark, sf_dir)
    model = Pipeline(stages=[VectorAssembler(inputCols=["value"], outputCol="features"),
                             LinearRegression(regParam=0.0, solver="normal", standardization=False)]).fit(s.filter("split = 'train'"))
    root = scratch_path(spark, "store")
    ModelStore(spark, root).put("Linear Regression_all", "Linear Regression", "all", model)
    back = ModelStore(spark, root).get("Linear Regression_all")
    return rounded(predict(back, s.filter("split = 'test'"), ["value"]).select("row_id", "label", "prediction"))


@register("cv_scores", "C14 M11 M10 M15", f""", s AS (SELECT row_id, value, label, row_number() OVER (ORDER BY md5(concat(CAST(row_id AS VARCHAR), '{C.SEED_TEXT}')), row_id) - 1 AS r,
          count(*) OVER () AS n FROM d3)
, f AS (SELECT value AS x, label AS y, {FOLD_SQL} AS fold FROM s)
, tr AS (SELECT k, avg(x) AS mx, avg(y) AS my, count(*) * var_pop(x) AS sxx, count(*) * covar_pop(x, y) AS sxy
         FROM f, range(0, 5) r(k) WHERE fold <> k GROUP BY k)
, a AS (SELECT unnest([{", ".join(str(float(v)) + "::DOUBLE" for v in C.PARAM_GRIDS["Ridge"]["alpha"])}]) AS alpha)
, e AS (SELECT alpha, k, avg((y - (my + sxy / (sxx + alpha) * (x - mx))) * (y - (my + sxy / (sxx + alpha) * (x - mx)))) AS mse
        FROM a, tr JOIN f ON f.fold = tr.k GROUP BY alpha, k)
SELECT alpha, round(avg(mse), 6) AS mean_mse, round(-avg(mse), 6) AS mean_test_score FROM e GROUP BY alpha""")
def q_cv_scores(spark, sf_dir):
    """Ridge grid, five folds: mean validation error and its scoring sign."""
    from quarry.functions.columns import neg_mse
    from quarry.operators.features import kfold
    from quarry.operators.linear import linear_grid_search
    train = kfold(d3(spark, sf_dir), "row_id", C.N_SPLITS_CV, C.SEED_TEXT)
    _, _, table = linear_grid_search(train, ["value"], ["Ridge"])["Ridge"]
    df = spark.createDataFrame([(float(p["alpha"]), v) for p, v in table], "alpha double, mean_mse double")
    return rounded(df.withColumn("mean_test_score", neg_mse("mean_mse")))
