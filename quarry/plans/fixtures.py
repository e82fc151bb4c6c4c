"""Test views over the driver's tables (FIXTURES.md D1-D4).

The same SQL text runs in Spark (here, with DataFrame parameters) and in
DuckDB (the oracle statements in ``plans.catalog``), so both engines see
identical inputs that grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

D1_SQL = """
SELECT o_orderkey AS row_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_totalprice - 2.5e5) / 5e4 END AS Difference,
  CAST(o_orderkey % 6 AS DOUBLE) AS estimated,
  CASE WHEN o_orderkey % 17 = 0 THEN 'bad' ELSE CAST(o_custkey % 6 AS STRING) END AS simulated_damage,
  CASE o_orderkey % 5 WHEN 0 THEN 'un' WHEN 1 THEN 'not_applicable'
       ELSE CAST(o_custkey % 40 AS STRING) END AS wall_thickness,
  CASE WHEN o_orderkey % 7 = 0 THEN '  ' WHEN o_orderkey % 13 = 0 THEN NULL
       ELSE o_orderpriority END AS foundation_type_u,
  o_orderstatus AS roof_shape_o, o_orderstatus AS roof_shape_u,
  'x' AS const_col,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS building_area_m2,
  o_custkey % 3 AS front_Photos, 'NA' AS notes, o_orderkey % 2 = 0 AS is_even
FROM {orders}
"""

D2_SQL = """
SELECT l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_returnflag AS returnflag,
  l_linestatus AS linestatus, 5e0 AS const_num, l_extendedprice AS label
FROM {lineitem}
"""

D3_SQL = """
SELECT event_id AS row_id, event_type, CAST(user_id % 10 AS DOUBLE) AS user_bucket,
  CAST(hour(ts) AS DOUBLE) AS hour_of_day, value,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS minority,
  value * 2e0 + user_id % 10 AS label
FROM {events}
"""

D4_SQL = """
SELECT o_orderkey AS row_id, o_custkey % 50 AS grp,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN NULL
       ELSE o_totalprice / 1e3 END AS x,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS y,
  o_totalprice / 1e3 + 1e9 AS far,
  CAST(o_orderkey AS DOUBLE) * 1e6 + 5e-1 AS big,
  CASE o_orderkey % 5 WHEN 0 THEN '1d' WHEN 1 THEN '2F' WHEN 2 THEN '0x1p3' WHEN 3 THEN ' 7.5 ' ELSE '1e3' END AS code,
  CASE o_orderkey % 3 WHEN 0 THEN 'St. A' WHEN 1 THEN 'a.b' ELSE 'B' END AS town,
  CAST(o_custkey % 2 AS DOUBLE) AS bit1, CAST(o_orderkey % 2 AS DOUBLE) AS bit2
FROM {orders}
"""

#: Thirty numeric columns with nulls and an offset, over D4's keys.
D4_WIDE = [f"c{i}" for i in range(30)]
D4_WIDE_SQL = ("SELECT row_id, " + ", ".join(
    f"CASE WHEN (row_id + {i}) % 10 = 0 THEN NULL ELSE CAST((row_id * {2 * i + 3}) % 101 AS DOUBLE) + 1e9 END AS c{i}"
    for i in range(30)) + " FROM {d4}")

#: Two hundred text columns of two to eight values, some with nulls, over D4's keys.
D4_TEXTS = [f"t{i}" for i in range(200)]
D4_TEXTS_SQL = ("SELECT row_id, " + ", ".join(
    f"CASE WHEN (row_id + {i}) % {17 + i % 5} = 0 THEN NULL ELSE CAST((row_id * {2 * i + 3} + o_custkey % {2 + i % 4}) % {2 + i % 7} AS STRING) END AS t{i}"
    for i in range(200)) + " FROM (SELECT o_orderkey AS row_id, o_custkey FROM {orders})")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty wide table with a unique key (one row per order)."""
    return spark.sql(D1_SQL, orders=table(spark, sf_dir, "orders"))


def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics table (one row per line item; no unique key)."""
    return spark.sql(D2_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed model table (one row per event)."""
    return spark.sql(D3_SQL, events=table(spark, sf_dir, "events"))


def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traps: NaN, Java number texts, dotted categories, ties, offsets, large doubles."""
    return spark.sql(D4_SQL, orders=table(spark, sf_dir, "orders"))


def d4_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(D4_WIDE_SQL, d4=d4(spark, sf_dir))


def d4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(D4_TEXTS_SQL, orders=table(spark, sf_dir, "orders"))


def duck_ctes() -> str:
    """The same views for DuckDB, as a WITH prefix."""
    return ("WITH d1 AS (" + D1_SQL.format(orders="orders") + "), d2 AS ("
            + D2_SQL.format(lineitem="lineitem") + "), d3 AS (" + D3_SQL.format(events="events")
            + "), d4 AS (" + D4_SQL.format(orders="orders") + ")")
