import pytest
from pyspark.sql import types as T

from quarry.session import scratch_path
from quarry.sources.io import (MissingColumnsError, ModelStore, load_matrix, read_table, require_columns,
                               save_matrix, write_csv)


def _write(spark, text):
    p = scratch_path(spark, "csv")
    spark.sparkContext.parallelize([text], 1).saveAsTextFile(p)
    return p


def test_csv_scan_types_and_na(spark):
    text = ('id,num,txt,flag,mixed,allna\n1,1.5,"a, b",True,NA,\n2,NaN,café,False,x,null\n'
            '3, 2 ,  ,true,3,NA')
    df = read_table(spark, _write(spark, text))
    types = {f.name: type(f.dataType) for f in df.schema.fields}
    assert types["id"] is T.DoubleType and types["num"] is T.DoubleType
    assert types["txt"] is T.StringType and types["flag"] is T.BooleanType
    assert types["mixed"] is T.StringType and types["allna"] is T.DoubleType
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["txt"] == "a, b" and rows[2]["txt"] == "café" and rows[3]["txt"] == "  "
    assert rows[2]["num"] is None and rows[3]["num"] == 2.0
    assert rows[1]["mixed"] is None and rows[1]["flag"] is True


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    require_columns(df, ["a"])
    with pytest.raises(MissingColumnsError) as e:
        require_columns(df, ["a", "zz"])
    assert e.value.missing == ["zz"] and e.value.available == ["a", "b"]


def test_write_csv_float_format(spark):
    df = spark.createDataFrame([("m", 1.0 / 3)], "k string, v double")
    p = scratch_path(spark, "out")
    write_csv(df, p, float_format="%.6f")
    back = spark.read.option("header", True).csv(p).collect()
    assert back[0]["v"] == "0.333333"


def test_matrix_and_model_store_roundtrip(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.createDataFrame([(i, float(i), 2.0 * i + 1) for i in range(20)], "row_id long, x double, label double")
    p = scratch_path(spark, "m")
    save_matrix(df, p)
    assert load_matrix(spark, p).count() == 20
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression()]).fit(df)
    store = ModelStore(spark, scratch_path(spark, "store"))
    store.put("Linear Regression_Original Features", "Linear Regression", "Original Features", model)
    got = store.get("Linear Regression_Original Features")
    assert abs(got.stages[-1].coefficients[0] - 2.0) < 1e-6
    assert store.get("absent") is None


ODD_FIELDS = ["plain", "", "two\nlines", "a \"quoted\" word", "comma, inside", "\n", "\n\nthree\n", "\"", "ends\n\"", "5\" pipe", "é\nü", " pad ", "x" * 300 + "\n" + "y" * 300]


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_records_that_span_lines_in_many_splits(spark, tmp_path, encoding):
    import csv
    import random

    import pandas as pd

    from quarry.sources import csv_records
    rnd = random.Random(3)
    for f in range(2):
        with open(tmp_path / f"part{f}.csv", "w", newline="", encoding=encoding) as out:
            w = csv.writer(out, lineterminator="\n" if f else "\r\n")
            w.writerow(["id", "a.b", "c,d", "e"])
            for i in range(400):
                w.writerow([f"{f}-{i}", *rnd.choices(ODD_FIELDS, k=3)])
            out.write(f'{f}-x,5" pipe,loose "quote" inside,last\n')
    want = pd.concat([pd.read_csv(tmp_path / f"part{f}.csv", dtype=str, keep_default_na=False, encoding=encoding) for f in range(2)])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("700", "5000", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "10")
            lines = csv_records.read_lines(spark, str(tmp_path), encoding)
            assert csv_records.may_span_lines(lines)
            if size == "700":
                assert lines.rdd.getNumPartitions() > 100  # a file is many tasks, and records cross them
            got = csv_records.read_records(spark, str(tmp_path), encoding=encoding)
            assert got.columns == list(want.columns)
            assert sorted(tuple(x or "" for x in r) for r in got.collect()) == sorted(map(tuple, want.to_numpy()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_read_table_chooses_by_the_lines(spark, tmp_path):
    from quarry.sources.csv_records import may_span_lines, read_lines
    from quarry.sources.io import read_table
    (tmp_path / "flat.csv").write_text('a,b\n1,"x, ""y"""\n2,""\n')
    (tmp_path / "deep.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    assert not may_span_lines(read_lines(spark, str(tmp_path / "flat.csv")))
    assert [tuple(r) for r in read_table(spark, str(tmp_path / "flat.csv")).collect()] == [(1.0, 'x, "y"'), (2.0, None)]
    assert [tuple(r) for r in read_table(spark, str(tmp_path / "deep.csv")).collect()] == [(1.0, "x\ny"), (2.0, "z")]
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n')
    with pytest.raises(ValueError, match="inside a quoted field"):
        read_table(spark, str(tmp_path / "open.csv"))


def test_quote_automaton():
    import csv
    import io
    import random

    from quarry.sources.csv_records import INSIDE, OUTSIDE, state_after
    rnd = random.Random(5)
    for _ in range(3000):
        text = "".join(rnd.choices('ab,"\n', k=rnd.randint(1, 25)))
        state, cuts = OUTSIDE, 0
        for line in text.split("\n"):
            cuts += state == OUTSIDE
            state = state_after(line, state)
        rows = list(csv.reader(io.StringIO(text, newline="")))  # reads blank lines as empty rows, but none after the last break
        assert cuts - (text.endswith("\n") and state == OUTSIDE) == len(rows), text


def test_many_small_splits_share_tasks(spark, tmp_path):
    from quarry.sources.csv_records import in_few_tasks, read_lines, read_records
    rows = [(i, f'a "{i}"\nb, c' if i % 3 else "plain") for i in range(3000)]
    text = "id,note\n" + "".join(f'{i},"{n.replace(chr(34), chr(34) * 2)}"\n' for i, n in rows)
    (tmp_path / "t.csv").write_text(text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        lines = in_few_tasks(read_lines(spark, str(tmp_path / "t.csv")))
        assert lines.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
        assert lines.select("split").distinct().count() > 100
        assert sorted((int(r["id"]), r["note"]) for r in read_records(spark, str(tmp_path / "t.csv")).collect()) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
