import datetime
import subprocess
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import scalars, udfs
from tidemark.sources.catalog import literal_rows

EDGES = [None, 2**63 - 1, -(2**63), 0, 2, -3, 10000000, 3037000499, 3037000500, -3037000499, -3037000500, 2097151, 2097152, -2097152, -2097153]


@pytest.mark.parametrize("native, vectorised, power", [(scalars.square, udfs.square_udf, 2), (scalars.cube, udfs.cube_udf, 3)])
def test_powers(spark, native, vectorised, power):
    df = spark.createDataFrame([(x,) for x in EDGES], "x long")
    got = {r["x"]: (r["n"], r["v"]) for r in df.select("x", native(F.col("x")).alias("n"), vectorised("x").alias("v")).collect()}
    for x in EDGES:
        exact = None if x is None else x**power
        fits = exact is not None and -(2**63) <= exact < 2**63
        assert got[x] == ((exact, exact) if fits else (None, None)), x


def test_salary_classes(spark):
    people = literal_rows(spark, [("Tove", 15500), ("Kemal", 4200), ("Priya", 26000), ("Nils", None), ("upper", 20000), ("lower", 10000)], "name string, salary long")
    expected = {"Tove": "Medium", "Kemal": "Low", "Priya": "Large", "Nils": None, "upper": "Medium", "lower": "Low"}
    for rule in (scalars.categorize, udfs.categorize_udf):
        assert dict(tuple(r) for r in people.select("name", rule(F.col("salary"))).collect()) == expected


@pytest.mark.parametrize("name", ["square_udf", "cube_udf", "categorize_udf", "concatenate_udf"])
def test_udf_code_travels_without_the_package(name, tmp_path):
    """Workers get the function itself; the package need not be installed there."""
    code = "import pickle, sys; pickle.load(sys.stdin.buffer); assert 'tidemark' not in sys.modules"
    pickled = cloudpickle.dumps(getattr(udfs, name).func)
    subprocess.run([sys.executable, "-c", code], input=pickled, cwd=tmp_path, check=True)


def test_full_name(spark):
    df = spark.createDataFrame([("Ada", "Lovelace"), ("Ada", None), (None, "Lovelace"), ("", "x")], "a string, b string")
    for rule in (scalars.full_name, udfs.concatenate_udf):
        assert [r[0] for r in df.select(rule(F.col("a"), F.col("b"))).collect()] == ["Ada Lovelace", None, None, " x"]


def test_dates(spark):
    df = spark.createDataFrame([("2/24/2003 0:00",), ("12/1/2004 13:05",), ("2003-02-24",), (None,)], "t string")
    parsed = df.select(scalars.parse_date(F.col("t"), "M/d/yyyy H:mm").cast("string"))
    assert [r[0] for r in parsed.collect()] == ["2003-02-24", "2004-12-01", None, None]
    seconds = df.select(scalars.parse_epoch(F.col("t"), "M/d/yyyy H:mm").alias("s"))
    assert [r[0] for r in seconds.collect()] == [1046044800, 1101906300, None, None]
    days = seconds.select(scalars.epoch_date(F.col("s")).cast("string"))
    assert [r[0] for r in days.collect()] == ["2003-02-24", "2004-12-01", None, None]


@pytest.mark.parametrize("start", [1710028800, 1730592000])
def test_epoch_in_another_time_zone(spark, conf, start):
    """Every minute around both clock changes, the skipped hour included."""
    conf(spark__sql__session__timeZone="America/New_York")
    moments = [datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=start + 60 * i) for i in range(480)]
    texts = [(i, f"{m.month}/{m.day}/{m.year} {m.hour}:{m.minute:02d}") for i, m in enumerate(moments)]
    texts = spark.createDataFrame(texts, "id long, t string")
    parsed = texts.select("id", "t", scalars.parse_epoch(F.col("t"), "M/d/yyyy H:mm").alias("s"))
    assert parsed.where(f"s IS NULL OR s <> {start} + 60 * id").isEmpty()


def test_categories_of_fractions(spark):
    """NaN is above every number."""
    df = spark.createDataFrame([(float("nan"),), (1.5,), (10000.5,), (None,)], "x double")
    for rule in (scalars.categorize, udfs.categorize_udf):
        assert [r[0] for r in df.select(rule(F.col("x"))).collect()] == ["Large", "Low", "Medium", None]


def test_clean_name(spark):
    assert spark.range(1).select(scalars.clean_name(F.lit("a.b@c-d"))).first()[0] == "a_b_c_d"


def test_try_integer(spark):
    df = spark.createDataFrame([("7",), (" -8 ",), ("x",), ("",), ("9999999999",), ("1.5",), (None,)], "t string")
    assert [r[0] for r in df.select(scalars.try_integer(F.col("t"))).collect()] == [7, -8, None, None, None, None, None]


def test_literal_rows_from_dicts_and_names(spark):
    assert literal_rows(spark, [{"b": 1, "a": "x"}], None).columns == ["a", "b"]
    assert rows(literal_rows(spark, [(1, "x")], ["k", "v"])) == [(1, "x")]


def test_bounded_result_to_pandas(spark):
    frame = spark.range(10).groupBy((F.col("id") % 2).alias("odd")).count().orderBy("odd").toPandas()
    assert isinstance(frame, pd.DataFrame) and list(frame["count"]) == [5, 5]
