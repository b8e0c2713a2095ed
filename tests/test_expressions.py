"""Translated pandas text against pandas itself, on rows with nulls."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from martline.functions.expressions import ExpressionError
from martline.operators.calc import calculate_fields, filter_data

ROWS = [(1, 2, 1.5, "a", 4.0), (2, -3, None, "b", 2.0), (None, 7, -2.25, None, -1.0), (4, -2, 8.0, "c d", 9.0), (5, 5, 0.0, "", None),
        (-6, 4, 3.5, "A", 16.0), (7, None, None, "a", 0.25)]
SCHEMA = "a int, b int, x double, s string, `y z` double"

FILTERS = ['s in ["a", "c d"]', 's not in ["a"]', "a == [1, 4, 9]", "a != [1, 4]", "x ** 2 > 2", "a > 1 and b < 5", "a > 1 & b < 5 | x > 3", "not (a > 1)",
           "a != 1", "not (a == 1 or x > 1)", "~(a > 1) and b == b", "1 < a <= 5", "not (1 < a <= 5)", "-a ** 2 < -3", "a + b * 2 >= x", "`y z` > x",
           "s == 'a' or `y z` < 0", "s.isnull()", "not s.notnull()", "s.isin(['a', ''])", "a % 3 == 1", "b // 2 == -2", "a == b", "a != b", "not (a != b)",
           "(a > 2) == (b > 2)", 'a > @low and s in @some', "a.between(1, 4)"]
VALUES = ["a + b", "a - b * 2", "x ** 2", "2 ** a", "-x", "a / 2", "a // 2", "b // 4", "b % 3", "(a + b) % 4", "a > 1", "a != 1", "not (a > 1)", "a > 1 and x > 1",
          "sqrt(`y z` + 1)", "exp(x) - log1p(a + 10)", "arctan2(x, 2) + abs(b)", "floor(x) + ceil(x)", "sin(x) ** 2 + cos(x) ** 2", "a * @k + 1",
          "x if_ y"]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumn("row", F.monotonically_increasing_id()).coalesce(1)


def plain():
    df = pd.DataFrame(ROWS, columns=["a", "b", "x", "s", "y z"])
    return df.astype({"a": "float64", "b": "float64", "x": "float64", "y z": "float64"})


@pytest.mark.parametrize("text", FILTERS)
def test_filters_keep_the_rows_that_pandas_keeps(spark, text):
    low, some = 1, ["a", "c d"]
    params = {"low": low, "some": some}
    wanted = plain().query(text, engine="python").index.tolist()
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], SCHEMA + ", i int")
    assert sorted(r.i for r in filter_data(df, text, language="pandas", params=params).collect()) == wanted
    turned = filter_data(df, f"not ({text})", language="pandas", params=params)
    assert sorted(r.i for r in turned.collect()) == plain().query(f"not ({text})", engine="python").index.tolist()
    assert low and some


@pytest.mark.parametrize("text", VALUES[:-1])
def test_values_are_those_of_pandas(spark, text):
    k = 3
    wanted = plain().eval(text, engine="python").tolist()
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], SCHEMA + ", i int")
    got = [r.v for r in calculate_fields(df, {"v": text}, language="pandas", params={"k": k}).orderBy("i").collect()]
    for a, b in zip(got, wanted, strict=True):
        assert (a is None and math.isnan(b)) or float(a) == pytest.approx(float(b), rel=1e-12), text
    assert k


def test_text_that_is_no_expression(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for text in ("x if_ y", "nothing > 1", "a.explode()", "import os", "a[0] > 1", "unknown(a)", "a > @missing", "lambda: a", "a in b", "__import__('os')"):
        with pytest.raises(ExpressionError):
            filter_data(df, text, language="pandas").collect()
    with pytest.raises(ValueError):
        filter_data(df, "a > 1", language="perl")


def test_language_is_found(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert filter_data(df, 's in ["a", "c d"]').count() == 3 and filter_data(df, "x ** 2 > 2").count() == 4
    assert filter_data(df, "a <> 1").count() == 5 and filter_data(df, "s IS NULL").count() == 1  # SQL as before
    assert filter_data(df, "a != 1").count() == 5 and filter_data(df, "a != 1", language="pandas").count() == 6
    out = calculate_fields(df, {"t": "a * 2", "u": "t ** 2"}).where("a = 4").first()
    assert (out.t, out.u) == (8, 64.0)


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 0)], "a int, b int")
    got = calculate_fields(df, {"p": "a / b", "q": "a // b", "r": "a % b"}, language="pandas", zero_division="null").first()
    assert got[2:] == (None, None, None)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        calculate_fields(df, {"p": "a / b"}, language="pandas").collect()


def test_filters_reach_the_scan(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = 'l_returnflag in ["A", "N"] and 5 <= l_quantity < @most and l_discount != 0.05 and not (l_linenumber > 5 or l_tax < 0.01)'
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    plan = filter_data(li, text, language="pandas", params={"most": 40.0})._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    for part in ("In(l_returnflag", "GreaterThanOrEqual(l_quantity", "LessThan(l_quantity", "Or(Not(EqualTo(l_discount,0.05)),IsNull(l_discount))",
                 "Or(LessThanOrEqual(l_linenumber,5),IsNull(l_linenumber))", "Or(GreaterThanOrEqual(l_tax,0.01),IsNull(l_tax))"):
        assert part in pushed, pushed
