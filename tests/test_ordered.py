"""Skew-safe ordered operators against pandas brute force, with a hot key."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from martline.operators.aggregate import aggregate_data
from martline.operators.ordered import (exact_median, fill_ordered, global_row_number, grouped_exact_median,
                                        mode_value)


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))  # a third on one key
    val = np.where(rng.random(n) < 0.4, np.nan, rng.integers(0, 100, n).astype(float))
    pdf = pd.DataFrame({"k": key.astype("int64"), "t": np.arange(n, dtype="int64")[::-1].copy(), "v": val})
    pdf = pdf.sample(frac=1.0, random_state=1).reset_index(drop=True)
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_row_number_dense_and_ordered(spark):
    pdf, df = _skewed(spark)
    out = global_row_number(df, ["k", "t"], "rn", num_partitions=5).toPandas()
    out = out.sort_values(["k", "t"]).reset_index(drop=True)
    assert out["rn"].tolist() == list(range(1, len(pdf) + 1))


def test_row_number_by_files(spark, tmp_path):
    pdf, df = _skewed(spark)
    out = global_row_number(df, ["k", "t"], "rn", num_partitions=5, columns=["t", "v"], copy_to=str(tmp_path / "copy"))
    assert out.columns == ["t", "v", "rn"] and list((tmp_path / "copy").glob("part-*.zstd.parquet"))
    got = out.toPandas().sort_values("rn")
    want = pdf.sort_values(["k", "t"])
    assert got["rn"].tolist() == list(range(1, len(pdf) + 1)) and got["t"].tolist() == want["t"].tolist()
    assert np.allclose(got["v"].values, want["v"].values, equal_nan=True)
    assert global_row_number(df.limit(0), ["k", "t"], "rn", copy_to=str(tmp_path / "none")).count() == 0


def test_fill_forward_backward_hot_key_matches_pandas(spark):
    pdf, df = _skewed(spark)
    for direction, method in (("forward", "ffill"), ("backward", "bfill")):
        got = fill_ordered(df, ["v"], ["t"], ["k"], direction, num_partitions=6).toPandas()
        exp = pdf.sort_values(["k", "t"]).copy()
        exp["v"] = getattr(exp.groupby("k")["v"], method)()
        g = got.sort_values(["k", "t"]).reset_index(drop=True)
        e = exp.reset_index(drop=True)
        assert g["v"].isna().tolist() == e["v"].isna().tolist()
        assert np.allclose(g["v"].fillna(-1), e["v"].fillna(-1))


def test_global_fill_matches_pandas(spark):
    pdf, df = _skewed(spark)
    got = fill_ordered(df, ["v"], ["t"], num_partitions=6).toPandas().sort_values("t")
    exp = pdf.sort_values("t")["v"].ffill()
    assert np.allclose(got["v"].fillna(-1).values, exp.fillna(-1).values)


def test_medians_and_mode(spark):
    pdf, df = _skewed(spark)
    assert exact_median(df, "v") == pdf["v"].median()
    g = grouped_exact_median(df, ["k"], "v", "m").toPandas().set_index("k")["m"]
    e = pdf.groupby("k")["v"].median()
    assert np.allclose(g.sort_index().values, e.sort_index().values, equal_nan=True)
    counts = pdf["v"].value_counts()
    assert mode_value(df, "v") == min(counts[counts == counts.max()].index)


def test_aggregate_registry(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, 3.0, 1), (2, 5.0, 2), (None, 9.0, 1)],
                               "k INT, x DOUBLE, o INT")
    out = {r.k: r for r in aggregate_data(df, ["k"], {"x": ["sum", "count", "size", "median", "first", "last",
                                                            "prod", "nunique"]}, order_by=["o"]).collect()}
    assert set(out) == {1, 2}                      # NULL key dropped
    assert out[1].x_sum == 0 and out[1].x_count == 0 and out[1].x_size == 2 and out[1].x_median is None
    assert out[2].x_median == 4.0 and out[2].x_first == 3.0 and out[2].x_last == 5.0 and out[2].x_prod == 15.0
    import pytest
    with pytest.raises(ValueError):
        aggregate_data(df, ["k"], {"x": ["bogus"]})
    with pytest.raises(ValueError):
        aggregate_data(df, ["k"], {"nope": ["sum"]})


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=40))
def test_ffill_property(spark, data):
    pdf = pd.DataFrame({"k": [a for a, _ in data], "t": range(len(data)),
                        "v": [np.nan if b is None else float(b) for _, b in data]})
    df = spark.createDataFrame(pdf, "k long, t long, v double")
    got = fill_ordered(df, ["v"], ["t"], ["k"], num_partitions=3).toPandas().sort_values("t")
    exp = pdf.groupby("k")["v"].ffill()
    assert got["v"].fillna(-1).tolist() == exp.fillna(-1).tolist()


def test_fill_leaves_other_columns_alone(spark):
    """NaN stays NaN, and times that pandas can't hold pass through."""
    df = spark.sql("""SELECT * FROM VALUES (1, 1, 5.0D, double('NaN'), timestamp_ntz'9999-01-01 00:00:00'), (1, 2, CAST(NULL AS DOUBLE), 2.0D, NULL),
                      (2, 1, NULL, double('NaN'), timestamp_ntz'0001-01-01 00:00:00') AS t(k, o, v, x, ts)""")
    out = {(r.k, r.o): r for r in fill_ordered(df, ["v"], ["o"], ["k"]).collect()}
    assert out[1, 2].v == 5.0 and out[2, 1].v is None and out[1, 2].ts is None
    assert out[1, 1].x != out[1, 1].x and out[2, 1].x != out[2, 1].x and out[1, 1].ts.year == 9999
