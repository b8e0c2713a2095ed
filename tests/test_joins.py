import pytest

from martline.operators.calc import calculate_fields, filter_data
from martline.operators.joins import enrich_with_lookup, join_data
from tests.helpers import rows


@pytest.fixture()
def lr(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 30)], "id INT, name STRING, v INT")
    right = spark.createDataFrame([(1, "A", 100), (3, "C", 300), (None, "N", 900)], "id INT, name STRING, w INT")
    return left, right


def test_join_types_and_suffixes(lr):
    left, right = lr
    inner = join_data(left, right, "id", "id")
    assert inner.columns == ["id", "name_x", "v", "name_y", "w"]
    assert rows(inner) == [(1, "a", 10, "A", 100)]
    assert len(rows(join_data(left, right, "id", "id", "left"))) == 3
    right_rows = rows(join_data(left, right, "id", "id", "right"), "w")
    assert [r[0] for r in right_rows] == [1, 3, None]
    full = rows(join_data(left, right, "id", "id", "outer"), "v", "w")
    assert len(full) == 5 and {r[0] for r in full} == {1, 2, 3, None}
    with pytest.raises(ValueError):
        join_data(left, right, "id", "id", "cross")


def test_null_safe_matches_null_keys(lr):
    left, right = lr
    assert len(rows(join_data(left, right, "id", "id", null_safe=True))) == 2


def test_different_key_names_keep_both(spark, lr):
    left, _ = lr
    r = spark.createDataFrame([(1, "x"), (1, "y")], "key INT, tag STRING")
    out = join_data(left, r, "id", "key", "inner")
    assert out.columns == ["id", "name", "v", "key", "tag"]
    assert len(rows(out)) == 2                         # duplicated lookup key multiplies rows


def test_enrich_with_prefix_and_key_drop(spark, lr):
    left, _ = lr
    lookup = spark.createDataFrame([(1, "red", 5)], "lk INT, color STRING, size INT")
    out = enrich_with_lookup(left, lookup, "id", "lk", ["color"], prefix="p")
    assert out.columns == ["id", "name", "v", "p_color"]
    assert rows(out, "v")[0] == (1, "a", 10, "red")


def test_calculate_fields_sequential_and_filter(spark):
    df = spark.createDataFrame([(2, 3.0, 10.0), (1, 5.0, 0.0), (None, 1.0, 0.0)], "q INT, p DOUBLE, d DOUBLE")
    out = calculate_fields(df, {"t": "q * p", "da": "t * d / 100", "f": "t - da"})
    assert rows(out.select("f"), "f")[-1] == (5.4,)
    assert filter_data(df, "q > 1 and p >= 3").count() == 1
    assert filter_data(df, "q != 1").count() == 1          # NULL drops the row (SQL logic)
    assert filter_data(df, "q IS DISTINCT FROM 1").count() == 2


def test_head_and_approx_distinct(spark):
    from martline.operators.aggregate import aggregate_data
    from martline.operators.calc import head
    from martline.plans.marts import customer_summary
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    assert [r.id for r in head(df, 3, ["k", "id"]).collect()] == [0, 7, 14]
    with pytest.raises(ValueError):
        head(df, 3)
    out = aggregate_data(df, ["k"], {"id": ["nunique", "nunique_approx"]}).collect()
    assert all(r.id_nunique == r.id_nunique_approx for r in out)
    dc = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "customer_id INT, city STRING, country STRING")
    r = customer_summary(dc, approx=True).first()
    assert (r.total_customers, r.cities, r.countries) == (2, 2, 1)
