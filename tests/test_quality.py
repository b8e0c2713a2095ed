from pyspark.sql import functions as F

from martline.operators import quality as dq
from tests.helpers import rows


def test_completeness_thresholds(spark):
    data = [(i, None if i < 5 else i, None if i < 6 else i) for i in range(100)]
    df = spark.createDataFrame(data, "id INT, a INT, b INT")
    out = {r.column: r for r in dq.completeness(df).collect()}
    assert out["a"].completeness == 0.95 and out["a"].passed
    assert out["b"].completeness == 0.94 and not out["b"].passed
    empty = dq.completeness(df.limit(0)).collect()
    assert all(r.completeness == 0.0 and not r.passed for r in empty)


def test_profile_high_null_rule(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None), (3, 1, None), (4, 2, 1)],
                               "id INT, half INT, most INT")
    out = {r.column: r for r in dq.profile(df).collect()}
    assert out["half"].null_percentage == 50.0 and not out["half"].high_null
    assert out["most"].high_null and out["most"].null_count == 3
    assert out["id"].dtype == "int"


def test_rules_null_zero_negative_violate(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -1), (4, 5)], "id INT, quantity INT")
    counts = {r.column: r for r in dq.rule_counts(df, {"quantity": "quantity > 0", "price": "price > 0"}).collect()}
    assert counts["quantity"].violations == 3 and not counts["quantity"].passed
    assert counts["price"].error and counts["price"].passed   # absent column: error text, not a failure
    v = rows(dq.rule_violations(df, {"quantity": F.col("quantity") > 0}, ["id"]), "id")
    assert v == [("quantity", 1, None), ("quantity", 2, "0"), ("quantity", 3, "-1")]


def test_python_rule_exception_is_violation(spark):
    df = spark.createDataFrame([(1, "10"), (2, "x"), (3, "-2")], "id INT, q STRING")
    r = dq.python_rule("q", lambda v: int(v) > 0)
    assert [x.id for x in df.where(~r).orderBy("id").collect()] == [2, 3]


def test_validate_all_report(spark):
    df = spark.createDataFrame([(1, 101, 201, 2, 29.99), (2, 102, 202, 0, 49.99)],
                               "order_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE")
    rep = dq.validate_all(df, dq.DEFAULT_REQUIRED, {"quantity": int, "unit_price": float}, dq.DEFAULT_RULES)
    assert not dq.report_is_valid(rep)
    bad = [r.column for r in rep.where("counts_toward_valid AND NOT passed").collect()]
    assert bad == ["quantity"]
    ok = dq.validate_all(df.where("quantity > 0"), dq.DEFAULT_REQUIRED, None, dq.DEFAULT_RULES)
    assert dq.report_is_valid(ok)
    missing = dq.validate_all(df.drop("unit_price"), dq.DEFAULT_REQUIRED)
    assert not dq.report_is_valid(missing)
    assert dq.schema_faults(df, ["order_id"], {"quantity": str})[-1] == ("schema_type", "quantity", "quantity is int, not str")


def test_constraints(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99), (4, 10)], "sale_id INT, customer_id INT")
    dim = spark.createDataFrame([(10,), (11,)], "customer_id INT")
    assert [r.sale_id for r in dq.fk_orphans(fact, "customer_id", dim, "customer_id").collect()] == [4]
    assert rows(dq.pk_duplicates(fact, ["sale_id"])) == [(4, 2)]
    nn = {(r.column, r.constraint): r.violations
          for r in dq.not_null_check(fact, ["customer_id"], unique=["sale_id"]).collect()}
    assert nn == {("customer_id", "not_null"): 1, ("sale_id", "unique"): 1}
    tb = spark.createDataFrame([("x" * 101, 123456789.5)], "name STRING, amount DOUBLE")
    out = {r.column: r.violations for r in dq.type_bounds(tb, {"name": 100}, {"amount": (10, 2)}).collect()}
    assert out == {"name": 1, "amount": 1}
