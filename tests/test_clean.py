import datetime as dt

import pytest
from pyspark.sql import functions as F

from martline.operators import clean
from tests.helpers import rows


@pytest.fixture()
def dups(spark):
    data = [(1, None, "a", 10), (1, None, "a", 10), (1, None, "b", 11), (2, "x", "c", 12),
            (2, "x", "d", 13), (3, "y", "e", 14)]
    return spark.createDataFrame(data, "k INT, k2 STRING, v STRING, seq INT")


def test_dedupe_all_columns_nulls_equal(dups):
    assert clean.remove_duplicates(dups).count() == 5


def test_dedupe_by_hashes_as_by_whole_rows(spark, monkeypatch):
    nan = float("nan")
    data = [(0.0, 1, "a", None), (-0.0, 1, "a", None), (-0.0, 2, "a", None), (nan, 1, None, b"x"), (nan, 1, None, b"x"), (None,) * 4, (None,) * 4]
    df = spark.createDataFrame(data, "x DOUBLE, n INT, `c.d` STRING, b BINARY").withColumn("f", F.col("x").cast("float"))
    want = sorted(str(r) for r in clean.remove_duplicates(df).collect())
    assert len(want) == 4
    for most in (clean.MAX_COPIED, 1):                        # three rows have copies: compared alone, or with all rows
        monkeypatch.setattr(clean, "MAX_COPIED", most)
        got = clean.remove_duplicates(df, reread=True)
        assert sorted(str(r) for r in got.collect()) == want and got.columns == df.columns
    for single in (df.where("n = 2"), df.limit(0)):           # no copies: the rows are not shuffled
        out = clean.remove_duplicates(single, reread=True)
        assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert [str(r) for r in out.collect()] == [str(r) for r in clean.remove_duplicates(single).collect()]


def test_dedupe_different_rows_with_one_hash(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "k INT, v STRING")
    monkeypatch.setattr(clean.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    assert rows(clean.remove_duplicates(df, reread=True), "k") == [(1, "a"), (2, "b"), (3, None)]


def test_dedupe_collated_text_by_whole_rows(spark):
    df = spark.sql("SELECT a COLLATE UTF8_LCASE AS a FROM VALUES ('A'), ('a'), ('b') t(a)")
    assert clean.remove_duplicates(df, reread=True).count() == 2


def test_dedupe_subset_first_last_none(dups):
    first = rows(clean.remove_duplicates(dups, ["k", "k2"], "first", ["seq"]), "k")
    last = rows(clean.remove_duplicates(dups, ["k", "k2"], "last", ["seq"]), "k")
    none = rows(clean.remove_duplicates(dups, ["k", "k2"], False), "k")
    assert first == [(1, None, "a", 10), (2, "x", "c", 12), (3, "y", "e", 14)]
    assert last == [(1, None, "b", 11), (2, "x", "d", 13), (3, "y", "e", 14)]
    assert none == [(3, "y", "e", 14)]
    with pytest.raises(ValueError):
        clean.remove_duplicates(dups, ["k"], "first")


def test_keep_variants_partition_the_duplicates(dups):
    total = dups.count()
    keep_first = clean.remove_duplicates(dups, ["k"], "first", ["seq"]).count()
    keep_none = clean.remove_duplicates(dups, ["k"], False).count()
    groups = dups.select("k").distinct().count()
    assert keep_first == groups and keep_none <= keep_first <= total


def test_fill_constant_mean_median_mode(spark):
    df = spark.createDataFrame([(1, 3.0, "a"), (2, None, None), (3, 1.0, "b"), (4, 3.0, "b"), (5, 1.0, None)],
                               "id INT, x DOUBLE, s STRING")
    const = rows(clean.handle_nulls(df, "fill", fill_value=0, columns=["x"]), "id")
    assert [r[1] for r in const] == [3.0, 0.0, 1.0, 3.0, 1.0]
    mean = rows(clean.handle_nulls(df, "fill", fill_method="mean", columns=["x"]), "id")
    assert mean[1][1] == 2.0
    med = rows(clean.handle_nulls(df, "fill", fill_method="median", columns=["x"]), "id")
    assert med[1][1] == 2.0
    mode = rows(clean.handle_nulls(df, "fill", fill_method="mode", columns=["x", "s"]), "id")
    assert mode[1][1] == 1.0          # tie 3,1,3,1 -> smallest
    assert mode[1][2] == "b" and mode[4][2] == "b"
    # non-numeric column under mean falls through to the constant
    mixed = rows(clean.handle_nulls(df, "fill", fill_method="mean", fill_value="?", columns=["x", "s"]), "id")
    assert mixed[1][2] == "?"


def test_fill_all_null_column_unchanged_and_default_noop(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id INT, x DOUBLE")
    assert rows(clean.handle_nulls(df, "fill", fill_method="mode", columns=["x"]), "id") == [(1, None), (2, None)]
    assert rows(clean.handle_nulls(df, "fill", fill_method="mean", columns=["x"]), "id") == [(1, None), (2, None)]
    assert clean.handle_nulls(df) is df or rows(clean.handle_nulls(df), "id") == [(1, None), (2, None)]
    assert clean.handle_nulls(df, "skip") is df


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1.0, None), (3, 2.0, "c")], "id INT, x DOUBLE, s STRING")
    assert [r[0] for r in rows(clean.handle_nulls(df, "drop"), "id")] == [3]
    assert [r[0] for r in rows(clean.handle_nulls(df, "drop", columns=["x"]), "id")] == [2, 3]


def test_ffill_bfill_leading_trailing(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "t INT, x DOUBLE")
    f = rows(clean.handle_nulls(df, "fill", fill_method="forward", columns=["x"], order_by=["t"]), "t")
    b = rows(clean.handle_nulls(df, "fill", fill_method="backward", columns=["x"], order_by=["t"]), "t")
    assert [r[1] for r in f] == [None, 5.0, 5.0, 7.0, 7.0]
    assert [r[1] for r in b] == [5.0, 5.0, 7.0, 7.0, None]
    ff = clean.handle_nulls(spark.createDataFrame(f, df.schema), "fill", fill_method="forward",
                            columns=["x"], order_by=["t"])
    assert rows(ff, "t") == f  # ffill is idempotent


def test_trim_and_emails(spark):
    df = spark.createDataFrame([(1, " a ", "  X@Y.COM\t"), (2, "\tb\n", None), (3, None, " z@q.io　")],
                               "id INT, s STRING, e STRING")
    t = rows(clean.trim_whitespace(df), "id")
    assert [r[1] for r in t] == ["a", "b", None]
    e = rows(clean.standardize_emails(df, ["e", "absent"]), "id")
    assert [r[2] for r in e] == ["x@y.com", None, "z@q.io"]


def test_standardize_dates(spark):
    """One format a column, chosen over the whole column; what it can't parse is NULL; a mixed column is an error."""
    iso = ["2024-01-15", "2024-01-15 10:30:00", "2024-01-15T10:30:00.25", "2024-01-15T10:30:00Z", "2024-01-15T12:30:00+02:00", "bad", None]
    eu = ["25/04/2024", "03/04/2024", "3/4/2024", "1/2/2024 05:06:07", "", None, "bad"]
    us = ["01/02/2024", "04/03/2024", None, None, None, None, None]
    named = ["Jan 15, 2024", "February 3, 2024", "15 Jan 2024", None, None, None, None]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(zip(iso, eu, us, named, strict=True))], "id INT, iso STRING, eu STRING, us STRING, named STRING")
    out = rows(clean.standardize_dates(df, ["iso", "eu", "us", "named", "absent"]), "id")
    half, d = dt.datetime(2024, 1, 15, 10, 30), dt.datetime
    assert [r[1] for r in out] == [d(2024, 1, 15), half, half.replace(microsecond=250000), half, half, None, None]
    assert [r[2] for r in out] == [d(2024, 4, 25), d(2024, 4, 3), d(2024, 4, 3), d(2024, 2, 1, 5, 6, 7), None, None, None]
    assert [r[3] for r in out][:2] == [d(2024, 1, 2), d(2024, 4, 3)]      # both orders fit: month first
    assert [r[4] for r in out][:3] == [d(2024, 1, 15), d(2024, 2, 3), d(2024, 1, 15)]
    fmt = rows(clean.standardize_dates(df, ["eu"], format="dd/MM/yyyy"), "id")
    assert [r[2] for r in fmt][:3] == [d(2024, 4, 25), d(2024, 4, 3), None]
    mixed = spark.createDataFrame([("2024-01-15",), ("15/01/2024",), ("bad",)], "m STRING")
    with pytest.raises(ValueError, match="'iso'.*'dd/MM/yyyy'"):
        clean.standardize_dates(mixed, ["m"])
    assert clean.standardize_dates(df.limit(0), ["iso"]).count() == 0


def test_clean_all_chain(spark):
    df = spark.createDataFrame([(1, " A@B.C "), (1, " A@B.C "), (2, None)], "id INT, email STRING")
    out = rows(clean.clean_all(df, standardize_emails_=["email"]), "id")
    assert out == [(1, "a@b.c"), (2, None)]
    assert F is not None


def test_only_text_of_a_forms_shape_is_parsed(spark):
    """Nothing that a form parses is left out by its shape; text of another shape never reaches the parser, where it costs an exception."""
    from martline.functions import dates

    texts = ["2024-01-02 03:04:05", "2024-01-02t03:04:05z", "2024-01-02 03:04:05.1-09:30", "+12345-01-02", "0001-01-01", "2024/01/02", "001/0002/2024",
             "13/02/2024", "31.2.2023", "20240102", "JAN 2, 2024", "ſep 2, 2024", "2 May 2024", " 2024-01-02 ", "2024-01-02 24:00:00", "2024-02-30", "n/a", "", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for form in [*(f for fs in dates.FORMATS.values() for f in fs), "[yyyy]-MM-dd"]:
        plain = F.try_to_timestamp(F.trim("x"), F.lit(form)).cast("timestamp_ntz")
        assert df.where(~plain.eqNullSafe(dates.parse_timestamp("x", form))).count() == 0, form
    assert all(dates.shape(f) for fs in dates.FORMATS.values() for f in fs) and dates.shape("[yyyy]-MM-dd") is None
    assert df.where(F.col("x").rlike(dates.shape("yyyy-MM-dd"))).count() == 3
