import datetime as dt

import pytest
from pyspark.sql import functions as F

from martline.sources import files
from martline.sources.lake import DataLake
from martline.sources.payloads import payload_rows
from tests.helpers import rows, tmpdir, write


def test_csv_edges(spark):
    d = tmpdir()
    with pytest.raises(FileNotFoundError):
        files.extract_csv(spark, f"{d}/missing.csv")
    with pytest.raises(ValueError):
        files.extract_csv(spark, write(d, "zero.csv", ""))
    head = files.extract_csv(spark, write(d, "head.csv", "a,b\n"))
    assert head.columns == ["a", "b"] and head.count() == 0
    na = files.extract_csv(spark, write(d, "na.csv", "a,b\n1,NA\n2,3\n"), null_value="NA")
    assert rows(na, "a") == [(1, None), (2, 3)]
    ragged = files.extract_csv(spark, write(d, "rag.csv", "a,b\n1,2\n3\n"), schema="a INT, b INT")
    with pytest.raises(Exception):
        ragged.collect()
    df, rep = files.extract_csv_with_validation(spark, write(d, "ok.csv", "a,b\n1,2\n"), ["a", "c"], 5)
    r = rep.first()
    assert not r.is_valid and r.rows_extracted == 1 and r.warnings == ["1 rows, not 5"]


def test_csv_matches_columns_by_header(spark):
    d = tmpdir()
    p = write(d, "o.csv", "order_id,unit_price,quantity\n1,2.5,7\n")
    df = files.extract_csv(spark, p, schema="order_id INT, quantity INT, unit_price DOUBLE")
    assert df.columns == ["order_id", "quantity", "unit_price"] and rows(df) == [(1, 7, 2.5)]
    with pytest.raises(ValueError, match="coupon"):
        files.extract_csv(spark, p, schema="order_id INT, coupon STRING")
    df, rep = files.extract_csv_with_validation(spark, p, ["order_id"], schema="quantity INT, coupon STRING")
    r = rep.first()
    assert df.columns == ["quantity"] and not r.is_valid and r.errors == ["no column coupon"]
    with pytest.raises(ValueError):
        files.extract_csv(spark, write(d, "zero.csv", ""), schema="a INT")
    write(d, "two/a.csv".replace("two/", "t_"), "a,b\n1,2\n")
    write(d, "t_b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        files.extract_csv(spark, f"{d}/t_*.csv", schema="a INT, b INT").collect()      # headers differ


def test_csv_quotes_and_line_breaks(spark):
    d = tmpdir()
    p = write(d, "q.csv", 'a,b,c\n1,"He said ""hi"", ok",2\n2,"x\ny",3\n')
    assert rows(files.extract_csv(spark, p, schema="a INT, b STRING, c INT", multiline=True), "a") == [(1, 'He said "hi", ok', 2), (2, "x\ny", 3)]
    assert rows(files.extract_csv(spark, p, multiline=True), "a")[0] == (1, 'He said "hi", ok', 2)


def test_csv_header_lines(spark):
    d = tmpdir()
    p = write(d, "h.csv", 'made by,x\n\nb,a\n1,"q, ""z"""\n2,w\n')
    assert rows(files.extract_csv(spark, write(d, "h0.csv", "a,b\n1,2\n"), header=0)) == [(1, 2)]
    assert rows(files.extract_csv(spark, p, header=2, schema="a STRING, b INT"), "b") == [('q, "z"', 1), ("w", 2)]
    got = files.extract_csv(spark, p, header=2)
    assert got.columns == ["b", "a"] and rows(got, "b") == [(1, 'q, "z"'), (2, "w")]
    none = files.extract_csv(spark, write(d, "n.csv", "1,2\n3,4\n"), header=False, schema="x INT, y INT")
    assert rows(none, "x") == [(1, 2), (3, 4)]
    with pytest.raises(ValueError):
        files.extract_csv(spark, p, header=9)


def test_json_keys_that_are_no_identifiers(spark):
    d = tmpdir()
    p = write(d, "k.json", """[{"user-id": 1, "first name": "a", "a.b": 2, "it's": {"x y": [1]}, "m": 1}, {"m": "text"}, {"m": {"o": 1}}]""")
    out = files.extract_json(spark, p)
    r = out.where("`user-id` = 1").first()
    assert (r["first name"], r["a.b"], r["it's.x y"], r["m"]) == ("a", 2, [1], "1")
    assert out.groupBy("m").count().count() == 3                     # mixed types are text, which can be grouped
    nested = write(d, "n.json", """{"the shop": {"it's": 5}, "line items": [{"unit price": 1.5}]}""")
    got = files.extract_json_nested(spark, nested, record_path="line items", meta=[["the shop", "it's"]])
    assert rows(got) == [(1.5, 5)]


def test_json_shapes(spark):
    d = tmpdir()
    arr = files.extract_json(spark, write(d, "a.json", '[{"a":1,"b":{"c":2}},{"a":3,"l":[1,2]}]'))
    assert sorted(arr.columns) == ["a", "b.c", "l"]
    assert rows(arr.select("a", "`b.c`", "l"), "a") == [(1, 2, None), (3, None, [1, 2])]
    assert files.extract_json(spark, write(d, "e.json", "[]")).count() == 0
    sc = files.extract_json(spark, write(d, "s.json", "[1,2,3]"))
    assert sc.columns == ["value"] and sc.count() == 3
    rec = files.extract_json(spark, write(d, "r.json", '{"records":[{"a":1},{"a":2}]}'))
    assert rows(rec, "a") == [(1,), (2,)]
    idx = files.extract_json(spark, write(d, "i.json", '{"x":{"a":1},"y":{"a":2}}'), orient="index")
    assert rows(idx.select("index", "a"), "index") == [("x", 1), ("y", 2)]
    one = files.extract_json(spark, write(d, "o.json", '{"a":1,"b":{"c":{"d":2}}}'))
    assert rows(one.select("a", "`b.c.d`")) == [(1, 2)]
    with pytest.raises(Exception):
        files.extract_json(spark, write(d, "bare.json", "42")).collect()
    with pytest.raises(Exception):
        files.extract_json(spark, write(d, "bad.json", '{"a":')).collect()
    with pytest.raises(FileNotFoundError):
        files.extract_json(spark, f"{d}/nope.json")


def test_json_record_path_meta(spark):
    d = tmpdir()
    doc = '{"shop":"s1","info":{"region":"EU"},"orders":[{"id":1,"lines":[{"sku":"a"},{"sku":"b"}]},{"id":2,"lines":[{"sku":"c"}]}]}'
    p = write(d, "n.json", doc)
    out = files.extract_json_nested(spark, p, record_path="orders", meta=["shop", ["info", "region"]])
    assert out.columns[-2:] == ["shop", "info.region"]
    assert rows(out.select("id", "shop", "`info.region`"), "id") == [(1, "s1", "EU"), (2, "s1", "EU")]
    deep = files.extract_json_nested(spark, p, record_path=["orders", "lines"], meta=["shop"])
    assert rows(deep, "sku") == [("a", "s1"), ("b", "s1"), ("c", "s1")]
    with pytest.raises(Exception):
        files.extract_json_nested(spark, p, record_path="nope").collect()


def test_payload_path_stops_where_it_breaks(spark):
    resp = spark.createDataFrame([
        ("u1", '{"data":{"results":[{"id":1},{"id":2}]}}'),
        ("u2", '{"data":{"nope":[1]}}'),
        ("u3", '{"data":{"results":{"id":3}}}')], "url STRING, body STRING")
    out = payload_rows(resp, "data.results", keep=["url"])
    got = {(r.url, r.path_complete) for r in out.collect()}
    assert got == {("u1", True), ("u2", False), ("u3", True)}
    assert out.where("url = 'u1'").count() == 2
    assert out.where("url = 'u2'").select("nope").first()[0] == [1]


def test_lake_latest_snapshot(spark):
    lake = DataLake(spark, tmpdir())
    df = spark.range(3).withColumn("v", F.lit("old"))
    lake.save_raw(df, "src", "csv", dt.datetime(2024, 1, 1, 0, 0, 0))
    lake.save_raw(df.withColumn("v", F.lit("new")), "src", "csv", dt.datetime(2024, 1, 2, 0, 0, 0))
    latest = lake.latest("raw", "src", "csv", schema=df.schema)
    assert {r.v for r in latest.collect()} == {"new"}
    with pytest.raises(ValueError):
        lake.save_raw(df, "src", "xml")


def test_csv_bad_encoding(spark):
    d = tmpdir()
    p = f"{d}/latin1.csv"
    with open(p, "wb") as f:
        f.write("name,city\nJos\xe9,Hu\xe9\n".encode("latin-1"))
    with pytest.raises(Exception):
        files.extract_csv(spark, p, strict_encoding=True).collect()
    ok = files.extract_csv(spark, p, encoding="iso-8859-1", strict_encoding=True).collect()
    assert ok[0].name == "José"
    _, rep = files.extract_csv_with_validation(spark, p)
    r = rep.first()
    assert not r.is_valid and "invalid in the file encoding" in r.errors[0]


def test_rows_are_written_in_two_folders_without_a_sort(spark, tmp_path):
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "IF(id % 10 = 9, null, id % 3 = 0) AS rejected")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    seen = []
    keep = df.write.__class__.parquet

    def parquet(self, *a, **k):
        seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return keep(self, *a, **k)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(df.write.__class__, "parquet", parquet)
        files._write_split(df, "rejected", str(tmp_path / "out"))
    assert seen == [3] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "out")).exceptAll(df).count() == 0
    assert len(list((tmp_path / "out").glob("rejected=*/*.parquet"))) == 3


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_lake_snapshots_are_compressed(spark, tmp_path, fmt):
    df = spark.range(0, 20_000, 1, 2).selectExpr("id", "concat('name ', id % 7) AS name")
    lake = DataLake(spark, str(tmp_path))
    path = lake.save_raw(df, "names", fmt, dt.datetime(2024, 1, 15, 9, 0, 0))
    back = lake.latest("raw", "names", fmt, schema=df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    ends = {"json": ".json.gz", "csv": ".csv.gz", "parquet": ".zstd.parquet"}[fmt]
    from pathlib import Path

    assert all(f.name.endswith(ends) for f in Path(path).glob("part-*"))
