"""File sources: CSV (S1/S2), JSON documents (S3/S5), nested JSON record paths.

A path may be a file, a directory or a glob: many files read in parallel.
CSV splits by byte range. A multi-line JSON document cannot be split, so it is
one task per file; JSON Lines (``lines=True``) splits like text. Errors that
need the data (malformed rows with ``mode='FAILFAST'``) surface when the
DataFrame is evaluated, not at definition time.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from martline.functions import json as J

log = logging.getLogger(__name__)


def _not_found(e: Exception) -> bool:
    text = str(e)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


REPLACEMENT = "\ufffd"  # what the decoder substitutes for bytes invalid in ``encoding``


def _string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def undecodable(df: DataFrame) -> F.Column:
    """TRUE for a row where some text column holds the decoder's replacement character."""
    cond = F.lit(False)
    for c in _string_cols(df):
        cond = cond | F.coalesce(F.instr(F.col(f"`{c}`"), REPLACEMENT) > 0, F.lit(False))
    return cond


def csv_header(spark: SparkSession, path: str, encoding: str = "utf-8", delimiter: str = ",", header: bool | int = True, **options) -> list[str]:
    """Column names of the header line (of the first file); none for files of no bytes."""
    if header is not True and header != 0:
        line = _numbered(spark, path, encoding, int(header)).where(F.col("number") == int(header)).first()
        return [] if line is None else _parse_header(spark, line.value, delimiter, options)
    try:
        return spark.read.options(**_csv_options(encoding, delimiter, True, options)).csv(path).columns
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no CSV file at {path}") from e
        raise


def _csv_options(encoding: str, delimiter: str, header: bool, options: dict) -> dict:
    return {"header": header, "sep": delimiter, "encoding": encoding, "escape": '"'} | options


def _inferred(spark: SparkSession, reader: DataFrameReader, lines: DataFrame) -> DataFrame:
    """CSV lines with inferred types (the JVM's reader takes them as a typed dataset)."""
    return DataFrame(reader._jreader.csv(getattr(lines._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())), spark)


def _parse_header(spark: SparkSession, line: str, delimiter: str, options: dict) -> list[str]:
    return spark.read.options(**_csv_options("utf-8", delimiter, True, options)).csv(spark.sparkContext.parallelize([line], 1)).columns


def _lines(spark: SparkSession, path: str, encoding: str, **more) -> DataFrame:  # noqa: ANN003
    try:
        lines = spark.read.options(encoding=encoding, **more).text(path)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no CSV file at {path}") from e
        raise
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _numbered(spark: SparkSession, path: str, encoding: str, upto: int) -> DataFrame:
    """Lines with their number from 0 in their file up to ``upto``; others have null.

    Only the block that begins a file holds its first lines, which a task reads in order: the numbers that tasks give to rows rise
    through a file, so a line's place is its number less the file's smallest. Few lines are ranked: those with the smallest numbers of
    each file."""
    lines = _lines(spark, path, encoding).withColumn("row", F.monotonically_increasing_id())
    first = lines.where("start = 0").groupBy("file").agg(F.min("row").alias("first"))
    return lines.join(first, "file").select("value", F.when((F.col("start") == 0) & (F.col("row") - F.col("first") <= upto),
                                                                         F.col("row") - F.col("first")).alias("number"))


def extract_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                encoding: str = "utf-8", delimiter: str = ",", header: bool | int = True,
                null_value: str | None = None, mode: str = "FAILFAST", strict_encoding: bool = False,
                multiline: bool = False, absent: str = "error", **options) -> DataFrame:
    """CSV -> DataFrame. Missing path -> FileNotFoundError; zero-byte file (no
    columns) -> ValueError; header-only -> empty frame with the header's columns.
    Without ``schema`` the types are inferred (one extra pass; give a schema at scale). With a schema and a header,
    columns are matched by name: the result has the schema's columns in its order, whatever the file's order, and
    columns that the header lacks are an error (or left out with ``absent="skip"``). All files must have the same header.
    ``header``: True or 0 for the first line, n for the line after n others (which are passed over; fields may then hold no
    line breaks), False for none. Quotes in quoted fields are doubled; ``multiline`` allows line breaks in
    them (a file is then one task). ``strict_encoding=True`` makes a row with bytes invalid in ``encoding`` an
    error when evaluated (Spark's decoder otherwise substitutes U+FFFD)."""
    first = header is True or (header is not False and header == 0)
    names = csv_header(spark, path, encoding, delimiter, header, **options) if header is not False else None
    if names is not None and not names:
        raise ValueError(f"no columns in {path}")
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    as_read = wanted
    if wanted is not None and names is not None:
        lacking = [f.name for f in wanted if f.name not in names]
        if lacking and absent == "error":
            raise ValueError(f"the header of {path} has no {', '.join(lacking)}")
        kinds = {f.name: f.dataType for f in wanted}
        as_read = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    opts = _csv_options(encoding, delimiter, first, options) | {"mode": mode, "multiLine": multiline}
    if null_value is not None:
        opts["nullValue"] = null_value
    if as_read is not None:
        reader = spark.read.schema(as_read).options(**opts, enforceSchema=names is None or not first)
    else:
        reader = spark.read.options(**opts, inferSchema=True)
    try:
        if names is not None and not first:
            body = _numbered(spark, path, encoding, int(header)).where("number is null").select("value")
            df = _inferred(spark, reader, body) if as_read is None else body.where("value <> ''").select(
                F.from_csv("value", J.ddl(as_read)[len("struct<"):-1].replace("`: ", "` "), {k: str(v) for k, v in opts.items() if k not in ("header", "multiLine", "encoding")}).alias("r")).select("r.*")
            df = df.toDF(*names)
        else:
            df = reader.csv(path)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no CSV file at {path}") from e
        raise
    if not df.columns:
        raise ValueError(f"no columns in {path}")
    if wanted is not None and names is not None:
        df = df.select(*[F.col(J._q(f.name)) for f in wanted if f.name in names])
    if strict_encoding and _string_cols(df):
        bad = undecodable(df)
        df = df.where(F.when(bad, F.raise_error(F.lit(f"{path} holds bytes that are not valid {encoding}")))
                       .otherwise(F.lit(True)))
    return df


@dataclass
class CsvScan:
    """Rows that fit the schema; lines that don't, as (file, block, line, reason, fields); how many of each."""

    good: DataFrame
    rejects: DataFrame
    n_good: int
    n_rejects: int


def _write_split(df: DataFrame, flag: str, out: str) -> None:
    """Rows in two folders by a boolean. A task keeps both files open, where Spark would else sort all its rows by the folder."""
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, "0")
    conf.set(name, str(max(3, int(before))))  # true, false, null
    try:
        df.write.partitionBy(flag).parquet(out)
    finally:
        conf.set(name, before)


def extract_csv_rejects(spark: SparkSession, path: str, schema: T.StructType | str, out: str, encoding: str = "utf-8", delimiter: str = ",",
                        header: bool = True, null_value: str | None = None, **options) -> CsvScan:
    """S1 for files with bad lines: the good rows are kept, the others go to a quarantine. One pass: files are parsed once, and good and bad
    rows written side by side below ``out`` (a folder of this scan's own, partitioned by ``rejected``), from where both are read.

    A line is rejected if it has more or fewer fields than the header (without a header: than the schema), reason ``fields``, or if some
    field is not of its type, reason ``type`` with the columns' names. ``block`` is where in the file the line's split begins. Columns
    are matched by name as in ``extract_csv``; files must not break lines within quotes."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = csv_header(spark, path, encoding, delimiter, True, **options) if header else wanted.names
    if not names:
        raise ValueError(f"no columns in {path}")
    lacking = [c for c in wanted.names if c not in names]
    if lacking:
        raise ValueError(f"the header of {path} has no {', '.join(lacking)}")
    kinds = {f.name: f.dataType for f in wanted}
    as_text = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("__line", T.StringType())])
    as_read = T.StructType([*(T.StructField(n, kinds.get(n, T.StringType())) for n in names), as_text["__line"]])
    # a parser that skips columns would not see that fields are missing
    opts = _csv_options(encoding, delimiter, header, options) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__line", "columnPruning": False}
    if null_value is not None:
        opts["nullValue"] = null_value
    try:
        df = spark.read.schema(as_read).options(**opts, enforceSchema=not header).csv(path)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no CSV file at {path}") from e
        raise
    again = F.from_csv("__line", J.ddl(as_text)[len("struct<"):-1].replace("`: ", "` "),
                       {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in opts.items() if k not in ("header", "encoding")})
    untyped = [F.when(F.col("__text").getField(n).isNotNull() & F.col(J._q(n)).isNull(), F.lit(n)) for n in names if not isinstance(kinds.get(n, as_text[n].dataType), T.StringType)]
    bad = F.col("__line").isNotNull()
    df = (df.withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start")})
          .withColumn("__text", F.when(bad, again))
          .withColumn("__reason", F.when(bad, F.when(F.col("__text").getField("__line").isNotNull(), "fields").otherwise("type")))
          .withColumn("__fields", F.when(F.col("__reason") == "type", F.array_compact(F.array(*untyped)) if untyped else F.array().cast("array<string>"))))
    seen = Observation(f"scan_{uuid.uuid4().hex[:8]}")
    kept = [F.col(J._q(n)) for n in wanted.names]
    df = df.select(*kept, "__file", "__block", "__line", "__reason", "__fields", bad.alias("rejected")).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("bad"))
    _write_split(df, "rejected", out)
    both = spark.read.schema(df.schema).parquet(out)
    n, n_bad = int(seen.get["rows"]), int(seen.get["bad"])
    rejects = both.where("rejected").select(F.col("__file").alias("file"), F.col("__block").alias("block"), F.col("__line").alias("line"),
                                            F.col("__reason").alias("reason"), F.col("__fields").alias("fields"))
    return CsvScan(both.where("not rejected").select(*kept), rejects, n - n_bad, n_bad)


def scan_report(df: DataFrame, path: str, required_columns: Sequence[str] | None = None, expected_rows: int | None = None,
                available: Sequence[str] | None = None, rejected: int = 0) -> DataFrame:
    """One-row report - rows_extracted (one aggregate), columns_found,
    is_valid (missing required columns = error), errors, warnings (count mismatch, lines that a scan rejected). ``available``: the file's
    columns, where ``df`` has only some of them."""
    missing = sorted(set(required_columns or []) - set(df.columns if available is None else available))
    errors = [f"no column {c}" for c in missing]
    rows = F.count(F.lit(1))
    warn = (F.when(rows != F.lit(expected_rows),
                   F.array(F.concat(rows.cast("string"), F.lit(f" rows, not {expected_rows}"))))
            .otherwise(F.array().cast("array<string>"))) if expected_rows is not None \
        else F.array().cast("array<string>")
    bad = F.sum(F.when(undecodable(df), 1).otherwise(0))
    enc = F.when(F.coalesce(bad, F.lit(0)) > 0,
                 F.array(F.concat(F.coalesce(bad, F.lit(0)).cast("string"),
                                  F.lit(" rows hold bytes invalid in the file encoding"))))\
        .otherwise(F.array().cast("array<string>"))
    return df.agg(F.lit(path).alias("file_path"), rows.alias("rows_extracted"),
                  F.array(*[F.lit(c) for c in df.columns]).cast("array<string>").alias("columns_found"),
                  (F.lit(not errors) & (F.coalesce(bad, F.lit(0)) == 0)).alias("is_valid"),
                  F.concat(F.array(*[F.lit(e) for e in errors]).cast("array<string>"), enc).alias("errors"),
                  (F.concat(warn, F.array(F.lit(f"{rejected} lines rejected"))) if rejected else warn).alias("warnings"))


def extract_csv_with_validation(spark: SparkSession, path: str, required_columns: Sequence[str] | None = None,
                                expected_rows: int | None = None, rejects_to: str | None = None, **kwargs) -> tuple[DataFrame, DataFrame]:
    """The rows and their report; columns of a schema that the header lacks are reported, not read. With ``rejects_to`` (a folder
    for the scan's rows, see ``extract_csv_rejects``) bad lines don't fail the scan: the report counts them."""
    if rejects_to is not None:
        scan = extract_csv_rejects(spark, path, out=rejects_to, **kwargs)
        return scan.good, scan_report(scan.good, path, required_columns, expected_rows, rejected=scan.n_rejects)
    schema = kwargs.get("schema")
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    df = extract_csv(spark, path, **({"absent": "skip"} | kwargs))
    needed = [*(required_columns or []), *(wanted.names if wanted is not None else [])]
    how = {k: v for k, v in kwargs.items() if k in ("encoding", "delimiter", "header")}
    names = csv_header(spark, path, **how) if how.get("header", True) is not False else df.columns  # what the file has
    return df, scan_report(df, path, list(dict.fromkeys(needed)), expected_rows, names)


def _documents(spark: SparkSession, path: str, lines: bool, encoding: str) -> DataFrame:
    try:
        if lines:
            text = spark.read.option("encoding", encoding).text(path)
            text = text.where(F.length(F.trim("value")) > 0)
        else:
            text = spark.read.option("encoding", encoding).text(path, wholetext=True)
    except AnalysisException as e:
        if _not_found(e):
            raise FileNotFoundError(f"no JSON file at {path}") from e
        raise
    return text.select(F.parse_json("value").alias("__doc"))


def extract_json(spark: SparkSession, path: str, orient: str = "records", lines: bool = False,
                 encoding: str = "utf-8", schema: T.StructType | None = None) -> DataFrame:
    """S3: JSON document(s) -> rows, nested objects flattened to dotted columns.

    array of objects -> one row each; array of scalars -> one ``value`` column;
    ``{"records": [...]}`` (orient='records') -> the records; dict of objects
    with orient='index' -> one row per key (``index`` column + fields); single
    object -> one row; ``[]`` -> empty frame; top-level scalar or malformed
    text -> error when evaluated.
    """
    docs = _documents(spark, path, lines, encoding)
    recs = docs.select(F.explode(J.rows_of(F.col("__doc"), orient)).alias("__rec"))
    out = J.records_to_frame(recs, "__rec", schema=schema)
    if orient == "index" and "index" in out.columns:
        rename = {c: c[len("value."):] for c in out.columns if c.startswith("value.")}
        out = out.select(*[F.col(J._q(c)).alias(rename.get(c, c)) for c in out.columns])
    return out


def extract_json_nested(spark: SparkSession, path: str, record_path: str | Sequence[str] | None = None,
                        meta: Sequence[str | Sequence[str]] | None = None, lines: bool = False,
                        encoding: str = "utf-8") -> DataFrame:
    """One row per element under ``record_path`` (a key or a list of keys
    walked level by level), with ``meta`` fields of the top-level record
    repeated on each row (columns after the record's own). A missing record
    path is an error."""
    docs = _documents(spark, path, lines, encoding)
    tops = docs.select(F.explode(J.rows_of(F.col("__doc"), orient="none")).alias("__top"))
    if not record_path:
        return J.records_to_frame(tops, "__top")
    steps = [record_path] if isinstance(record_path, str) else list(record_path)
    metas = [[m] if isinstance(m, str) else list(m) for m in (meta or [])]
    meta_cols = [F.variant_get(F.col("__top"), J.path_of(m), "variant").alias(f"__m{i}")
                 for i, m in enumerate(metas)]
    cur = tops.select(F.col("__top").alias("__rec"), *meta_cols)
    keep = [f"__m{i}" for i in range(len(metas))]
    for s in steps:
        arr = F.try_variant_get(F.col("__rec"), J.path_of([s]), "array<variant>")
        arr = F.when(arr.isNull(), F.raise_error(F.lit(f"record path not found: {s}")).cast("array<variant>")) \
               .otherwise(arr)
        cur = cur.select(F.explode(arr).alias("__rec"), *keep)
    types = J.infer_schemas(cur, ["__rec"] + keep)   # one pass for the record and every meta field
    out = J.records_to_frame(cur, "__rec", keep=keep, schema=types["__rec"]) if types["__rec"] is not None \
        else cur.select(*keep)
    for i, m in enumerate(metas):
        name, dt = ".".join(m), types[f"__m{i}"]
        out = out.withColumn(name, F.variant_get(F.col(f"__m{i}"), "$", J.ddl(dt)) if dt
                             else F.lit(None)).drop(f"__m{i}")
    return out


def extract_json_with_validation(spark: SparkSession, path: str, required_fields: Sequence[str] | None = None,
                                 expected_count: int | None = None, **kwargs) -> tuple[DataFrame, DataFrame]:
    """As S2 for JSON."""
    df = extract_json(spark, path, **kwargs)
    return df, scan_report(df, path, required_fields, expected_count)
