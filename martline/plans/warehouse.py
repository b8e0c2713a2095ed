"""Star-schema warehouse on versioned parquet directories (K3-K11, §2.14 audit).

``<root>/<table>/v=<n>/load=<id>/`` holds one load of version n. A load becomes visible by its
audit row: readers take only the load folders that the audit names, so a load that broke off is never seen
and its replay (same id) overwrites what it left. An append adds a load to the current version;
replace and upsert write the only load of version n+1. The audit row keeps the table's columns and partition columns: a
load that doesn't fit them is refused before anything is written, and readers never ask files for a schema.
Small loads are merged into one that names those it replaces (``merge_small``).

A table may be bucketed by its keys (Spark's own bucketing, ``bucketBy``): its files are read, joined and merged without
a shuffle.

``<root>/_audit`` has one row a load (table, version, operation, load, rows, watermark, ...), numbered in
sequence by the writer (one writer at a time); every ``COMPACT``-th row all rows are written together, so a reader
opens one folder and at most that many small files. Row counts and watermarks come from ``Observation``
on the write itself.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import logging
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.plans import marts

log = logging.getLogger(__name__)

# The star schema of the warehouse (keys widened to BIGINT).
STAR_DDL = {
    "dim_customers": "customer_id BIGINT NOT NULL, customer_name VARCHAR(255) NOT NULL, email VARCHAR(255), "
                     "city VARCHAR(100), country VARCHAR(100), created_at TIMESTAMP",
    "dim_products": "product_id BIGINT NOT NULL, product_name VARCHAR(255) NOT NULL, category VARCHAR(100), "
                    "brand VARCHAR(100), price DECIMAL(10,2), created_at TIMESTAMP",
    "dim_date": "date_id INT NOT NULL, date DATE NOT NULL, year INT, quarter INT, month INT, week INT, "
                "day_of_week INT, created_at TIMESTAMP",
    "fact_sales": "sale_id BIGINT NOT NULL, customer_id BIGINT, product_id BIGINT, date_id INT, "
                  "quantity INT NOT NULL, unit_price DECIMAL(10,2) NOT NULL, total_amount DECIMAL(10,2) NOT NULL, "
                  "discount DECIMAL(10,2), created_at TIMESTAMP_NTZ",
}
# Drop order respects the foreign keys (fact first).
DROP_ORDER = ["fact_sales", "dim_date", "dim_products", "dim_customers"]

#: Column that takes the time of loading when a load leaves it out.
LOADED_AT = "created_at"

AUDIT_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("table_name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("operation", T.StringType()), T.StructField("load", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("loaded_at", T.TimestampType()), T.StructField("layout", T.StringType()),
    T.StructField("watermark_column", T.StringType()),
    T.StructField("watermark", T.StringType()), T.StructField("watermark_type", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("columns", T.StringType()),  # the table's schema (JSON)
    T.StructField("partition_by", T.ArrayType(T.StringType())),
    T.StructField("high", T.MapType(T.StringType(), T.StringType())),  # largest values observed on the write
    T.StructField("replaces", T.ArrayType(T.StringType())),  # loads whose rows this one holds
    T.StructField("reads", T.ArrayType(T.StringType()))])  # what the load was made from, for lineage
#: Operations after which nothing of the table from before is read.
STARTS = ("create", "replace", "rewrite", "drop")
#: Audit rows after which all are written together.
COMPACT = 50

LOAD = "__load"


def _load_id(batch_id: str | None = None) -> str:
    """Folder name of a load (never only digits, so a reader takes it for text)."""
    return "l" + (uuid.uuid4().hex if batch_id is None else hashlib.sha256(batch_id.encode()).hexdigest()[:32])


#: (type of a load's column, type of the table's): numbers that a load may have narrower.
WIDENED = {(a, b) for kinds in (("tinyint", "smallint", "int", "bigint"), ("float", "double")) for i, a in enumerate(kinds) for b in kinds[i + 1 :]}


def _bucketing(layout: str | None) -> tuple[list[str], int] | None:
    if not layout:
        return None
    _, n, keys = layout.split(":", 2)
    return keys.split(","), int(n)


def create_table_sql(table: str, location: str) -> str:
    """K9 as catalog DDL (for sessions that keep a metastore), with the default load time."""
    columns = re.sub(rf"({LOADED_AT} TIMESTAMP)\b(?!_)", r"\1 DEFAULT CURRENT_TIMESTAMP", STAR_DDL[table])
    columns = re.sub(rf"({LOADED_AT} TIMESTAMP_NTZ)", r"\1 DEFAULT LOCALTIMESTAMP", columns)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{location}'"


def merge_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                 update_columns: Sequence[str] | None = None,
                 order_by: Sequence[str] | None = None,
                 only_if_newer: Sequence[str] | None = None,
                 insert_defaults: dict[str, Column] | None = None) -> DataFrame:
    """K4 as a pure DataFrame: new keys inserted, existing keys get the batch
    values of ``update_columns`` (default: every non-key batch column), other
    target columns keep their value. Duplicate keys in the batch: the last in
    ``order_by`` wins (order columns may be batch-only; they are not written).
    Without ``order_by`` duplicates resolve to the greatest row (deterministic).
    All columns being keys gives insert-if-absent. ``only_if_newer`` (columns
    stored in both) updates an existing key only when the batch row is not
    older - what a stream needs when a late micro-batch carries old rows.
    ``insert_defaults`` gives inserted rows a value in columns that the batch lacks."""
    keys = list(keys)
    order = list(order_by or [])
    data_cols = [c for c in batch.columns if c not in order or c in target.columns]
    extra = [c for c in data_cols if c not in target.columns]
    if extra:
        raise ValueError(f"batch columns not in target: {extra}")
    for k in keys:
        if k not in batch.columns or k not in target.columns:
            raise ValueError(f"conflict column {k!r} must be in target and batch")
    vals = [c for c in data_cols if c not in keys]
    upd = [c for c in (update_columns if update_columns is not None else vals) if c in vals]
    rank = F.struct(*[F.col(c) for c in order]) if order else F.struct(*[F.col(c) for c in vals or keys])
    if vals:
        b = batch.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in vals]), rank).alias("__b"))
    else:
        b = batch.select(*keys).distinct().withColumn("__b", F.lit(True))
    b = b.withColumn("__in_b", F.lit(True))
    t = target.withColumn("__in_t", F.lit(True))
    j = t.join(b, keys, "full_outer")
    take_b = F.col("__in_b")
    if only_if_newer:
        newer = F.struct(*[F.col(f"__b.{c}") for c in only_if_newer]) >= F.struct(*[F.col(c) for c in only_if_newer])
        take_b = take_b & (F.col("__in_t").isNull() | F.coalesce(newer, F.lit(True)))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(take_b, F.col(f"__b.{c}")).otherwise(F.col(c)).alias(c))
        elif c in vals:
            out.append(F.when(F.col("__in_t"), F.col(c)).otherwise(F.col(f"__b.{c}")).alias(c))
        elif c in (insert_defaults or {}):
            out.append(F.when(F.col("__in_t"), F.col(c)).otherwise(insert_defaults[c]).alias(c))
        else:
            out.append(F.col(c))
    return j.select(out)


def incremental_rows(df: DataFrame, timestamp_column: str, last_load_timestamp) -> DataFrame:
    """K5 filter: rows strictly newer than the watermark; no watermark -> all rows;
    missing column -> all rows (with a warning). NULL timestamps never pass a watermark."""
    if timestamp_column not in df.columns:
        log.warning("timestamp column %r not found; loading all rows", timestamp_column)
        return df
    if last_load_timestamp is None:
        return df
    return df.where(F.col(timestamp_column) > F.lit(last_load_timestamp))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._rows: list | None = None  # audit rows since each table's last rewrite, and the last of dropped ones
        self._seq = 0
        self.last_metrics: dict = {}

    # ---- audit -----------------------------------------------------------------
    def _audit_base(self) -> tuple[int, list[str]]:
        """Number of the newest collected audit folder, and the audit folders that matter."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_audit")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        done = [n for n in names if n.startswith("base=") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_audit/{n}/_SUCCESS"))]
        base = max((int(n[5:]) for n in done), default=0)
        return base, [f"{self.root}/_audit/{n}" for n in (f"base={base}", f"after={base}") if n in names]

    def audit(self) -> DataFrame:
        """All audit rows, one a load; a row that was written twice (a retried driver) counts once."""
        _, paths = self._audit_base()
        if not paths:
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(*paths).dropDuplicates(["seq"])

    def _record(self, table: str, version: int, operation: str, rows: int, load: str | None = None, **more) -> None:  # noqa: ANN003
        self._state()
        base, _ = self._audit_base()
        self._seq += 1
        values = {"seq": self._seq, "table_name": table, "version": version, "operation": operation, "load": load, "rows": rows,
                  "loaded_at": dt.datetime.now(dt.timezone.utc)} | more
        row = Row(*AUDIT_SCHEMA.names)(*[values.get(c) for c in AUDIT_SCHEMA.names])
        self.spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/_audit/after={base}")
        self._rows.append(row)
        if self._seq - base >= COMPACT:
            self.audit().coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_audit/base={self._seq}")

    def refresh(self) -> None:
        """Read the audit again."""
        self._rows = None

    def _state(self) -> list:
        """Audit rows of live loads from each table's last rewrite on, in sequence; of dropped tables the drop."""
        if self._rows is None:
            a = self.audit()
            last = a.where(F.col("operation").isin(*STARTS)).groupBy("table_name").agg(F.max("seq").alias("from"))
            gone = a.select("table_name", F.explode("replaces").alias("load"))
            self._rows = (a.join(last, "table_name").where("seq >= from").join(gone, ["table_name", "load"], "left_anti")
                          .select(*AUDIT_SCHEMA.names).orderBy("seq").collect())
            self._seq = a.agg(F.max("seq")).first()[0] or 0
        return self._rows

    def _chain(self, table: str) -> list:
        """Rows of a table's live loads since its last rewrite; none if it doesn't exist."""
        rows = [r for r in self._state() if r.table_name == table]
        start = max((i for i, r in enumerate(rows) if r.operation in STARTS), default=0)
        rows = rows[start:]
        gone = {x for r in rows for x in r.replaces or ()}
        return [] if not rows or rows[0].operation == "drop" else [r for r in rows if r.load not in gone]

    def _next_version(self, table: str) -> int:
        """Versions only grow, also across drop and re-create (old folders are never reused)."""
        return max((r.version for r in self._state() if r.table_name == table), default=-1) + 1

    def version(self, table: str) -> int | None:
        """Current version of ``table``, None if it doesn't exist."""
        chain = self._chain(table)
        return chain[-1].version if chain else None

    def exists(self, table: str) -> bool:
        return bool(self._chain(table))

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version:06d}"

    def _layout(self, table: str) -> tuple[list[str], int] | None:
        """(keys, number of buckets) of a bucketed table."""
        chain = self._chain(table)
        return _bucketing(chain[0].layout) if chain else None

    def schema(self, table: str) -> T.StructType:
        """Columns of a table, from the audit."""
        return T.StructType.fromJson(json.loads(self._chain(table)[-1].columns))

    def read(self, table: str) -> DataFrame:
        """The table's live rows: those of the loads that the audit names."""
        chain = self._chain(table)
        if not chain:
            raise ValueError(f"table {table} not found in warehouse {self.root}")
        schema, out = self.schema(table), None
        if chain[0].layout:  # the loads appended to a bucketed one are plain
            out = self._bucketed(chain[0], schema)
            chain = chain[1:]
        if chain:
            folders = [f"{self.path(table, r.version)}/{LOAD}={r.load}" for r in chain]
            plain = self.spark.read.schema(schema).option("basePath", self.path(table, chain[0].version)).parquet(*folders).select(*[F.col(f"`{c}`") for c in schema.names])
            out = plain if out is None else out.unionByName(plain)
        return out

    def _bucketed(self, row: Row, schema: T.StructType) -> DataFrame:
        """Files of a bucketed load with their bucketing, which only a catalog table can tell Spark."""
        keys, n = _bucketing(row.layout)
        name, by = f"martline_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS "
                       f"LOCATION '{self.path(row.table_name, row.version)}/{LOAD}={row.load}'")
        df = self.spark.table(name)
        df.schema  # noqa: B018  the plan is resolved while the name is there
        self.spark.sql(f"DROP TABLE {name}")  # files of a table with a location stay
        return df

    # ---- writing --------------------------------------------------------------------
    def _publish(self, df: DataFrame, table: str, version: int, operation: str, watermark_column: str | None = None,
                 batch_id: str | None = None, partition_by: Sequence[str] | None = None, layout: str | None = None,
                 record_empty: bool = True, high: Sequence[str] = (), **more) -> int:  # noqa: ANN003
        """Write one load folder, then name it in the audit. A batch's folder is called after the batch, so a
        replay replaces what an earlier attempt wrote. Rows, watermark and largest values are observed on the write."""
        load = _load_id(batch_id)
        rows = self._write(df, table, version, load, watermark_column, partition_by, layout, high)
        if rows or record_empty:
            wm_col = watermark_column if watermark_column in df.columns else None
            top = {c: self.last_metrics.get(f"high_{c}") for c in high if self.last_metrics.get(f"high_{c}") is not None}
            self._record(table, version, operation, rows, load, layout=layout, watermark_column=wm_col, watermark=self.last_metrics.get("wm"),
                         watermark_type=df.schema[wm_col].dataType.simpleString() if wm_col else None, batch_id=batch_id,
                         columns=df.schema.json(), partition_by=list(partition_by or []) or None, high=top or None, **more)
        return rows

    def _write(self, df: DataFrame, table: str, version: int, load: str, watermark_column: str | None = None,
               partition_by: Sequence[str] | None = None, layout: str | None = None, high: Sequence[str] = ()) -> int:
        obs = Observation(f"load_{table}_{load}_{uuid.uuid4().hex[:8]}")
        metrics = [F.count(F.lit(1)).alias("rows"), *(F.max(c).cast("string").alias(f"high_{c}") for c in high if c in df.columns)]
        if watermark_column and watermark_column in df.columns:
            metrics.append(F.max(F.col(watermark_column)).cast("string").alias("wm"))
        folder = f"{self.path(table, version)}/{LOAD}={load}"
        w = df.observe(obs, *metrics).write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        if layout:
            keys, n = _bucketing(layout)
            gone = self.spark._jvm.org.apache.hadoop.fs.Path(folder)  # of an attempt that broke off
            gone.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(gone, True)
            name = f"martline_{uuid.uuid4().hex}"
            w.bucketBy(n, *keys).sortBy(*keys).option("path", folder).format("parquet").saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
        else:
            (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
        self.last_metrics = obs.get
        return int(self.last_metrics["rows"])

    def _fitted(self, df: DataFrame, table: str) -> DataFrame:
        """Rows in the table's columns: absent ones null, narrower whole and floating numbers widened. Columns that the table lacks and
        other types are refused."""
        schema = self.schema(table)
        own = {f.name: f.dataType for f in df.schema}
        extra = [c for c in own if c not in schema.names]
        other = [f"{f.name} is {f.dataType.simpleString()}, not {own[f.name].simpleString()}" for f in schema
                 if f.name in own and own[f.name] != f.dataType and (own[f.name].simpleString(), f.dataType.simpleString()) not in WIDENED]
        if extra or other:
            raise ValueError(f"load doesn't fit table {table}: " + "; ".join([f"no column {c}" for c in extra] + other))
        return df.select(*[(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def _with_load_time(self, df: DataFrame, table: str) -> DataFrame:
        """The DDL's default: a load into a star table that leaves the load time out gets the time of loading."""
        return df.withColumn(LOADED_AT, self._defaults(table)[LOADED_AT]) if LOADED_AT not in df.columns and self._defaults(table) else df

    def _defaults(self, table: str) -> dict[str, Column]:
        if table not in STAR_DDL or not self.exists(table):
            return {}
        field = next((f for f in self.schema(table) if f.name == LOADED_AT), None)
        return {LOADED_AT: F.current_timestamp().cast(field.dataType)} if field else {}

    # ---- DDL ------------------------------------------------------------------------
    def create_star_schema(self) -> list[str]:
        """K9: create the four tables empty if absent."""
        made = []
        for t, ddl in STAR_DDL.items():
            if not self.exists(t):
                # parquet files carry STRING; VARCHAR(n) lengths are checked by type_bounds
                ddl_types = re.sub(r"VARCHAR\(\d+\)", "STRING", ddl.replace(" NOT NULL", ""))
                self._publish(self.spark.createDataFrame([], T.DataType.fromDDL(ddl_types)), t, self._next_version(t), "create")
                made.append(t)
        return made

    def drop_star_schema(self) -> None:
        """Drop in foreign-key order (the audit keeps the history)."""
        for t in DROP_ORDER:
            if self.exists(t):
                self._record(t, self.version(t), "drop", 0)

    def create_bucketed(self, df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> dict:
        """Create ``table`` with its rows in ``buckets`` sorted files by the hash of ``keys`` (choose ``buckets`` so that one holds
        about 128-512 MB)."""
        if self.exists(table):
            raise ValueError(f"table {table} already exists")
        rows = self._publish(df.repartition(buckets, *keys), table, self._next_version(table), "create", layout=f"bucketed:{buckets}:{','.join(keys)}")
        return {"rows_loaded": rows, "status": "success", "table": table}

    # ---- loads --------------------------------------------------------------------------
    def load(self, df: DataFrame, table: str, if_exists: str = "append", watermark_column: str | None = None,
             batch_id: str | None = None, partition_by: Sequence[str] | None = None, high: Sequence[str] = (), reads: Sequence[str] = ()) -> dict:
        """K3: fail / replace / append; an empty frame is skipped. ``batch_id`` makes a load replay-safe: a batch that the
        table holds (``has_batch``) is not loaded again, one that broke off before is written over.
        ``watermark_column`` records the load's high-watermark for K6, ``high`` the largest values of columns (``largest``).
        ``partition_by`` writes Hive-style partition folders (e.g. a date key) for pruning; appends keep the table's, which a
        table that is still empty takes over. An append whose columns or types don't fit the table is refused. ``reads`` names
        what the rows were made from (tables or paths)."""
        if if_exists not in ("fail", "replace", "append"):
            raise ValueError("if_exists must be 'fail', 'replace' or 'append'")
        if batch_id is not None and self.has_batch(table, batch_id):
            return {"rows_loaded": 0, "status": "duplicate_batch"}
        exists = self.exists(table)
        if exists and if_exists == "fail":
            raise ValueError(f"table {table} already exists")
        # One pass: write, then look at the observed count; an empty load is not named in the audit.
        kw = {"watermark_column": watermark_column, "batch_id": batch_id, "record_empty": False, "high": high, "reads": list(reads) or None}
        df = self._with_load_time(df, table)
        if exists and if_exists == "append":
            chain, df = self._chain(table), self._fitted(df, table)
            laid, wanted = list(chain[0].partition_by or []), list(partition_by or [])
            if wanted and wanted != laid:
                if any(r.rows for r in chain):
                    raise ValueError(f"table {table} is partitioned by {laid}, not by {wanted}")
                rows = self._publish(df, table, self._next_version(table), "rewrite", partition_by=wanted, **kw)  # still empty: laid out anew
            else:
                rows = self._publish(df, table, self.version(table), "append", partition_by=laid, **kw)
        else:
            layout = self._chain(table)[0].layout if exists else None
            if layout:
                keys, n = _bucketing(layout)
                df = df.repartition(n, *keys)
            rows = self._publish(df, table, self._next_version(table), "replace" if exists else "create", partition_by=partition_by, layout=layout, **kw)
        if rows == 0:
            return {"rows_loaded": 0, "status": "skipped"}
        return {"rows_loaded": rows, "status": "success", "table": table}

    def has_batch(self, table: str, batch_id: str) -> bool:
        """Whether the table holds the batch: the audit names it, and the table was not dropped or replaced since. (A batch that a
        replace took away may be loaded again; compaction and upserts keep what was loaded.)"""
        a = self.audit().where(F.col("table_name") == table)
        since = a.where(F.col("operation").isin("create", "replace", "drop")).agg(F.max("seq")).first()[0] or 0
        return not a.where((F.col("seq") >= since) & (F.col("batch_id") == batch_id)).isEmpty()

    def upsert(self, df: DataFrame, table: str, conflict_columns: Sequence[str],
               update_columns: Sequence[str] | None = None, order_by: Sequence[str] | None = None,
               only_if_newer: Sequence[str] | None = None, reads: Sequence[str] = ()) -> dict:
        """K4: merge and publish the merged table as a new version. The batch is read once: its rows are counted while it is
        merged, and an empty batch is not published. A table that is bucketed by the conflict columns is merged
        bucket by bucket: only the batch is shuffled."""
        seen = Observation(f"upsert_{table}_{uuid.uuid4().hex[:8]}")
        order, newer = list(order_by or []), list(only_if_newer or [])
        if not self.exists(table):  # first load: the deduplicated batch becomes the table
            empty = df.limit(0).select(*[c for c in df.columns if c not in order or c in conflict_columns or c in newer])
            rows = self._publish(merge_upsert(empty, df, conflict_columns, update_columns, order_by, only_if_newer), table,
                                 self._next_version(table), "create", record_empty=False, reads=list(reads) or None)
            return {"rows_upserted": rows, "status": "success", "table": table} if rows else {"rows_upserted": 0, "status": "skipped"}
        first, schema = self._chain(table)[0], self.schema(table)
        target = self.read(table)
        layout = _bucketing(first.layout)
        batch = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if layout and layout[0] == list(conflict_columns):
            batch = batch.repartition(layout[1], *layout[0])  # as the table's buckets are: its only shuffle
        merged = merge_upsert(target, batch, conflict_columns, update_columns, order_by, only_if_newer, self._defaults(table))
        merged = merged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        if layout and (layout[0] != list(conflict_columns) or self.loads(table) > 1):
            merged = merged.repartition(layout[1], *layout[0])
        version, load = self._next_version(table), _load_id()
        rows = self._write(merged, table, version, load, partition_by=first.partition_by, layout=first.layout)
        if not int(seen.get["rows"]):
            return {"rows_upserted": 0, "status": "skipped"}  # the written folder is named nowhere
        self._record(table, version, "rewrite", rows, load, layout=first.layout, partition_by=first.partition_by, columns=merged.schema.json(),
                     reads=list(reads) or None)
        return {"rows_upserted": rows, "status": "success", "table": table}

    def loads(self, table: str) -> int:
        """Loads that readers of the table put together."""
        return len(self._chain(table))

    def compact(self, df: DataFrame, table: str) -> None:
        """Replace the table's loads by one with the rows of ``df``, which are what its readers make of the loads."""
        loads, first = self.loads(table), self._chain(table)[0]
        rows = self._publish(df, table, self._next_version(table), "rewrite", layout=first.layout, partition_by=first.partition_by)
        log.info("compacted %s: %d loads to %d rows", table, loads, rows)

    def merge_small(self, table: str, most: int) -> bool:
        """If the table has ``most`` loads or more, write its newest ones together: back to the first that is over twice as large as
        all behind it. So sizes fall by halves, loads stay few (``most`` and the logarithm of the rows), and a row is
        written again only as often."""
        chain = self._chain(table)
        if len(chain) < most:
            return False
        at, behind = len(chain) - 1, chain[-1].rows
        while at > (1 if chain[0].layout else 0) and chain[at - 1].rows <= 2 * behind:
            at -= 1
            behind += chain[at].rows
        some = chain[at:]
        if len(some) < 2:
            return False
        one = len({(r.watermark_column, r.watermark_type) for r in some}) == 1 and some[0].watermark_column
        schema = self.schema(table)
        rows = (self.spark.read.schema(schema).option("basePath", self.path(table, some[0].version))
                .parquet(*[f"{self.path(table, r.version)}/{LOAD}={r.load}" for r in some]).select(*schema.names))
        high = sorted({c for r in some for c in r.high or {}})
        self._publish(rows, table, self.version(table), "merge", partition_by=some[0].partition_by, watermark_column=one or None, high=high,
                      replaces=[r.load for r in some])
        return True

    def largest(self, table: str, column: str):  # noqa: ANN201
        """Largest value of a column: from the audit where every live load observed it (``high``), otherwise one scan of the column."""
        chain = [r for r in self._chain(table) if r.rows]
        if not chain:
            return None
        kind = self.schema(table)[column].dataType.simpleString()
        if all(column in (r.high or {}) for r in chain):
            typed = self.spark.createDataFrame([(r.high[column],) for r in chain], "w string")
            return typed.agg(F.max(F.col("w").cast(kind))).first()[0]
        return self.read(table).agg(F.max(column)).first()[0]

    def watermark(self, table: str, timestamp_column: str):
        """K6: MAX(ts) of the target; None if there is no such table. A column that the table lacks is an error.

        Answered from the audit when every load since the last rewrite recorded the column's high-watermark (a bounded
        number of rows, compared in the column's own type); otherwise one scan of the column."""
        chain = self._chain(table)
        if not chain:
            return None
        chain = [r for r in chain if r.rows] or chain
        if all(r.watermark_column == timestamp_column for r in chain) and len({r.watermark_type for r in chain}) == 1:
            typed = self.spark.createDataFrame([(r.watermark,) for r in chain], "w string")
            return typed.agg(F.max(F.col("w").cast(chain[0].watermark_type))).first()[0]
        df = self.read(table)
        if timestamp_column not in df.columns:
            raise ValueError(f"table {table} has no column {timestamp_column!r}")
        return df.agg(F.max(timestamp_column)).first()[0]

    def incremental_load(self, df: DataFrame, table: str, timestamp_column: str = "created_at",
                         last_load_timestamp=None, batch_id: str | None = None) -> dict:
        """K5: append only rows newer than the watermark (strict). One pass: the
        input and the new rows are both counted while the new rows are written."""
        wm = last_load_timestamp
        if wm is None and timestamp_column in df.columns:
            wm = self.watermark(table, timestamp_column)
        seen = Observation(f"incr_{table}_{uuid.uuid4().hex[:8]}")
        tagged = df.observe(seen, F.count(F.lit(1)).alias("rows_in"))
        res = self.load(incremental_rows(tagged, timestamp_column, wm), table, "append",
                        watermark_column=timestamp_column, batch_id=batch_id)
        if res["status"] in ("success", "duplicate_batch"):
            return res
        return {"rows_loaded": 0, "status": "skipped" if int(seen.get["rows_in"]) == 0 else "no_new_data"}

    def load_dimension_table(self, df: DataFrame, table: str, key_column: str, buckets: int | None = None, reads: Sequence[str] = ()) -> dict:
        """K7: type-1 dimension load = upsert on the key. With ``buckets``, a new
        dimension is created key-bucketed so that later upserts shuffle the batch only."""
        if buckets and not self.exists(table):
            first = merge_upsert(df.limit(0), df, [key_column])
            return self.create_bucketed(first, table, [key_column], buckets)
        return self.upsert(df, table, [key_column], reads=reads)

    def load_fact_table(self, df: DataFrame, table: str, watermark_column: str | None = "created_at",
                        batch_id: str | None = None, partition_by: Sequence[str] | None = None, high: Sequence[str] = (),
                        reads: Sequence[str] = ()) -> dict:
        """K8: append only (records the ``created_at`` high-watermark when present)."""
        return self.load(df, table, "append", watermark_column=watermark_column, batch_id=batch_id,
                         partition_by=partition_by, high=high, reads=reads)

    def tables(self) -> list[str]:
        return sorted({r.table_name for r in self._state() if self.exists(r.table_name)})

    def table_stats(self) -> DataFrame:
        """Row counts of every live table, sorted by name, with the total."""
        return marts.table_stats({t: self.read(t) for t in self.tables()})
