"""The batch sales job, a chain of named stages over one shared state.

read -> land -> check -> clean -> enrich -> store -> publish. Every stage is a Spark job over the
whole input and leaves a record (name, state, rows, seconds, error); all totals of the report come from
these records. After a lake write the job goes on from the written snapshot, so sources are
parsed once and lineage is cut. Rows are counted by ``Observation`` on those writes.

A run has an id, by default a digest of its input files (path, size, time). The fact load carries it as its
batch id, so running the job again on the same files adds nothing, and a run that broke off can be run
again.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.operators import clean, quality
from martline.plans import star
from martline.plans.warehouse import Warehouse
from martline.session import remove_path, scratch_path, short_lived_shuffles
from martline.sources import files
from martline.sources.lake import DataLake

log = logging.getLogger(__name__)


@dataclass
class Inputs:
    orders: str
    customers: str
    products: str
    record_path: str = "products"
    orders_schema: T.StructType | str | None = None
    json_lines: bool = False


@dataclass
class Checks:
    required: list[str] = field(default_factory=lambda: list(quality.DEFAULT_REQUIRED))
    rules: dict = field(default_factory=lambda: dict(quality.DEFAULT_RULES))
    completeness: float = quality.DEFAULT_MIN_COMPLETENESS


@dataclass
class Cleaning:
    duplicates: bool = True
    nulls: bool = True
    strategy: str = "fill"


@dataclass
class Publishing:
    fact: bool = True
    dimension_buckets: int | None = None  # key-bucketed dimensions: upserts shuffle the batch only
    partition_by: list[str] | None = None  # e.g. ["date_id"]: partition folders of the fact, for pruning
    dense_ids: bool = False  # True: 1..n without gaps, for one more range shuffle and a written copy


@dataclass
class JobConfig:
    """A stage whose options are None (or False) is left out; ``lake`` None keeps everything out of the lake."""

    inputs: Inputs
    warehouse: str
    lake: str | None = None
    checks: Checks | None = field(default_factory=Checks)
    cleaning: Cleaning | None = field(default_factory=Cleaning)
    enrich: bool = True
    publishing: Publishing | None = field(default_factory=Publishing)
    go_on: bool = False
    run_id: str | None = None


@dataclass
class StageRecord:
    name: str
    state: str
    seconds: float
    rows: dict[str, int] = field(default_factory=dict)
    error: str | None = None


class JobReport:
    def __init__(self, run_id: str) -> None:
        self.run_id = run_id
        self.stages: list[StageRecord] = []
        self.broke_off = False
        self.checks: list = []

    @property
    def ok(self) -> bool:
        return not self.broke_off

    def names(self, state: str) -> list[str]:
        return [s.name for s in self.stages if s.state == state]

    def rows(self) -> dict[str, int]:
        return {f"{s.name}.{k}": n for s in self.stages for k, n in s.rows.items()}

    def as_dict(self) -> dict:
        return {"run_id": self.run_id, "ok": self.ok, "seconds": round(sum(s.seconds for s in self.stages), 3),
                "stages": [vars(s) for s in self.stages],
                "failed_checks": [f"{r.check}:{r.column}" for r in self.checks if r.counts_toward_valid and not r.passed]}


def input_digest(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the input files' paths, sizes and times; only file listings are read."""
    listed = spark.read.format("binaryFile").load(paths).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    n, total = listed.agg(F.count("*"), F.sum(F.col("h").cast("decimal(20,0)"))).first()
    return f"{n}-{total}"


class SalesJob:
    def __init__(self, spark: SparkSession, config: JobConfig):
        self.spark = spark
        self.config = config
        self.lake = DataLake(spark, config.lake) if config.lake else None
        self.warehouse = Warehouse(spark, config.warehouse)
        i = config.inputs
        self.report = JobReport(config.run_id or input_digest(spark, [i.orders, i.customers, i.products]))
        self.stamp = dt.datetime.now(dt.timezone.utc)
        self.frames: dict[str, DataFrame] = {}
        self.cleaned: Observation | None = None

    # ---- stages: each changes ``frames`` and returns what it counted -----------------------
    def read(self) -> dict[str, int]:
        i = self.config.inputs
        self.frames = {
            "orders": files.extract_csv(self.spark, i.orders, schema=i.orders_schema),
            "customers": files.extract_json(self.spark, i.customers, lines=i.json_lines),
            "products": files.extract_json_nested(self.spark, i.products, i.record_path, lines=i.json_lines)}
        return {}

    def land(self) -> dict[str, int]:
        return {name: self._snapshot("raw", name) for name in list(self.frames)}

    def check(self) -> dict[str, int]:
        """One aggregate pass; the report has one row a check."""
        c = self.config.checks
        report = quality.validate_all(self.frames["orders"], c.required, None, c.rules, c.completeness)
        rows = self.report.checks = report.collect()
        if self.lake:
            self.lake.save_processed(self.spark.createDataFrame(rows, report.schema).coalesce(1), "validation_report", "parquet", self.stamp)
        bad = [r for r in rows if r.counts_toward_valid and not r.passed]
        if bad:
            raise ValueError("orders fail " + ", ".join(f"{r.check}({r.column})" for r in bad))
        return {"checks": len(rows)}

    def clean(self) -> dict[str, int]:
        c = self.config.cleaning
        orders = clean.clean_all(self.frames["orders"], remove_duplicates_=c.duplicates, handle_nulls_=c.nulls, null_strategy=c.strategy,
                                 reread=self.lake is not None)  # the landed snapshot
        if self.lake and self.config.enrich:  # counted while the processed snapshot is written
            self.cleaned = Observation(f"cleaned_{uuid.uuid4().hex[:8]}")
            orders = orders.observe(self.cleaned, F.count(F.lit(1)).alias("rows"))
        self.frames["orders"] = orders
        return {}

    def enrich(self) -> dict[str, int]:
        f = self.frames
        f["sales"] = star.transform_sales(f["orders"], f["customers"], f["products"])
        return {}

    def store(self) -> dict[str, int]:
        name = "sales" if "sales" in self.frames else "orders"
        out = {"rows": self._snapshot("processed", name, "sales_transformed")}
        if self.cleaned:
            out["cleaned"] = int(self.cleaned.get["rows"])
        return out

    def publish(self) -> dict[str, int]:
        p, wh, f, i = self.config.publishing, self.warehouse, self.frames, self.config.inputs
        out = {"dim_customers": wh.load_dimension_table(star.dim_customers(f["customers"]), "dim_customers", "customer_id", p.dimension_buckets, [i.customers]),
               "dim_products": wh.load_dimension_table(star.dim_products(f["products"]), "dim_products", "product_id", p.dimension_buckets, [i.products])}
        sales = f.get("sales")
        if sales is not None and p.fact and "order_date" in sales.columns:
            out["dim_date"] = wh.load_dimension_table(star.dim_date(sales, "order_date"), "dim_date", "date_id", reads=[i.orders])
            if "shipped_at" not in sales.columns:  # the DDL default: load time
                sales = sales.withColumn("shipped_at", F.current_timestamp().cast("timestamp_ntz"))
            if wh.has_batch("fact_sales", self.report.run_id) if wh.exists("fact_sales") else False:
                return {k: r.get("rows_upserted", r.get("rows_loaded", 0)) for k, r in out.items()} | {"fact_sales": 0}
            first = 1 + (wh.largest("fact_sales", "sale_id") or 0 if wh.exists("fact_sales") else 0)
            copy = scratch_path(self.spark, "fact-copy") if p.dense_ids else None
            try:
                fact = star.fact_sales(sales, with_sale_id=True, first_id=first, dense_ids=p.dense_ids, copy_to=copy)
                out["fact_sales"] = wh.load_fact_table(fact, "fact_sales", batch_id=self.report.run_id, partition_by=p.partition_by,
                                                       high=["sale_id"], reads=[i.orders, "dim_customers", "dim_products"])
            finally:
                if copy:
                    remove_path(self.spark, copy)
        return {k: r.get("rows_upserted", r.get("rows_loaded", 0)) for k, r in out.items()}

    def _snapshot(self, zone: str, name: str, saved_as: str | None = None) -> int:
        """Write a frame to the lake and go on from what was written."""
        obs = Observation(f"{zone}_{name}_{uuid.uuid4().hex[:8]}")
        save = self.lake.save_raw if zone == "raw" else self.lake.save_processed
        save(self.frames[name].observe(obs, F.count(F.lit(1)).alias("rows")), saved_as or name, "parquet", self.stamp)
        self.frames[name] = self.lake.latest(zone, saved_as or name)
        return int(obs.get["rows"])

    # ---- driver -------------------------------------------------------------------
    def plan(self) -> list[str]:
        c = self.config
        wanted = {"read": True, "land": self.lake, "check": c.checks, "clean": c.cleaning, "enrich": c.enrich, "store": self.lake,
                  "publish": c.publishing}
        return [name for name, on in wanted.items() if on]

    def run(self) -> JobReport:
        """Run the planned stages. A failed check is passed over with ``go_on``; any other failure ends the run,
        and is raised unless ``go_on``. A stage goes on from written files, so the shuffles of its queries end with them."""
        with short_lived_shuffles(self.spark):
            return self._run()

    def _run(self) -> JobReport:
        for name in self.plan():
            began = time.monotonic()
            try:
                rows = getattr(self, name)()
            except Exception as e:
                self.report.stages.append(StageRecord(name, "failed", time.monotonic() - began, error=str(e)))
                if not self.config.go_on:
                    self.report.broke_off = True
                    raise
                log.exception("stage %s failed", name)
                if name != "check":
                    self.report.broke_off = True
                    break
            else:
                self.report.stages.append(StageRecord(name, "done", time.monotonic() - began, rows))
        return self.report


def run_job(spark: SparkSession, config: JobConfig) -> JobReport:
    return SalesJob(spark, config).run()
