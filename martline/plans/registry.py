"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables of ``sf_dir`` (or what Spark derives from
them) in full. Column names match the oracle text in ``oracle_sql``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.operators import aggregate as _agg
from martline.operators import calc as _calc
from martline.operators import clean as _clean
from martline.operators import joins as _joins
from martline.operators import quality as _dq
from martline.functions import aggregates as _reg
from martline.functions import json as _json
from martline.operators.ordered import fill_ordered, global_row_number
from martline.plans.batch_job import Inputs, JobConfig, Publishing, run_job
from martline.plans.marts_sql import run_bi_sql
from martline.plans.warehouse import Warehouse, _load_id
from martline.session import scratch_path, short_lived_shuffles
from martline.sources import files as _files
from martline.sources.lake import DataLake
from martline.sources.payloads import payload_rows
from martline.plans import lineage, marts, star
from martline.sources import testdata as td
from martline.streaming import incremental as _stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---- shared building blocks -------------------------------------------------

def orders(spark, sf):
    return td.orders_source(spark, sf)


def customers(spark, sf):
    return td.customers_source(spark, sf)


def products(spark, sf):
    return td.products_source(spark, sf)


def fact(spark, sf, with_sale_id=False):
    return star.fact_sales(orders(spark, sf), with_sale_id=with_sale_id)


def _landed(spark, df, name: str):
    """A frame that several loads read, derived once: its rows as files in the scratch folder."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dim_c(spark, sf):
    return star.dim_customers(customers(spark, sf))


def dim_p(spark, sf):
    return star.dim_products(products(spark, sf))


# ---- X1 / star schema ---------------------------------------------------------

@query("xf_sales")
def xf_sales(spark, sf):
    return star.transform_sales(orders(spark, sf), customers(spark, sf), products(spark, sf))


@query("fact_sales")
def fact_sales(spark, sf):
    return fact(spark, sf, with_sale_id=True)


@query("dim_customers")
def dim_customers(spark, sf):
    return dim_c(spark, sf)


@query("dim_products")
def dim_products(spark, sf):
    return dim_p(spark, sf)


@query("dim_date")
def dim_date(spark, sf):
    return star.dim_date(orders(spark, sf), "order_date")


# ---- BI marts -------------------------------------------------------------------

@query("bi_sales_summary")
def bi_sales_summary(spark, sf):
    return marts.sales_summary(fact(spark, sf))


@query("bi_customer_summary")
def bi_customer_summary(spark, sf):
    return marts.customer_summary(dim_c(spark, sf))


@query("bi_product_summary")
def bi_product_summary(spark, sf):
    return marts.product_summary(dim_p(spark, sf))


@query("bi_top_customers")
def bi_top_customers(spark, sf):
    return marts.top_customers(dim_c(spark, sf), fact(spark, sf))


@query("bi_top_products")
def bi_top_products(spark, sf):
    return marts.top_products(dim_p(spark, sf), fact(spark, sf))


@query("bi_daily_sales")
def bi_daily_sales(spark, sf):
    return marts.daily_sales(fact(spark, sf))


@query("bi_category_performance")
def bi_category_performance(spark, sf):
    return marts.category_performance(dim_p(spark, sf), fact(spark, sf))


@query("bi_category_share")
def bi_category_share(spark, sf):
    return marts.category_share(dim_p(spark, sf), fact(spark, sf))


@query("bi_table_stats")
def bi_table_stats(spark, sf):
    o = orders(spark, sf)
    return marts.table_stats({"dim_customers": dim_c(spark, sf), "dim_products": dim_p(spark, sf),
                              "dim_date": star.dim_date(o, "order_date"),
                              "fact_sales": star.fact_sales(o, with_sale_id=False)})


# ---- cleaning (C1-C11, W1-W4) ---------------------------------------------------


ORDER_LINE_KEY = ["order_id", "line_number"]
ORDER_LINE_ORDER = ["product_id", "supplier_id"]


def feed(spark, sf):
    return td.orders_feed(spark, sf)


@query("clean_dedup_all")
def clean_dedup_all(spark, sf):
    return _clean.remove_duplicates(feed(spark, sf))


@query("clean_dedup_first")
def clean_dedup_first(spark, sf):
    return _clean.remove_duplicates(feed(spark, sf), ORDER_LINE_KEY, "first", ORDER_LINE_ORDER)


@query("clean_dedup_last")
def clean_dedup_last(spark, sf):
    return _clean.remove_duplicates(feed(spark, sf), ORDER_LINE_KEY, "last", ORDER_LINE_ORDER)


@query("clean_dedup_none")
def clean_dedup_none(spark, sf):
    return _clean.remove_duplicates(feed(spark, sf), ORDER_LINE_KEY, False)


@query("clean_null_drop")
def clean_null_drop(spark, sf):
    return _clean.handle_nulls(feed(spark, sf), "drop", columns=["discount"])


@query("clean_fill_const")
def clean_fill_const(spark, sf):
    return _clean.handle_nulls(feed(spark, sf), "fill", fill_value=0, columns=["discount"])


@query("clean_fill_mean")
def clean_fill_mean(spark, sf):
    return _clean.handle_nulls(feed(spark, sf), "fill", fill_method="mean", columns=["discount"])


@query("clean_fill_median")
def clean_fill_median(spark, sf):
    return _clean.handle_nulls(feed(spark, sf), "fill", fill_method="median", columns=["discount"])


@query("clean_fill_mode")
def clean_fill_mode(spark, sf):
    return _clean.handle_nulls(feed(spark, sf), "fill", fill_method="mode", columns=["discount"])


EVENT_ORDER = ["ts", "event_id"]


@query("clean_ffill")
def clean_ffill(spark, sf):
    return _clean.handle_nulls(td.events_feed(spark, sf), "fill", fill_method="forward",
                               columns=["value"], order_by=EVENT_ORDER, partition_by=["user_id"])


@query("clean_bfill")
def clean_bfill(spark, sf):
    return _clean.handle_nulls(td.events_feed(spark, sf), "fill", fill_method="backward",
                               columns=["value"], order_by=EVENT_ORDER, partition_by=["user_id"])


@query("clean_ffill_global")
def clean_ffill_global(spark, sf):
    return fill_ordered(td.events_feed(spark, sf), ["value"], EVENT_ORDER)


@query("clean_trim")
def clean_trim(spark, sf):
    return _clean.trim_whitespace(customers(spark, sf))


@query("clean_emails")
def clean_emails(spark, sf):
    return _clean.standardize_emails(customers(spark, sf), ["email"])


def events_with_date_text(spark, sf):
    """Event times as text, one notation a column ('error' events carry junk), to be parsed back by the standardizer."""
    e = td.events_source(spark, sf)
    text = lambda pattern: F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", pattern))
    return e.select("event_id", "event_type", text("yyyy-MM-dd HH:mm:ss").alias("iso"), text("yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fraction"),
                    text("yyyy-MM-dd'T'HH:mm:ss'Z'").alias("zulu"), text("MM/dd/yyyy").alias("month_first"), text("dd/MM/yyyy").alias("day_first"),
                    text("MMM d, yyyy").alias("named"))


@query("clean_dates")
def clean_dates(spark, sf):
    return _clean.standardize_dates(events_with_date_text(spark, sf),
                                    ["iso", "fraction", "zulu", "month_first", "day_first", "named", "absent_column"])


@query("clean_all")
def clean_all(spark, sf):
    return _clean.clean_all(customers(spark, sf), standardize_emails_=["email"])


# ---- data quality (V1-V11, S9) --------------------------------------------------

FEED_TYPES = {"order_id": int, "customer_id": int, "product_id": int, "quantity": int,
              "unit_price": float, "discount": float, "order_date": str}
FEED_RULES = {"quantity": "quantity > 0", "unit_price": "unit_price > 0", "discount": "discount > 0",
              "coupon_code": "coupon_code IS NOT NULL"}


@query("dq_schema")
def dq_schema(spark, sf):
    return _dq.schema_check(feed(spark, sf), _dq.DEFAULT_REQUIRED + ["coupon_code"], FEED_TYPES)


@query("dq_profile")
def dq_profile(spark, sf):
    return _dq.profile(feed(spark, sf))


@query("dq_rule_counts")
def dq_rule_counts(spark, sf):
    return _dq.rule_counts(feed(spark, sf), FEED_RULES)


@query("dq_rule_violations")
def dq_rule_violations(spark, sf):
    return _dq.rule_violations(feed(spark, sf), FEED_RULES, ORDER_LINE_KEY + ORDER_LINE_ORDER)


@query("dq_completeness")
def dq_completeness(spark, sf):
    return _dq.completeness(feed(spark, sf))


@query("dq_report")
def dq_report(spark, sf):
    return _dq.validate_all(feed(spark, sf), _dq.DEFAULT_REQUIRED + ["discount"], FEED_TYPES, FEED_RULES)


@query("dq_pk_duplicates")
def dq_pk_duplicates(spark, sf):
    return _dq.pk_duplicates(feed(spark, sf), ORDER_LINE_KEY)


@query("dq_fk_orphans")
def dq_fk_orphans(spark, sf):
    o = orders(spark, sf)
    f = star.fact_sales(o, with_sale_id=False)
    return _dq.fk_orphan_counts(f, [("customer_id", dim_c(spark, sf), "customer_id"),
                                    ("product_id", dim_p(spark, sf), "product_id"),
                                    ("date_id", star.dim_date(o, "order_date"), "date_id")])


@query("dq_not_null")
def dq_not_null(spark, sf):
    f = fact(spark, sf)
    return _dq.not_null_check(f, ["quantity", "unit_price", "total_amount", "created_at"], unique=["created_at"])


@query("dq_type_bounds")
def dq_type_bounds(spark, sf):
    x = xf_sales(spark, sf)
    # the warehouse DDL bounds: VARCHAR(255)/(100), DECIMAL(10,2)
    return _dq.type_bounds(x, varchar={"customer_name": 255, "email": 255, "city": 100, "country": 100,
                                       "product_product_name": 255, "product_category": 100,
                                       "product_brand": 100},
                           decimals={"total_amount": (10, 2), "unit_price": (10, 2),
                                     "discount_amount": (10, 2)})


# ---- joins, projections, aggregates (J1-J6, P1-P2, A1-A2) ------------------------


def customer_period_revenue(spark, sf, early: bool):
    """Revenue per customer before / from 1998 (customers appear in one or both periods)."""
    o = star.add_sales_amounts(orders(spark, sf))
    cond = F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz")
    o = o.where(cond if early else ~cond)
    return o.groupBy("customer_id").agg(F.sum("total_amount").cast("decimal(18,2)").alias("revenue"),
                                        F.count(F.lit(1)).alias("lines"))


@query("join_inner")
def join_inner(spark, sf):
    return _joins.join_data(orders(spark, sf), customers(spark, sf), "customer_id", "customer_id", "inner")


@query("join_left")
def join_left(spark, sf):
    return _joins.join_data(orders(spark, sf), products(spark, sf), "product_id", "product_id", "left")


@query("join_right")
def join_right(spark, sf):
    """All order lines against customers: those without an order stay, unmatched."""
    o = star.add_sales_amounts(orders(spark, sf))
    all_time = o.groupBy("customer_id").agg(F.sum("total_amount").cast("decimal(18,2)").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    return _joins.join_data(all_time, customers(spark, sf), "customer_id", "customer_id", "right")


@query("join_full")
def join_full(spark, sf):
    return _joins.join_data(customer_period_revenue(spark, sf, True),
                            customer_period_revenue(spark, sf, False),
                            "customer_id", "customer_id", "outer")


@query("join_suffixes")
def join_suffixes(spark, sf):
    sold = (orders(spark, sf).groupBy(F.col("product_id").alias("pid"))
            .agg(F.max("unit_price").alias("price"), F.sum("quantity").alias("quantity")))
    return _joins.join_data(products(spark, sf), sold, "product_id", "pid", "left")


@query("xf_enrich_lookup")
def xf_enrich_lookup(spark, sf):
    lookup = customers(spark, sf).withColumnRenamed("customer_id", "cust_key")
    return _joins.enrich_with_lookup(orders(spark, sf), lookup, "customer_id", "cust_key",
                                     ["customer_name", "country"], prefix="cust")


@query("xf_calculate_fields")
def xf_calculate_fields(spark, sf):
    return _calc.calculate_fields(orders(spark, sf), {
        "gross": "CAST(quantity * unit_price AS DECIMAL(18,2))",
        "tax": "CAST(gross * 0.08 AS DECIMAL(18,4))",
        "net": "CAST(gross + tax AS DECIMAL(18,4))",
        "bulk": "quantity >= 25",
    })


@query("xf_filter")
def xf_filter(spark, sf):
    return _calc.filter_data(feed(spark, sf), "quantity > 25 and discount != 5")


@query("xf_query_language")
def xf_query_language(spark, sf):
    """P2 in the pandas language on a feed with nulls: lists, powers, parameters, chained comparisons, negations."""
    text = ("quantity in @sizes or (line_number not in [1, 2] and 5 <= quantity < 20 and not (discount > 4 or discount == 2)) "
            "| discount != 5 & quantity ** 2 > 2000 & customer_id % 7 == 3")
    return _calc.filter_data(feed(spark, sf), text, language="pandas", params={"sizes": [1, 25, 50]})


@query("xf_eval_language")
def xf_eval_language(spark, sf):
    """P1 in the pandas language: precedence, whole division and remainder of negative numbers, truth values of nulls, functions."""
    return _calc.calculate_fields(feed(spark, sf).select("order_id", "line_number", "product_id", "supplier_id", "quantity", "discount"), {
        "steps": "(line_number - quantity) // 4", "left": "(line_number - quantity) % 4", "power": "-quantity ** 2 + 2 ** line_number",
        "gone": "not (discount >= 1)", "other": "discount != 3", "some": "discount in [1, 2] or line_number == 1 and quantity > @q",
        "twice": "abs(left - steps) * 2"}, language="pandas", params={"q": 10})


@query("agg_custom")
def agg_custom(spark, sf):
    """§2.13: aggregates written in Python, in parts and merged, beside a built-in one; the hottest key is a category."""
    f = feed(spark, sf).join(dim_p(spark, sf).select("product_id", "category"), "product_id")
    out = _agg.aggregate_data(f, ["category"], {"quantity": ["sum", _reg.GEOMETRIC_MEAN, _reg.HARMONIC_MEAN], "discount": [_reg.HARMONIC_MEAN]})
    return out.select("category", "quantity_sum", *[F.round(c, 6).alias(c) for c in ("quantity_gmean", "quantity_hmean", "discount_hmean")])


@query("agg_generic")
def agg_generic(spark, sf):
    return _agg.aggregate_data(feed(spark, sf), ["customer_id"], {
        "quantity": ["sum", "mean", "count", "size", "min", "max"],
        "discount": ["nunique", "count", "sum", "min"],
    })


@query("agg_generic_stats")
def agg_generic_stats(spark, sf):
    out = _agg.aggregate_data(feed(spark, sf), ["customer_id"], {"quantity": ["std", "var", "median"]})
    # sample moments are order-sensitive in the last bits: compare at 6 decimals
    return out.select("customer_id", F.round("quantity_std", 6).alias("quantity_std"),
                      F.round("quantity_var", 6).alias("quantity_var"), "quantity_median")


@query("agg_generic_ordered")
def agg_generic_ordered(spark, sf):
    return _agg.aggregate_data(feed(spark, sf), ["order_id"], {
        "discount": ["first", "last"], "quantity": ["prod"],
    }, order_by=["line_number", "product_id", "supplier_id"])


@query("agg_daily_sales")
def agg_daily_sales(spark, sf):
    # A2 needs the order lines with their amounts only; the dimension enrichment
    # of X1 (left joins on unique keys) changes no totals, so it is not paid for.
    sales = star.add_sales_amounts(orders(spark, sf))
    out = _agg.aggregate_daily_sales(sales, "order_date")
    return out.select("date", "quantity_sum", F.col("total_amount_sum").cast("double").alias("total_amount_sum"),
                      F.col("final_amount_sum").cast("double").alias("final_amount_sum"), "order_count")


# ---- sources, lake, warehouse loads (S1-S7, K1-K8) -------------------------------


CUTOFF = "1998-01-01"          # split between an earlier load and a later batch
FACT_CUTOFF = "1999-01-01"


def _before(col: str, ts: str):
    return F.col(col) < F.lit(ts).cast("timestamp_ntz")


def _write_text(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").text(path)
    return path


@query("src_csv_roundtrip")
def src_csv_roundtrip(spark, sf):
    f = feed(spark, sf)
    path = scratch_path(spark, "orders_csv")
    f.write.option("header", True).option("nullValue", "NA").csv(path)
    return _files.extract_csv(spark, path, schema=f.schema, null_value="NA")


@query("src_scan_report")
def src_scan_report(spark, sf):
    f = feed(spark, sf)
    path = scratch_path(spark, "orders_csv")
    f.write.option("header", True).option("nullValue", "NA").csv(path)
    expected = td.table(spark, sf, "orders").count()  # one line per order header (a wrong guess on purpose)
    _, rep = _files.extract_csv_with_validation(spark, path, _dq.DEFAULT_REQUIRED + ["coupon_code"],
                                                expected_rows=expected, null_value="NA")
    return rep.select("rows_extracted", F.array_join("columns_found", ",").alias("columns_found"),
                      "is_valid", F.array_join("errors", "; ").alias("errors"),
                      F.array_join("warnings", "; ").alias("warnings"))


def _quoted_products(spark, sf):
    p = products(spark, sf)
    return p.select("product_id", F.concat(F.lit('He said "'), "product_name", F.lit('", ok')).alias("product_name"),
                    F.concat("category", F.lit("\n"), "brand").alias("label"), "price")


@query("src_csv_quoted")
def src_csv_quoted(spark, sf):
    """Doubled quotes, separators and line breaks inside fields."""
    path = scratch_path(spark, "products_csv")
    q = _quoted_products(spark, sf)
    q.write.option("header", True).option("escape", '"').csv(path)
    return _files.extract_csv(spark, path, schema=q.schema, multiline=True)


@query("src_csv_reordered")
def src_csv_reordered(spark, sf):
    """Columns matched by name: the schema has another order than the header, and leaves columns out."""
    path = scratch_path(spark, "orders_csv")
    orders(spark, sf).write.option("header", True).csv(path)
    return _files.extract_csv(spark, path, schema="unit_price DECIMAL(10,2), quantity INT, line_number BIGINT, order_id BIGINT")


@query("src_scan_missing")
def src_scan_missing(spark, sf):
    """The report of a scan whose schema names a column that the header lacks."""
    path = scratch_path(spark, "orders_csv")
    orders(spark, sf).write.option("header", True).csv(path)
    _, rep = _files.extract_csv_with_validation(spark, path, ["order_id"], schema="order_id BIGINT, coupon_code STRING, quantity INT")
    return rep.select("rows_extracted", F.array_join("columns_found", ",").alias("columns_found"), "is_valid", F.array_join("errors", "; ").alias("errors"))


@query("src_json_odd_keys")
def src_json_odd_keys(spark, sf):
    """Keys with a hyphen, a blank and a dot."""
    c = customers(spark, sf)
    doc = F.to_json(F.struct(F.col("customer_id").alias("user-id"), F.col("customer_name").alias("first name"),
                             F.struct(F.col("city").alias("home.city")).alias("the address")))
    out = _files.extract_json(spark, _write_text(c.select(doc.alias("value")), scratch_path(spark, "odd_jsonl")), lines=True)
    return out.select(F.col("`user-id`").alias("user_id"), F.col("`first name`").alias("first_name"), F.col("`the address.home.city`").alias("city"))


@query("src_json_scalars")
def src_json_scalars(spark, sf):
    """Arrays of scalars, one document a customer."""
    docs = customers(spark, sf).select(F.to_json(F.array("customer_id", F.col("customer_id") * 10)).alias("value"))
    return _files.extract_json(spark, _write_text(docs, scratch_path(spark, "scalars_jsonl")), lines=True)


@query("src_json_unnest")
def src_json_unnest(spark, sf):
    """Orders as documents with a list of quantities (empty for pending orders, null for urgent ones), unnested on request."""
    lines = td.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("s"))
    o = td.table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    sizes = (F.when(F.col("o_orderstatus") == "P", F.array().cast("array<int>")).when(F.col("o_orderpriority").startswith("1"), F.lit(None))
             .otherwise(F.transform("s", lambda x: x["l_quantity"].cast("int"))))
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("order_id"), sizes.alias("sizes")), {"ignoreNullFields": "false"})
    docs = _files.extract_json(spark, _write_text(o.select(doc.alias("value")), scratch_path(spark, "lists_jsonl")), lines=True)
    return _json.unnest(docs, "sizes", position="at").select("order_id", "at", F.col("sizes").cast("long").alias("size"))


@query("src_csv_rejects")
def src_csv_rejects(spark, sf):
    """S1/S2 over files with planted bad lines (a field too many, one too few, text in a number and in a time): good rows and rejects
    by reason, with checksums of both."""
    o = orders(spark, sf).select("order_id", "line_number", "quantity", "unit_price", "shipped_at")
    fields = [F.col(c).cast("string") for c in ("order_id", "line_number", "quantity", "unit_price")] + [F.date_format("shipped_at", "yyyy-MM-dd HH:mm:ss")]
    line = F.concat_ws(",", *fields)
    kind = F.col("order_id") % 101
    text = (F.when(kind == 7, F.concat(line, F.lit(",extra"))).when(kind == 11, F.concat_ws(",", *fields[:4]))
            .when(kind == 13, F.concat_ws(",", fields[0], fields[1], F.lit("many"), *fields[3:])).when(kind == 17, F.concat_ws(",", *fields[:4], F.lit("soon"))).otherwise(line))
    base = scratch_path(spark, "rejects")
    o.select(text.alias("value")).write.text(f"{base}/in")
    scan = _files.extract_csv_rejects(spark, f"{base}/in", "order_id BIGINT, line_number INT, quantity INT, unit_price DECIMAL(10,2), shipped_at TIMESTAMP_NTZ",
                                      f"{base}/out", header=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    good = scan.good.agg(F.count("*").alias("n"), F.sum("order_id").alias("ids"), F.sum("quantity").alias("quantity")).select(
        F.lit("good").alias("outcome"), F.lit("").alias("fields"), "n", "ids", "quantity")
    bad = scan.rejects.groupBy("reason", F.coalesce(F.array_join("fields", ","), F.lit("")).alias("fields")).agg(
        F.count("*").alias("n"), F.sum(F.split("line", ",")[0].cast("long")).alias("ids")).select(F.col("reason").alias("outcome"), "fields", "n", "ids",
                                                                                                 F.lit(None).cast("long").alias("quantity"))
    told = spark.range(1).select(F.lit("counted").alias("outcome"), F.lit("").alias("fields"), F.lit(scan.n_good + scan.n_rejects).cast("long").alias("n"),
                                 F.lit(scan.n_rejects).cast("long").alias("ids"), F.lit(None).cast("long").alias("quantity"))
    return good.unionByName(bad).unionByName(told)


@query("src_json_records")
def src_json_records(spark, sf):
    """Documents that wrap their records."""
    docs = products(spark, sf).select(F.to_json(F.struct(F.array(F.struct("product_id", "brand")).alias("records"))).alias("value"))
    return _files.extract_json(spark, _write_text(docs, scratch_path(spark, "records_jsonl")), lines=True)


@query("src_json_index")
def src_json_index(spark, sf):
    """S3d: objects of objects by key."""
    c = customers(spark, sf)
    docs = c.select(F.to_json(F.create_map(F.col("customer_id").cast("string"), F.struct("customer_name", "country"))).alias("value"))
    return _files.extract_json(spark, _write_text(docs, scratch_path(spark, "index_jsonl")), orient="index", lines=True)


@query("src_json_object")
def src_json_object(spark, sf):
    """S3e and S3f: single objects and empty arrays; the arrays give no rows."""
    c = customers(spark, sf).select(F.to_json(F.struct("customer_id", F.struct(F.struct("city").alias("home")).alias("at"))).alias("value"))
    empty = customers(spark, sf).select(F.lit("[]").alias("value"))
    return _files.extract_json(spark, _write_text(c.unionByName(empty), scratch_path(spark, "object_jsonl")), lines=True)


@query("src_json_flatten")
def src_json_flatten(spark, sf):
    c = customers(spark, sf)
    doc = F.to_json(F.struct("customer_id", "customer_name",
                             F.struct("city", "country").alias("address"),
                             F.struct("email").alias("contact")))
    path = _write_text(c.select(doc.alias("value")), scratch_path(spark, "customers_jsonl"))
    return _files.extract_json(spark, path, lines=True)


@query("src_json_record_path")
def src_json_record_path(spark, sf):
    o = orders(spark, sf)
    line = F.struct("line_number", "product_id", "supplier_id", "quantity", "unit_price", "discount")
    doc = F.to_json(F.struct("order_id", "customer_id",
                             F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
                             F.array(line).alias("lines")))
    path = _write_text(o.select(doc.alias("value")), scratch_path(spark, "orders_nested"))
    return _files.extract_json_nested(spark, path, record_path="lines",
                                      meta=["order_id", "customer_id", "order_date"], lines=True)


def landed_event_responses(spark, sf):
    """One landed response per event; failed calls carry an error object instead of data.results."""
    e = td.events_source(spark, sf)
    ok = F.to_json(F.struct(F.struct(F.array(F.struct(
        "event_id", "user_id", "event_type", "value",
        F.from_json("props", "k BIGINT").alias("props"))).alias("results")).alias("data")))
    err = F.to_json(F.struct(F.struct(F.lit(500).alias("code"), F.lit("upstream failure").alias("message"))
                             .alias("error")))
    return e.select(F.concat(F.lit("/events/"), F.col("event_id").cast("string")).alias("url"),
                    F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                    F.when(F.col("event_type") == "error", err).otherwise(ok).alias("body"))


@query("src_payload_path")
def src_payload_path(spark, sf):
    return payload_rows(landed_event_responses(spark, sf), "data.results", keep=["url"])


def _cleaned_customers(spark, sf):
    return _clean.standardize_emails(_clean.trim_whitespace(customers(spark, sf)), ["email"])


@query("src_latest_snapshot")
def src_latest_snapshot(spark, sf):
    lake = DataLake(spark, scratch_path(spark, "lake"))
    lake.save_raw(customers(spark, sf), "customers", "parquet", _dt.datetime(2024, 1, 15, 9, 0, 0))
    lake.save_raw(_cleaned_customers(spark, sf), "customers", "parquet", _dt.datetime(2024, 1, 16, 9, 0, 0))
    return lake.latest("raw", "customers")


@query("sink_lake_roundtrip")
def sink_lake_roundtrip(spark, sf):
    f = feed(spark, sf)
    lake = DataLake(spark, scratch_path(spark, "lake"))
    lake.save_raw(f, "orders", "json", _dt.datetime(2024, 1, 15, 9, 0, 0))
    return lake.latest("raw", "orders", "json", schema=f.schema)


@query("sink_lake_csv")
def sink_lake_csv(spark, sf):
    """K1/S7 with CSV; an older snapshot of other columns is not looked at."""
    lake = DataLake(spark, scratch_path(spark, "lake"))
    q = _quoted_products(spark, sf).drop("label")
    lake.save_raw(customers(spark, sf), "products", "csv", _dt.datetime(2024, 1, 14, 9, 0, 0))
    lake.save_raw(q, "products", "csv", _dt.datetime(2024, 1, 15, 9, 0, 0))
    return lake.latest("raw", "products", "csv", schema=q.schema)


@query("load_star_schema")
def load_star_schema(spark, sf):
    """K9 and the DDL's default: rows and rows without a load time in each table after loads that leave it out."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.create_star_schema()
    wh.load_dimension_table(dim_c(spark, sf), "dim_customers", "customer_id")
    wh.load_dimension_table(dim_p(spark, sf), "dim_products", "product_id")
    wh.load_fact_table(fact(spark, sf, with_sale_id=True).drop("created_at"), "fact_sales")
    parts = [wh.read(t).agg(F.count("*").alias("row_count"), F.count_if(F.col("created_at").isNull()).alias("without_time"))
             .select(F.lit(t).alias("table_name"), "row_count", "without_time") for t in wh.tables()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sink_load_modes")
def sink_load_modes(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.load(dim_c(spark, sf), "dim_customers", "fail")
    wh.load(_cleaned_customers(spark, sf), "dim_customers", "replace")
    wh.load(_cleaned_customers(spark, sf), "dim_customers", "append")
    return wh.read("dim_customers")


def _products_sold_before(spark, sf):
    early = orders(spark, sf).where(_before("order_date", CUTOFF)).select("product_id")
    return dim_p(spark, sf).join(early, "product_id", "left_semi")


def _price_observations(spark, sf):
    """Product rows observed in sales from the cutoff on: price = the sale's unit price."""
    late = orders(spark, sf).where(~_before("order_date", CUTOFF))
    p = products(spark, sf)
    return late.join(p.select("product_id", "product_name", "category", "brand"), "product_id").select(
        "product_id", F.upper("product_name").alias("product_name"), "category", "brand",
        F.col("unit_price").alias("price"), "order_date", "order_id", "line_number", "supplier_id")


def _upsert_products(spark, sf, update_columns):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.load(_products_sold_before(spark, sf), "dim_products", "fail")
    wh.upsert(_price_observations(spark, sf), "dim_products", ["product_id"], update_columns,
              order_by=["order_date", "order_id", "line_number", "supplier_id"])
    return wh.read("dim_products")


@query("load_upsert")
def load_upsert(spark, sf):
    return _upsert_products(spark, sf, None)


@query("load_upsert_partial")
def load_upsert_partial(spark, sf):
    return _upsert_products(spark, sf, ["price"])


def _fact_warehouse(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    f = fact(spark, sf)
    wh.load(f.where(_before("created_at", FACT_CUTOFF)), "fact_sales", "fail")
    return wh, f


@query("load_incremental")
def load_incremental(spark, sf):
    wh, f = _fact_warehouse(spark, sf)
    wh.incremental_load(f, "fact_sales", "created_at")
    return wh.read("fact_sales")


@query("load_watermark")
def load_watermark(spark, sf):
    """K6 over the whole fact, loaded in two batches: a timestamp and a decimal column, from the audit and by a scan."""
    wh, f = _fact_warehouse(spark, sf)
    rest = f.where(~_before("created_at", FACT_CUTOFF))
    wh.load(rest, "fact_sales", "append")
    amounts = f.select("quantity", "total_amount")
    for i, part in enumerate((F.col("quantity") < 25, F.col("quantity") >= 25)):  # all rows, in two loads
        wh.load(amounts.where(part), "amounts", "append", watermark_column="total_amount", batch_id=f"part {i}")
    return spark.createDataFrame([(wh.watermark("fact_sales", "created_at"), wh.watermark("amounts", "total_amount"))],
                                 f"last_load_ts {f.schema['created_at'].dataType.simpleString()}, "
                                 f"last_amount {f.schema['total_amount'].dataType.simpleString()}")


@query("load_dim_customers")
def load_dim_customers(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    early = orders(spark, sf).where(_before("order_date", CUTOFF)).select("customer_id")
    wh.load(dim_c(spark, sf).join(early, "customer_id", "left_semi"), "dim_customers", "fail")
    wh.load_dimension_table(star.dim_customers(_cleaned_customers(spark, sf)), "dim_customers", "customer_id")
    return wh.read("dim_customers")


@query("load_dim_products")
def load_dim_products(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.load(_products_sold_before(spark, sf), "dim_products", "fail")
    wh.load_dimension_table(dim_p(spark, sf), "dim_products", "product_id")
    return wh.read("dim_products")


@query("load_fact_append")
def load_fact_append(spark, sf):
    wh, f = _fact_warehouse(spark, sf)
    wh.load_fact_table(f.where(~_before("created_at", FACT_CUTOFF)), "fact_sales")
    return wh.read("fact_sales")


@query("load_append_replay")
def load_append_replay(spark, sf):
    """K8 replayed: a batch loaded twice, and one whose writer was lost after its files and before its audit row."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    f = fact(spark, sf)
    early = f.where(_before("created_at", FACT_CUTOFF))
    late = f.where(~_before("created_at", FACT_CUTOFF))
    for _ in range(2):
        wh.load_fact_table(early, "fact_sales", batch_id="early")
    wh._write(late, "fact_sales", wh.version("fact_sales"), _load_id("late"))  # lost here
    again = Warehouse(spark, wh.root)
    for _ in range(2):
        again.load_fact_table(late, "fact_sales", batch_id="late")
    return again.read("fact_sales")


@query("load_after_drop")
def load_after_drop(spark, sf):
    """A batch loaded, its schema dropped and made again, the batch loaded twice more: the table holds it once. Then a replace by a part
    takes it away, and the batch comes back by another load."""
    wh, f = Warehouse(spark, scratch_path(spark, "warehouse")), _landed(spark, fact(spark, sf), "fact")
    wh.create_star_schema()
    wh.load_fact_table(f, "fact_sales", batch_id="b")
    wh.drop_star_schema()
    wh.create_star_schema()
    for _ in range(2):
        Warehouse(spark, wh.root).load_fact_table(f, "fact_sales", batch_id="b")
    early = _before("created_at", FACT_CUTOFF)
    again = Warehouse(spark, wh.root)
    again.load(f.where(early), "fact_sales", "replace", batch_id="early")
    again.load_fact_table(f.where(~early), "fact_sales", batch_id="b")
    return again.read("fact_sales").select(*f.columns)


@query("load_partitioned_fact")
def load_partitioned_fact(spark, sf):
    """K8 in folders by quantity, after ``create_star_schema``: a partitioned load, then one that does not say how the table is laid out."""
    wh, f = Warehouse(spark, scratch_path(spark, "warehouse")), fact(spark, sf)
    wh.create_star_schema()
    early = _before("created_at", FACT_CUTOFF)
    wh.load_fact_table(f.where(early), "fact_sales", partition_by=["quantity"])
    wh.load_fact_table(f.where(~early), "fact_sales")
    return wh.read("fact_sales").select(*f.columns)


@query("load_type_mismatch")
def load_type_mismatch(spark, sf):
    """Loads that don't fit are refused and change nothing: another type, a column too many; a narrower number fits."""
    wh, f = Warehouse(spark, scratch_path(spark, "warehouse")), fact(spark, sf).select("customer_id", "product_id", "quantity")
    early = F.col("quantity") < 25
    wh.load(f.where(early), "sales")
    refused = 0
    for bad in (f.withColumn("quantity", F.col("quantity").cast("string")), f.withColumn("note", F.lit("x"))):
        try:
            wh.load(bad, "sales", "append")
        except ValueError:
            refused += 1
    wh.load(f.where(~early).withColumn("quantity", F.col("quantity").cast("smallint")), "sales", "append")
    return wh.read("sales").withColumn("refused", F.lit(refused))


# ---- X2 batch job -------------------------------------------------------------------


def land_sources(spark, sf, base: str) -> dict[str, str]:
    """Land the driver-derived sources as gzip files: orders CSV, customers and
    products JSON Lines (products under a ``products`` key)."""
    o = orders(spark, sf)
    paths = {"orders": f"{base}/orders_csv", "customers": f"{base}/customers_jsonl",
             "products": f"{base}/products_jsonl"}
    p = products(spark, sf).select(F.to_json(F.struct(F.array(F.struct("*")).alias("products"))).alias("value"))
    with short_lived_shuffles(spark):
        o.write.option("header", True).option("compression", "gzip").csv(paths["orders"])
        customers(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").text(paths["customers"])
        p.write.option("compression", "gzip").text(paths["products"])
    return paths


def _job(spark, sf, runs: int, dense: bool = False):
    base = scratch_path(spark, "job")
    paths = land_sources(spark, sf, base)
    cfg = JobConfig(inputs=Inputs(**paths, orders_schema=orders(spark, sf).schema, json_lines=True),
                    lake=f"{base}/lake", warehouse=f"{base}/warehouse", publishing=Publishing(dense_ids=dense))
    for _ in range(runs):
        run_job(spark, cfg)
    return Warehouse(spark, cfg.warehouse).read("fact_sales")


@query("etl_batch_run")
def etl_batch_run(spark, sf):
    """The job as it runs by default: ids rise with the order lines, with gaps, so their ranks are compared."""
    out = _job(spark, sf, 1)
    return global_row_number(out.withColumnRenamed("sale_id", "id"), ["id"], "sale_id").drop("id").select(*out.columns)


@query("etl_batch_rerun")
def etl_batch_rerun(spark, sf):
    """The job run twice on the same files, with dense ids: the second run adds nothing."""
    return _job(spark, sf, 2, dense=True)


# ---- streaming ----------------------------------------------------------------------


#: Rows of a landed file at most, so that even small tables come in several files; a large table comes in about so many.
LANDED_ROWS, LANDED_FILES = 20_000, 200


def _file_rows(table: DataFrame, least: int = LANDED_ROWS) -> int:
    """Rows of a landed file of a table (counted by its footers): files grow with the table, not in number."""
    return max(least, -(-table.count() // LANDED_FILES))


def _part_of(spark, path: str, parts: int = 4) -> int:
    """Bytes a batch, so that what landed is read in about so many batches, whatever its size."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() // parts + 1


@query("stream_daily_sales")
def stream_daily_sales(spark, sf):
    """Files landed newest day first, a quarter of them a batch, so every batch but the first is late."""
    base = scratch_path(spark, "stream_daily")
    src = fact(spark, sf).select("created_at", "quantity", "total_amount")
    src.orderBy(F.desc("created_at")).write.option("maxRecordsPerFile", _file_rows(td.table(spark, sf, "lineitem"))).parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/warehouse")
    _stream.daily_sales_stream(spark, f"{base}/in", src.schema, wh, "daily_sales", f"{base}/checkpoint", max_bytes_per_trigger=_part_of(spark, f"{base}/in"), compact_every=3)
    return _stream.daily_sales(wh, "daily_sales").withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("stream_customer_activity")
def stream_customer_activity(spark, sf):
    base = scratch_path(spark, "stream_activity")
    o = td.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("order_total"))
    o.orderBy(F.xxhash64("order_id")).write.option("maxRecordsPerFile", _file_rows(o)).parquet(f"{base}/in")  # customers in every file
    wh = Warehouse(spark, f"{base}/warehouse")
    newer = ["last_order_date", "last_order_id"]
    _stream.latest_per_key_stream(
        spark, f"{base}/in", o.schema, wh, "customer_activity", f"{base}/checkpoint", key=["customer_id"],
        columns=["customer_id", F.col("order_date").alias("last_order_date"),
                 F.col("order_id").alias("last_order_id"), F.col("order_total").alias("last_order_total")],
        newer_by=newer, max_bytes_per_trigger=_part_of(spark, f"{base}/in"))
    return _stream.latest_rows(wh, "customer_activity", ["customer_id"], newer)


# ---- S8: SQL text with bound parameters ---------------------------------------------


def _star_views(spark, sf):
    return {"fact_sales": fact(spark, sf), "dim_customers": dim_c(spark, sf), "dim_products": dim_p(spark, sf)}


@query("bi_top_customers_sql")
def bi_top_customers_sql(spark, sf):
    return run_bi_sql(spark, "top_customers", _star_views(spark, sf), limit=10)


@query("bi_top_products_sql")
def bi_top_products_sql(spark, sf):
    return run_bi_sql(spark, "top_products", _star_views(spark, sf), limit=10)


@query("bi_category_performance_sql")
def bi_category_performance_sql(spark, sf):
    return run_bi_sql(spark, "category_performance", _star_views(spark, sf))


@query("bi_daily_sales_sql")
def bi_daily_sales_sql(spark, sf):
    return run_bi_sql(spark, "daily_sales", _star_views(spark, sf))


@query("bi_customer_summary_sql")
def bi_customer_summary_sql(spark, sf):
    return run_bi_sql(spark, "customer_summary", _star_views(spark, sf))


@query("bi_product_summary_sql")
def bi_product_summary_sql(spark, sf):
    return run_bi_sql(spark, "product_summary", _star_views(spark, sf))


#: Key and measures of each mart, as ``bi_all_marts`` lists them.
MART_VALUES = {
    "stats": ("table_name", ["row_count", "total_records"]),
    "sales_summary": (None, ["total_orders", "total_quantity", "total_revenue", "avg_order_value", "total_discount"]),
    "customer_summary": (None, ["total_customers", "cities", "countries"]),
    "product_summary": (None, ["total_products", "categories", "brands", "avg_price"]),
    "top_customers": ("customer_id", ["order_count", "total_revenue"]),
    "top_products": ("product_id", ["sales_count", "total_quantity_sold", "total_revenue"]),
    "daily_sales": ("date", ["order_count", "total_quantity", "total_revenue", "avg_order_value"]),
    "category_performance": ("category", ["sales_count", "total_quantity", "total_revenue", "avg_order_value"])}


@query("bi_all_marts")
def bi_all_marts(spark, sf):
    """A10: every mart from one read of the fact: all values of all marts, one a row."""
    tables, out = {n: df for n, df in _star_views(spark, sf).items()}, None
    for name, df in marts.all_marts(tables).items():
        key, measures = MART_VALUES[name]
        values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("v")
        one = df.select(F.lit(name).alias("mart"), (F.col(key).cast("string") if key else F.lit("all")).alias("key"), values).select("mart", "key", "v.measure", "v.value")
        out = one if out is None else out.unionByName(one)
    return out


@query("agg_generic_sorted")
def agg_generic_sorted(spark, sf):
    """A1 with its groups in the order of the keys (T5)."""
    return _agg.aggregate_data(feed(spark, sf), ["customer_id"], {"quantity": ["sum"]}, sort=True)


@query("bi_sales_summary_sql")
def bi_sales_summary_sql(spark, sf):
    return run_bi_sql(spark, "sales_summary", _star_views(spark, sf))


@query("dq_dimensions")
def dq_dimensions(spark, sf):
    return _dq.quality_dimensions(
        feed(spark, sf), _dq.DEFAULT_REQUIRED + ["discount"], FEED_RULES,
        references=[("customer_id", dim_c(spark, sf), "customer_id"), ("product_id", dim_p(spark, sf), "product_id")],
        plausible="shipped_at >= order_date", freshness_column="shipped_at", as_of="2002-01-01")


@query("load_upsert_bucketed")
def load_upsert_bucketed(spark, sf):
    """K4 on a dimension bucketed by its key: filled by a replace and an append, then upserted."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    before = _products_sold_before(spark, sf)
    cheap = F.col("price") < 1000
    wh.create_bucketed(dim_p(spark, sf), "dim_products", ["product_id"], 16)
    wh.load(before.where(cheap), "dim_products", "replace")
    wh.load(before.where(~cheap), "dim_products", "append")
    wh.upsert(_price_observations(spark, sf), "dim_products", ["product_id"],
              order_by=["order_date", "order_id", "line_number", "supplier_id"])
    return wh.read("dim_products")


@query("stream_fact_append")
def stream_fact_append(spark, sf):
    """Fact rows landed as several files, appended micro-batch by micro-batch."""
    base = scratch_path(spark, "stream_fact")
    f = fact(spark, sf)
    f.write.option("maxRecordsPerFile", _file_rows(td.table(spark, sf, "lineitem"))).parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/warehouse")
    _stream.append_stream(spark, f"{base}/in", f.schema, wh, "fact_sales", f"{base}/checkpoint",
                          watermark_column="created_at", max_bytes_per_trigger=_part_of(spark, f"{base}/in", 6), merge_every=3)
    return wh.read("fact_sales")


def _deduplicated(spark, sf):
    """Events landed newest first in two thirds of the files, oldest first in the rest; every tenth event lands twice."""
    base = scratch_path(spark, "stream_dedup")
    e = td.events_source(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    twice = e.where(F.col("event_id") % 10 == 3)
    rows = _file_rows(e, LANDED_ROWS // 40)
    e.orderBy(F.desc("ts")).write.option("maxRecordsPerFile", rows).parquet(f"{base}/in")
    twice.orderBy("ts").write.mode("append").option("maxRecordsPerFile", rows).parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/warehouse")
    for _ in range(2):  # the second run, a restart, finds nothing new
        _stream.dedup_stream(spark, f"{base}/in", e.schema, wh, "events", "late_events", f"{base}/checkpoint", ["event_id"], "ts", delay="2 days",
                             max_bytes_per_trigger=_part_of(spark, f"{base}/in"))
    return wh


@query("stream_dedup")
def stream_dedup(spark, sf):
    """One row of every event, whether it came in time or late."""
    return _stream.dedup_rows(_deduplicated(spark, sf), "events", "late_events")


@query("stream_dedup_late")
def stream_dedup_late(spark, sf):
    """What came in time and what came late hold every event once: rows of both, and events in both. Newest first, so some are late."""
    wh = _deduplicated(spark, sf)
    kept = wh.read("events")
    late = wh.read("late_events") if wh.exists("late_events") else kept.limit(0)
    both = kept.join(late, "event_id", "left_semi").agg(F.count("*").alias("in_both"))
    return kept.select("event_id").unionByName(late.select("event_id")).agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("events")).join(both).join(
        late.agg((F.count("*") > 0).alias("some_late")))


@query("stream_sessions")
def stream_sessions(spark, sf):
    """Sessions of users with a gap of 30 days, over batches in the order of time; a last row moves time on, so that all close."""
    base = scratch_path(spark, "stream_sessions")
    e = td.events_source(spark, sf).select("user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"), F.lit(False).alias("beat"))
    e.orderBy("ts").write.option("maxRecordsPerFile", _file_rows(e, LANDED_ROWS // 8)).parquet(f"{base}/in")
    end = e.agg((F.max("ts") + F.expr("INTERVAL 100 DAYS")).alias("ts")).select(F.lit(None).cast("long").alias("user_id"), "ts", F.lit(0).cast("long").alias("cents"), F.lit(True).alias("beat"))
    end.coalesce(1).write.mode("append").parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/warehouse")
    _stream.sessions_stream(spark, f"{base}/in", e.schema, wh, "sessions", f"{base}/checkpoint", "user_id", "ts", "cents", gap="30 days", delay="30 days",
                            heartbeat="beat", max_bytes_per_trigger=_part_of(spark, f"{base}/in"))
    return wh.read("sessions")


@query("bi_quarter_sales")
def bi_quarter_sales(spark, sf):
    """K8 partitioned by month, cut at run time by the filtered date dimension."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    wh.load_dimension_table(star.dim_date(orders(spark, sf), "order_date"), "dim_date", "date_id")
    f = fact(spark, sf).withColumn("month_id", marts.month_key("date_id"))
    wh.load_fact_table(f.repartition("month_id"), "fact_sales", partition_by=["month_id"])
    return marts.period_sales(wh.read("fact_sales"), wh.read("dim_date"), (F.col("year") == 1997) & F.col("quarter").isin(2, 3))


#: Rows of a bucket of order lines at most, about: one task sorts them, in some 170 bytes each.
BUCKET_ROWS = 1_500_000


def _buckets(lines: int, least: int = 8) -> int:
    return max(least, -(-lines // BUCKET_ROWS))


def _bucketed_sources(spark, sf, buckets: int | None = None):
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    buckets = buckets or _buckets(td.table(spark, sf, "lineitem").count())
    wh.create_bucketed(td.table(spark, sf, "lineitem"), "lineitem", ["l_orderkey"], buckets)
    wh.create_bucketed(td.table(spark, sf, "orders"), "orders", ["o_orderkey"], buckets)
    return td.order_lines(wh.read("lineitem"), wh.read("orders"))


@query("xf_sales_bucketed")
def xf_sales_bucketed(spark, sf):
    """X1 from order lines and headers that are stored bucketed and sorted by the order: their join shuffles nothing."""
    return star.transform_sales(_bucketed_sources(spark, sf), customers(spark, sf), products(spark, sf))


@query("bi_distinct_incremental")
def bi_distinct_incremental(spark, sf):
    """Customers and days by category, from distinct sketches that each of three loads wrote and a read merges, against the exact
    numbers: both within 3 % (over three times the sketches' standard error)."""
    f = fact(spark, sf).join(dim_p(spark, sf).select("product_id", "category"), "product_id").select("customer_id", "created_at", "date_id", "category")
    wh, f = Warehouse(spark, scratch_path(spark, "warehouse")), _landed(spark, f, "categories")
    for i in range(3):
        part = f.where(F.pmod(F.xxhash64("customer_id", "created_at"), F.lit(3)) == i)
        wh.load(part.groupBy("category").agg(_reg.distinct_sketch("customer_id").alias("customers"), _reg.distinct_sketch("date_id").alias("days")),
                "distinct", batch_id=f"part {i}")
    merged = wh.read("distinct").groupBy("category").agg(_reg.distinct_of("customers").alias("customers"), _reg.distinct_of("days").alias("days"))
    exact = f.groupBy("category").agg(F.count_distinct("customer_id").alias("n_customers"), F.count_distinct("date_id").alias("n_days"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.03 + 1
    return exact.join(merged, "category").select("category", "n_customers", "n_days", (close("customers", "n_customers") & close("days", "n_days")).alias("within"))


@query("lineage_upstream")
def lineage_upstream(spark, sf):
    """What the facts of a job were made from, by its audit: a recursive walk from ``fact_sales``."""
    base = scratch_path(spark, "job")
    paths = land_sources(spark, sf, base)
    cfg = JobConfig(inputs=Inputs(**paths, orders_schema=orders(spark, sf).schema, json_lines=True), warehouse=f"{base}/warehouse")
    run_job(spark, cfg)
    return lineage.upstream(Warehouse(spark, cfg.warehouse), "fact_sales").select(F.regexp_replace("node", ".*/", "").alias("node"), "depth")


def _spiked(spark, sf):
    return td.events_source(spark, sf).withColumn("value", F.when(F.col("event_id") % 997 == 5, F.col("value") * 1000 + 100_000).otherwise(F.col("value")))


@query("dq_outliers")
def dq_outliers(spark, sf):
    """Event values far from the median of their type, with planted spikes."""
    out = _dq.outliers(_spiked(spark, sf).select("event_id", "event_type", "value"), "value", ["event_type"], least=8.0)
    return out.select("event_id", "event_type", F.round("median", 9).alias("median"), F.round("deviation", 9).alias("deviation"))


@query("stream_sliding_events")
def stream_sliding_events(spark, sf):
    """Events by type in windows of two days every day, landed newest first: all batches but the first are late."""
    base = scratch_path(spark, "stream_sliding")
    e = td.events_source(spark, sf).select("ts", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    e.orderBy(F.desc("ts")).write.option("maxRecordsPerFile", _file_rows(e, LANDED_ROWS // 8)).parquet(f"{base}/in")
    wh = Warehouse(spark, f"{base}/warehouse")
    _stream.window_sums_stream(spark, f"{base}/in", e.schema, wh, "sliding", f"{base}/checkpoint", "ts", ["cents"], "2 days", "1 day", ["event_type"],
                               max_bytes_per_trigger=_part_of(spark, f"{base}/in"), compact_every=2)
    return _stream.window_sums(wh, "sliding", ["event_type"])


@query("src_json_report")
def src_json_report(spark, sf):
    """Rows of JSON documents with a report: a field that none has, and a wrong number expected."""
    path = _write_text(customers(spark, sf).select(F.to_json(F.struct("customer_id", "city")).alias("value")), scratch_path(spark, "report_jsonl"))
    _, rep = _files.extract_json_with_validation(spark, path, ["customer_id", "phone"], expected_count=1, lines=True)
    return rep.select("rows_extracted", F.array_join("columns_found", ",").alias("columns_found"), "is_valid", F.array_join("errors", "; ").alias("errors"),
                      F.array_join("warnings", "; ").alias("warnings"))


@query("clean_null_skip")
def clean_null_skip(spark, sf):
    """Nulls are left as they are."""
    return _clean.handle_nulls(feed(spark, sf), "skip")


@query("xf_head")
def xf_head(spark, sf):
    """The first rows in an order."""
    return _calc.head(orders(spark, sf), 25, [F.desc("quantity"), "order_id", "line_number", "product_id", "supplier_id"])


@query("xf_math")
def xf_math(spark, sf):
    """§2.12: the mathematical functions of the eval language."""
    base = orders(spark, sf).select("order_id", "line_number", "product_id", "supplier_id", F.col("quantity").cast("double").alias("q"))
    names = ["sin", "cos", "arctan", "tanh", "arcsinh", "exp", "expm1", "log", "log10", "log1p", "sqrt", "floor", "ceil"]
    out = _calc.calculate_fields(base, {n: f"{n}(q / 8)" for n in names} | {"angle": "arctan2(q, 3) + abs(1 - q)"}, language="pandas")
    return out.select("order_id", "line_number", "product_id", "supplier_id", *[F.round(F.col(n).cast("double"), 6).alias(n) for n in [*names, "angle"]])


def _small_discount(value):
    if value is None:
        raise ValueError("no discount")
    return value <= 5


@query("dq_python_rule")
def dq_python_rule(spark, sf):
    """§2.13: violations of a rule that is a Python function, by what it raised."""
    f = feed(spark, sf).select("order_id", "line_number", F.col("discount").cast("double").alias("discount"))
    out = _dq.rule_violations(f, {"discount": _dq.python_rule("discount", _small_discount)}, ["order_id"], errors={"discount": _small_discount})
    return out.groupBy("column", "error").agg(F.count("*").alias("violations"), F.sum("order_id").alias("ids"))


@query("load_audit")
def load_audit(spark, sf):
    """§2.14: what the audit says of a replace, an append, a batch that came twice, and an upsert."""
    wh, f = Warehouse(spark, scratch_path(spark, "warehouse")), fact(spark, sf)
    early = _before("created_at", FACT_CUTOFF)
    wh.load(dim_c(spark, sf), "dim_customers", "replace")
    wh.load_fact_table(f.where(early), "fact_sales", batch_id="early")
    for _ in range(2):
        wh.load_fact_table(f.where(~early), "fact_sales", batch_id="late")
    wh.upsert(_cleaned_customers(spark, sf), "dim_customers", ["customer_id"])
    return wh.audit().select("table_name", "operation", "version", "rows", "batch_id", "watermark_column", F.to_date("watermark").alias("watermark_day"))


@query("etl_step_metrics")
def etl_step_metrics(spark, sf):
    """The records of a job's stages: state and counted rows."""
    base = scratch_path(spark, "job")
    paths = land_sources(spark, sf, base)
    report = run_job(spark, JobConfig(inputs=Inputs(**paths, orders_schema=orders(spark, sf).schema, json_lines=True), lake=f"{base}/lake", warehouse=f"{base}/warehouse"))
    rows = [(s.name, s.state, k, n) for s in report.stages for k, n in (s.rows or {"": None}).items()]  # one or two a stage
    return spark.createDataFrame(rows, "stage string, state string, counted string, rows long")
