"""DuckDB oracle text for every registered query that has an SQL equivalent.

The views ``lineitem orders customer nation region part events ...`` are the
driver parquet tables. The CTEs below restate the adapter mapping of
``martline.sources.testdata`` and the star schema of ``martline.plans.star``
in SQL; each oracle query is ``WITH <ctes> <select>``. Money is kept in
DECIMAL, multiplied (never divided: DuckDB turns DECIMAL division into DOUBLE)
and cast to DOUBLE only at the end, as the Spark side does.
"""

from __future__ import annotations


CTES = {
    "orders_src": """
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_suppkey AS supplier_id,
         o.o_custkey AS customer_id, l.l_partkey AS product_id, o.o_orderdate AS order_date,
         l.l_shipdate AS shipped_at, CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(floor(l.l_extendedprice * 100 / l.l_quantity + 0.5) / 100.0 AS DECIMAL(10,2)) AS unit_price,
         CAST(l.l_discount * 100 AS DECIMAL(5,2)) AS discount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "customers_src": """
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name,
         '  ' || upper(c.c_name) || '@Example.com ' AS email,
         n.n_name AS city, r.r_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "products_src": """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part""",
    "sales_amounts": """
  SELECT *, CAST(quantity * unit_price AS DECIMAL(18,2)) AS total_amount,
         CAST(quantity * unit_price * discount * 0.01 AS DECIMAL(18,4)) AS discount_amount,
         CAST(quantity * unit_price - quantity * unit_price * discount * 0.01 AS DECIMAL(18,4)) AS final_amount
  FROM orders_src""",
    "fact": """
  SELECT row_number() OVER (ORDER BY order_id, line_number, product_id, supplier_id) AS sale_id,
         customer_id, product_id,
         CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS INTEGER) AS date_id,
         quantity, unit_price, CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
         CAST(discount_amount AS DECIMAL(10,2)) AS discount, shipped_at AS created_at
  FROM sales_amounts""",
    "dim_customers": """
  SELECT customer_id, customer_name, email, city, country FROM customers_src""",
    "dim_products": """
  SELECT product_id, product_name, category, brand, price FROM products_src""",
    "orders_feed": """
  SELECT order_id, line_number, supplier_id, customer_id, product_id, order_date, shipped_at, quantity,
         unit_price, CASE WHEN discount <> 0 THEN discount END AS discount
  FROM orders_src""",
    "events_feed": """
  SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value, props
  FROM events""",
    "dim_date": """
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week,
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week
  FROM (SELECT CAST(unnest(generate_series(min(CAST(order_date AS DATE)), max(CAST(order_date AS DATE)),
                                           INTERVAL 1 DAY)) AS DATE) AS d FROM orders_src)""",
}

_ORDER = ["orders_src", "customers_src", "products_src", "sales_amounts", "fact",
          "dim_customers", "dim_products", "orders_feed", "events_feed", "dim_date"]


def with_ctes(body: str, *extra: tuple[str, str]) -> str:
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _ORDER]
    parts += [f"{n} AS ({sql}\n)" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


SQL: dict[str, str] = {}


def register(name: str, body: str, *extra: tuple[str, str]) -> None:
    SQL[name] = with_ctes(body, *extra)


register("xf_sales", """
SELECT s.order_id, s.line_number, s.supplier_id, s.customer_id, s.product_id, s.order_date,
       s.shipped_at, s.quantity, s.unit_price, s.discount,
       c.customer_name, c.email, c.city, c.country,
       p.product_name AS product_product_name, p.category AS product_category,
       p.brand AS product_brand, p.price AS product_price,
       s.total_amount, s.discount_amount, s.final_amount
FROM sales_amounts s LEFT JOIN customers_src c ON s.customer_id = c.customer_id
                     LEFT JOIN products_src p ON s.product_id = p.product_id""")

register("fact_sales", "SELECT * FROM fact")
register("dim_customers", "SELECT * FROM dim_customers")
register("dim_products", "SELECT * FROM dim_products")
register("dim_date", "SELECT * FROM dim_date")

register("bi_sales_summary", """
SELECT count(*) AS total_orders, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_quantity,
       coalesce(CAST(sum(total_amount) AS DOUBLE), 0.0) AS total_revenue,
       coalesce(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 0.0) AS avg_order_value,
       coalesce(CAST(sum(discount) AS DOUBLE), 0.0) AS total_discount
FROM fact""")

register("bi_customer_summary", """
SELECT count(*) AS total_customers, count(DISTINCT city) AS cities, count(DISTINCT country) AS countries
FROM dim_customers""")

register("bi_product_summary", """
SELECT count(*) AS total_products, count(DISTINCT category) AS categories, count(DISTINCT brand) AS brands,
       CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
FROM dim_products""")

register("bi_top_customers", """
SELECT c.customer_id, c.customer_name, c.city, c.country, count(f.customer_id) AS order_count,
       CAST(sum(f.total_amount) AS DOUBLE) AS total_revenue
FROM dim_customers c LEFT JOIN fact f ON c.customer_id = f.customer_id
GROUP BY c.customer_id, c.customer_name, c.city, c.country
ORDER BY total_revenue DESC NULLS LAST, c.customer_id LIMIT 10""")

register("bi_top_products", """
SELECT p.product_id, p.product_name, p.category, p.brand, count(f.product_id) AS sales_count,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(f.total_amount) AS DOUBLE) AS total_revenue
FROM dim_products p LEFT JOIN fact f ON p.product_id = f.product_id
GROUP BY p.product_id, p.product_name, p.category, p.brand
ORDER BY total_revenue DESC NULLS LAST, p.product_id LIMIT 10""")

register("bi_daily_sales", """
SELECT CAST(created_at AS DATE) AS date, count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value
FROM fact GROUP BY CAST(created_at AS DATE) ORDER BY 1""")

register("bi_category_performance", """
SELECT p.category, count(f.product_id) AS sales_count, CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(f.total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(f.total_amount) AS DOUBLE) / count(f.total_amount) AS avg_order_value
FROM dim_products p LEFT JOIN fact f ON p.product_id = f.product_id
GROUP BY p.category ORDER BY total_revenue DESC NULLS LAST, p.category""")

register("bi_category_share", """
SELECT category, CAST(rev AS DOUBLE) AS total_revenue,
       CAST(rev AS DOUBLE) / CAST(sum(rev) OVER () AS DOUBLE) AS revenue_share
FROM (SELECT p.category, sum(f.total_amount) AS rev
      FROM dim_products p LEFT JOIN fact f ON p.product_id = f.product_id GROUP BY p.category)""")

register("bi_table_stats", """
SELECT table_name, row_count, CAST(sum(row_count) OVER () AS BIGINT) AS total_records FROM (
  SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM dim_customers
  UNION ALL SELECT 'dim_date', CAST(max(CAST(order_date AS DATE)) - min(CAST(order_date AS DATE)) AS BIGINT) + 1
            FROM orders_src
  UNION ALL SELECT 'dim_products', count(*) FROM dim_products
  UNION ALL SELECT 'fact_sales', count(*) FROM fact) ORDER BY table_name""")

# ---- cleaning ----------------------------------------------------------------------

FEED_COLS = ("order_id, line_number, supplier_id, customer_id, product_id, order_date, shipped_at, "
             "quantity, unit_price")

register("clean_dedup_all", "SELECT DISTINCT * FROM orders_feed")
register("clean_dedup_first", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number
                                                        ORDER BY product_id, supplier_id) AS rn
                           FROM orders_feed) WHERE rn = 1""")
register("clean_dedup_last", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number
                                                        ORDER BY product_id DESC, supplier_id DESC) AS rn
                           FROM orders_feed) WHERE rn = 1""")
register("clean_dedup_none", """
SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY order_id, line_number) AS n
                          FROM orders_feed) WHERE n = 1""")
register("clean_null_drop", "SELECT * FROM orders_feed WHERE discount IS NOT NULL")
register("clean_fill_const", f"SELECT {FEED_COLS}, CAST(coalesce(discount, 0) AS DECIMAL(5,2)) AS discount FROM orders_feed")
register("clean_fill_mean", f"""
SELECT {FEED_COLS}, coalesce(CAST(discount AS DOUBLE),
       (SELECT CAST(sum(discount) AS DOUBLE) / count(discount) FROM orders_feed)) AS discount
FROM orders_feed""")
register("clean_fill_median", f"""
SELECT {FEED_COLS}, coalesce(CAST(discount AS DOUBLE),
       (SELECT median(CAST(discount AS DOUBLE)) FROM orders_feed)) AS discount
FROM orders_feed""")
register("clean_fill_mode", f"""
SELECT {FEED_COLS}, coalesce(discount, (SELECT discount FROM (
         SELECT discount, count(*) AS n FROM orders_feed WHERE discount IS NOT NULL GROUP BY discount)
         ORDER BY n DESC, discount LIMIT 1)) AS discount
FROM orders_feed""")
register("clean_ffill", """
SELECT event_id, ts, user_id, event_type,
       last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value, props
FROM events_feed""")
register("clean_bfill", """
SELECT event_id, ts, user_id, event_type,
       first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value, props
FROM events_feed""")
register("clean_ffill_global", """
SELECT event_id, ts, user_id, event_type,
       last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value, props
FROM events_feed""")
# The white space that Python's str.strip takes off, written out.
_BLANK = r"[\x{09}-\x{0d}\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = f"^{_BLANK}+|{_BLANK}+$"
register("clean_trim", f"""
SELECT customer_id, regexp_replace(customer_name, '{_STRIP}', '', 'g') AS customer_name,
       regexp_replace(email, '{_STRIP}', '', 'g') AS email,
       regexp_replace(city, '{_STRIP}', '', 'g') AS city,
       regexp_replace(country, '{_STRIP}', '', 'g') AS country
FROM customers_src""")
register("clean_emails", f"""
SELECT customer_id, customer_name, regexp_replace(lower(email), '{_STRIP}', '', 'g') AS email, city, country
FROM customers_src""")
register("clean_all", f"""
SELECT DISTINCT customer_id, regexp_replace(customer_name, '{_STRIP}', '', 'g') AS customer_name,
       regexp_replace(lower(regexp_replace(email, '{_STRIP}', '', 'g')), '{_STRIP}', '', 'g') AS email,
       regexp_replace(city, '{_STRIP}', '', 'g') AS city,
       regexp_replace(country, '{_STRIP}', '', 'g') AS country
FROM customers_src""")
_PARTS = "CASE WHEN event_type <> 'error' THEN date_trunc('{part}', ts) END AS {name}"
register("clean_dates", "SELECT event_id, event_type, " + ", ".join(_PARTS.format(part=p, name=n) for n, p in (
    ("iso", "second"), ("fraction", "microsecond"), ("zulu", "second"), ("month_first", "day"), ("day_first", "day"), ("named", "day"))) + " FROM events")

# ---- data quality ----------------------------------------------------------------------

_FEED_DTYPES = [("order_id", "bigint"), ("line_number", "int"), ("supplier_id", "bigint"),
                ("customer_id", "bigint"), ("product_id", "bigint"), ("order_date", "timestamp_ntz"),
                ("shipped_at", "timestamp_ntz"), ("quantity", "int"), ("unit_price", "decimal(10,2)"),
                ("discount", "decimal(5,2)")]

register("dq_schema", """
SELECT * FROM (VALUES
  ('order_id', 'int', 'bigint', true, true), ('customer_id', 'int', 'bigint', true, true),
  ('product_id', 'int', 'bigint', true, true), ('quantity', 'int', 'int', true, true),
  ('unit_price', 'float', 'decimal(10,2)', true, true), ('coupon_code', NULL, NULL, false, false),
  ('discount', 'float', 'decimal(5,2)', true, true), ('order_date', 'str', 'timestamp_ntz', true, false)
) AS m("column", expected_type, actual_type, present, type_ok)
JOIN (SELECT 'order_id' AS c, count(order_id) AS non_null FROM orders_feed
      UNION ALL SELECT 'customer_id', count(customer_id) FROM orders_feed
      UNION ALL SELECT 'product_id', count(product_id) FROM orders_feed
      UNION ALL SELECT 'quantity', count(quantity) FROM orders_feed
      UNION ALL SELECT 'unit_price', count(unit_price) FROM orders_feed
      UNION ALL SELECT 'coupon_code', NULL
      UNION ALL SELECT 'discount', count(discount) FROM orders_feed
      UNION ALL SELECT 'order_date', count(order_date) FROM orders_feed) AS k ON k.c = m."column" """.replace(
    "SELECT * FROM (VALUES", "SELECT m.*, k.non_null FROM (VALUES"))

register("dq_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
       CASE WHEN count(*) > 0 THEN CAST(count(*) - count({c}) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE)
            ELSE 0.0 END AS null_percentage,
       CAST(count(*) - count({c}) AS DOUBLE) > CAST(count(*) AS DOUBLE) * 0.5 AS high_null,
       count(*) AS row_count FROM orders_feed""" for c, t in _FEED_DTYPES))

register("dq_rule_counts", """
SELECT "column", violations, violations = 0 AS passed, CAST(NULL AS VARCHAR) AS error FROM (
  SELECT 'quantity' AS "column", CAST(sum(CASE WHEN coalesce(NOT (quantity > 0), true) THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM orders_feed
  UNION ALL SELECT 'unit_price', CAST(sum(CASE WHEN coalesce(NOT (unit_price > 0), true) THEN 1 ELSE 0 END) AS BIGINT) FROM orders_feed
  UNION ALL SELECT 'discount', CAST(sum(CASE WHEN coalesce(NOT (discount > 0), true) THEN 1 ELSE 0 END) AS BIGINT) FROM orders_feed)
UNION ALL SELECT 'coupon_code', 0, true, 'no column coupon_code for its rule'""")

register("dq_rule_violations", """
SELECT 'quantity' AS "column", order_id, line_number, product_id, supplier_id, CAST(quantity AS VARCHAR) AS value
FROM orders_feed WHERE coalesce(NOT (quantity > 0), true)
UNION ALL SELECT 'unit_price', order_id, line_number, product_id, supplier_id, CAST(unit_price AS VARCHAR)
FROM orders_feed WHERE coalesce(NOT (unit_price > 0), true)
UNION ALL SELECT 'discount', order_id, line_number, product_id, supplier_id, CAST(discount AS VARCHAR)
FROM orders_feed WHERE coalesce(NOT (discount > 0), true)""")

register("dq_completeness", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
       CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) ELSE 0.0 END AS completeness,
       (CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) ELSE 0.0 END) >= 0.95 AS passed
       FROM orders_feed""" for c, _ in _FEED_DTYPES))

_REPORT_REQ = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "discount"]
register("dq_report", "\nUNION ALL ".join(
    ["SELECT 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS \"column\", CAST(count(*) AS DOUBLE) AS value, "
     "true AS passed, false AS counts_toward_valid, CAST(NULL AS VARCHAR) AS message FROM orders_feed",
     "SELECT 'column_count', NULL, 10.0, true, false, NULL",
     "SELECT 'schema_type', 'order_date', NULL, false, true, 'order_date is timestamp_ntz, not str'"]
    + [f"""SELECT 'null_share', '{c}',
       CASE WHEN count(*) > 0 THEN CAST(count(*) - count({c}) AS DOUBLE) / count(*) ELSE 0.0 END,
       NOT (CAST(count(*) - count({c}) AS DOUBLE) > CAST(count(*) AS DOUBLE) * 0.5), false,
       CASE WHEN CAST(count(*) - count({c}) AS DOUBLE) > CAST(count(*) AS DOUBLE) * 0.5
            THEN 'Column ''{c}'' has a high null share' END FROM orders_feed""" for c, _ in _FEED_DTYPES]
    + [f"""SELECT 'completeness', '{c}',
       CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / count(*) ELSE 0.0 END,
       (CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / count(*) ELSE 0.0 END) >= 0.95, true,
       CASE WHEN (CASE WHEN count(*) > 0 THEN CAST(count({c}) AS DOUBLE) / count(*) ELSE 0.0 END) < 0.95
            THEN 'Column ''{c}'' below minimum completeness' END FROM orders_feed""" for c in _REPORT_REQ]
    + [f"""SELECT 'business_rule', '{c}', CAST(v AS DOUBLE), v = 0, true,
       CASE WHEN v > 0 THEN CAST(v AS VARCHAR) || ' rows break the rule of {c}' END
       FROM (SELECT sum(CASE WHEN coalesce(NOT ({r}), true) THEN 1 ELSE 0 END) AS v FROM orders_feed)"""
       for c, r in [("quantity", "quantity > 0"), ("unit_price", "unit_price > 0"), ("discount", "discount > 0")]]
    + ["SELECT 'business_rule', 'coupon_code', NULL, true, false, 'no column coupon_code for its rule'"]))

register("dq_pk_duplicates", """
SELECT order_id, line_number, count(*) AS occurrences FROM orders_feed
GROUP BY order_id, line_number HAVING count(*) > 1""")

register("dq_fk_orphans", """
SELECT 'customer_id' AS fk_column, count(*) AS orphan_rows FROM fact f
WHERE f.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customers d WHERE d.customer_id = f.customer_id)
UNION ALL SELECT 'product_id', count(*) FROM fact f
WHERE f.product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_products d WHERE d.product_id = f.product_id)
UNION ALL SELECT 'date_id', count(*) FROM fact f
WHERE f.date_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_id = f.date_id)""")

register("dq_not_null", """
SELECT 'quantity' AS "column", 'not_null' AS "constraint", count(*) - count(quantity) AS violations FROM fact
UNION ALL SELECT 'unit_price', 'not_null', count(*) - count(unit_price) FROM fact
UNION ALL SELECT 'total_amount', 'not_null', count(*) - count(total_amount) FROM fact
UNION ALL SELECT 'created_at', 'not_null', count(*) - count(created_at) FROM fact
UNION ALL SELECT 'created_at', 'unique', CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (
  SELECT created_at, count(*) AS k FROM fact WHERE created_at IS NOT NULL GROUP BY created_at HAVING count(*) > 1)""")

register("dq_type_bounds", """
SELECT 'customer_name' AS "column", 'varchar(255)' AS "constraint", CAST(sum(CASE WHEN length(customer_name) > 255 THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM x
UNION ALL SELECT 'email', 'varchar(255)', CAST(sum(CASE WHEN length(email) > 255 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'city', 'varchar(100)', CAST(sum(CASE WHEN length(city) > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'country', 'varchar(100)', CAST(sum(CASE WHEN length(country) > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'product_product_name', 'varchar(255)', CAST(sum(CASE WHEN length(product_product_name) > 255 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'product_category', 'varchar(100)', CAST(sum(CASE WHEN length(product_category) > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'product_brand', 'varchar(100)', CAST(sum(CASE WHEN length(product_brand) > 100 THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'total_amount', 'decimal(10,2)', CAST(sum(CASE WHEN total_amount IS NOT NULL AND TRY_CAST(total_amount AS DECIMAL(10,2)) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'unit_price', 'decimal(10,2)', CAST(sum(CASE WHEN unit_price IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM x
UNION ALL SELECT 'discount_amount', 'decimal(10,2)', CAST(sum(CASE WHEN discount_amount IS NOT NULL AND TRY_CAST(discount_amount AS DECIMAL(10,2)) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM x""",
         ("x", """
  SELECT s.*, c.customer_name, c.email, c.city, c.country, p.product_name AS product_product_name,
                  p.category AS product_category, p.brand AS product_brand
           FROM sales_amounts s LEFT JOIN customers_src c ON s.customer_id = c.customer_id
                                LEFT JOIN products_src p ON s.product_id = p.product_id"""))

# ---- joins / projections / aggregates ---------------------------------------------

_PERIOD = """
  SELECT customer_id, CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue, count(*) AS lines
  FROM sales_amounts WHERE {cond} GROUP BY customer_id"""
_EARLY = ("early", _PERIOD.format(cond="order_date < TIMESTAMP '1998-01-01'"))
_LATE = ("late", _PERIOD.format(cond="NOT (order_date < TIMESTAMP '1998-01-01')"))

register("join_inner", """
SELECT o.*, c.customer_name, c.email, c.city, c.country
FROM orders_src o JOIN customers_src c ON o.customer_id = c.customer_id""")
register("join_left", """
SELECT o.*, p.product_name, p.category, p.brand, p.price
FROM orders_src o LEFT JOIN products_src p ON o.product_id = p.product_id""")
register("join_right", """
SELECT c.customer_id, e.revenue, e.lines, c.customer_name, c.email, c.city, c.country
FROM all_time e RIGHT JOIN customers_src c ON e.customer_id = c.customer_id""", ("all_time", _PERIOD.format(cond="true")))
register("join_full", """
SELECT coalesce(e.customer_id, l.customer_id) AS customer_id, e.revenue AS revenue_x, e.lines AS lines_x,
       l.revenue AS revenue_y, l.lines AS lines_y
FROM early e FULL OUTER JOIN late l ON e.customer_id = l.customer_id""", _EARLY, _LATE)
register("join_suffixes", """
SELECT p.product_id, p.product_name, p.category, p.brand, p.price AS price_x, s.pid, s.price AS price_y, s.quantity
FROM products_src p LEFT JOIN (SELECT product_id AS pid, max(unit_price) AS price,
                                      CAST(sum(quantity) AS BIGINT) AS quantity
                               FROM orders_src GROUP BY product_id) s ON p.product_id = s.pid""")
register("xf_enrich_lookup", """
SELECT o.*, c.customer_name AS cust_customer_name, c.country AS cust_country
FROM orders_src o LEFT JOIN customers_src c ON o.customer_id = c.customer_id""")
register("xf_calculate_fields", """
SELECT *, CAST(gross + tax AS DECIMAL(18,4)) AS net, quantity >= 25 AS bulk FROM (
  SELECT *, CAST(gross * 0.08 AS DECIMAL(18,4)) AS tax FROM (
    SELECT *, CAST(quantity * unit_price AS DECIMAL(18,2)) AS gross FROM orders_src))""")
register("xf_filter", "SELECT * FROM orders_feed WHERE quantity > 25 AND discount <> 5")
register("agg_generic", """
SELECT customer_id, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity_sum, avg(quantity) AS quantity_mean,
       count(quantity) AS quantity_count, count(*) AS quantity_size, min(quantity) AS quantity_min,
       max(quantity) AS quantity_max, count(DISTINCT discount) AS discount_nunique,
       count(discount) AS discount_count, CAST(coalesce(sum(discount), 0) AS DECIMAL(22,2)) AS discount_sum, min(discount) AS discount_min
FROM orders_feed WHERE customer_id IS NOT NULL GROUP BY customer_id""")
register("agg_generic_stats", """
SELECT customer_id, round(stddev_samp(quantity), 6) AS quantity_std, round(var_samp(quantity), 6) AS quantity_var,
       median(CAST(quantity AS DOUBLE)) AS quantity_median
FROM orders_feed WHERE customer_id IS NOT NULL GROUP BY customer_id""")
register("agg_generic_ordered", """
SELECT order_id,
       arg_min(discount, (line_number, product_id, supplier_id)) FILTER (WHERE discount IS NOT NULL) AS discount_first,
       arg_max(discount, (line_number, product_id, supplier_id)) FILTER (WHERE discount IS NOT NULL) AS discount_last,
       coalesce(product(quantity), 1.0) AS quantity_prod
FROM orders_feed WHERE order_id IS NOT NULL GROUP BY order_id""")
register("agg_daily_sales", """
SELECT CAST(order_date AS DATE) AS date, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity_sum,
       CAST(coalesce(sum(total_amount), 0) AS DOUBLE) AS total_amount_sum,
       CAST(coalesce(sum(final_amount), 0) AS DOUBLE) AS final_amount_sum, count(order_id) AS order_count
FROM sales_amounts GROUP BY CAST(order_date AS DATE)""")

# ---- sources, lake, loads -----------------------------------------------------------

_CLEAN_CUSTOMERS = ("clean_customers", f"""
  SELECT customer_id, regexp_replace(customer_name, '{_STRIP}', '', 'g') AS customer_name,
         regexp_replace(lower(regexp_replace(email, '{_STRIP}', '', 'g')), '{_STRIP}', '', 'g') AS email,
         regexp_replace(city, '{_STRIP}', '', 'g') AS city,
         regexp_replace(country, '{_STRIP}', '', 'g') AS country
  FROM customers_src""")

register("src_csv_roundtrip", "SELECT * FROM orders_feed")
register("src_scan_report", """
SELECT count(*) AS rows_extracted,
       'order_id,line_number,supplier_id,customer_id,product_id,order_date,shipped_at,quantity,unit_price,discount'
         AS columns_found,
       false AS is_valid, 'no column coupon_code' AS errors,
       CASE WHEN count(*) <> (SELECT count(*) FROM orders)
            THEN count(*) || ' rows, not ' || (SELECT count(*) FROM orders) ELSE '' END AS warnings
FROM orders_feed""")
_QUOTED = """SELECT product_id, 'He said "' || product_name || '", ok' AS product_name, category || chr(10) || brand AS label, price FROM products_src"""
register("src_csv_quoted", _QUOTED)
register("sink_lake_csv", f"SELECT * EXCLUDE (label) FROM ({_QUOTED})")
register("src_csv_reordered", "SELECT unit_price, quantity, line_number, order_id FROM orders_src")
register("src_scan_missing", """
SELECT count(*) AS rows_extracted, 'order_id,quantity' AS columns_found, false AS is_valid, 'no column coupon_code' AS errors FROM orders_src""")
register("src_json_odd_keys", "SELECT customer_id AS user_id, customer_name AS first_name, city FROM customers_src")
register("src_json_scalars", "SELECT unnest([customer_id, customer_id * 10]) AS value FROM customers_src")
register("src_json_records", "SELECT product_id, brand FROM products_src")
register("src_json_index", "SELECT CAST(customer_id AS VARCHAR) AS index, customer_name, country FROM customers_src")
register("src_json_object", 'SELECT customer_id, city AS "at.home.city" FROM customers_src')
register("src_json_flatten", """
SELECT customer_id, customer_name, city AS "address.city", country AS "address.country", email AS "contact.email"
FROM customers_src""")
register("src_json_record_path", """
SELECT CAST(line_number AS BIGINT) AS line_number, product_id, supplier_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date
FROM orders_src""")
register("src_payload_path", """
SELECT '/events/' || event_id AS url, event_type <> 'error' AS path_complete,
       CASE WHEN event_type = 'error' THEN CAST(500 AS BIGINT) END AS "error.code",
       CASE WHEN event_type = 'error' THEN 'upstream failure' END AS "error.message",
       CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS "props.k",
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN value END AS value
FROM events""")
register("src_latest_snapshot", "SELECT * FROM clean_customers", _CLEAN_CUSTOMERS)
register("sink_lake_roundtrip", "SELECT * FROM orders_feed")
register("sink_load_modes", "SELECT * FROM clean_customers UNION ALL SELECT * FROM clean_customers",
         _CLEAN_CUSTOMERS)

_EARLY_PRODUCTS = ("t", """
  SELECT * FROM dim_products p WHERE EXISTS (
    SELECT 1 FROM orders_src o WHERE o.product_id = p.product_id AND o.order_date < TIMESTAMP '1998-01-01')""")
_PRICE_OBS = ("b", """
  SELECT * EXCLUDE (rn) FROM (
    SELECT o.product_id, upper(p.product_name) AS product_name, p.category, p.brand, o.unit_price AS price,
           row_number() OVER (PARTITION BY o.product_id
                              ORDER BY o.order_date DESC, o.order_id DESC, o.line_number DESC, o.supplier_id DESC) AS rn
    FROM orders_src o JOIN products_src p ON o.product_id = p.product_id
    WHERE NOT (o.order_date < TIMESTAMP '1998-01-01')) WHERE rn = 1""")
register("load_upsert", """
SELECT coalesce(t.product_id, b.product_id) AS product_id,
       CASE WHEN b.product_id IS NOT NULL THEN b.product_name ELSE t.product_name END AS product_name,
       CASE WHEN b.product_id IS NOT NULL THEN b.category ELSE t.category END AS category,
       CASE WHEN b.product_id IS NOT NULL THEN b.brand ELSE t.brand END AS brand,
       CASE WHEN b.product_id IS NOT NULL THEN b.price ELSE t.price END AS price
FROM t FULL OUTER JOIN b ON t.product_id = b.product_id""", _EARLY_PRODUCTS, _PRICE_OBS)
register("load_upsert_partial", """
SELECT coalesce(t.product_id, b.product_id) AS product_id,
       CASE WHEN t.product_id IS NOT NULL THEN t.product_name ELSE b.product_name END AS product_name,
       CASE WHEN t.product_id IS NOT NULL THEN t.category ELSE b.category END AS category,
       CASE WHEN t.product_id IS NOT NULL THEN t.brand ELSE b.brand END AS brand,
       CASE WHEN b.product_id IS NOT NULL THEN b.price ELSE t.price END AS price
FROM t FULL OUTER JOIN b ON t.product_id = b.product_id""", _EARLY_PRODUCTS, _PRICE_OBS)

_FACT_NOID = ("f0", "SELECT * EXCLUDE (sale_id) FROM fact")
register("load_incremental", """
SELECT * FROM f0 WHERE created_at < TIMESTAMP '1999-01-01'
UNION ALL
SELECT * FROM f0 WHERE created_at > (SELECT max(created_at) FROM f0 WHERE created_at < TIMESTAMP '1999-01-01')""",
         _FACT_NOID)
register("load_watermark", """
SELECT max(created_at) AS last_load_ts, max(total_amount) AS last_amount FROM f0""", _FACT_NOID)
register("load_dim_customers", "SELECT * FROM clean_customers", _CLEAN_CUSTOMERS)
register("load_dim_products", "SELECT * FROM dim_products")
register("load_fact_append", "SELECT * FROM f0", _FACT_NOID)
register("load_star_schema", """
SELECT 'dim_customers' AS table_name, count(*) AS row_count, 0 AS without_time FROM dim_customers
UNION ALL SELECT 'dim_products', count(*), 0 FROM dim_products UNION ALL SELECT 'fact_sales', count(*), 0 FROM fact
UNION ALL SELECT 'dim_date', 0, 0""")
register("agg_generic_sorted", """
SELECT customer_id, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity_sum FROM orders_feed WHERE customer_id IS NOT NULL GROUP BY customer_id""")
register("load_append_replay", "SELECT * FROM f0", _FACT_NOID)

register("etl_batch_run", "SELECT * FROM fact")
register("etl_batch_rerun", "SELECT * FROM fact")

# ---- streaming ----------------------------------------------------------------------

register("stream_daily_sales", """
SELECT date_trunc('day', created_at) AS window_start, date_trunc('day', created_at) + INTERVAL 1 DAY AS window_end,
       count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue
FROM fact GROUP BY 1, 2""")
register("stream_customer_activity", """
SELECT customer_id, last_order_date, last_order_id, last_order_total FROM (
  SELECT o_custkey AS customer_id, o_orderdate AS last_order_date, o_orderkey AS last_order_id,
         o_totalprice AS last_order_total,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")

# The SQL-text marts return the same rows as the DataFrame marts.
for _k in ("bi_top_customers", "bi_top_products", "bi_category_performance", "bi_sales_summary", "bi_daily_sales", "bi_customer_summary",
           "bi_product_summary"):
    SQL[f"{_k}_sql"] = SQL[_k]

register("dq_dimensions", """
SELECT 'completeness' AS dimension, CAST(cells AS DOUBLE) / (CAST(n AS DOUBLE) * 6) AS score FROM a
UNION ALL SELECT 'validity', CAST(valid AS DOUBLE) / CAST(n AS DOUBLE) FROM a
UNION ALL SELECT 'consistency', CAST(cons AS DOUBLE) / CAST(n AS DOUBLE) FROM a
UNION ALL SELECT 'accuracy', CAST(plaus AS DOUBLE) / CAST(n AS DOUBLE) FROM a
UNION ALL SELECT 'timeliness_days', CAST(date_diff('day', CAST(newest AS DATE), DATE '2002-01-01') AS DOUBLE) FROM a""",
         ("b", """
  SELECT f.*, c.customer_id IS NOT NULL AS c_hit, p.product_id IS NOT NULL AS p_hit
  FROM orders_feed f
  LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customers) c ON f.customer_id = c.customer_id
  LEFT JOIN (SELECT DISTINCT product_id FROM dim_products) p ON f.product_id = p.product_id"""),
         ("a", """
  SELECT count(*) AS n,
         count(order_id) + count(customer_id) + count(product_id) + count(quantity) + count(unit_price)
           + count(discount) AS cells,
         sum(CASE WHEN NOT coalesce(NOT (quantity > 0), true) AND NOT coalesce(NOT (unit_price > 0), true)
                       AND NOT coalesce(NOT (discount > 0), true) THEN 1 ELSE 0 END) AS valid,
         sum(CASE WHEN (customer_id IS NULL OR c_hit) AND (product_id IS NULL OR p_hit) THEN 1 ELSE 0 END) AS cons,
         sum(CASE WHEN coalesce(shipped_at >= order_date, false) THEN 1 ELSE 0 END) AS plaus,
         max(shipped_at) AS newest
  FROM b"""))

SQL["load_upsert_bucketed"] = SQL["load_upsert"]

register("stream_fact_append", "SELECT * FROM f0", _FACT_NOID)

register("xf_query_language", """
SELECT * FROM orders_feed WHERE quantity IN (1, 25, 50)
  OR (line_number NOT IN (1, 2) AND quantity >= 5 AND quantity < 20 AND NOT (coalesce(discount > 4, false) OR coalesce(discount = 2, false)))
  OR (discount IS DISTINCT FROM 5 AND quantity * quantity > 2000 AND customer_id % 7 = 3)""")
register("xf_eval_language", """
SELECT *, abs(remainder - steps) * 2 AS twice FROM (
  SELECT order_id, line_number, product_id, supplier_id, quantity, discount,
         CAST(floor((line_number - quantity) / 4.0) AS BIGINT) AS steps,
         CAST((line_number - quantity) - 4 * floor((line_number - quantity) / 4.0) AS INTEGER) AS remainder,
         CAST(-quantity * quantity + pow(2, line_number) AS DOUBLE) AS power,
         NOT coalesce(discount >= 1, false) AS gone, discount IS DISTINCT FROM 3 AS other,
         coalesce(discount IN (1, 2), false) OR (line_number = 1 AND quantity > 10) AS some
  FROM orders_feed)""")
SQL["xf_eval_language"] = SQL["xf_eval_language"].replace("SELECT *, abs(", "SELECT * RENAME (remainder AS \"left\"), abs(")
register("agg_custom", """
SELECT category, CAST(sum(quantity) AS BIGINT) AS quantity_sum, round(exp(avg(ln(quantity))), 6) AS quantity_gmean,
       round(count(*) / sum(1.0::DOUBLE / quantity), 6) AS quantity_hmean, round(count(discount) / sum(1.0::DOUBLE / CAST(discount AS DOUBLE)), 6) AS discount_hmean
FROM orders_feed JOIN dim_products USING (product_id) WHERE category IS NOT NULL GROUP BY category""")
register("src_json_unnest", """
SELECT o_orderkey AS order_id, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) - 1 AS INTEGER) AS at,
       CAST(l_quantity AS BIGINT) AS size
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '1%'
UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority LIKE '1%'
  OR o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
register("src_csv_rejects", """
SELECT 'good' AS outcome, '' AS fields, count(*) AS n, CAST(sum(order_id) AS BIGINT) AS ids, CAST(sum(quantity) AS BIGINT) AS quantity
FROM orders_src WHERE order_id % 101 NOT IN (7, 11, 13, 17)
UNION ALL SELECT 'fields', '', count(*), CAST(sum(order_id) AS BIGINT), NULL FROM orders_src WHERE order_id % 101 IN (7, 11) HAVING count(*) > 0
UNION ALL SELECT 'type', 'quantity', count(*), CAST(sum(order_id) AS BIGINT), NULL FROM orders_src WHERE order_id % 101 = 13 HAVING count(*) > 0
UNION ALL SELECT 'type', 'shipped_at', count(*), CAST(sum(order_id) AS BIGINT), NULL FROM orders_src WHERE order_id % 101 = 17 HAVING count(*) > 0
UNION ALL SELECT 'counted', '', count(*), count(*) FILTER (order_id % 101 IN (7, 11, 13, 17)), NULL FROM orders_src""")
_MARTS = {"stats": ("table_name", ["row_count", "total_records"], """SELECT table_name, row_count, sum(row_count) OVER () AS total_records FROM (
              SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM dim_customers UNION ALL SELECT 'dim_products', count(*) FROM dim_products
              UNION ALL SELECT 'fact_sales', count(*) FROM fact)"""),
          "sales_summary": ("'all'", ["total_orders", "total_quantity", "total_revenue", "avg_order_value", "total_discount"], SQL["bi_sales_summary"]),
          "customer_summary": ("'all'", ["total_customers", "cities", "countries"], SQL["bi_customer_summary"]),
          "product_summary": ("'all'", ["total_products", "categories", "brands", "avg_price"], SQL["bi_product_summary"]),
          "top_customers": ("customer_id", ["order_count", "total_revenue"], SQL["bi_top_customers"]),
          "top_products": ("product_id", ["sales_count", "total_quantity_sold", "total_revenue"], SQL["bi_top_products"]),
          "daily_sales": ("date", ["order_count", "total_quantity", "total_revenue", "avg_order_value"], SQL["bi_daily_sales"]),
          "category_performance": ("category", ["sales_count", "total_quantity", "total_revenue", "avg_order_value"], SQL["bi_category_performance"])}
register("bi_all_marts", " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, CAST({key} AS VARCHAR) AS key, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({text})"
    for mart, (key, measures, text) in _MARTS.items() for m in measures))
register("load_after_drop", "SELECT * FROM f0", _FACT_NOID)
register("load_partitioned_fact", "SELECT * FROM f0", _FACT_NOID)
register("load_type_mismatch", "SELECT customer_id, product_id, quantity, 2 AS refused FROM fact")
register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
register("stream_dedup_late", "SELECT count(*) AS rows, count(DISTINCT event_id) AS events, 0 AS in_both, true AS some_late FROM events")
register("stream_sessions", """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 DAY AS session_end, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS total FROM (
  SELECT *, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 30 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
    SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS cents, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events))
GROUP BY user_id, session""")

register("bi_quarter_sales", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, count(*) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(total_amount) AS DOUBLE) AS total_revenue
FROM (SELECT *, strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS d FROM fact) WHERE year(d) = 1997 AND quarter(d) IN (2, 3) GROUP BY 1, 2, 3""")
SQL["xf_sales_bucketed"] = SQL["xf_sales"]
register("bi_distinct_incremental", """
SELECT category, count(DISTINCT customer_id) AS n_customers, count(DISTINCT date_id) AS n_days, true AS within
FROM fact JOIN dim_products USING (product_id) WHERE category IS NOT NULL GROUP BY category""")
register("lineage_upstream", """
SELECT * FROM (VALUES ('orders_csv', 1), ('dim_customers', 1), ('dim_products', 1), ('customers_jsonl', 2), ('products_jsonl', 2)) AS t(node, depth)
WHERE (SELECT count(*) FROM fact) > 0""")
register("dq_outliers", """
SELECT event_id, event_type, round(median, 9) AS median, round(deviation, 9) AS deviation FROM (
  SELECT *, median(abs(value - median)) OVER (PARTITION BY event_type) AS deviation FROM (
    SELECT *, median(value) OVER (PARTITION BY event_type) AS median FROM (
      SELECT event_id, event_type, CASE WHEN event_id % 997 = 5 THEN value * 1000 + 100000 ELSE value END AS value FROM events)))
WHERE abs(value - median) > 0 AND abs(value - median) / (deviation * 1.4826) >= 8""")
register("stream_sliding_events", """
SELECT start AS window_start, start + INTERVAL 2 DAY AS window_end, event_type, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS cents FROM (
  SELECT date_trunc('day', ts) - INTERVAL (k) DAY AS start, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events, (VALUES (0), (1)) AS t(k))
GROUP BY 1, 2, 3""")

register("src_json_report", """
SELECT count(*) AS rows_extracted, 'city,customer_id' AS columns_found, false AS is_valid, 'no column phone' AS errors, count(*) || ' rows, not 1' AS warnings
FROM customers_src""")
register("clean_null_skip", "SELECT * FROM orders_feed")
register("xf_head", "SELECT * FROM orders_src ORDER BY quantity DESC, order_id, line_number, product_id, supplier_id LIMIT 25")
_MATH = {"sin": "sin(x)", "cos": "cos(x)", "arctan": "atan(x)", "tanh": "tanh(x)", "arcsinh": "asinh(x)", "exp": "exp(x)", "expm1": "exp(x) - 1", "log": "ln(x)",
         "log10": "log10(x)", "log1p": "ln(1 + x)", "sqrt": "sqrt(x)", "floor": "floor(x)", "ceil": "ceil(x)", "angle": "atan2(q, 3) + abs(1 - q)"}
register("xf_math", "SELECT order_id, line_number, product_id, supplier_id, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in _MATH.items())
         + " FROM (SELECT *, CAST(quantity AS DOUBLE) AS q, CAST(quantity AS DOUBLE) / 8 AS x FROM orders_src)")
register("dq_python_rule", """
SELECT 'discount' AS column, CASE WHEN discount IS NULL THEN 'ValueError: no discount' END AS error, count(*) AS violations, CAST(sum(order_id) AS BIGINT) AS ids
FROM orders_feed WHERE discount IS NULL OR discount > 5 GROUP BY 2""")
register("load_audit", """
SELECT 'dim_customers' AS table_name, 'create' AS operation, 0 AS version, count(*) AS rows, NULL AS batch_id, NULL AS watermark_column, CAST(NULL AS DATE) AS watermark_day FROM dim_customers
UNION ALL SELECT 'dim_customers', 'rewrite', 1, count(*), NULL, NULL, NULL FROM dim_customers
UNION ALL SELECT 'fact_sales', 'create', 0, count(*), 'early', 'created_at', CAST(max(created_at) AS DATE) FROM fact WHERE created_at < TIMESTAMP '1999-01-01'
UNION ALL SELECT 'fact_sales', 'append', 0, count(*), 'late', 'created_at', CAST(max(created_at) AS DATE) FROM fact WHERE NOT created_at < TIMESTAMP '1999-01-01'""")
register("etl_step_metrics", """
SELECT s.stage, 'done' AS state, s.counted, s.rows FROM (
  SELECT 'read' AS stage, '' AS counted, CAST(NULL AS BIGINT) AS rows UNION ALL SELECT 'land', 'orders', (SELECT count(*) FROM orders_src)
  UNION ALL SELECT 'land', 'customers', (SELECT count(*) FROM customers_src) UNION ALL SELECT 'land', 'products', (SELECT count(*) FROM products_src)
  UNION ALL SELECT 'clean', '', NULL UNION ALL SELECT 'enrich', '', NULL UNION ALL SELECT 'store', 'rows', (SELECT count(*) FROM orders_src)
  UNION ALL SELECT 'store', 'cleaned', (SELECT count(*) FROM orders_src) UNION ALL SELECT 'publish', 'dim_customers', (SELECT count(*) FROM customers_src)
  UNION ALL SELECT 'publish', 'dim_products', (SELECT count(*) FROM products_src) UNION ALL SELECT 'publish', 'dim_date', (SELECT count(*) FROM dim_date)
  UNION ALL SELECT 'publish', 'fact_sales', (SELECT count(*) FROM fact) UNION ALL SELECT 'check', 'checks', 19) AS s""")
