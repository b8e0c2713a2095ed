"""Lineage: what a warehouse table was made from (§2.14).

Every load names in its audit row what it read (``reads``: tables of the warehouse, or paths). These are the edges of a graph, which a
recursive query walks upstream or downstream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.plans.warehouse import Warehouse

#: Steps of a walk at most; also ends one that goes in circles (a table made from itself).
MAX_DEPTH = 50


def edges(warehouse: Warehouse) -> DataFrame:
    """(child, parent, loads, last_loaded): which tables and paths each table's loads read, over all its history."""
    a = warehouse.audit().where("reads is not null")
    return (a.select(F.col("table_name").alias("child"), F.explode("reads").alias("parent"), "loaded_at")
            .groupBy("child", "parent").agg(F.count("*").alias("loads"), F.max("loaded_at").alias("last_loaded")))


def _walk(warehouse: Warehouse, table: str, start: str, to: str) -> DataFrame:
    spark, name = warehouse.spark, f"lineage_{uuid.uuid4().hex[:8]}"
    edges(warehouse).select("child", "parent").createOrReplaceTempView(name)
    try:
        found = spark.sql(f"""
            WITH RECURSIVE walk(node, depth) AS (
              SELECT {to}, 1 FROM {name} WHERE {start} = :table
              UNION ALL
              SELECT e.{to}, w.depth + 1 FROM walk w JOIN {name} e ON e.{start} = w.node WHERE w.depth < {MAX_DEPTH}
            ) SELECT node, min(depth) AS depth FROM walk GROUP BY node""", args={"table": table})
        found.schema  # noqa: B018  resolved while the view is there
        return found
    finally:
        spark.catalog.dropTempView(name)


def upstream(warehouse: Warehouse, table: str) -> DataFrame:
    """(node, depth): tables and paths that ``table`` was made from, and in how few steps."""
    return _walk(warehouse, table, "child", "parent")


def downstream(warehouse: Warehouse, node: str) -> DataFrame:
    """(node, depth): tables that were made from a table or path."""
    return _walk(warehouse, node, "parent", "child")
