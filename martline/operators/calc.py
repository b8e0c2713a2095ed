"""Computed columns (P1) and expression filters.

Expressions are text or ``Column`` objects. Text is Spark SQL (``language="sql"``), the pandas ``eval``/``query`` language
(``"pandas"``, see ``functions.expressions``), or by default (``"auto"``) SQL where it parses as SQL and pandas otherwise, as in
``s in ["a", "c"]``, ``x ** 2`` and ``a == @limit``. Expressions are applied in mapping order, so later ones see earlier
results; Catalyst collapses the chain of projections into one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions import expressions


def _to_col(e: str | Column, df: DataFrame, language: str, params: Mapping[str, object] | None, zero_division: str, condition: bool) -> Column:
    if not isinstance(e, str):
        return e
    if language not in ("auto", "sql", "pandas"):
        raise ValueError("language must be 'auto', 'sql' or 'pandas'")
    if language != "pandas":
        try:
            if not params:
                df.select(F.expr(e))  # text is parsed when a plan takes it
                return F.expr(e)
        except ParseException:
            if language == "sql":
                raise
    translate = expressions.predicate if condition else expressions.value
    return translate(e, df.columns, params, zero_division)


def calculate_fields(df: DataFrame, calculations: Mapping[str, str | Column], language: str = "auto",
                     params: Mapping[str, object] | None = None, zero_division: str = "error") -> DataFrame:
    """Add or replace columns in the order of ``calculations``. ``params`` are the values of ``@names`` (pandas text only)."""
    # withColumns evaluates all entries against the *input*; the contract here
    # is sequential, so fold one projection per entry (Catalyst merges them).
    for name, e in calculations.items():
        df = df.withColumn(name, _to_col(e, df, language, params, zero_division, condition=False))
    return df


def filter_data(df: DataFrame, condition: str | Column, language: str = "auto", params: Mapping[str, object] | None = None,
                zero_division: str = "error") -> DataFrame:
    """Keep rows where ``condition`` is TRUE. SQL has three truth values (NULL drops the row); in pandas text a comparison with a
    null is false, so ``not (a > 1)`` and ``a != 1`` keep rows without ``a``."""
    return df.filter(_to_col(condition, df, language, params, zero_division, condition=True))


def head(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """The first ``n`` rows in an explicit order (a top-k: each partition keeps
    n, one merge); without an order Spark rows have no "first", so one is required."""
    if not order_by:
        raise ValueError("head needs order_by: Spark rows have no implicit order")
    cols = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return df.orderBy(*cols).limit(n)
