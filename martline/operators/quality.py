"""Validation and data-quality checks.

Every data check is one aggregate pass: null counts, completeness and rule
violation counts for all columns/rules are computed by a single ``agg`` and
then unpivoted with ``stack`` into one-row-per-check reports (no driver loop
over rows, no job per column). Violating rows are a separate DataFrame.
Rules are ``Column`` predicates or SQL text; a row violates a rule when the
predicate is FALSE *or NULL* (a NULL value fails a comparison).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.operators.ordered import grouped_exact_median

# Type families accepted by the schema check.
TYPE_FAMILIES: dict[str, tuple[type, ...]] = {
    "int": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "str": (T.StringType, T.VarcharType, T.CharType),
    "bool": (T.BooleanType,),
}
PY_FAMILIES = {int: "int", float: "float", str: "str", bool: "bool"}

# The pipeline's default checks on orders.
DEFAULT_REQUIRED = ["order_id", "customer_id", "product_id", "quantity", "unit_price"]
DEFAULT_RULES = {"quantity": "quantity > 0", "unit_price": "unit_price > 0"}
DEFAULT_MIN_COMPLETENESS = 0.95
HIGH_NULL_SHARE = 0.5


def _q(c: str) -> str:
    return f"`{c}`"


def _family(expected) -> str:
    return PY_FAMILIES.get(expected, expected)


def type_matches(dt: T.DataType, expected) -> bool:
    fam = _family(expected)
    return isinstance(dt, TYPE_FAMILIES.get(fam, ()))


def rule_column(rule: str | Column | Callable) -> Column:
    if isinstance(rule, Column):
        return rule
    if isinstance(rule, str):
        return F.expr(rule)
    raise TypeError("rules are Column or SQL text; wrap Python callables with python_rule()")


def python_rule(column: str, fn: Callable, name: str | None = None) -> Column:
    """Fallback for a Python predicate: an Arrow-batched pandas UDF that treats
    an exception (or a non-True result) as a violation, as the reference does."""

    @F.pandas_udf(T.BooleanType())
    def _check(s: pd.Series) -> pd.Series:
        def ok(v):
            try:
                return bool(fn(None if pd.isna(v) else v)) if not isinstance(v, (list, dict)) else bool(fn(v))
            except Exception:  # noqa: BLE001 - the rule's own failure counts as a violation
                return False
        return s.map(ok).astype(bool)

    return _check(F.col(_q(column)))


def python_rule_error(column: str, fn: Callable) -> Column:
    """What a Python rule raised for a value, as text; null where it gave an answer. For ``rule_violations(errors=...)``."""

    @F.pandas_udf(T.StringType())
    def _said(s: pd.Series) -> pd.Series:
        def said(v):
            try:
                fn(None if not isinstance(v, (list, dict)) and pd.isna(v) else v)
            except Exception as e:  # noqa: BLE001 - whatever the rule raises is reported
                return f"{type(e).__name__}: {e}"
            return None
        return s.map(said).astype(object)

    return _said(F.col(_q(column)))


def violation(rule: str | Column) -> Column:
    """TRUE when the row breaks the rule (FALSE or NULL predicate)."""
    return F.coalesce(~rule_column(rule), F.lit(True))


# ---- V1 schema -------------------------------------------------------------------

def schema_faults(df: DataFrame, required_columns: Sequence[str],
                  column_types: Mapping[str, object] | None = None) -> list[tuple[str, str, str]]:
    """(check, column, what is wrong) for absent required columns, then for columns of another type family."""
    have = {f.name: f.dataType for f in df.schema}
    absent = [("schema_missing", c, f"{c} is required and absent") for c in sorted(set(required_columns) - have.keys())]
    wrong = [("schema_type", c, f"{c} is {have[c].simpleString()}, not {_family(want)}")
             for c, want in (column_types or {}).items() if c in have and not type_matches(have[c], want)]
    return absent + wrong


def schema_check(df: DataFrame, required_columns: Sequence[str],
                 column_types: Mapping[str, object] | None = None) -> DataFrame:
    """V1 as rows: column, expected_type, actual_type, present, type_ok, non_null
    (``non_null`` comes from one pass over the data)."""
    types = dict(column_types or {})
    names = list(dict.fromkeys(list(required_columns) + list(types)))
    present = [c for c in names if c in df.columns]
    counts = df.agg(*[F.count(_q(c)).alias(c) for c in present]) if present \
        else df.agg(F.count(F.lit(1)).alias("__rows"))
    entries = []
    for c in names:
        exp = _family(types[c]) if c in types else None
        if c in df.columns:
            act = df.schema[c].dataType.simpleString()
            ok = True if c not in types else type_matches(df.schema[c].dataType, types[c])
            nn = F.col(_q(c)).cast("long")
        else:
            act, ok, nn = None, False, F.lit(None).cast("long")
        entries.append(F.struct(F.lit(c).alias("column"), F.lit(exp).cast("string").alias("expected_type"),
                                F.lit(act).cast("string").alias("actual_type"),
                                F.lit(c in df.columns).alias("present"), F.lit(ok).alias("type_ok"),
                                nn.alias("non_null")))
    return counts.select(F.inline(F.array(*entries)))


# ---- V2 / S9 profile -------------------------------------------------------------

def profile(df: DataFrame) -> DataFrame:
    """Per column: dtype, null_count, null_percentage (0 for an empty frame),
    high_null (more than half NULL), plus the row count. One pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(F.when(F.col(_q(c)).isNull(), 1).otherwise(0)).alias(f"__n{i}")
                   for i, c in enumerate(cols)])
    rows = F.col("__rows")
    entries = []
    for i, c in enumerate(cols):
        n = F.coalesce(F.col(f"__n{i}"), F.lit(0)).cast("long")
        entries.append(F.struct(
            F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            n.alias("null_count"),
            F.when(rows > 0, n.cast("double") * 100 / rows.cast("double")).otherwise(F.lit(0.0)).alias("null_percentage"),
            (n.cast("double") > rows.cast("double") * HIGH_NULL_SHARE).alias("high_null"),
            rows.alias("row_count")))
    return agg.select(F.inline(F.array(*entries)))


# ---- V3 business rules ----------------------------------------------------------

def rule_counts(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Per rule: column, violations, passed, error (absent column -> error text,
    not counted as a failure: the report stays valid, as in the reference)."""
    live = {c: r for c, r in rules.items() if c in df.columns}
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(F.when(violation(r), 1).otherwise(0)).alias(f"__v{i}")
                   for i, (c, r) in enumerate(live.items())])
    entries = []
    live_idx = {c: i for i, c in enumerate(live)}
    for c in rules:
        if c in live_idx:
            v = F.coalesce(F.col(f"__v{live_idx[c]}"), F.lit(0)).cast("long")
            entries.append(F.struct(F.lit(c).alias("column"), v.alias("violations"),
                                    (v == 0).alias("passed"), F.lit(None).cast("string").alias("error")))
        else:
            entries.append(F.struct(F.lit(c).alias("column"), F.lit(0).cast("long").alias("violations"),
                                    F.lit(True).alias("passed"),
                                    F.lit(f"no column {c} for its rule").alias("error")))
    return agg.select(F.inline(F.array(*entries)))


def rule_violations(df: DataFrame, rules: Mapping[str, str | Column], key_columns: Sequence[str],
                    errors: Mapping[str, Callable] | None = None) -> DataFrame:
    """Violating rows: rule column, the row key columns, the value as text. ``errors`` names the Python functions behind rules made by
    ``python_rule``: a column ``error`` then says what a function raised for the value (null: it was simply broken)."""
    if errors:
        out = rule_violations(df.withColumns({f"__e_{c}": python_rule_error(c, fn) for c, fn in errors.items()}), rules,
                              [*key_columns, *[f"__e_{c}" for c in errors]])
        said = F.coalesce(*[F.when(F.col("column") == c, F.col(_q(f"__e_{c}"))) for c in errors], F.lit(None).cast("string"))
        return out.withColumn("error", said).drop(*[f"__e_{c}" for c in errors])
    live = [(c, r) for c, r in rules.items() if c in df.columns]
    if not live:
        raise ValueError("no rule column present")
    arr = F.array(*[F.when(violation(r), F.struct(F.lit(c).alias("column"),
                                                   F.col(_q(c)).cast("string").alias("value")))
                    for c, r in live])
    return (df.select(*[F.col(_q(k)) for k in key_columns], F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("__v"))
              .select(F.col("__v.column").alias("column"), *[F.col(_q(k)) for k in key_columns],
                      F.col("__v.value").alias("value")))


# ---- V4 completeness --------------------------------------------------------------

def completeness(df: DataFrame, columns: Sequence[str] | None = None,
                 min_completeness: float = DEFAULT_MIN_COMPLETENESS) -> DataFrame:
    """Per column: null_count, completeness = 1 - nulls/rows (0 when empty), passed."""
    cols = [c for c in (columns or df.columns) if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(_q(c)).alias(f"__c{i}") for i, c in enumerate(cols)])
    rows = F.col("__rows")
    entries = []
    for i, c in enumerate(cols):
        nn = F.col(f"__c{i}")
        comp = F.when(rows > 0, nn.cast("double") / rows.cast("double")).otherwise(F.lit(0.0))
        entries.append(F.struct(F.lit(c).alias("column"), (rows - nn).alias("null_count"),
                                comp.alias("completeness"), (comp >= F.lit(min_completeness)).alias("passed")))
    return agg.select(F.inline(F.array(*entries)))


# ---- V5 validate-all ---------------------------------------------------------------

def validate_all(df: DataFrame, required_columns: Sequence[str] = DEFAULT_REQUIRED,
                 column_types: Mapping[str, object] | None = None,
                 business_rules: Mapping[str, str | Column] | None = None,
                 min_completeness: float = DEFAULT_MIN_COMPLETENESS) -> DataFrame:
    """One row per check: check, column, value, passed, message - from ONE pass.

    Checks: row_count, column_count, schema (missing / type), high_null
    (warning only), completeness over ``required_columns``, rule violations.
    The overall flag is ``bool_and(passed)`` over rows whose check counts.
    """
    cols = df.columns
    req = [c for c in required_columns if c in cols]
    rules = {c: r for c, r in (business_rules or {}).items()}
    live = {c: r for c, r in rules.items() if c in cols}
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(_q(c)).alias(f"__c{i}") for i, c in enumerate(cols)],
                 *[F.sum(F.when(violation(r), 1).otherwise(0)).alias(f"__v{i}") for i, (c, r) in enumerate(live.items())])
    rows = F.col("__rows")

    def entry(check, column, value, passed, counts, message):
        return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                        value.cast("double").alias("value"), passed.alias("passed"),
                        F.lit(counts).alias("counts_toward_valid"), message.cast("string").alias("message"))

    entries = [entry("row_count", None, rows, F.lit(True), False, F.lit(None)),
               entry("column_count", None, F.lit(len(cols)), F.lit(True), False, F.lit(None))]
    for check, c, message in schema_faults(df, required_columns, column_types):
        entries.append(entry(check, c, F.lit(None), F.lit(False), True, F.lit(message)))
    idx = {c: i for i, c in enumerate(cols)}
    for c in cols:
        nulls = rows - F.col(f"__c{idx[c]}")
        high = nulls.cast("double") > rows.cast("double") * HIGH_NULL_SHARE
        entries.append(entry("null_share", c, F.when(rows > 0, nulls.cast("double") / rows).otherwise(0.0),
                             ~high, False, F.when(high, F.lit(f"Column '{c}' has a high null share"))))
    for c in req:
        comp = F.when(rows > 0, F.col(f"__c{idx[c]}").cast("double") / rows).otherwise(F.lit(0.0))
        entries.append(entry("completeness", c, comp, comp >= F.lit(min_completeness), True,
                             F.when(comp < F.lit(min_completeness), F.lit(f"Column '{c}' below minimum completeness"))))
    for i, c in enumerate(live):
        v = F.coalesce(F.col(f"__v{i}"), F.lit(0))
        entries.append(entry("business_rule", c, v, v == 0, True,
                             F.when(v > 0, F.concat(v.cast("string"), F.lit(f" rows break the rule of {c}")))))
    for c in rules:
        if c not in live:
            entries.append(entry("business_rule", c, F.lit(None), F.lit(True), False,
                                 F.lit(f"no column {c} for its rule")))
    return agg.select(F.inline(F.array(*entries)))


def report_is_valid(report: DataFrame) -> bool:
    row = report.agg(F.bool_and(F.when(F.col("counts_toward_valid"), F.col("passed"))).alias("ok")).first()
    return bool(row["ok"]) if row["ok"] is not None else True


# ---- V8-V11 warehouse constraints ------------------------------------------------

def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation absorbs hot keys)."""
    return df.groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias("occurrences")) \
             .where(F.col("occurrences") > 1)


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Fact rows whose non-NULL ``fk`` has no ``pk`` in the dimension (NULL FK allowed)."""
    d = dim.select(F.col(_q(pk)).alias("__pk"))
    return fact.where(F.col(_q(fk)).isNotNull()).join(d, F.col(_q(fk)) == F.col("__pk"), "left_anti")


def fk_orphan_counts(fact: DataFrame, checks: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key: fk_column, orphan_rows. The fact is read once: its keys are unpivoted to
    (key column, value), counted with map-side combine, and joined to all the dimensions' keys together."""
    values = F.array(*[F.struct(F.lit(fk).alias("fk_column"), F.col(_q(fk)).cast("string").alias("value")) for fk, _, _ in checks])
    used = (fact.select(F.explode(values).alias("u")).select("u.*").where("value is not null")
            .groupBy("fk_column", "value").agg(F.count(F.lit(1)).alias("n")))
    keys = None
    for fk, dim, pk in checks:
        one = dim.select(F.lit(fk).alias("fk_column"), F.col(_q(pk)).cast("string").alias("value"))
        keys = one if keys is None else keys.unionByName(one)
    lost = used.join(keys, ["fk_column", "value"], "left_anti").groupBy("fk_column").agg(F.sum("n").alias("n"))
    names = fact.sparkSession.createDataFrame([(fk,) for fk, _, _ in checks], "fk_column string")
    return names.join(lost, "fk_column", "left").select("fk_column", F.coalesce("n", F.lit(0)).cast("long").alias("orphan_rows"))


def not_null_check(df: DataFrame, not_null: Sequence[str], unique: Sequence[str] = ()) -> DataFrame:
    """NOT NULL violations per column (one pass) and UNIQUE violations (duplicate values)."""
    agg = df.agg(*[F.sum(F.when(F.col(_q(c)).isNull(), 1).otherwise(0)).alias(f"__n{i}")
                   for i, c in enumerate(not_null)])
    nn = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit("not_null").alias("constraint"),
                 F.coalesce(F.col(f"__n{i}"), F.lit(0)).cast("long").alias("violations"))
        for i, c in enumerate(not_null)])))
    out = nn
    for c in unique:
        dup = (df.where(F.col(_q(c)).isNotNull()).groupBy(_q(c)).agg(F.count(F.lit(1)).alias("__k"))
                 .where(F.col("__k") > 1).agg(F.coalesce(F.sum(F.col("__k") - 1), F.lit(0)).cast("long").alias("violations"))
                 .select(F.lit(c).alias("column"), F.lit("unique").alias("constraint"), "violations"))
        out = out.unionByName(dup)
    return out


def type_bounds(df: DataFrame, varchar: Mapping[str, int] = {}, decimals: Mapping[str, tuple[int, int]] = {}) -> DataFrame:  # noqa: B006
    """VARCHAR(n) over-length and DECIMAL(p,s) overflow counts, one pass."""
    checks = [(c, f"varchar({n})", F.length(F.col(_q(c))) > n) for c, n in varchar.items()]
    checks += [(c, f"decimal({p},{s})", F.col(_q(c)).isNotNull()
                & F.col(_q(c)).try_cast(T.DecimalType(p, s)).isNull()) for c, (p, s) in decimals.items()]
    agg = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).alias(f"__b{i}") for i, (_, _, cond) in enumerate(checks)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("constraint"),
                 F.coalesce(F.col(f"__b{i}"), F.lit(0)).cast("long").alias("violations"))
        for i, (c, kind, _) in enumerate(checks)])))


# ---- quality dimensions (declared in the reference's docs) -----------------------

def quality_dimensions(df: DataFrame, required_columns: Sequence[str], rules: Mapping[str, str | Column],
                       references: Sequence[tuple[str, DataFrame, str]] = (),
                       plausible: str | Column | None = None, freshness_column: str | None = None,
                       as_of=None) -> DataFrame:
    """One row per dimension, from one aggregate pass (reference keys joined first):

    completeness  non-NULL share of the required cells
    validity      share of rows passing every rule (NULL fails)
    consistency   share of rows whose every foreign key resolves (NULL FK counts as resolved)
    accuracy      share of rows passing the ``plausible`` cross-field check
    timeliness    days from the newest ``freshness_column`` value to ``as_of``
    """
    base = df
    flags = []
    for i, (fk, dim, pk) in enumerate(references):
        keys = dim.select(F.col(_q(pk)).alias(f"__pk{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        base = base.join(keys, F.col(_q(fk)) == F.col(f"__pk{i}"), "left")
        flags.append(F.col(_q(fk)).isNull() | F.col(f"__hit{i}").isNotNull())
    req = [c for c in required_columns if c in df.columns]
    live = [r for c, r in rules.items() if c in df.columns]
    valid = F.lit(True)
    for r in live:
        valid = valid & ~violation(r)
    consistent = F.lit(True)
    for f in flags:
        consistent = consistent & f
    plaus = F.coalesce(rule_column(plausible), F.lit(False)) if plausible is not None else F.lit(True)
    agg = base.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(_q(c)).alias(f"__c{i}") for i, c in enumerate(req)],
        F.sum(F.when(valid, 1).otherwise(0)).alias("__valid"),
        F.sum(F.when(consistent, 1).otherwise(0)).alias("__cons"),
        F.sum(F.when(plaus, 1).otherwise(0)).alias("__plaus"),
        (F.max(_q(freshness_column)) if freshness_column else F.lit(None)).alias("__newest"))
    rows = F.col("__rows").cast("double")

    def share(x):
        return F.when(F.col("__rows") > 0, x.cast("double") / rows).otherwise(F.lit(None).cast("double"))

    cells = F.lit(0).cast("long")
    for i in range(len(req)):
        cells = cells + F.col(f"__c{i}")
    completeness = F.when(F.col("__rows") > 0, cells.cast("double") / (rows * len(req))) if req \
        else F.lit(None).cast("double")
    timeliness = (F.datediff(F.lit(as_of).cast("date"), F.to_date("__newest")).cast("double")
                  if freshness_column and as_of is not None else F.lit(None).cast("double"))
    return agg.select(F.inline(F.array(
        F.struct(F.lit("completeness").alias("dimension"), completeness.alias("score")),
        F.struct(F.lit("validity").alias("dimension"), share(F.col("__valid")).alias("score")),
        F.struct(F.lit("consistency").alias("dimension"), share(F.col("__cons")).alias("score")),
        F.struct(F.lit("accuracy").alias("dimension"), share(F.col("__plaus")).alias("score")),
        F.struct(F.lit("timeliness_days").alias("dimension"), timeliness.alias("score")))))


# ---- anomalies (declared in the reference's docs) ---------------------------------

#: Makes the median absolute deviation of normal values their standard deviation.
MAD_SCALE = 1.4826


def outliers(df: DataFrame, column: str, group_by: Sequence[str], least: float = 5.0) -> DataFrame:
    """Rows of ``df`` whose value is at least ``least`` robust standard deviations from its group's median, with columns ``median``,
    ``deviation`` (median of the absolute distances) and ``robust_z``.

    Both medians are exact, from counted values in a range shuffle, so a large group spreads over many partitions. Groups with a null
    key and null values have no outliers; in a group whose deviation is 0 every other value is one (``robust_z`` null)."""
    keys = list(group_by)
    value = F.col(_q(column)).cast("double")
    middle = grouped_exact_median(df.select(*[F.col(_q(k)) for k in keys], value.alias("__v")), keys, "__v", "median")
    far = df.join(middle, keys).withColumn("__far", F.abs(value - F.col("median")))
    spread = grouped_exact_median(far.select(*[F.col(_q(k)) for k in keys], "__far"), keys, "__far", "deviation")
    z = F.try_divide(F.col("__far"), F.col("deviation") * F.lit(MAD_SCALE))
    out = far.join(spread, keys).where((F.col("__far") > 0) & (F.coalesce(z, F.lit(float("inf"))) >= least))
    return out.select(*[F.col(_q(c)) for c in df.columns], "median", "deviation", z.alias("robust_z"))
