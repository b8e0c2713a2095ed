"""Date parsing with one format a column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats by name, in the order of preference; month-first comes before day-first, as in
# pandas' default (dayfirst=False). The forms of a name are alternatives of one notation.
FORMATS: dict[str, tuple[str, ...]] = {
    "iso": ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd",
            "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXXX",
            "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
    "yyyy/MM/dd": ("yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss"),
    "MM/dd/yyyy": ("M/d/yyyy", "M/d/yyyy HH:mm:ss"),
    "dd/MM/yyyy": ("d/M/yyyy", "d/M/yyyy HH:mm:ss"),
    "dd-MM-yyyy": ("d-M-yyyy",),
    "dd.MM.yyyy": ("d.M.yyyy",),
    "yyyyMMdd": ("yyyyMMdd",),
    "month name": ("MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy"),
}


#: Text that a part of a form can stand for, at least all that Spark's strict parser takes (which is case-insensitive, and takes zeros
#: before a number of one letter).
_PARTS = {"yyyy": r"[+-]?\d{4,}", "MM": r"(?:0[1-9]|1[0-2])", "M": r"0*(?:[1-9]|1[0-2])", "dd": r"(?:0[1-9]|[12]\d|3[01])", "d": r"0*(?:[1-9]|[12]\d|3[01])",
          "HH": r"(?:[01]\d|2[0-4])", "mm": r"[0-5]\d", "ss": r"[0-6]\d", "SSSSSS": r"\d{1,6}", "MMM": "[^0-9]+", "MMMM": "[^0-9]+", "XXX": r"(?:Z|[+-][\d:]+)"}


def shape(form: str) -> str | None:
    """Regular expression that all text of a form matches; None for a form with other parts than the known ones.

    A failed parse costs an exception, so only text of the right shape is parsed."""
    out = []
    for quoted, letters, other in re.findall(r"'([^']*)'|([A-Za-z]+)|([^A-Za-z']+)", form):
        for run in re.findall(r"((.)\2*)", letters):
            if run[0] not in _PARTS:
                return None
            out.append(_PARTS[run[0]])
        if re.search(r"[\[\]{}#]", other) or (other or quoted) == "" and not letters:  # optional sections, a quote
            return None
        out.append(re.escape(quoted + other))
    return "(?i)^" + "".join(out) + "$"


def _parse(c: Column, form: str) -> Column:
    known, parsed = shape(form), F.try_to_timestamp(c, F.lit(form))
    return parsed if known is None else F.when(c.rlike(known), parsed)


def parse_timestamp(c: str | Column, forms: str | Sequence[str]) -> Column:
    """Text -> TIMESTAMP_NTZ by the first form that fits; other text -> NULL. An offset is counted back to UTC (the session's zone)."""
    c = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.coalesce(*[_parse(c, f) for f in ([forms] if isinstance(forms, str) else forms)]).cast(T.TimestampNTZType())


def choose_formats(df: DataFrame, columns: Sequence[str], formats: Mapping[str, Sequence[str]] = FORMATS) -> dict[str, str]:
    """For each text column the first format that parses as many values as any other, from one aggregate over the
    table. A column in which no single format parses all that some format can parse is an error that names two
    formats: a mixed column can't be read without guessing at day and month."""
    names = list(formats)
    masks = []  # a column's bits say which formats parse the value: parsed once, counted for each format
    for i, c in enumerate(columns):
        text = F.col("`" + c.replace("`", "``") + "`")
        bits = [F.when(parse_timestamp(text, formats[n]).isNotNull(), F.lit(1 << k).cast("long")).otherwise(0) for k, n in enumerate(names)]
        masks.append(sum(bits[1:], bits[0]).alias(f"m{i}"))
    aggs = []
    for i in range(len(masks)):
        aggs += [F.count_if(F.col(f"m{i}").bitwiseAND(F.lit(1 << k).cast("long")) != 0).alias(f"n{i}_{k}") for k in range(len(names))]
        aggs.append(F.count_if(F.col(f"m{i}") != 0).alias(f"n{i}"))
    counts = df.select(*masks).agg(*aggs).first() if aggs else None
    out = {}
    for i, c in enumerate(columns):
        by = [counts[f"n{i}_{k}"] for k in range(len(names))]
        best = max(range(len(names)), key=lambda k: (by[k], -k))
        if by[best] < counts[f"n{i}"]:
            other = max((k for k in range(len(names)) if k != best), key=lambda k: by[k])
            raise ValueError(f"column {c!r} mixes date formats: {names[best]!r} parses {by[best]} values, {names[other]!r} {by[other]}, "
                             f"together {counts[f'n{i}']}; give the format")
        out[c] = names[best]
    return out
