"""Text helpers that keep Python ``str.strip`` / ``str.lower`` semantics in JVM expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whitespace_class() -> str:
    # The characters Python's str.strip() removes (str.isspace), as one regex class.
    chars = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    return "[" + "".join(f"\\x{{{ord(c):04x}}}" for c in chars) + "]"


WHITESPACE_CLASS = _whitespace_class()
STRIP_PATTERN = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def strip(c: str | Column) -> Column:
    """Remove leading/trailing whitespace (tabs, newlines, Unicode blanks); NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, STRIP_PATTERN, "")


def normalize_email(c: str | Column) -> Column:
    """Lower case, then strip."""
    c = F.col(c) if isinstance(c, str) else c
    return strip(F.lower(c))
