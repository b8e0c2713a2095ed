"""Landed API payloads -> rows.

HTTP fetching is not part of the engine: responses are landed as a table
``(url, status, body)`` (one row per response or page, so paging is more
rows), and this operator turns the bodies into rows in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions import json as J


def payload_rows(responses: DataFrame, json_path: str | None = "data.results", body: str = "body",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Walk ``json_path`` in each body; when a step is missing, use the value
    reached so far (``path_complete`` tells which rows stopped early). A list
    of objects gives one row per object (flattened), an object one row, a
    scalar one ``value`` row. Malformed bodies raise when evaluated."""
    doc = F.parse_json(F.col(body))
    located = responses.select(*keep, J.walk_path(doc, json_path).alias("__at"),
                               J.path_complete(doc, json_path).alias("path_complete"))
    recs = located.select(*keep, "path_complete",
                          F.explode(J.rows_of(F.col("__at"), orient="none", allow_scalar=True)).alias("__rec"))
    return J.records_to_frame(recs, "__rec", keep=list(keep) + ["path_complete"])
