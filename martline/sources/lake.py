"""Lake snapshots (K1, K2) and the latest-snapshot scan.

Layout: ``<base>/<zone>/<name>/snapshot_ts=YYYYmmdd_HHMMSS/part-*.<fmt>`` with
zone ``raw`` or ``processed``. Each save writes one new partition directory
(no rewrite of older ones); the latest snapshot is found by folder name and read alone.
Files are compressed, also text (parquet as zstd, text as gzip: a file is read by one task, as one wrote it).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("parquet", "csv", "json")
CODECS = {"parquet": "zstd", "csv": "gzip", "json": "gzip"}
_SNAP = re.compile(r"snapshot_ts=(\d{8}_\d{6})")


def snapshot_label(ts: dt.datetime | None = None) -> str:
    return (ts or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


class DataLake:
    def __init__(self, spark: SparkSession, base_path: str):
        self.spark = spark
        self.base = base_path.rstrip("/")

    def _dir(self, zone: str, name: str) -> str:
        return f"{self.base}/{zone}/{name}"

    def _save(self, df: DataFrame, zone: str, name: str, format: str, timestamp) -> str:  # noqa: A002
        if format not in FORMATS:
            raise ValueError(f"no snapshots of kind {format}")
        path = f"{self._dir(zone, name)}/snapshot_ts={snapshot_label(timestamp)}"
        w = df.write.mode("errorifexists").format(format).option("compression", CODECS[format])
        if format == "csv":
            w = w.option("header", True).option("escape", '"')
        w.save(path)
        return path

    def save_raw(self, df: DataFrame, source: str, format: str = "parquet", timestamp=None) -> str:  # noqa: A002
        """K1: one new snapshot of a source; JSON is one record per line, ISO timestamps."""
        return self._save(df, "raw", source, format, timestamp)

    def save_processed(self, df: DataFrame, name: str, format: str = "parquet", timestamp=None) -> str:  # noqa: A002
        """K2: same layout under the ``processed`` zone."""
        return self._save(df, "processed", name, format, timestamp)

    def _reader(self, format: str, schema: T.StructType | None):  # noqa: A002, ANN202
        reader = self.spark.read.format(format)
        if format == "csv":
            reader = reader.option("header", True).option("escape", '"').option("inferSchema", schema is None)
        return reader if schema is None else reader.schema(schema)

    def snapshots(self, zone: str, name: str, format: str = "parquet",  # noqa: A002
                  schema: T.StructType | None = None) -> DataFrame:
        """All snapshots, with their label in ``snapshot_ts``."""
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField("snapshot_ts", T.StringType())])
        return self._reader(format, schema).option("basePath", self._dir(zone, name)).load(self._dir(zone, name))

    def latest_label(self, zone: str, name: str) -> str | None:
        """Newest snapshot by its folder's name; only that folder is listed, no file is opened."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._dir(zone, name))
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return None
        found = [_SNAP.fullmatch(s.getPath().getName()) for s in fs.listStatus(path)]
        return max((m.group(1) for m in found if m), default=None)

    def latest(self, zone: str, name: str, format: str = "parquet",  # noqa: A002
               schema: T.StructType | None = None) -> DataFrame:
        """Rows of the newest snapshot; only its folder is read, also to infer a schema."""
        label = self.latest_label(zone, name)
        if label is None:
            raise FileNotFoundError(f"no snapshot under {self._dir(zone, name)}")
        return self._reader(format, schema).load(f"{self._dir(zone, name)}/snapshot_ts={label}")
