"""Shared helpers: input columns, written intermediates, connected components.

Inputs are reduced to the named columns first, so extra columns (also ones named like an
operator's own outputs) never clash. A null text counts as the empty text.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import checkpoint_root, scratch_path

#: Rows of a text table handed to Python at once; with the slices below this bounds a worker's memory.
ARROW_ROWS = 500
ARROW_BYTES = 8 << 20
SLICE_BYTES = 2 << 20


def texts_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """doc_id and text of a table of texts; null text becomes ''."""
    return [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(*texts_columns(id_col, text_col))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: where neither their path nor their folder has it, send it once."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == root or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    out = Path(tempfile.mkdtemp()) / "martline.zip"  # the driver's own copy; Spark serves it to executors
    with zipfile.ZipFile(out, "w") as z:
        for f in (root / "martline").rglob("*.py"):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(out))


_SHIPPED: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Hand text to Python in small record batches (only lowers the session's value)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"  # rows of blobs are large
    now = spark.conf.get(key, None)
    if now and (int(now.rstrip("b")) <= 0 or int(now.rstrip("b")) > ARROW_BYTES):
        spark.conf.set(key, f"{ARROW_BYTES}b")


def slices(batch: pa.RecordBatch, text_at: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about ``limit`` bytes of text each (one long text is a slice by itself)."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i in range(n):
        if total and total + size[i] > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size[i])
    yield batch.slice(start, n - start)


def written(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives lost executors. ``group_rows``: rows of a row
    group at most, for rows of blobs, as writers and readers hold a group in memory."""
    path = scratch_path(df.sparkSession, name)
    for t in _TRACKS:
        t.paths.append(path)
    w = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tracked:
    """Scratch tables written by ``written`` while it is active; ``clear`` deletes them, but none that a frame still reads."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> Tracked:
        _TRACKS.append(self)
        return self

    def __exit__(self, *_) -> None:  # noqa: ANN002
        _TRACKS.remove(self)

    def clear(self, spark: SparkSession, needed: DataFrame) -> None:
        read = {f.rsplit("/", 2)[-2] for f in needed.inputFiles()} if self.paths else set()  # names of the files' folders, which are unique
        for path in list(self.paths):
            if path.rsplit("/", 1)[-1] not in read:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
                self.paths.remove(path)


_TRACKS: list[Tracked] = []


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a frame made by ``written`` (only below the checkpoint folder)."""
    root = checkpoint_root(spark).split(":", 1)[-1].replace("//", "/")
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"{root}/martline/" in name.split(":", 1)[-1].replace("//", "/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def meet(rows: DataFrame, keys: list[str], spread: str, size: int, name: str) -> DataFrame:
    """Rows sorted so that all of a cell stand together: columns part, cell.

    A bucket of up to ``size`` rows is one cell. A larger one is cut by the hash of ``spread`` into parts, and every two
    parts (and each with itself) meet in a cell of their own: all pairs of rows of the bucket are together in some
    cell, and no task gets more than about 2 * ``size`` rows of it. Only the keys of the large buckets are written and
    joined back; their table is small or none."""
    large = written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > size)
                    .select(*keys, F.ceil(F.col("n") / size).cast("int").alias("parts")), name)
    if large.isEmpty():
        cells = rows.withColumns({"part": F.lit(0), "cell": F.lit(0).cast("long")})
    else:
        parts = F.coalesce("parts", F.lit(1))
        cell = F.transform(F.sequence(F.lit(0), parts - 1),
                           lambda j: F.least("part", j).cast("long") * parts + F.greatest("part", j))
        cells = (rows.join(large, keys, "left").withColumn("part", F.pmod(F.xxhash64(spread), parts).cast("int"))
                 .select(*rows.columns, "part", F.explode(cell).alias("cell")))
    return cells.repartition(*keys, "cell").sortWithinPartitions(*keys, "cell")


class Recent(dict):
    """Values by key (text), made when they are first asked for. ``turn`` drops what was not asked for since the turn before
    the last, so at most about twice ``keep`` entries are held; those of long keys never are."""

    LONG = 256

    def __init__(self, make: Callable, keep: int) -> None:
        super().__init__()
        self.make, self.keep, self.old = make, keep, {}

    def __missing__(self, key):  # noqa: ANN001, ANN204
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.LONG:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.keep:
            self.old = self.copy()
            self.clear()


_CACHES: dict[str, Callable[[], None]] = {}
_AT_WORK = ""


def at_work(name: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called by an operator's tasks: what a worker process keeps from one task to the next it keeps for one operator at a
    time. When another one comes, the caches go and their memory is given back."""
    global _AT_WORK
    _CACHES[name] = clear
    if name == _AT_WORK:
        return
    for other, forget in _CACHES.items():
        if other != name:
            forget()
    _AT_WORK = name
    give_back()


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Forest:
    """Union-find over 64-bit ids; the root of a set is its smallest id."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while (y := up.get(x, x)) != root:
            up[x] = root
            x = y
        return root

    def join(self, pairs: Iterable[tuple[int, int]]) -> None:
        for a, b in pairs:
            a, b = self.find(a), self.find(b)
            if a != b:
                self.up[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        """One edge (id, root) for each id that is not a root: a spanning star per set."""
        return [(x, self.find(x)) for x in list(self.up)]


EDGES = "src long, dst long"
_EDGES = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(a[:, 0]), pa.array(a[:, 1])], schema=_EDGES)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as spanning stars; the forest is emitted and begun anew when it gets large,
    so memory stays bounded whatever a partition holds."""
    forest = Forest()
    for b in batches:
        forest.join(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if len(forest.up) > 1_000_000:
            yield edge_batch(forest.edges())
            forest = Forest()
    yield edge_batch(forest.edges())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every id that has an edge to another id.

    Alternating large-star and small-star rounds over (src, dst) edges; each round is written to the
    shared checkpoint folder, and the rounds end when every node has one edge, to its root. The minima
    are aggregates with map-side combine, and the joins have a shuffle on either side, so AQE splits a
    hub's partition. Self-loops and repeated edges are allowed; nulls are dropped.
    """
    spark = edges.sparkSession
    e = (edges.select(F.col(edges.columns[0]).cast("long").alias("src"), F.col(edges.columns[1]).cast("long").alias("dst"))
         .where("src is not null and dst is not null and src <> dst"))
    # the edges are written first: found and contracted in one stage they would need two Python workers a task
    raw = written(e, "cc")
    e = written(raw.mapInArrow(_contract, EDGES).distinct(), "cc")
    discard(spark, raw)
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
        if not now[0] or now == seen:
            return e.select(F.col("src").alias("node"), F.col("dst").alias("component"))
        seen = now
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        near = written(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")), "cc")
        large = written(both.join(near, "src").where("dst > src and dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
                        .distinct(), "cc")
        low = written(large.groupBy("src").agg(F.min("dst").alias("low")), "cc")
        small = (large.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
                 .unionByName(low.select("src", F.col("low").alias("dst"))).where("src <> dst").distinct())
        old, e = e, written(small, "cc")
        for x in (old, near, large, low):
            discard(spark, x)
