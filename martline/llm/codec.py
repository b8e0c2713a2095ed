"""Encoding and decoding of whole texts by Spark tasks (see ``bpe.WordBPE``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from martline.llm.bpe import word_bpe
from martline.llm.common import slices, small_batches, texts

ENCODED = "doc_id long, ids binary, n_tokens long"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64())])


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens): ids as little-endian uint32 bytes, one row per input row.

    Null text is the empty text (no ids); rows that repeat stay; a null id stays null; an empty table gives no
    rows. Narrow: no shuffle. Long texts are handled one at a time."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = [bpe.encode(x) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array([x.tobytes() for x in ids], pa.binary()),
                                       pa.array([len(x) for x in ids], pa.int64())], schema=_ENCODED)

    return texts(df, id_col, text_col).mapInArrow(run, ENCODED)


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) decoded from ids as written by ``encode``; special tokens are kept. Null ids give ''."""
    import numpy as np

    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                out = [bpe.decode(np.frombuffer(x or b"", dtype="<u4")) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    from pyspark.sql import functions as F

    return (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("binary").alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


def encode_digest(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode then decode within a task, only digests leave it."""
    import hashlib

    small_batches(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in slices(batch):
                n, a, b = [], [], []
                for text in part.column(1).to_pylist():
                    ids = bpe.encode(text)
                    n.append(len(ids))
                    a.append(sha(ids.tobytes()))
                    b.append(sha(bpe.decode(ids)))
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], schema=schema)

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
