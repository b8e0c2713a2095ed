import os
import tempfile

from pyspark.sql import functions as F


def write(tmp_dir: str, name: str, text: str) -> str:
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def tmpdir() -> str:
    return tempfile.mkdtemp(prefix="martline-test-")


def col_sum(df, c):
    return df.agg(F.sum(c)).first()[0]
