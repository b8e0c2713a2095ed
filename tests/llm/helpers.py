"""Small frames with odd cases, and brute-force versions."""

import random

import public_tokenizers
from pyspark.sql import types as T

TOKENIZER = str(public_tokenizers.path("word_bpe_49k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))

#: An extra column named like operators' own columns.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("component_id", T.StringType()),
                     T.StructField("block", T.LongType()), T.StructField("ids", T.StringType())])
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        T.StructField("id", T.StringType()), T.StructField("n", T.StringType())])


LETTERS = str.maketrans("0123456789", "abcdefghij")


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x".translate(LETTERS) for _ in range(n))


def odd_docs(seed: int = 0) -> list[tuple]:
    """Null and empty texts, copies, near copies, a shared passage, a very long text, letters of many bytes, repeated rows."""
    rng = random.Random(seed)
    passage, long = words(rng, 40), words(rng, 9000)
    base = [words(rng, rng.randrange(1, 200)) for _ in range(30)]
    texts = [None, "", "  \t\n", "one", "One two\x0bthree", "äöü 日本語 😀 naïve", *base, base[3], base[3], base[4] + " tail",
             base[5] + " " + passage, passage + " " + base[6], "é" * 300, "é" * 300, "ab" * 400, long, long[: len(long) // 2], base[7].upper()]
    rows = [(i, t, "x", None, None) for i, t in enumerate(texts)]
    return [*rows, (7, base[1], "x", 1, "y"), (7, base[1], "x", 1, "y"), (None, base[2], None, 2, "z"), (None, None, None, None, None)]


def docs(spark, rows=None):
    return spark.createDataFrame(odd_docs() if rows is None else rows, DOCS)


def union_find(n: int, pairs) -> list[int]:
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
