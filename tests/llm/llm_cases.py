"""Small document tables with the awkward cases every operator must stand."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use or return themselves
    T.StructField("size", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("__size", T.StringType()),
    T.StructField("k_id", T.StringType()), T.StructField("data", T.StringType()),
])
WORDS = "the of and to in is für être león naïve Ünder ONE two tHree x yy zzz foo bar baz qux".split()


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", str(r.randint(0, 99))]) for _ in range(n))


def documents(seed: int = 0, n: int = 80, long_words: int = 3000) -> list[tuple]:
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = r.random()
        if out and k < 0.15:
            text = r.choice(out)[1]
            if text is not None and k < 0.05:
                text = text.upper() if text.isascii() else text
        elif out and k < 0.3:
            words = (r.choice(out)[1] or "a b c").split(" ")
            words[r.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif k < 0.35:
            text = None
        elif k < 0.4:
            text = r.choice(["", " ", "\t\n", "one", "\x1cnot blank\x1c"])
        else:
            text = prose(r, r.randint(1, 120)) + r.choice(["", "\n", "\n" + prose(r, 8)])
        source = r.choice(["src0", "src0", "src0", "src1", "b", "Ä", None])
        out.append((i, text, "en", source))
    out.append((n, prose(r, long_words), "en", "src0"))
    out.append((None, out[5][1], "en", "src1"))          # no identifier
    r.shuffle(out)
    return [(*row, len(row[1] or ""), *["clash"] * 8) for row in out]


def frame(spark, rows, parts: int = 4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
