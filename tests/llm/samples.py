"""Small inputs that the operators' tests share."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string"
#: Nulls in each column, empty and blank texts, repeated rows, one id with two texts.
ODD = [
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "an odd row without an id"),
    (4, "a repeated row"),
    (4, "a repeated row"),
    (5, "one id"),
    (5, "two texts"),
    (6, "x\x00y NUL and ß 的字 👍 #*$"),
]


def sentences(n: int, seed: int = 3) -> str:
    rng = random.Random(seed)
    stems = ["lorem", "ipsum", "dolor", "süß", "amet", "consectetur", "的字", "elit"]
    return " ".join(rng.choice(stems) + str(rng.randint(0, 99)) for _ in range(n))


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)


def with_clashes(df):
    """Extra columns, named like those the operators make for themselves."""
    from pyspark.sql import functions as F

    names = "key row_key words grams bits n_words kept content ord tie spans dedup prediction score"
    return df.withColumns({n: F.lit(7) for n in names.split()}).withColumn("Doc", F.lit("x"))
