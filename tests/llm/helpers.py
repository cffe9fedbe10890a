"""Texts and frames the tests of the training-data operators share."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("start", T.IntegerType())])


def docs(spark, texts, ids=None):
    """Documents with an extra column named like something inside the operators."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", n) for n, (i, t) in enumerate(zip(ids, texts, strict=True))], DOCS)


def prose(seed, words, vocabulary=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}x" for _ in range(words))


# NULL, empty, white space, one word, punctuation, non-Latin, astral code points.
ODD = [None, "", "  \n\t ", "word", "...!?", "naïve Straße ÉCOLE Ωmega", "a\U0001F600b \U0001F600\U0001F600 c"]
