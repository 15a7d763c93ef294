"""Rows that are hard on an operator: nulls, empty and long texts, ties, repeated rows and
columns whose names clash with those operators use inside."""

from pyspark.sql import SparkSession

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def passage(seed: int, words: int = 40) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed + 3) + i) % len(WORDS)] + ("" if i % 9 else ".") for i in range(words))


def rows():
    long_text = " ".join(f"w{i}" for i in range(30_000))
    texts = ["", None, " ", "one", "One", "two words", passage(1), passage(1) + " end", passage(2), passage(2).replace(" ", "  "), long_text, long_text + " x", "ñandú 日本語 \U0001f600 text"]
    out = [(i, t, f"s{i % 3}" if i % 4 else None, i) for i, t in enumerate(texts)]
    out += [(100, passage(3), "s0", 1), (100, passage(3), "s0", 1), (None, passage(4), "s1", None), (None, None, None, None), (101, passage(4), "s1", 2)]
    return out


def table(spark: SparkSession, given=None):
    given = rows() if given is None else given
    df = spark.createDataFrame([(a, b, c, d, "h", 1, "p", "en") for a, b, c, d in given], "doc_id bigint, text string, source string, score bigint, hash string, position int, `group` string, lang string")
    return df.repartition(3)
