"""Documents with every odd case, and plain versions of the rules the operators follow."""

import random
import re

WORDS = "oak elm ash fir yew bay fig box ivy may rye hop".split()


def prose(seed, n, pool=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(pool) for _ in range(n))


def odd_documents(spark):
    """Null ids and texts, empty, blank, one-word, repeated and very long ones; further columns with clashing names."""
    passage = prose(1, 80, [f"w{i}" for i in range(500)])
    long = prose(2, 60_000, [f"v{i}" for i in range(3000)])
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ünï cödé \U0001F600 漢字 ٣"), (None, "a text without an id"),
        (None, None), (None, passage), (6, passage), (6, passage), (7, passage), (8, passage + " and an end"), (9, long),
        (10, "x" * 200_000), (11, "la " * 300), (12, passage.upper() + "!!"), (13, "a\nb\na\n\nb"), (13, "another text of one id"),
    ]
    clash = ["ids", "label", "score", "hit_id", "row_key", "node", "digest", "text_a", "n", "row", "shared", "state"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"),
                     *(F.lit("x").alias(c) for c in clash))


def no_documents(spark):
    return odd_documents(spark).where("1 = 0")


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letter_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
