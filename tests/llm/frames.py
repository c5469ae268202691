"""Small awkward inputs shared by the operator tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or add; as extra columns they must do no harm.
CLASHING = ["id", "size", "kept", "fp", "lines", "words", "copies", "text_hash", "n", "key",
            "pii", "uid", "piece", "score", "n_words", "rid", "vector", "host", "gone"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    words = ["w" + format(r.randrange(vocabulary), "x") + "abcdefgh"[r.randrange(8)] * (i % 3 + 1)
             for i in range(n)]
    lines = [" ".join(words[i:i + 12]) for i in range(0, n, 12)]
    return "\n".join(lines)


def rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeats."""
    out = [(i, prose(i % 17, 20 + 3 * i), ("en", "de", None)[i % 3], f"s{i % 4}", 5)
           for i in range(24)]
    out += [(100, None, "en", "s1", None), (101, "", "en", "s1", 0), (102, " \n\t ", "de", None, 4),
            (103, "a", None, None, 1), (104, "Ünï cödé ß 漢字 \U0001f600 word", "de", "s2", 9),
            (None, prose(3, 40), "en", "s0", 1), (None, None, None, None, None),
            (105, "same same same same same same same same same same same", "en", "s3", 3),
            (106, "x" * 30_000 + " tail", "en", "s0", 30_005),
            (107, prose(5, 9_000, 5_000), "en", "s0", 1), (1, prose(1, 23), "en", "s1", 5)]
    return out + [out[2], out[2], out[24]]


def documents(spark, data=None, extra: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        for i, c in enumerate(CLASHING):
            df = df.withColumn(c, F.lit(i) if i % 2 else F.lit(f"x{i}"))
    return df
