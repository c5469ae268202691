"""Quality rules: signals against plain Python, limits by example."""

import re
from collections import Counter

from tidewater.llm.quality_rules import Rules, bucket, quality_rules

from .frames import SCHEMA, documents, prose, rows


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_signals_match_plain_python(spark):
    data = rows() + [(300 + i, " ".join(["a b c d e f"[: 2 * k + 1] for k in range(6)] * i), "en",
                      "s0", 1) for i in range(1, 6)] + [(310, "l\nl\n\nl \n x#y&\n x#y&", "de", "s0", 1)]
    docs = documents(spark, data, extra=True)
    got = quality_rules(docs).collect()
    assert len(got) == len(data)
    for r in got:
        n, chars, symbols, dup, repeat = plain(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert not (r["base_failed"] and r["kept"])


def test_limits_follow_language_and_source(spark):
    code = [(i, prose(i, 60).replace(" ", " # "), "en", "code", 1) for i in range(300)]
    talk = [(1000 + i, prose(i, 60), "en", "talk", 1) for i in range(300)]
    odd = [(5000, prose(1, 60).replace(" ", " # "), "en", "talk", 1),
           (5001, prose(2, 60), "en", "code", 1)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(
        spark.createDataFrame(code + talk + odd, SCHEMA)).collect()}
    assert not got[5000]  # many symbols among talk
    assert sum(got[i] for i in range(300)) == 300
    assert sum(got[1000 + i] for i in range(300)) == 300


def test_small_groups_use_their_language(spark):
    many = [(i, prose(i, 60), "en", f"s{i}", 1) for i in range(250)]
    few = [(900, prose(1, 60).replace(" ", " # "), "en", "alone", 1)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(
        spark.createDataFrame(many + few, SCHEMA), rules=Rules()).collect()}
    assert not got[900] and sum(got[i] for i in range(250)) == 250


def test_buckets_are_monotone(spark):
    from pyspark.sql import functions as F
    got = [r[0] for r in spark.range(2500).select(bucket(F.col("id"))).collect()]
    assert got == sorted(got) and all(b <= v <= b * 1.1 for v, b in enumerate(got))


def test_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
