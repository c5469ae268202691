"""Quality rules with thresholds that adapt to language and source.

Signals of each text are computed by built-in functions alone. Each signal is
an integer, and its distribution per (language, source) is kept as a sketch:
counts over integer buckets of bounded relative width. Two sketches merge by
adding counts, so the groups' sketches are built from map-side partial counts
and a small group is widened by merging its language's sketch, or all, with
no second pass. Quantiles read off a sketch give every group its own limits,
and a join brings them back to the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, col, free_names, materialize

#: Words to a window of ``n_repeat_words``.
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Production parameters.

    A text fails a signal if it lies above ``median + reach * spread``, where
    spread is the distance from the median to the lower quantile ``low`` or to
    the upper quantile ``high``, whichever is smaller (so a group with many bad
    texts on one side does not widen its own limit), and never less than the
    signal's ``least`` step. Mean word length has a limit on both sides.
    """

    min_words: int = 10
    max_repeat_pct: int = 20
    low: float = 0.1
    high: float = 0.9
    reach: float = 4.0
    min_group: int = 200
    least: tuple[tuple[str, int], ...] = (
        ("symbols", 4), ("dup_lines", 75), ("repeats", 50), ("word_length", 75))


def signal_columns(text: Column) -> dict[str, Column]:
    """Step one: arrays the signals are read from (null text counts as empty)."""
    whole = F.coalesce(text, F.lit(""))
    bare = F.btrim(whole, F.lit(" \t\n\x0b\x0c\r"))
    return {
        "text": whole,
        "words": F.when(bare == "", F.array().cast("array<string>")).otherwise(
            F.split(bare, SPACE)),
        "lines": F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    }


def with_signals(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the signals added under unused names, and those names.

    ``n_repeat_words`` counts the words inside windows of five words that occur
    at least twice in the text. Windows are compared by a 64-bit hash of their
    words. Only texts with a repeated hash are sorted: positions of repeated
    hashes, in order, then cover ``min(5, distance to the next)`` words each.
    """
    names = free_names(docs, "words", "lines", "windows", "repeated", "n_words", "word_chars",
                       "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "flat")
    (words, lines, windows, repeated, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
     n_repeat, flat) = names
    step = signal_columns(col(text_col))
    df = (docs.withColumn(flat, step["text"]).withColumn(words, step["words"])
          .withColumn(lines, step["lines"])
          .withColumn(n_words, F.size(words).cast("long")))
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(col(words), i + k) for k in range(WINDOW)]))
    df = df.withColumn(windows, F.when(F.size(words) >= WINDOW, hashed)
                       .otherwise(F.array().cast("array<long>")))
    ordered = F.sort_array(F.transform(col(windows), lambda h, i: F.struct(h.alias("h"),
                                                                             i.alias("i"))))
    df = df.withColumn(repeated, F.when(
        F.size(windows) > F.size(F.array_distinct(windows)), ordered))
    twice = F.filter(col(repeated), lambda x, j: F.coalesce(
        (j > 0) & (F.get(col(repeated), j - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(
        F.get(col(repeated), j + 1)["h"] == x["h"], F.lit(False)))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"),
                                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    signals = F.struct(
        col(n_words).alias(n_words),
        F.length(F.translate(flat, " \t\n\x0b\x0c\r", "")).cast("long").alias(word_chars),
        (F.length(flat) - F.length(F.translate(flat, "#*$%&|<>", ""))).cast("long")
        .alias(n_symbols),
        F.size(lines).cast("long").alias(n_lines),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(n_dup_lines),
        F.coalesce(covered, F.lit(0)).cast("long").alias(n_repeat))
    # generated, so that a later filter on a signal is not pushed into the
    # steps above, where it would sort the windows once per window
    df = (df.select(*[col(c) for c in docs.columns],
                    F.explode_outer(F.array(signals)).alias(flat))
          .select(*[col(c) for c in docs.columns], F.col(f"`{flat}`.*")))
    return df, dict(zip(["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                         "n_repeat_words"],
                        [n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat],
                        strict=True))


def rates(names: dict[str, str]) -> dict[str, Column]:
    """The sketched signals: integers, null where the text has no word."""
    def share(part: str, whole: str, scale: int) -> Column:
        return F.when(col(names[whole]) > 0, F.floor(
            scale * col(names[part]) / col(names[whole])).cast("long"))

    return {"symbols": share("n_symbols", "word_chars", 1000),
            "dup_lines": share("n_dup_lines", "n_lines", 1000),
            "repeats": share("n_repeat_words", "n_words", 1000),
            "word_length": share("word_chars", "n_words", 100)}


def bucket(v: Column) -> Column:
    """Integer bucket: exact below 100, then two leading digits.

    Monotone; a bucket's smallest value is at least 10/11 of its largest.
    """
    text = v.cast("string")
    return F.when(v < 100, v).otherwise(
        F.rpad(F.substring(text, 1, 2), F.length(text), "0").cast("long"))


def thresholds(signals: DataFrame, rules: Rules) -> DataFrame:
    """Limits per (lang, source).

    ``signals``: ``lang``, ``source`` and the four rates. Returns ``lang``,
    ``source`` and, per rate, ``<rate>_low`` and ``<rate>_high``; one row per
    group. A group of fewer than ``min_group`` texts takes its language's
    merged sketch, a small language the sketch of all.
    """
    rate_names = [r for r, _ in rules.least]
    long = signals.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket"))
        for r in rate_names])).alias("s")).select("lang", "source", "s.rate", "s.bucket")
    own = materialize(long.where(F.col("bucket").isNotNull())
                      .groupBy("lang", "source", "rate", "bucket")
                      .agg(F.count(F.lit(1)).alias("n")), "sketches")
    by_lang = own.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = own.groupBy("rate", "bucket").agg(F.sum("n").alias("n"))
    least = F.element_at(F.create_map(*[x for r, v in rules.least
                                        for x in (F.lit(r), F.lit(float(v)))]), F.col("rate"))

    def limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
        to_here = Window.partitionBy(*keys, "rate").orderBy("bucket")
        cum = (sketch.withColumn("upto", F.sum("n").over(to_here))
               .withColumn("all", F.sum("n").over(Window.partitionBy(*keys, "rate"))))

        def quantile(q: float) -> Column:
            return F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bucket")))

        q = (cum.groupBy(*keys, "rate")
             .agg(F.max("all").alias("n"), quantile(rules.low).alias("lo"),
                  quantile(0.5).alias("mid"), quantile(rules.high).alias("hi")))
        spread = F.greatest(F.least(F.col("mid") - F.col("lo"), F.col("hi") - F.col("mid")), least)
        return q.select(*keys, "rate", "n",
                        (F.col("mid") - rules.reach * spread).alias("low"),
                        (F.col("mid") + rules.reach * spread).alias("high"))

    def struct_of(name: str) -> Column:
        return F.struct("n", "low", "high").alias(name)

    a = limits(own, ["lang", "source"]).select("lang", "source", "rate", struct_of("a"))
    b = limits(by_lang, ["lang"]).select(F.col("lang").alias("b_lang"),
                                         F.col("rate").alias("b_rate"), struct_of("b"))
    c = limits(whole, []).select(F.col("rate").alias("c_rate"), struct_of("c"))
    chosen = (a.join(b, a["lang"].eqNullSafe(F.col("b_lang")) & (a["rate"] == F.col("b_rate")))
              .join(c, F.col("rate") == F.col("c_rate"))
              .select("lang", "source", "rate",
                      F.when(F.col("a.n") >= rules.min_group, F.col("a"))
                      .when(F.col("b.n") >= rules.min_group, F.col("b"))
                      .otherwise(F.col("c")).alias("t")))
    return chosen.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rate") == r, F.col(f"t.{side}"))).alias(f"{r}_{side}")
        for r in rate_names for side in ("low", "high")])


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with signals, ``base_failed`` and ``kept`` added.

    ``base_failed``: fewer than ``min_words`` words, or repeated windows over
    more than ``max_repeat_pct`` percent of the words. ``kept`` is false then;
    otherwise it is true unless a rate lies outside its group's limits.

    Defined cases: a null, empty or blank text has no words and fails the base
    rule; null language or source is a group of its own; repeated rows get
    equal verdicts; an empty table gives an empty result; input columns named
    like an added one are replaced. A very long text is a row like any other:
    its words and windows are arrays of one row, in one task.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "kept"]
    df, names = with_signals(docs, text_col)
    rate = rates(names)
    lang, source = col(lang_col).cast("string"), col(source_col).cast("string")
    limits = materialize(thresholds(
        df.select(lang.alias("lang"), source.alias("source"),
                  *[v.alias(k) for k, v in rate.items()]), rules), "limits")
    t = limits.select(*[F.col(c).alias(f"limit {c}") for c in limits.columns])
    joined = df.join(t, lang.eqNullSafe(F.col("limit lang"))
                     & source.eqNullSafe(F.col("limit source")), "left")
    failed = ((col(names["n_words"]) < rules.min_words)
              | (100 * col(names["n_repeat_words"])
                 > rules.max_repeat_pct * col(names["n_words"])))
    fine = F.lit(True)
    for r, v in rate.items():
        fine = fine & F.coalesce(v <= F.col(f"limit {r}_high"), F.lit(True))
    fine = fine & F.coalesce(rate["word_length"] >= F.col("limit word_length_low"), F.lit(True))
    return joined.select(
        *[col(c) for c in docs.columns if c.lower() not in out],
        *[col(names[c]).alias(c) for c in out[:5]],
        failed.alias("base_failed"), (~failed & fine).alias("kept"))
