"""Mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, its source's
target over its source's size. The documents of a source are put in one order,
the expected copies are summed along it from one random offset per source, and
a document is emitted once for every integer boundary its own share crosses.

The order goes from the largest size down, so each stretch of the sum sees
documents of like size and the words taken stay near the target. The few
documents that hold a hundredth or more of their source come first; what they
took by chance is made good in the expected copies of the rest.

The order is never laid out in one task: the position of a document is the
number of documents in larger size classes, plus those in earlier slices of its
class, plus its rank in its own slice. Slices are cut by a hash of the id, so
each of the three sums runs over a bounded group whatever share of the rows a
source holds.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, col, free_names, materialize


#: A document of at least 1 / LARGE of its source's words comes first.
LARGE = 100


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Target of each source from its size.

    ``sizes``: ``key``, ``source``, ``source_size``, one row per source. Targets
    share the sum of all sizes by weight; those above ``most`` times their
    source's size stop there and the excess is shared by weight among the rest
    (a source reaches its stop exactly if all sources would take no more than
    the total at that source's level). The windows without partitions run over
    this table only: one row of three numbers per source.
    """
    n = len(weights)
    named = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % n + 1).cast("int"))
    full = most * F.col("source_size")
    ranked = (sizes.withColumn("rank", F.row_number().over(named) - 1)
              .withColumn("w", w.cast("long"))
              .withColumn("level", F.col("source_size") * F.expr(f"{lcm(*weights)} div w")))
    summed = (ranked.withColumn("w_before", F.sum("w").over(by_level))
              .withColumn("full_before", F.sum(full).over(by_level))
              .withColumn("w_all", F.sum("w").over(every))
              .withColumn("total", F.sum("source_size").over(every)))
    stops = ((F.col("full_before") * F.col("w") + full * (F.col("w_all") - F.col("w_before")))
             <= F.col("total") * F.col("w"))
    stopped = summed.withColumn("stops", stops)
    shared = (stopped
              .withColumn("left", F.col("total")
                          - F.sum(F.when(F.col("stops"), full).otherwise(0)).over(every))
              .withColumn("w_left", F.sum(F.when(F.col("stops"), 0).otherwise(F.col("w")))
                          .over(every)))
    target = F.when(F.col("stops"), full.cast("double")).otherwise(
        F.col("w").cast("double") * (F.col("left").cast("double") / F.col("w_left")))
    return shared.select("key", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3),
                most: int = 3, seed: int = 42,
                tries: int = 8) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` added.

    ``copies`` is how often the mix takes the row (0 to ``most``). The random
    offsets and the order inside a size class come from ``seed`` and the ids,
    so reruns agree. Of ``tries`` random offsets each source uses the one that
    takes the number of words nearest its target (the first such one).

    Defined cases: a null, empty or blank text has size 0; null sources are one
    source, last in order; a source of size 0 has target 0 and is not taken;
    repeated rows are separate documents; a null id is an id like any other; an
    empty table gives an empty result; input columns pass through, and an input
    column with the name of an added one is replaced. A very long text is a row like
    any other; one above a hundredth of its source's size is placed first.
    """
    added = ["size", "source_size", "target", "copies"]
    keep = [c for c in docs.columns if c.lower() not in added]
    base = docs.select(*[col(c) for c in keep],
                       word_count(col(text_col)).alias("size"))
    key, bucket, slice_, draw, place, at, large, best = free_names(
        base, "key", "bucket", "slice", "draw", "place", "at", "large", "best")
    digits = F.col("size").cast("string")
    rows = (base
            .withColumn(key, F.coalesce(F.concat(F.lit("="), col(source_col).cast("string")),
                                        F.lit("")))
            # never null, and seen to be: a test for it would count the words twice more
            .withColumn(bucket, F.coalesce(
                F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int"), F.lit(0)))
            .withColumn(draw, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
                col(id_col).cast("string"), F.lit("")))))
            .withColumn(slice_, F.substring(col(draw), 1, 2)))

    counted = materialize(
        rows.groupBy(col(key).alias("key"), col(bucket).alias("bucket"),
                     col(slice_).alias("slice"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"),
             F.first(col(source_col)).alias("source")), "counted")
    in_class = Window.partitionBy("key", "bucket").orderBy("slice")
    in_source = Window.partitionBy("key").orderBy(F.desc("bucket"))
    sizes = counted.groupBy("key").agg(F.first("source").alias("source"),
                                       F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0))
    # smallest size of a bucket, from its two digits and its length
    floor_ = (F.col("bucket") % 100) * F.pow(F.lit(10.0), F.greatest(
        F.floor(F.col("bucket") / 100) - 2, F.lit(0)))
    classes = (counted.groupBy("key", "bucket").agg(F.sum("n").alias("n"))
               .join(targets.select("key", "source_size"), "key")
               .select("key", "bucket", (F.sum("n").over(in_source) - F.col("n")).alias("before"),
                       ((floor_ * LARGE >= F.col("source_size")) & (F.col("source_size") > 0))
                       .alias("large")))
    places = materialize(
        counted.withColumn("earlier", F.sum("n").over(in_class) - F.col("n"))
        .join(classes, ["key", "bucket"])
        .select(F.col("key").alias(key), F.col("bucket").alias(bucket),
                F.col("slice").alias(slice_), F.col("large").alias(large),
                (F.col("before") + F.col("earlier")).alias(place)), "places")

    def placed(df: DataFrame) -> DataFrame:
        """``df`` with the number of documents before each row in its source."""
        ties = F.xxhash64(*[col(c) for c in df.columns
                            if "map<" not in df.schema[c].dataType.simpleString()])
        own = Window.partitionBy(key, bucket, slice_).orderBy(F.desc("size"), draw, ties)
        return (df.withColumn(at, F.row_number().over(own) - 1)
                .join(places, [key, bucket, slice_])
                .withColumn(at, (col(at) + col(place)).cast("double")).drop(place))

    def crossed(start: Column, step: Column) -> Column:
        return F.least(F.floor(start + step) - F.floor(start), F.lit(most)).cast("long")

    # what each candidate offset takes: first of the large documents, then of the rest
    narrow = materialize(placed(rows.select(key, bucket, slice_, draw, "size"))
                         .select(F.col(key).alias("key"), F.col(large).alias("large"),
                                 F.col(at).alias("at"), "size"), "places")
    tried = targets.withColumn("offsets", F.array(*[
        _offset(F.col("key"), seed, k) for k in range(tries)]))

    def taken(each) -> Column:
        return F.array(*[F.sum(F.col("size") * each(F.col("offsets")[k])) for k in range(tries)])

    first = (narrow.where("large").join(tried, "key").groupBy("key")
             .agg(F.count(F.lit(1)).alias("n_large"), F.sum("size").alias("large_size"),
                  taken(lambda o: crossed(F.col("rate") * F.col("at") + o, F.col("rate")))
                  .alias("large_taken")))
    tried = (tried.join(first, "key", "left")
             .withColumn("n_large", F.coalesce("n_large", F.lit(0)))
             .withColumn("rest_size", F.col("source_size") - F.coalesce("large_size", F.lit(0)))
             .withColumn("large_taken", F.coalesce(
                 "large_taken", F.array_repeat(F.lit(0).cast("long"), tries)))
             .withColumn("rest_rates", F.transform("large_taken", lambda t: F.when(
                 F.col("rest_size") > 0, F.greatest(F.lit(0.0), F.least(
                     F.lit(float(most)), (F.col("target") - t) / F.col("rest_size"))))
                 .otherwise(F.col("rate")))))
    tried = materialize(tried, "offsets")

    def start(o: Column, r: Column, at_: Column) -> Column:
        """The sum before a document that is not large."""
        return F.col("rate") * F.col("n_large") + r * (at_ - F.col("n_large")) + o

    then = (narrow.where("not large").join(tried, "key").groupBy("key")
            .agg(F.array(*[
                F.sum(F.col("size") * crossed(
                    start(F.col("offsets")[k], F.col("rest_rates")[k], F.col("at")),
                    F.col("rest_rates")[k])) for k in range(tries)]).alias("rest_taken")))
    miss = F.transform("large_taken", lambda t, k: F.struct(F.abs(
        t + F.coalesce(F.get("rest_taken", k), F.lit(0)) - F.col("target")).alias("miss"),
        k.alias("k")))
    chosen = (tried.join(then, "key", "left").withColumn("k", F.array_min(miss)["k"])
              .select(F.col("key").alias(key), "source_size", "target", "rate", "n_large",
                      F.get("offsets", F.col("k")).alias("o"),
                      F.get("rest_rates", F.col("k")).alias("rest_rate")))
    chosen = chosen.select(col(key), F.struct(*[c for c in chosen.columns if c != key]).alias(best))
    joined = placed(rows).join(materialize(chosen, "chosen"), key)
    here = {c: F.col(f"`{best}`.{c}") for c in ("rate", "n_large", "o", "rest_rate")}
    step = F.when(col(large), here["rate"]).otherwise(here["rest_rate"])
    begin = F.when(col(large), here["rate"] * col(at) + here["o"]).otherwise(
        here["rate"] * here["n_large"] + here["rest_rate"] * (col(at) - here["n_large"])
        + here["o"])
    return joined.select(*[col(c) for c in keep], "size",
                         F.col(f"`{best}`.source_size"), F.col(f"`{best}`.target"),
                         crossed(begin, step).alias("copies"))


def _offset(key: Column, seed: int, k: int) -> Column:
    """The k-th random offset of a source, in [0, 1)."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/{k}/"), key)), 1, 8), 16, 10)
            .cast("double") / F.lit(float(2 ** 32)))


def emit_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", **kw) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as the mix takes it.

    Columns and defined cases as in :func:`mix_sources`; none is replaced.
    """
    (whole,) = free_names(docs, "whole")
    read = dict.fromkeys([id_col, text_col, source_col])
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias(whole),
                         *[col(c) for c in read])
    return (mix_sources(packed, id_col, text_col, source_col, **kw)
            .where(F.col("copies") > 0)
            .select(col(whole), F.explode(F.expr("sequence(1, cast(copies as int))")))
            .select(f"`{whole}`.*"))
