"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans.session import scratch_dir

#: A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names built from ``bases`` that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    the shuffle files behind the table can go.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    # Spark drops the shuffle files of a query that nothing refers to any more,
    # but only once the driver's garbage collector has noticed
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def checksum(df: DataFrame) -> tuple[int, int]:
    """(rows, order-free checksum): two numbers reach the driver."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.xxhash64(*[col(c) for c in df.columns])
                       .cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    Alternating large-star and small-star steps; each is an aggregate and an
    equi-join on the node, so a node with very many edges is a skewed join
    side that adaptive execution splits. Every round is written out, and the
    loop ends when a round changes nothing. Rounds grow with the logarithm of
    the longest path.

    Null ends and self-links are ignored; an empty input gives an empty result.

    Returns ``node``, ``root`` (``root <= node``; roots map to themselves).
    """
    e = (edges.select(F.greatest(col(a), col(b)).alias("u"), F.least(col(a), col(b)).alias("v"))
         .where(F.col("u") != F.col("v")).distinct())
    e = materialize(e, "edges")
    seen = checksum(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"),
                                                    F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        e = materialize(small, "edges")
        now = checksum(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_components(n: int, u, v):
    """Smallest reachable index of 0..n-1 under links (u[i], v[i]); numpy arrays."""
    import numpy as np

    lab = np.arange(n)
    while len(u):
        low = np.minimum(lab[u], lab[v])
        np.minimum.at(lab, lab[u], low)
        np.minimum.at(lab, lab[v], low)
        while True:
            jumped = lab[lab]
            if np.array_equal(jumped, lab):
                break
            lab = jumped
        open_ = lab[u] != lab[v]
        u, v = u[open_], v[open_]
    return lab


def whole_groups(frames: Iterable, keys: list[str]):
    """Re-cut a stream of pandas frames sorted by ``keys`` so that no group
    spans two frames. Holds one incoming frame and one unfinished group."""
    import numpy as np
    import pandas as pd

    held: list = []
    last = None
    for f in frames:
        if not len(f):
            continue
        k = f[keys]
        changed = (k != k.shift()).any(axis=1).to_numpy()
        changed[0] = last is not None and tuple(k.iloc[0]) != last
        cuts = np.flatnonzero(changed)
        last = tuple(k.iloc[-1])
        if not len(cuts):
            held.append(f)
            continue
        yield pd.concat([*held, f.iloc[:cuts[-1]]], ignore_index=True)
        held = [f.iloc[cuts[-1]:]]
    if held:
        yield pd.concat(held, ignore_index=True)
