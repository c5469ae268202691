"""Embedding near-duplicates: binary codes that decide which pairs to recompute.

Vectors of one label are compared by cosine. Each unit vector is turned by a
random rotation and kept as the signs of its coordinates, one bit each, with a
stored correction factor: its inner product with its own code. The inner
product of another vector with that code, divided by the factor, is an unbiased
estimate of the cosine, with an error that shrinks with the square root of the
dimension. The other vector is rounded at random to four bits a coordinate, so
the estimate is a few bit counts. A pair is recomputed in double precision only
if the estimate's upper confidence bound reaches the threshold, and links only
if the exact cosine does.

Pairs are not formed over a whole label. Vectors are put into cells around
pivots; a cell's radius bounds where its vectors lie, so cells further apart
than their radii and the largest angle of a link cannot hold a linked pair
(triangle inequality on angles) and are never compared. Cells are cut into
blocks of bounded size; a task compares two blocks, and returns one row per
vector with its link count and the smallest vector of its local component,
never the pairs. Equal vectors are compared once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, connected_components, local_components, materialize

#: Vectors to a block.
BLOCK = 2048
#: Vectors to a cell, on average; also bounds the pivots of one label.
CELL = 4096
#: Error bounds are this many standard deviations wide.
SIGMAS = 6.0


def rotation(dim: int, seed: int) -> np.ndarray:
    """A uniformly random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def sign_codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs (64 to a word) and the inner product with the own code."""
    positive = turned >= 0
    own = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return _words(positive), own


def _words(bits: np.ndarray) -> np.ndarray:
    pad = -bits.shape[1] % 64
    packed = np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1)
    return np.ascontiguousarray(packed).view(np.uint64)


class Query:
    """Turned vectors rounded at random to four bits a coordinate."""

    def __init__(self, turned: np.ndarray, seed: int):
        self.dim = turned.shape[1]
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / 15, 1e-12)
        noise = np.random.default_rng(seed).random(turned.shape)
        level = np.floor((turned - self.low[:, None]) / self.step[:, None] + noise)
        level = np.clip(level, 0, 15).astype(np.uint8)
        self.total = level.sum(axis=1, dtype=np.int64)
        self.planes = [_words((level >> k) & 1) for k in range(4)]

    def may_link(self, rows: slice, code: np.ndarray, own: np.ndarray, threshold: float,
                 sigmas: float) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs (query, coded) whose cosine may reach ``threshold``.

        The estimate's variance is (1 - own^2) / (own^2 (dim - 1)) from the
        code, plus a quarter of the squared rounding step over own^2.
        """
        met = sum((1 << k) * np.bitwise_count(p[rows][:, None, :] & code[None, :, :])
                  .sum(axis=2, dtype=np.int64) for k, p in enumerate(self.planes))
        low, step = self.low[rows][:, None], self.step[rows][:, None]
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        inner = (low * (2 * ones - self.dim) + step * (2 * met - self.total[rows][:, None])
                 ) / np.sqrt(self.dim)
        var = np.maximum(1 - own ** 2, 0) / max(self.dim - 1, 1) + step ** 2 / 4
        upper = (inner + sigmas * np.sqrt(var)) / np.maximum(own, 1e-9)
        return np.nonzero(upper >= threshold)


def exact(x: np.ndarray, y: np.ndarray, i, j, step: int = 1 << 16) -> np.ndarray:
    """Cosine of rows i of x and j of y in double precision."""
    out = np.empty(len(i))
    for a in range(0, len(i), step):
        p, q = x[i[a:a + step]], y[j[a:a + step]]
        out[a:a + step] = np.einsum("ij,ij->i", p, q) / np.sqrt(
            np.einsum("ij,ij->i", p, p) * np.einsum("ij,ij->i", q, q))
    return out


def unit_rows(column: pd.Series) -> np.ndarray:
    v = np.array(column.tolist(), np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


GROUP = ["label", "dim"]


def into_cells(reps: DataFrame, cell: int, seed: int, chunk: int = 20_000) -> DataFrame:
    """``reps`` with ``cell``, ``angle`` to its pivot, ``code`` and ``own``.

    About one vector in ``cell`` is a pivot, at most about 1024 of a label. The
    vectors of a label are dealt out in chunks, each with all its pivots.
    """
    n = reps.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    sized = reps.join(n, GROUP).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    k = F.least(F.ceil(F.col("n") / cell), F.lit(1024))
    pivots = (sized.where((k > 1) & (F.pmod(F.xxhash64("rid", F.lit(0)), F.col("n")) < k))
              .select(*GROUP, F.col("rid").alias("pivot"), "vector",
                      F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"))
              .toDF(*GROUP, "pivot", "vector", "chunk"))
    dealt = sized.withColumn("chunk", F.pmod(F.xxhash64("rid", F.lit(1)), F.col("chunks"))
                             .cast("int")).drop("n", "chunks")

    def assign(f: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return f.assign(cell=[], angle=[], code=[], own=[]).drop(columns="chunk")
        unit = unit_rows(f["vector"])
        code, own = sign_codes(unit @ rotation(unit.shape[1], seed))
        f = f.drop(columns="chunk")
        f["cell"], f["angle"] = np.int64(-1), np.pi
        if len(p):
            p = p.sort_values("pivot", ignore_index=True)
            cos = unit @ unit_rows(p["vector"]).T
            near = cos.argmax(axis=1)
            f["cell"] = p["pivot"].to_numpy()[near]
            f["angle"] = np.arccos(np.clip(cos[np.arange(len(f)), near], -1, 1))
        f["code"], f["own"] = [c.tobytes() for c in code], own
        return f

    kind = ("label long, dim int, rid long, weight long, vector array<double>, cell long, "
            "angle double, code binary, own double")
    keys = [*GROUP, "chunk"]
    columns = [*GROUP, "rid", "weight", "vector", "chunk"]
    return (dealt.select(*columns).toDF(*columns).groupBy(*keys)
            .cogroup(pivots.groupBy(*keys)).applyInPandas(assign, kind))


def tasks_of(cells: DataFrame, threshold: float, block: int) -> DataFrame:
    """Pairs of blocks to compare, from the pivot, radius and size of each cell.

    Two cells are left out if the angle between their pivots exceeds both radii
    and the largest angle of a link together.
    """
    most = float(np.arccos(threshold)) + 1e-6

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("cell", ignore_index=True)
        radius, blocks = f["radius"].to_numpy(), -(-f["n"].to_numpy() // block)
        near = np.ones((len(f), len(f)), bool)
        if len(f) > 1:
            unit = unit_rows(f["vector"])
            apart = np.arccos(np.clip(unit @ unit.T, -1, 1))
            near = apart <= radius[:, None] + radius + most
        i, j = np.nonzero(np.triu(near | np.eye(len(f), dtype=bool)))
        rep = blocks[i] * blocks[j]
        pair = np.repeat(np.arange(len(i)), rep)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(rep) - rep, rep)
        i, j = i[pair], j[pair]
        a, b = nth // blocks[j], nth % blocks[j]
        keep = (i != j) | (a <= b)
        cell = f["cell"].to_numpy()
        return pd.DataFrame({"label": f["label"].iloc[0], "dim": f["dim"].iloc[0],
                             "a_cell": cell[i], "a_block": a, "b_cell": cell[j], "b_block": b}
                            )[keep]

    kind = "label long, dim int, a_cell long, a_block long, b_cell long, b_block long"
    return cells.groupBy(*GROUP).applyInPandas(meet, kind)


def compare(threshold: float, sigmas: float, seed: int):
    """Links of one pair of blocks: rid, number of links, smallest linked rid."""
    def one(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["side", "rid"], ignore_index=True)
        raw = np.array(f["vector"].tolist(), np.float64)
        unit = unit_rows(f["vector"])
        query = Query(unit @ rotation(unit.shape[1], seed), seed)
        code = np.stack([np.frombuffer(c, np.uint64) for c in f["code"]])
        own, side = f["own"].to_numpy(), f["side"].to_numpy()
        crossed = bool(side.any())
        y0 = int((side == 0).sum()) if crossed else 0
        x1 = y0 if crossed else len(f)
        us, vs = [], []
        for a in range(0, x1, 256):
            i, j = query.may_link(slice(a, min(a + 256, x1)), code[y0:], own[y0:], threshold,
                                  sigmas)
            i, j = i + a, j + y0
            i, j = (i, j) if crossed else (i[i < j], j[i < j])
            hit = exact(raw, raw, i, j) >= threshold
            us.append(i[hit])
            vs.append(j[hit])
        u = np.concatenate([np.zeros(0, np.int64), *us])
        v = np.concatenate([np.zeros(0, np.int64), *vs])
        weight, rid = f["weight"].to_numpy(), f["rid"].to_numpy()
        links = (np.bincount(u, weights=weight[v], minlength=len(f))
                 + np.bincount(v, weights=weight[u], minlength=len(f))).astype(np.int64)
        low = local_components(len(f), u, v)
        some = links > 0
        return pd.DataFrame({"rid": rid[some], "links": links[some], "low": rid[low[some]]})

    return one


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label",
                           threshold: float = 0.93, sigmas: float = SIGMAS, seed: int = 42,
                           block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """Links and component of every vector.

    Returns ``id_col``, ``n_links`` (other vectors with cosine at least
    ``threshold`` and the same label), ``component_id`` (smallest id reachable
    by links, own id included) and ``kept`` (id = component id). ``threshold``
    must be above 0; the label integral.

    Defined cases: a null, empty or zero vector, one with null or non-finite
    components and one with a null label link with nothing; vectors of unlike
    dimension do not link; equal rows are separate vectors that link with each
    other; a null id is no smallest id unless its component has no other, and
    is not kept; an empty table gives an empty result; only the three named
    columns are read.
    """
    rows = vectors.select(
        col(id_col).alias("id"), col(label_col).cast("long").alias("label"),
        col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    valid = F.coalesce(F.col("label").isNotNull() & finite
                       & F.exists("vector", lambda x: x != 0), F.lit(False))
    sound = rows.where(valid).withColumn("dim", F.size("vector"))
    reps = materialize(
        sound.groupBy(*GROUP, "vector").agg(F.min("id").alias("first_id"),
                                            F.count(F.lit(1)).alias("weight"))
        .withColumn("rid", F.monotonically_increasing_id()), "vectors")
    placed = materialize(into_cells(reps, cell, seed), "cells")
    stats = placed.groupBy(*GROUP, "cell").agg(F.count(F.lit(1)).alias("n"),
                                               F.max("angle").alias("radius"))
    centres = reps.select(F.col("rid").alias("cell"), "vector")
    stats = materialize(stats.join(centres, "cell", "left"), "cell_stats")
    tasks = tasks_of(stats, threshold, block)
    keys = [*GROUP, "a_cell", "a_block", "b_cell", "b_block"]
    same = (F.col("a_cell") == F.col("b_cell")) & (F.col("a_block") == F.col("b_block"))
    sides = F.when(same, F.array(F.struct(F.lit(0).alias("side"), F.col("a_cell").alias("cell"),
                                          F.col("a_block").alias("block")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("a_cell").alias("cell"),
                         F.col("a_block").alias("block")),
                F.struct(F.lit(1).alias("side"), F.col("b_cell").alias("cell"),
                         F.col("b_block").alias("block"))))
    wanted = tasks.withColumn("s", F.explode(sides)).select(*keys, "s.*")
    blocked = (placed.join(stats.select(*GROUP, "cell", "n"), [*GROUP, "cell"])
               .withColumn("block", F.pmod(F.xxhash64("rid", F.lit(2)),
                                           F.ceil(F.col("n") / block)))
               .select(*GROUP, "cell", "block", "rid", "weight", "vector", "code", "own"))
    found = materialize(
        wanted.join(blocked, [*GROUP, "cell", "block"]).groupBy(*keys)
        .applyInPandas(compare(threshold, sigmas, seed), "rid long, links long, low long"),
        "vector_links")
    roots = connected_components(found.select(F.col("rid").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    per_rep = (reps.join(links, "rid", "left")
               .join(roots.withColumnRenamed("node", "rid"), "rid", "left")
               .withColumn("root", F.coalesce("root", "rid")))
    first = per_rep.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_rep = materialize(
        per_rep.join(first, "root")
        .select("label", "vector", "component_id",
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")),
        "vector_components")
    alone = rows.where(~valid).select("id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("id").alias("component_id"))
    out = (sound.join(per_rep, ["label", "vector"])
           .select("id", "n_links", "component_id").unionByName(alone))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
                      .alias("kept"))
