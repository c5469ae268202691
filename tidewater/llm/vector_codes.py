"""Vector code compression: product codes from codebooks trained on integers.

Every component becomes ``floor(scale * x)``; a vector is cut into equal
consecutive parts, and every part position has its own codebook. Rounds of
assignment and of componentwise ``floor(sum / count)`` refine the codebooks;
then every part gets the index of its nearest entry. All arithmetic is on whole
numbers, so reruns agree whatever the partitioning.

Nearest entries are found with LAESA. Each part position has a few fixed
pivots, and the distance of every part to them is computed once and stored
beside the integers. A round computes the distances of the (few) entries to the
pivots; by the triangle inequality the largest difference between a part's and
an entry's pivot distances bounds their distance from below. Entries are visited
in the order of these bounds, the squared distance is evaluated exactly, and a
part is done when the next bound exceeds its best distance. Bounds are floating
point and are lowered by more than their rounding error, so that no entry, and no
tie, is pruned wrongly.

A round is one pass over the stored rows; a task returns one partial sum per
codebook entry, and the driver receives the added-up sums: ``parts * entries``
rows, whatever the size of the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_names, materialize

#: Components must lie within this, so that all sums of one row are exact in 64 bits.
LARGEST = 1 << 26
#: Rows assigned at a time.
CHUNK = 8192


def usable(vector: Column) -> Column:
    """Whether a vector is not null and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    v = np.floor(scale * np.asarray(vectors, np.float64))
    if v.size and np.abs(v).max() > LARGEST:
        raise ValueError(f"a component times {scale} exceeds {LARGEST}")
    return v.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def choose_pivots(codebook: np.ndarray, pivots: int) -> np.ndarray:
    """Fixed pivots of one part position, out of its first codebook: the first entry,
    then always the entry farthest from the pivots so far."""
    chosen = [0]
    near = squared(codebook, codebook[0])
    while len(chosen) < min(pivots, len(codebook)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(codebook, codebook[chosen[-1]]))
    return codebook[chosen]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            entry_to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """LAESA over one part position.

    ``parts`` (n, width), ``to_pivots`` (n, p) and ``entry_to_pivots`` (e, p) are
    distances. Returns the index of the nearest entry (the lowest of several), its
    squared distance, and how many exact evaluations that took.
    """
    n, done = len(parts), 0
    bound = np.zeros((n, len(entries)))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - entry_to_pivots[None, :, p]), out=bound)
    if bound.size:
        bound -= 1e-9 * (to_pivots.max() + entry_to_pivots.max() + 1)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.zeros(n, np.int64)
    open_ = np.arange(n)
    for rank in range(len(entries)):
        entry = order[open_, rank]
        low = bound[open_, entry]
        left = (low <= 0) | (low * low <= best[open_])
        open_, entry = open_[left], entry[left]
        if not len(open_):
            break
        d = squared(parts[open_], entries[entry])
        done += len(d)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < index[open_]))
        at = open_[better]
        best[at], index[at] = d[better], entry[better]
    return index, best, done


class Codebooks:
    """``entries`` (parts, e, width), and the fixed ``pivots`` (parts, p, width)."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots
        self.to_pivots = np.sqrt(squared(entries[:, :, None], pivots[:, None]).astype(np.float64))

    def assign(self, whole: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and squared distance of every part of every vector."""
        parts, _, width = self.entries.shape
        whole = whole.reshape(-1, parts, width)
        stored = stored.reshape(-1, parts, self.pivots.shape[1])
        found = [nearest(whole[:, k], stored[:, k], self.entries[k], self.to_pivots[k])[:2]
                 for k in range(parts)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _store(rows: DataFrame, books: Codebooks, scale: int, kept: list[str]) -> DataFrame:
    """``kept`` columns with the whole numbers and the distances to the pivots."""
    parts, p, width = books.pivots.shape

    def compute(vectors: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in vectors:
            v = whole_numbers(np.array(s.tolist()).reshape(-1, parts * width), scale)
            d = squared(v.reshape(-1, parts, 1, width), books.pivots[None])
            yield pd.DataFrame({
                "whole": list(v.astype(np.int32)),
                "to_pivots": list(np.sqrt(d.astype(np.float64)).reshape(-1, parts * p))})

    made = F.pandas_udf(compute, "whole array<int>, to_pivots array<double>")
    return (rows.select(*[col(c) for c in kept], made(F.col("vector")).alias("made"))
            .select(*[col(c) for c in kept], "made.whole", "made.to_pivots"))


def _sums(stored: DataFrame, books: Codebooks) -> DataFrame:
    """Per part and entry: how many parts it got, and the sum of each component."""
    parts, e, width = books.entries.shape
    p = books.pivots.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, e), np.int64)
        total = np.zeros((parts, e, width), np.int64)
        for b in batches:
            whole = _matrix(b.column(0), parts * width).astype(np.int64)
            pivots = _matrix(b.column(1), parts * p)
            for a in range(0, len(whole), CHUNK):
                codes, _ = books.assign(whole[a:a + CHUNK], pivots[a:a + CHUNK])
                cut = whole[a:a + CHUNK].reshape(-1, parts, width)
                for k in range(parts):
                    n[k] += np.bincount(codes[:, k], minlength=e)
                    np.add.at(total[k], codes[:, k], cut[:, k])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part.astype(np.int32)), "entry": pa.array(entry.astype(np.int32)),
            "n": pa.array(n[part, entry]),
            "total": pa.array(list(total[part, entry]), pa.list_(pa.int64()))})

    partial = (stored.select("whole", "to_pivots")
               .mapInArrow(add, "part int, entry int, n long, total array<long>"))
    return partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))


def fit(stored: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    """``rounds`` of assignment and update; unused entries stay."""
    for _ in range(rounds):
        entries = books.entries.copy()
        for r in _sums(stored, books).collect():  # at most parts * entries rows
            entries[r["part"], r["entry"]] = np.array(r["total"], np.int64) // r["n"]
        if np.array_equal(entries, books.entries):
            break  # every later round would repeat this one
        books = Codebooks(entries, books.pivots)
    return books


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     label_col: str = "label", parts: int = 8, entries: int = 16,
                     rounds: int = 6, scale: int = 4096, pivots: int = 4) -> DataFrame:
    """``id_col``, ``code`` (two hex digits a part), ``error`` (squared distances to
    the entries, summed), ``label_error`` (``error`` summed over equal labels, nulls
    together) and ``codebooks_sha256`` (of all entries in order).

    The codebooks start from the vectors with the ``entries`` smallest ids.

    Defined cases: a vector that is null or has a null or non-finite component is
    dropped, and so is one that cannot be cut like the first (another length, or
    a length that ``parts`` does not divide); rows with equal ids count as ties and
    are taken in the order of their components, rows with a null id come last;
    repeated rows each get their result; with fewer vectors than ``entries`` the
    codebooks are as short; an empty table gives an empty result. A component
    whose whole number exceeds 2^26 in size raises. Other input columns, whatever
    their names, are not read.
    """
    rid, error = "id", "error"
    given = vectors.select(
        col(id_col).alias(rid), col(label_col).alias("label"),
        F.when(usable(col(vector_col)), col(vector_col)).cast("array<double>").alias("vector"))
    given = given.where(F.col("vector").isNotNull() & (F.size("vector") > 0)
                        & (F.size("vector") % parts == 0))
    order = [F.col(rid).asc_nulls_last(), F.col("vector").asc()]
    leading = given.select(rid, "vector").orderBy(*order).limit(entries).collect()
    kind = dict(given.dtypes)
    if not leading:
        return vectors.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind[rid]}, code string, error long, label_error long, "
                "codebooks_sha256 string")
    length = len(leading[0]["vector"])
    rows = given.where(F.size("vector") == length)
    if any(len(r["vector"]) != length for r in leading):
        leading = rows.select(rid, "vector").orderBy(*order).limit(entries).collect()
    first = whole_numbers(np.array([r["vector"] for r in leading]), scale)
    first = np.ascontiguousarray(first.reshape(len(first), parts, -1).transpose(1, 0, 2))
    books = Codebooks(first, np.stack([choose_pivots(c, pivots) for c in first]))

    stored = materialize(_store(rows, books, scale, [rid, "label"]), "vector_parts")
    books = fit(stored, books, rounds)
    digest, width = books.digest(), first.shape[2]

    def code(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for whole, to_pivots in frames:
            codes, far = books.assign(np.array(whole.tolist(), np.int64).reshape(-1, parts * width),
                                      np.array(to_pivots.tolist()))
            yield pd.DataFrame({
                "code": [bytes(c).hex() for c in codes.astype(np.uint8)], "error": far.sum(1)})

    coded = (stored.select(rid, "label", F.pandas_udf(code, "code string, error long")(
        "whole", "to_pivots").alias("made")).select(rid, "label", "made.code", "made.error"))
    coded = materialize(coded, "vector_codes")
    by_label = coded.groupBy("label").agg(F.sum(error).alias("label_error"))
    (other,) = free_names(coded, "its label")
    by_label = by_label.withColumnRenamed("label", other)
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col(other)))
            .select(F.col(rid).alias(id_col), "code", error, "label_error",
                    F.lit(digest).alias("codebooks_sha256")))
