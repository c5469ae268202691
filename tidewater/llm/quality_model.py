"""Quality classifier: gradient-boosted trees over document statistics.

Statistics of every whole text are computed once and kept as a small table.
Trees are grown level by level on histograms of binned statistics (gradient
and curvature of the logistic loss per bin), on a bounded sample of labelled
rows. A fitted model is three arrays, one row per tree and one column per node
of a complete binary tree, and texts are scored by walking all rows of a batch
down one level at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialize
from .language_id import held_out

FEATURES = [
    "words", "word_length", "distinct_words", "top_word", "repeated_next", "distinct_triples",
    "lines", "distinct_lines", "words_per_line", "upper", "digits", "symbols", "punctuation",
    "exclamation", "pipes", "white_space", "not_ascii", "short_words", "sentence_ends",
    "long_words",
]
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,;:!?"
_WHITE = b" \t\n\x0b\x0c\r"
_HIGH = bytes(range(128, 256))


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``FEATURES``; zeros without words."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(b)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in b.split(b"\n") if x.strip()]
    counts = Counter(words)

    def share(chars: bytes) -> float:
        return (size - len(b.translate(None, chars))) / size

    same_next = sum(map(bytes.__eq__, words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [
        float(np.log1p(n)), float(lengths.mean()), len(counts) / n, max(counts.values()) / n,
        same_next / n, triples / max(n - 2, 1), float(np.log1p(len(lines))),
        len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), share(_UPPER),
        share(_DIGITS), share(_SYMBOLS), share(_MARKS), share(b"!"), share(b"|"), share(_WHITE),
        share(_HIGH), float((lengths <= 3).mean()),
        (b.count(b". ") + b.count(b".\n") + b.endswith(b".")) / n, float((lengths >= 15).mean()),
    ]


@dataclass
class Trees:
    """A fitted ensemble. Node i of a tree has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); larger values go right
    leaf: np.ndarray  # (trees, leaves)
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1] if len(self.feature) else 0
        depth = int(np.log2(inner + 1))
        row = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[row, f[node]] > t[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1,
        bins: int = 64, smooth: float = 1.0, least: float = 3.0) -> Trees:
    """Histogram gradient boosting of the logistic loss.

    ``smooth`` is added to a node's curvature, ``least`` is the curvature that
    each side of a split must keep. Without rows of both classes there is no
    tree and every score is the smoothed share of class 1 (0.5 without rows).
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)),
                     start)
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    feature, threshold, leaf = [], [], []
    total = np.full(n, start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        f = np.zeros(inner, np.int64)
        t = np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            own = node - first
            best = np.zeros(width)
            for j in range(m):
                at = own * bins + binned[:, j]
                gs = np.bincount(at, weights=g, minlength=width * bins).reshape(width, bins)
                hs = np.bincount(at, weights=h, minlength=width * bins).reshape(width, bins)
                gl, hl = gs.cumsum(axis=1)[:, :-1], hs.cumsum(axis=1)[:, :-1]
                gt, ht = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                gain = (gl ** 2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth)
                        - gt ** 2 / (ht + smooth))
                gain[(hl < least) | (ht - hl < least)] = 0
                gain[:, len(edges[j]):] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                for k in np.flatnonzero(top > best + 1e-12):
                    best[k], f[first + k], t[first + k] = top[k], j, edges[j][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > t[node])
        at = node - inner
        value = -rate * np.bincount(at, weights=g, minlength=leaves) / (
            np.bincount(at, weights=h, minlength=leaves) + smooth)
        total += value[at]
        feature.append(f)
        threshold.append(t)
        leaf.append(value)
    return Trees(np.array(feature), np.array(threshold), np.array(leaf), start)


def statistics_udf():
    def compute(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in columns:
            yield pd.Series([statistics(t) for t in s])

    return F.pandas_udf(compute, "array<double>")


def score_udf(model):
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in columns:
            x = np.array(s.tolist(), np.float64).reshape(len(s), len(FEATURES))
            yield pd.Series(model.value.scores(x))

    return F.pandas_udf(score, "double")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_id_col: str = "doc_id",
                  label_col: str = "quality", cut: float = 0.7,
                  max_labelled: int = 100_000) -> DataFrame:
    """Score of every text.

    Fits on labelled rows that are not held out (crc32 of the id as text,
    modulo 4, is not 2): all, or the ``max_labelled`` with the smallest id
    hashes. Returns ``id_col``, ``held_out``, ``score`` (0 to 1, higher: label 1
    likelier) and ``predicted`` (1 if ``score >= cut``).

    Defined cases: a null, empty or blank text has all statistics zero and is
    scored like any other; labels with a null id or value are left out, and
    several labels of one id count as the majority (1 on a tie); without both
    classes all scores are the share of class 1; a null id is not held out and
    has no label; repeated rows are scored each; an empty table gives an empty
    result; only the named columns are read. A very long text is a row like any
    other: one task holds it while its statistics are taken.
    """
    stats = materialize(
        docs.select(col(id_col).alias("id"), statistics_udf()(col(text_col)).alias("x")),
        "statistics")
    out = held_out(F.col("id"))
    marks = (labels.select(col(label_id_col).alias("id"), col(label_col).alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~out)
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    sample = (stats.join(marks, "id").orderBy(F.xxhash64("id"), "id").limit(max_labelled)
              .select("x", "y").toPandas())
    x = np.array(sample["x"].tolist(), np.float64).reshape(len(sample), len(FEATURES))
    model = docs.sparkSession.sparkContext.broadcast(fit(x, sample["y"].to_numpy(np.float64)))
    return (stats.select(F.col("id").alias(id_col), out.alias("held_out"),
                         score_udf(model)("x").alias("score"))
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))
