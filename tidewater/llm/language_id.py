"""Language identification with a bit-sliced Bloom filter of n-grams.

One filter serves all languages: a row of the table holds one bit per language,
so the bitwise AND of an n-gram's rows gives every language whose set contains
it. A text's answer per language is the number of its n-grams with that bit,
less the number expected from false positives; the largest share decides.

An n-gram is four bytes of the text after lower-casing, with everything but
letters turned into single spaces. The set of a language holds the n-grams
that make up at least ``floor`` of its n-grams and are at least ``ratio`` times
as frequent there as in the language where they are most frequent. The sets
come from counts over all training texts. ``floor`` bounds a set to
``1 / floor`` n-grams whatever the corpus, and so the table that the tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize

HASHES = 4
#: N-grams handled at a time.
CHUNK = 1 << 21
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    """Letters only: numerals such as ½ or ① are none."""
    return bool(text) and any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, repeats included, as 32-bit numbers."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    b = np.frombuffer(b" " + b" ".join(words) + b"  ", np.uint8).astype(np.uint32)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def held_out(id_: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_.cast("string")), F.lit(folds)) == fold, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all texts of ``docs`` (``lang``, ``text``).

    A task adds up its own counts before anything is shuffled.
    """
    def merged(held):
        g = np.concatenate([h[0] for h in held])
        n = np.concatenate([h[1] for h in held])
        u, inverse = np.unique(g, return_inverse=True)
        return u, np.bincount(inverse, weights=n).astype(np.int64)

    def rows(lang, held):
        u, n = merged(held)
        for a in range(0, len(u), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(u[part])), "gram": pa.array(u[part].astype(np.int64)),
                "n": pa.array(n[part])})

    def count(batches):
        waiting: dict[str, list] = {}
        size: dict[str, int] = {}
        done: dict[str, list] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not has_letter(text):
                    continue
                g = grams(text)
                waiting.setdefault(lang, []).append(g)
                size[lang] = size.get(lang, 0) + len(g)
                if size[lang] >= CHUNK:
                    held = done.setdefault(lang, [])
                    held.append(np.unique(np.concatenate(waiting.pop(lang)), return_counts=True))
                    size[lang] = 0
                    if len(held) == 8:
                        done[lang] = [merged(held)]
        for lang, held in waiting.items():
            done.setdefault(lang, []).append(np.unique(np.concatenate(held), return_counts=True))
        for lang, held in done.items():
            yield from rows(lang, held)

    return (docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Filter:
    """The bit-sliced table: ``table[row, word]`` has one bit per language."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, table
        self.false = np.array([self._bit(table, i).mean() for i in range(len(langs))]) ** HASHES

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> masks.dtype.type(i % 64)) & masks.dtype.type(1)

    def masks(self, g: np.ndarray) -> np.ndarray:
        """Languages that contain each n-gram, as bit masks."""
        out = None
        for at in positions(g, len(self.table)):
            hit = self.table[at]
            out = hit if out is None else out & hit
        return out

    def shares(self, g: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Corrected share of the n-grams of each text in each language.

        Texts are the stretches of ``g`` that start at ``edges``.
        """
        masks = self.masks(g)
        n = np.diff(np.r_[edges, len(g)])
        out = np.empty((len(edges), len(self.langs)))
        for i, f in enumerate(self.false):
            hits = np.add.reduceat(self._bit(masks, i), edges, dtype=np.int64)
            out[:, i] = np.maximum(hits - n * f, 0) / (n * max(1 - f, 1e-9))
        return out


def positions(g: np.ndarray, rows: int):
    """The table rows of every n-gram, one array per hash; rows is a power of two."""
    h = (g.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    step = (h >> np.uint64(32)) | np.uint64(1)
    for _ in range(HASHES):
        yield (h & np.uint64(rows - 1)).astype(np.int64)
        h = h + step


def learn(docs: DataFrame, floor: float = 2e-6, ratio: float = 0.25) -> Filter:
    """Filter from ``docs`` (``lang`` not null, ``text``)."""
    counts = materialize(gram_counts(docs), "gram_counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()
    langs = [r["lang"] for r in totals]
    words = max(1, -(-len(langs) // 64))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64)
                if t is np.uint64 or len(langs) <= 8 * np.dtype(t).itemsize)
    if not langs:
        return Filter([], np.zeros((64, 1), kind))
    total = F.element_at(F.create_map(*[x for r in totals for x in (
        F.lit(r["lang"]), F.lit(float(r["total"])))]), F.col("lang"))
    number = F.element_at(F.create_map(*[x for i, s in enumerate(langs) for x in (
        F.lit(s), F.lit(i))]), F.col("lang"))
    share = counts.select("gram", number.alias("i"), (F.col("n") / total).alias("p"))
    most = share.groupBy("gram").agg(F.max("p").alias("most"))
    typical = materialize(
        share.where(F.col("p") >= floor).join(most, "gram")
        .where(F.col("p") >= ratio * F.col("most")).select("gram", "i"), "typical_grams")
    n = typical.select("gram").distinct().count()
    rows = max(64, 1 << int(np.ceil(np.log2(max(2 * HASHES * n, 64)))))
    slices = 64
    width = rows // slices

    def place(frames):
        for f in frames:
            for at in positions(f["gram"].to_numpy(), rows):
                yield pd.DataFrame({"slice": at // width, "at": at % width, "i": f["i"]})

    def union(f: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros((width, words), kind)
        at, i = f["at"].to_numpy(), f["i"].to_numpy()
        np.bitwise_or.at(part, (at, i // 64), kind(1) << (i % 64).astype(kind))
        return pd.DataFrame({"slice": f["slice"][:1], "part": [part.tobytes()]})

    table = np.zeros((slices, width, words), kind)
    placed = typical.mapInPandas(place, "slice long, at long, i int").distinct()
    for r in placed.groupBy("slice").applyInPandas(union, "slice long, part binary").collect():
        table[r["slice"]] = np.frombuffer(r["part"], kind).reshape(width, words)
    return Filter(langs, table.reshape(rows, words))


def predict_udf(model):
    """Arrow UDF: text to (language, score); ``model``: a broadcast :class:`Filter`."""
    def answer(texts: list[str]) -> tuple[list[str], np.ndarray]:
        f = model.value
        parts = [grams(t) for t in texts]
        size = np.array([len(p) for p in parts])
        share = f.shares(np.concatenate(parts), np.cumsum(size) - size)
        best, whole = share.argmax(axis=1), share.sum(axis=1)
        score = share[np.arange(len(texts)), best] / np.where(whole > 0, whole, 1)
        return [f.langs[i] for i in best], score

    def predict(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in columns:
            lang, score = ["und"] * len(s), np.zeros(len(s))
            at: list[int] = []
            size = 0
            known = [i for i, t in enumerate(s) if model.value.langs and has_letter(t)]
            for i in [*known, -1]:
                if at and (i < 0 or size >= CHUNK):
                    for k, name, x in zip(at, *answer([s.iloc[k] for k in at]), strict=True):
                        lang[k], score[k] = name, x
                    at, size = [], 0
                if i >= 0:
                    at.append(i)
                    size += len(s.iloc[i])
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return F.pandas_udf(predict, "lang_pred string, score double")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", floor: float = 2e-6,
                       ratio: float = 0.25) -> DataFrame:
    """Predicted language of every text.

    Learns from rows with a language that are not held out (crc32 of the id as
    text, modulo 4, is not 2). Returns ``id_col``, ``held_out``, ``lang_pred``
    and ``score``, the winner's part of all languages' corrected shares.

    Defined cases: a text that is null or has no letter is ``und`` with score
    0, and so is every text if there is nothing to learn from; a text none of
    whose n-grams is known gets the first language in order, score 0; ties go
    to the first language in order; a null id is not held out; repeated rows
    count and are answered each; a very long text is read whole, in chunks of
    n-grams; an empty table gives an empty result; only the three named columns
    are read.
    """
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"),
                       col(lang_col).cast("string").alias("lang"))
    out = held_out(F.col("id"))
    model = learn(rows.where(~out & F.col("lang").isNotNull()), floor, ratio)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return (rows.select("id", out.alias("held_out"), predict_udf(held)("text").alias("p"))
            .select(F.col("id").alias(id_col), "held_out", "p.lang_pred", "p.score"))
