"""Fill-in-middle: cut a text at two unit boundaries and move the middle to the end.

A unit is a word with the white space before it, or the white space that ends a
text. Where the cuts lie follows from a hash of the document's id. To find
them, a text is taken as fixed blocks of UTF-8 bytes; a Fenwick tree over the
blocks holds how many units end in a block and how many code points start in
it. Binary lifting walks down the tree to the block where a cut's unit ends;
the boundary itself is looked up inside that block alone. Python returns three
numbers per text; Spark cuts and joins the text itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_names

#: Bytes of a block.
BLOCK = 512
#: The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree (from index 1) over per-block counts, built in one pass: node i
    holds the sum of the blocks that its lowest set bit spans."""
    upto = np.concatenate([[0], np.cumsum(counts)])
    i = np.arange(len(upto))
    return upto - upto[i - (i & -i)]


def descend(units: np.ndarray, points: np.ndarray, k: int) -> tuple[int, int, int]:
    """Block that holds the k-th unit end (k from 1), by binary lifting: the block's
    index, the unit ends before it and the code points before it."""
    at, before, chars = 0, 0, 0
    step = 1 << (len(units) - 1).bit_length()
    while step:
        then = at + step
        if then < len(units) and before + units[then] < k:
            at = then
            before += int(units[at])
            chars += int(points[at])
        step >>= 1
    return at, before, chars


class Blocks:
    """One text as blocks: ``n`` units, and where a unit ends."""

    def __init__(self, data: bytes, block: int = BLOCK):
        b = np.frombuffer(data, np.uint8)
        space = _IS_SPACE[b]
        ends = ~space
        if len(b):
            # a word ends where white space follows; white space is a unit at the end only
            ends[:-1] &= space[1:]
            ends[-1] = True
        self.block, self.ends = block, ends
        self.starts = (b & 0xC0) != 0x80
        cuts = np.arange(0, len(b), block)
        self.units = fenwick(np.add.reduceat(ends, cuts, dtype=np.int64) if len(b) else [])
        self.points = fenwick(np.add.reduceat(self.starts, cuts, dtype=np.int64) if len(b) else [])
        self.n = int(ends.sum())

    def chars_to(self, k: int) -> int:
        """Code points up to the end of the k-th unit."""
        if k <= 0:
            return 0
        at, before, chars = descend(self.units, self.points, k)
        first = at * self.block
        inside = np.flatnonzero(self.ends[first:first + self.block])[k - before - 1]
        return chars + int(self.starts[first:first + inside + 1].sum())


def cuts_of(text: str | None, h1: int, h2: int, block: int = BLOCK) -> tuple[int, int, int]:
    """Units of a text, and the code points of its prefix and of its middle."""
    blocks = Blocks((text or "").encode("utf-8", "surrogatepass"), block)
    a, b = sorted((h1 % (blocks.n + 1), h2 % (blocks.n + 1)))
    p = blocks.chars_to(a)
    return blocks.n, p, blocks.chars_to(b) - p


def _cuts(block: int) -> Column:
    def typed(frames: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, h1, h2 in frames:
            yield pd.DataFrame(
                [cuts_of(t, int(x), int(y), block) for t, x, y in zip(text, h1, h2, strict=True)],
                columns=["n", "p", "m"], dtype="int64")
    return F.pandas_udf(typed, "n long, p long, m long")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. The parts hold no marker, so the
    markers are the only places where it can be split."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   seed: int = 42, rate: int = 50, spm: int = 80,
                   block: int = BLOCK) -> DataFrame:
    """``docs`` with ``fim_text``, ``fim_form`` (``plain``, ``psm``, ``spm``),
    ``fim_units``, ``fim_prefix_chars`` and ``fim_middle_chars`` (null if plain).

    Of 100 texts, ``rate`` are transformed, ``spm`` in a hundred of those with the
    suffix first; a function of ``seed`` and the id alone, so reruns agree.

    Defined cases: a null text counts as empty, an empty one stays plain with no
    units; a text with a marker in it stays plain, so that every output can be
    read back; a null id is hashed as an empty string; a very long text is cut
    whole, in memory of a few times its size; repeated rows get equal results; an
    empty table gives an empty result; all columns pass through, input columns
    with the names of the new ones are replaced.
    """
    new = ["fim_text", "fim_form", "fim_units", "fim_prefix_chars", "fim_middle_chars"]
    text, digest, cut, form = free_names(docs, "whole text", "digest", "cut", "form of text")

    def h(i: int) -> Column:
        return F.conv(F.substring(col(digest), 8 * i - 7, 8), 16, 10).cast("long")

    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit("")))
    df = docs.withColumns({text: F.coalesce(col(text_col), F.lit("")),
                           digest: F.sha2(whole.cast("binary"), 256)})
    df = df.withColumn(cut, _cuts(block)(col(text), h(1), h(2)))
    marked = (F.contains(col(text), F.lit(PREFIX)) | F.contains(col(text), F.lit(SUFFIX))
              | F.contains(col(text), F.lit(MIDDLE)))
    df = df.withColumn(form, F.when((col(text) == "") | marked | (h(3) % 100 >= rate), "plain")
                       .when(h(4) % 100 < spm, "spm").otherwise("psm"))
    p, m = col(cut)["p"].cast("int"), col(cut)["m"].cast("int")
    prefix = F.substr(col(text), F.lit(1), p)
    middle = F.substr(col(text), p + 1, m)
    suffix = F.substr(col(text), p + m + 1)
    before, after, moved = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    cut_at_all = col(form) != "plain"
    return df.select(
        *[col(c) for c in docs.columns if c.lower() not in new],
        F.when(col(form) == "psm", F.concat(before, prefix, after, suffix, moved, middle))
        .when(col(form) == "spm", F.concat(after, suffix, before, prefix, moved, middle))
        .otherwise(col(text)).alias("fim_text"),
        col(form).alias("fim_form"), col(cut)["n"].alias("fim_units"),
        F.when(cut_at_all, col(cut)["p"]).alias("fim_prefix_chars"),
        F.when(cut_at_all, col(cut)["m"]).alias("fim_middle_chars"))


def fill_in_middle_summary(docs: DataFrame, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """Counts of :func:`fill_in_middle` and digests of its outputs and of the
    texts rebuilt from them."""
    out = fill_in_middle(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), "id")
    return out.select(
        F.col("id").alias(id_col), F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("fim_text"), F.col("fim_form")).cast("binary"), 256)
        .alias("restored_sha256"))
