"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

A fingerprint bit is 1 if more than half of the text's shingle hashes have it
set. Fingerprints link when they differ in at most ``max_bits`` bits.

The join walks pairs of trie nodes together, adds up the differing bits on the
way down and drops a pair of nodes once the budget is exceeded. To spread that
walk over tasks the bits are cut into ``max_bits + 1`` blocks and the trie is
built once per block, with that block rotated to the top: linked fingerprints
agree on at least one block, so walks that start at pairs of *equal* top nodes
lose no link. A top node with too many fingerprints is opened further before
it is dealt out: its fingerprints go to pairs of deeper nodes that are still
within the budget, so no task holds an unbounded group.

Work is done on distinct fingerprints: copies of a text never meet each other.
A walk returns, per fingerprint, the smallest one of its local component, not
the linked pairs, so a dense group costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import (
    col, connected_components, free_names, local_components, materialize, whole_groups,
)

BITS = 64
#: Distinct fingerprints under one top node before it is opened further.
NODE_LIMIT = 8192
#: Node pairs expanded at a time, which bounds a task's memory.
STEP = 1 << 17


def simhash_udf(shingle: int = 3, seed: int = 42):
    """Arrow UDF: text to 64-bit SimHash (as a signed long); null counts as empty."""
    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([fingerprint_of(t, shingle, seed) for t in s], dtype="int64")

    return fingerprint


def fingerprint_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of one text; zero without words.

    ``bytes.lower`` and ``bytes.split`` know exactly the ASCII letters and the
    white space of the word definition.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = (map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
             if len(words) >= shingle else [b" ".join(words)])
    hashes = np.fromiter((xxh64_intdigest(g, seed) for g in grams), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def link_fingerprints(fps: DataFrame, max_bits: int = 3, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Component of every fingerprint that links with another.

    ``fps``: one long column ``fp`` without repeats. Returns ``node``, ``root``.
    """
    cuts = [BITS * i // (max_bits + 1) for i in range(max_bits + 2)]
    turned = F.array(*[
        F.struct(F.lit(i).alias("turn"), _rotate_left(F.col("fp"), cuts[i]).alias("code"),
                 F.shiftrightunsigned(_rotate_left(F.col("fp"), cuts[i]),
                                      BITS - (cuts[i + 1] - cuts[i])).alias("top"))
        for i in range(max_bits + 1)])
    rows = fps.select(F.explode(turned).alias("t")).select("t.*")
    width = min(cuts[i + 1] - cuts[i] for i in range(max_bits + 1))

    crowded = materialize(
        rows.groupBy("turn", "top").count().where(F.col("count") > node_limit)
        .select("turn", "top", F.least(F.ceil(F.log2(F.col("count") / node_limit)), F.lit(16))
                .cast("int").alias("opened")), "crowded")
    opened = rows.withColumn("opened", F.lit(0))
    if not crowded.isEmpty():
        opened = (rows.join(crowded, ["turn", "top"], "left")
                  .withColumn("opened", F.coalesce("opened", F.lit(0))))
    # the bits after the top block, as many as the node was opened by
    cells = (opened
             .withColumn("sub", F.expr(f"shiftrightunsigned(shiftleft(code, {width}), 48)"))
             .withColumn("sub", F.expr("cast(shiftright(sub, 16 - opened) as int)"))
             .withColumn("mask", F.expr("explode(filter(sequence(0, shiftleft(1, opened) - 1), "
                                        f"m -> bit_count(m) <= {max_bits}))"))
             .withColumn("other", F.col("sub").bitwiseXOR(F.col("mask")))
             .select("turn", "top", F.least("sub", "other").alias("p"),
                     F.greatest("sub", "other").alias("q"), "sub", "code"))
    keys = ["turn", "top", "p", "q"]
    dealt = cells.repartition(*keys).sortWithinPartitions(*keys, "sub", "code")

    def walk_cells(frames):
        for f in whole_groups(frames, keys):
            code = f["code"].to_numpy().view(np.uint64)
            turn = f["turn"].to_numpy()
            first = np.r_[True, (f[keys].to_numpy()[1:] != f[keys].to_numpy()[:-1]).any(axis=1)]
            start = np.flatnonzero(first)
            end = np.r_[start[1:], len(f)]
            crossed = (f["p"] != f["q"]).to_numpy()[start]
            # the right half of a crossed pair starts where sub becomes q
            right = (f["sub"] == f["q"]).to_numpy()
            mid = end - np.add.reduceat(right, start)
            depth = np.array([cuts[i + 1] - cuts[i] for i in range(max_bits + 1)])[turn[start]]
            u, v = walk(code, start, end, mid, crossed, depth, max_bits)
            lab = local_components(len(f), u, v)
            fp = np.empty(len(f), np.uint64)
            for i in range(max_bits + 1):
                own = turn == i
                fp[own] = _rotated_back(code[own], cuts[i])
            moved = np.flatnonzero(lab != np.arange(len(f)))
            yield pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[lab[moved]].view(np.int64)})

    return connected_components(dealt.mapInPandas(walk_cells, "a long, b long"))


def _rotate_left(c: Column, by: int) -> Column:
    return c if by == 0 else F.shiftleft(c, by).bitwiseOR(F.shiftrightunsigned(c, BITS - by))


def _rotated_back(code, by: int):
    return code if by == 0 else (code >> np.uint64(by)) | (code << np.uint64(BITS - by))


def walk(code, start, end, mid, crossed, depth, max_bits):
    """Walk node pairs of the tries over ``code`` and return linked row pairs.

    Rows ``start[i]..end[i]`` are one trie whose first ``depth[i]`` bits agree,
    sorted (in two sorted halves split at ``mid[i]`` where ``crossed[i]``).
    Numpy arrays; a node is a range of rows, a node pair two ranges plus the
    bits they differ in so far. Neighbours within the budget are linked first;
    a pair of nodes that lies inside one such run needs no further walk.
    """
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = np.bitwise_count(code[1:] ^ code[:-1]) <= max_bits
    breaks = np.zeros(len(code) - 1, bool)
    breaks[start[1:] - 1] = True
    near &= ~breaks
    run = np.r_[0, np.cumsum(~near)]
    us, vs = [np.flatnonzero(near)], [np.flatnonzero(near) + 1]

    zeros_at: dict[int, np.ndarray] = {}

    def zeros(d: int):
        """zeros(d)[i]: rows before i whose bit d (from the top) is 0."""
        if d not in zeros_at:
            bit = (code >> np.uint64(BITS - 1 - d)) & np.uint64(1)
            zeros_at[d] = np.r_[0, np.cumsum(bit == 0)]
        return zeros_at[d]

    stack = []
    for d in np.unique(depth):
        at = depth == d
        a_end, b_start = np.where(crossed, mid, end)[at], np.where(crossed, mid, start)[at]
        stack.append((int(d), start[at], a_end, b_start, end[at],
                      np.zeros(at.sum(), np.int64)))
    while stack:
        d, al, ah, bl, bh, diff = stack.pop()
        same = al == bl
        live = ((ah > al) & (bh > bl) & (diff <= max_bits) & ~(same & (ah - al < 2))
                & (run[np.minimum(al, len(run) - 1)] != run[np.maximum(bh, 1) - 1]))
        al, ah, bl, bh, diff = al[live], ah[live], bl[live], bh[live], diff[live]
        if not len(al):
            continue
        if len(al) > STEP:
            h = len(al) // 2
            stack.append((d, al[:h], ah[:h], bl[:h], bh[:h], diff[:h]))
            stack.append((d, al[h:], ah[h:], bl[h:], bh[h:], diff[h:]))
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any():
            i, j = al[single], bl[single]
            hit = np.bitwise_count(code[i] ^ code[j]) <= max_bits
            us.append(i[hit])
            vs.append(j[hit])
            al, ah, bl, bh, diff = (x[~single] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        z = zeros(d)
        am, bm = al + z[ah] - z[al], bl + z[bh] - z[bl]
        same = al == bl
        x = ~same  # a node with itself has one crossed pair of children, not two
        parts = [(al, am, bl, bm, diff), (am, ah, bm, bh, diff), (al, am, bm, bh, diff + 1),
                 (am[x], ah[x], bl[x], bm[x], diff[x] + 1)]
        stack.append((d + 1, *(np.concatenate(c) for c in zip(*parts, strict=True))))
    return np.concatenate(us), np.concatenate(vs)


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 3, seed: int = 42,
                       node_limit: int = NODE_LIMIT) -> DataFrame:
    """Fingerprint and component of every row.

    Returns ``id_col``, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id`` (smallest id reachable over links, own id included).

    Defined cases: a null, empty or blank text has fingerprint zero and links
    like any other; repeated rows get equal results; a null id takes part in
    linking, is never the smallest id unless its whole component has none, and
    then ``component_id`` is null; an empty table gives an empty result; only
    the two named columns are read. A very long text is a row like any other, whose
    shingles one task hashes.
    """
    rows = materialize(
        docs.select(col(id_col).alias("id"), simhash_udf(shingle, seed)(col(text_col)).alias("fp")),
        "fingerprints")
    named = _components(rows, max_bits, node_limit)
    return (rows.join(named, "fp")
            .select(F.col("id").alias(id_col),
                    F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("first_id").alias("component_id")))


def _components(rows: DataFrame, max_bits: int, node_limit: int) -> DataFrame:
    """(fp, first_id, root) of every fingerprint, one row each."""
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("id")), "classes")
    roots = link_fingerprints(classes.select("fp"), max_bits, node_limit)
    rooted = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    rooted = materialize(rooted, "rooted")
    first = rooted.groupBy("root").agg(F.min("id").alias("first_id"))
    return rooted.join(first, "root").select("fp", "first_id", "root")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 3, seed: int = 42,
                       node_limit: int = NODE_LIMIT) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group.

    Kept is the row with the smallest id (null ids last; then the smallest
    fingerprint; among rows alike in both, the smallest row hash). Same defined
    cases as :func:`simhash_near_dedup`; all columns pass through.
    """
    fp, row_hash, w_fp, w_id, w_hash, copies = free_names(
        docs, "fp", "row_hash", "w_fp", "w_id", "w_hash", "copies")
    whole = F.xxhash64(*[col(c) for c in docs.columns if not _unhashable(docs, c)])
    marked = materialize(docs.withColumns({fp: simhash_udf(shingle, seed)(col(text_col)),
                                           row_hash: whole}), "marked")
    rows = marked.select(col(id_col).alias("id"), col(fp).alias("fp"),
                         col(row_hash).alias("row_hash"))
    named = _components(rows, max_bits, node_limit)
    # one (id, fingerprint, row hash) per component, chosen on narrow rows: null ids
    # sort last; and how many rows have all three
    distinct = rows.groupBy("id", "fp", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    best = (distinct.join(named.select("fp", "root"), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp", "row_hash",
                                "copies")).alias("w"))
            .select(F.col("w.fp").alias(w_fp), F.col("w.id").alias(w_id),
                    F.col("w.row_hash").alias(w_hash), F.col("w.copies").alias(copies)))
    best = materialize(best, "best")
    hit = marked.join(best, (col(fp) == col(w_fp)) & (col(row_hash) == col(w_hash))
                      & col(id_col).eqNullSafe(col(w_id)))
    # whole rows move once; only those that are there several times move again
    again = hit.where(col(copies) > 1).dropDuplicates([fp, row_hash])
    return hit.where(col(copies) == 1).unionByName(again).select(*[col(c) for c in docs.columns])


def _unhashable(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()
