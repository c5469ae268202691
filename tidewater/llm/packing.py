"""Best-fit packing of tokenized documents, certified by lower bounds.

A document is its token ids and one closing id; only longer ones than a
sequence are cut, into whole sequences and one shorter first piece. What is
left to pack is at most one shorter piece per document.

Pieces are dealt to partitions of bounded size at random. Each partition is
packed by best-fit decreasing and gets a lower bound on its sequences from
dual feasible functions: sizes are mapped so that any set that fits in one
sequence still sums to at most one, so the mapped total bounds the count from
below. A partition that meets its bound is certified and done. Partitions with
a gap give up the pieces of their sequences that are not full; those pieces
are dealt out anew and packed again, and the new packing is taken if it needs
fewer sequences than the same pieces had.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialize

#: Pieces to a partition, on average.
PER_PARTITION = 20_000
#: Times that partitions with gaps exchange pieces.
ROUNDS = 2
#: Chunks whose ids one Python worker remembers.
MEMO = 200_000


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit bytes, with a memo.

    Byte-level BPE splits a text before every single space that stands between
    two characters that are not white space, so such chunks can be encoded
    apart, and frequent ones once. Other texts are encoded whole. The added
    tokens of a ``vocabulary`` (a tokenizer's JSON file) are found in a text
    first and get their own ids; the ranks alone have none.
    """

    def __init__(self, ranks: str, vocabulary: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=table, special_tokens={}).encode_ordinary
        self._added = {}
        if vocabulary is not None:
            with open(vocabulary, encoding="utf-8") as f:
                for t in json.load(f)["added_tokens"]:
                    if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                        raise ValueError(f"added token with options: {t}")
                    self._added[t["content"]] = struct.pack("<I", t["id"])
        longest = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._any = re.compile(f"({'|'.join(longest)})" if longest else r"(?!)")
        self._spaces = re.compile(r" \s|\s ")
        outer = self

        class Memo(dict):
            def __missing__(self, chunk):
                ids = outer.raw(" " + chunk)
                if len(self) < MEMO:
                    self[chunk] = ids
                return ids

        self._memo = Memo()

    def raw(self, text: str) -> bytes:
        ids = self._encode(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        if self._any.search(text):
            return b"".join(self._added.get(x) or self._between(x)
                            for x in self._any.split(text) if x)
        return self._between(text)

    def _between(self, text: str) -> bytes:
        if self._spaces.search(text):
            return self.raw(text)
        first, *rest = text.split(" ")
        return self.raw(first) + b"".join(map(self._memo.__getitem__, rest))


@functools.cache
def tokens_of(ranks: str, vocabulary: str | None = None) -> Tokens:
    return Tokens(ranks, vocabulary)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_udf(capacity: int, ranks: str, vocabulary: str | None, with_ids: bool):
    """Arrow UDF: text to token count, checksum of each piece and, if asked, all ids."""
    kind = "n long, checksums array<long>" + ", ids binary" * with_ids

    def cut(texts):
        encode = tokens_of(ranks, vocabulary)
        for s in texts:
            rows = []
            for t in s:
                b = encode(t or "") + b"\0\0\0\0"
                step = 4 * capacity
                first = len(b) % step or step
                edges = [0, *range(first, len(b) + 1, step)]
                rows.append((len(b) // 4, [crc32(b[i:j]) for i, j in
                                           zip(edges, edges[1:], strict=False)],
                             *([b] if with_ids else [])))
            yield pd.DataFrame(rows, columns=["n", "checksums"] + ["ids"] * with_ids)

    def typed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from cut(texts)

    return F.pandas_udf(typed, kind)


def best_fit_decreasing(sizes: np.ndarray, capacity: int):
    """Bin and offset of every piece and the free space of every bin.

    A bit set of the free spaces that some bin has finds the tightest one.
    """
    order = np.argsort(-sizes, kind="stable")
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    free: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = present >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_free[room].pop()
            if not by_free[room]:
                present &= ~(1 << room)
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        free[b] = left
        if left:
            by_free[left].append(b)
            present |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Largest of the bounds that a family of dual feasible functions gives.

    * for each cut e up to half a sequence: sizes above ``capacity - e`` count
      as a whole sequence, sizes below e as nothing, the rest as they are;
    * for each k: a size x of which ``(k + 1) x`` is a whole number of
      sequences counts as it is, else as ``floor((k + 1) x / capacity) / k``.

    Integer arithmetic throughout.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    n_upto, sum_upto = np.cumsum(count), np.cumsum(count * x)
    e = np.arange(capacity // 2 + 1)
    large = n_upto[-1] - n_upto[capacity - e]
    middle = sum_upto[capacity - e] - np.where(e > 0, sum_upto[np.maximum(e - 1, 0)], 0)
    best = int(np.max(large + -(-middle // capacity)))
    for k in range(1, 21):
        scaled = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * scaled).sum()) // (k * capacity)))
    return best


def pack_sizes(items: DataFrame, capacity: int, per_partition: int, rounds: int) -> DataFrame:
    """Place pieces shorter than a sequence, and number whole ones.

    ``items``: ``uid`` (unique), ``size`` (0: none), ``whole`` (whole sequences).
    Returns ``uid``, ``sequence``, ``offset``, ``first_whole`` (number of the
    first whole sequence), ``certified``. Numbers are apart per partition, round and
    whole sequences, however many rounds there are.
    """
    def pack(number: int):
        def one(f: pd.DataFrame) -> pd.DataFrame:
            part = int(f["part"].iloc[0])
            f = f.sort_values("uid", ignore_index=True)
            size = f["size"].to_numpy()
            own = np.flatnonzero(size)
            bins, offsets, free = best_fit_decreasing(size[own], capacity)
            base = (part * (rounds + 2) + number) << 32
            out = pd.DataFrame({"uid": f["uid"], "size": size, "whole": f["whole"],
                                "sequence": base, "offset": 0, "free": 0,
                                "gap": len(free) - lower_bound(size[own], capacity),
                                "first_whole": f["first_whole"]})
            out.loc[own, "sequence"] = base + bins
            out.loc[own, "offset"] = offsets
            out.loc[own, "free"] = free[bins] if len(own) else 0
            if number == 0:
                out["first_whole"] = ((part * (rounds + 2) + rounds + 1) << 32) + np.cumsum(f["whole"]) - f["whole"]
            return out
        return one

    kind = ("uid long, size long, whole long, sequence long, offset long, free long, gap long, "
            "first_whole long")

    def dealt(rows: DataFrame, number: int, n: int) -> tuple[DataFrame, int]:
        parts = max(1, -(-n // per_partition))
        part = F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(parts)).alias("part")
        return materialize(
            rows.select("uid", "size", "whole", "first_whole", part).groupBy("part")
            .applyInPandas(pack(number), kind), "packed"), parts

    n = items.count()
    placed, parts = dealt(items.withColumn("first_whole", F.lit(0).cast("long")), 0, n)
    done = []
    for number in range(1, rounds + 1):
        loose = placed.where("gap > 0 and free > 0 and size > 0")
        before = loose.agg(F.count("uid").alias("n"),
                           F.sum(F.when(F.col("offset") == 0, 1)).alias("bins")).first()
        if parts == 1 or not before["n"]:
            break
        again, new_parts = dealt(loose, number, before["n"])
        if again.where("offset = 0").count() >= before["bins"]:
            break
        done.append(placed.where("not (gap > 0 and free > 0 and size > 0)"))
        placed, parts = again, new_parts
    for d in done:
        placed = placed.unionByName(d)
    return placed.select("uid", "sequence", "offset", "first_whole",
                         (F.col("gap") <= 0).alias("certified"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 2048, ranks: str | None = None, with_ids: bool = False,
                   per_partition: int = PER_PARTITION, rounds: int = ROUNDS,
                   vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents and their places.

    Returns ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, ``certified`` (the piece's last partition met
    its lower bound) and, with ``with_ids``, ``ids`` (little-endian unsigned
    32-bit). ``ranks`` and ``vocabulary`` default to the 50k vocabulary and its
    JSON file, whose added tokens (``<|endoftext|>``) keep their ids in a text; with
    other ``ranks`` and no ``vocabulary`` there are none.

    Defined cases: a null or empty text is the closing id alone; repeated rows
    and null ids are documents like any other; ties go by row order; an empty
    table gives an empty result; only the two named columns are read. A very long
    text is a row like any other: one task encodes it and cuts it into pieces.
    """
    if ranks is None and vocabulary is None:
        vocabulary = default_vocabulary()
    cut = pieces_udf(capacity, ranks or default_ranks(), vocabulary, with_ids)
    rows = materialize(
        docs.select(F.monotonically_increasing_id().alias("uid"), col(id_col).alias("id"),
                    cut(col(text_col)).alias("t")).select("uid", "id", "t.*"), "tokens")
    short = F.col("n") % capacity
    placed = pack_sizes(rows.select("uid", short.alias("size"),
                                    F.floor(F.col("n") / capacity).alias("whole")),
                        capacity, per_partition, rounds)
    n_short = F.when(short > 0, 1).otherwise(0)
    first = F.when(short > 0, short).otherwise(capacity)
    at_front = (F.col("piece") == 0) & (short > 0)
    start = F.when(F.col("piece") == 0, 0).otherwise(first + (F.col("piece") - 1) * capacity)
    length = F.when(F.col("piece") == 0, first).otherwise(capacity)
    out = (rows.join(placed, "uid")
           .select("*", F.posexplode("checksums").alias("piece", "ids_crc32")))
    return out.select(
        F.col("id").alias(id_col), F.col("piece").cast("int").alias("piece"),
        start.cast("long").alias("start"), length.cast("long").alias("length"), "ids_crc32",
        F.when(at_front, F.col("sequence"))
        .otherwise(F.col("first_whole") + F.col("piece") - n_short).cast("long")
        .alias("sequence_id"),
        F.when(at_front, F.col("offset")).otherwise(0).cast("long").alias("offset"), "certified",
        *([F.substring(F.col("ids"), (4 * start + 1).cast("int"), (4 * length).cast("int"))
           .alias("ids")] if with_ids else []))


def packed_sequences(docs: DataFrame, **kw) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` (binary), ``documents``.

    A group holds at most ``capacity`` ids, so gathering it is bounded.
    """
    id_col = kw.get("id_col", "doc_id")
    pieces = pack_documents(docs, with_ids=True, **kw)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", col(id_col).alias("id"))))
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))")
                    .alias("ids"), F.col("p.id").alias("documents")))
