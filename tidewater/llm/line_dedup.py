"""Line de-duplication: an exact set-similarity join over the lines of all texts.

A line is the set of its words (ASCII letters lower-cased). Two lines match if
the Jaccard similarity of their sets is at least ``threshold``; a line that
matches an earlier one is removed. Earlier means smaller (id, line number, text
hash), null ids last. Lines without words stay.

The join follows the prefix filter: with the words of a line in one global
order, rare first, two matching lines share a word among the first
``size - ceil(threshold * size) + 1`` of each. Such prefix words, with the
line's place and size, parity bits (64 of a short line, 128 of a long one) and a
signature of its set, are all that is shuffled to find pairs. Lines with equal sets
meet at their first word and need no more: they agree in size, parities and
signature, in which two unlike sets below the threshold agree with a chance of
2**-55 at most, about that of two words with the same hash. Of the others, inside the group of one word a pair of lines must pass

* the length filter (sizes within the threshold of each other),
* the positional filter (enough words left from this one on), and
* the parity filter: bits in which the two maps differ never outnumber the
  words in which the two sets differ.

Each line keeps the few most likely of the earlier lines that pass; those pairs
are verified on the full sets. A line is settled by one verified pair, so a large group of
alike lines yields rows in proportion to its lines, not its pairs. A line of
which every kept pair failed while more had passed is joined again with all
that pass, so nothing is lost.

Rarity comes from counts of hashed words: a table of ``2 ** sketch_bits``
counters over all words of all texts. Any order gives the same result; a
rarer-first one only makes groups small. A second table counts prefix words the
same way, and a word with more than ``cell`` of them is split into blocks that
meet pairwise, so no task gets an unbounded group. Words are compared by 56
bits of a 64-bit hash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_names, materialize

#: Bytes of text handled at a time.
CHUNK = 1 << 18
#: Most likely partners that a line keeps per prefix word.
KEPT = 3
WEAK = 16
#: Lines of fewer words keep 64 parity bits, which are plenty for them.
FOLD = 32
#: Pairs of lines compared at a time, and those beyond which a group is a large one.
PAIRS, LARGE = 1 << 18, 1 << 17

#: The least bytes of a little-endian number, by how many.
_LEAST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits of a hash are usable."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pieces(marks: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of what lies between marks, from 0 to ``end``."""
    start = np.r_[0, marks + 1]
    return start, np.r_[marks, end] - start


def cut(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased, where white space lies, and which of it breaks lines."""
    low = raw + ((raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))
    marks = np.flatnonzero((raw - np.uint8(9) < 5) | (raw == 32))
    return low, marks, raw[marks] == 10


def word_hashes(text: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at ``start``, taken in steps of eight bytes."""
    eight = np.ndarray((len(text) + 1,), "<u8", text + bytes(9), strides=(1,))
    h = _mixed((eight[start] & _LEAST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _ODD))
    long = np.flatnonzero(size > 8)
    if len(long):
        steps = (size[long] - 1) >> 3
        head = np.cumsum(steps) - steps
        nth = 1 + np.arange(steps.sum()) - np.repeat(head, steps)
        at = np.repeat(start[long], steps) + 8 * nth
        left = np.repeat(size[long], steps) - 8 * nth
        part = _mixed((eight[at] & _LEAST[np.minimum(left, 8)]) + nth.astype(np.uint64) * _ODD)
        h[long] = _mixed(h[long] + np.add.reduceat(part, head))
    return h


def words_of(batch: pa.RecordBatch, name: str, wanted=None
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, line, word hash) of every word, chunk by chunk, rows never split.

    Works on the batch's text buffer. With ``wanted``, a function of rows and line
    numbers, only of lines for which it is true; the others are not cut into words.
    """
    text = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = (np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None
            else np.zeros(0, np.uint8))
    row = 0
    while row < len(text):
        last = int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1
        last = min(max(last, row + 1), len(text))
        at = offsets[row:last + 1]
        # a line break between rows, so that all words and lines lie between marks
        raw = np.frombuffer(b"\n".join(
            [data[a:b] for a, b in itertools.pairwise(at.tolist())]), np.uint8)
        at = at[:-1] - at[0] + np.arange(last - row)
        if wanted is None:
            low, marks, breaks = cut(raw)
            start, size = pieces(marks[breaks], len(raw))
        else:
            start, size = pieces(np.flatnonzero(raw == 10), len(raw))
        r = np.searchsorted(at, start, "right") - 1
        line = np.arange(len(r)) - np.searchsorted(start, at)[r]
        r += row
        row = last
        if wanted is not None:
            hit = np.flatnonzero((size > 0) & wanted(r, line))
            r, line, start, size = r[hit], line[hit], start[hit], size[hit]
            low, marks, breaks = cut(np.frombuffer(b"\n".join(
                [raw[a:a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)]),
                np.uint8))
        of = np.r_[0, np.cumsum(breaks)]
        start, size = pieces(marks, len(low))
        full = np.flatnonzero(size)
        if len(full):
            of = of[full]
            yield r[of], line[of], word_hashes(low.tobytes(), start[full], size[full])


def line_edges(row: np.ndarray, line: np.ndarray) -> np.ndarray:
    """First index of every line in word-level arrays."""
    if not len(row):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])])


def word_keys(h: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Eight bits of rarity on top of 56 bits of hash."""
    rare = rarity[h >> np.uint64(64 - int(math.log2(len(rarity))))].astype(np.uint64)
    return rare << np.uint64(56) | h >> np.uint64(8)


class Lines:
    """Lines of a chunk as sorted sets of word keys, rare words first."""

    def __init__(self, row, line, h, rarity: np.ndarray):
        first = line_edges(row, line)
        key = word_keys(h, rarity)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True):
            key[a:b].sort()
        fresh = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        fresh[first] = True
        self.key = key[fresh]
        self.first = np.searchsorted(np.flatnonzero(fresh), first)
        self.size = np.diff(np.r_[self.first, len(self.key)])
        self.row, self.line = row[first], line[first]

    def picked(self, hit: np.ndarray) -> Lines:
        """Only the lines marked in ``hit``."""
        out = object.__new__(Lines)
        out.key, out.size = self.key[np.repeat(hit, self.size)], self.size[hit]
        out.first = np.cumsum(out.size) - out.size
        out.row, out.line = self.row[hit], self.line[hit]
        return out

    def signatures(self) -> np.ndarray:
        """Two 64-bit sums per line: equal sets have equal ones."""
        return np.stack([np.add.reduceat(_mixed(self.key ^ np.uint64(s)), self.first)
                         for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)], axis=1)

    def parity(self) -> np.ndarray:
        """128 parity bits per line, as two words; of short lines folded to one."""
        bit = np.uint64(1) << (self.key & np.uint64(63))
        upper = (self.key & np.uint64(64)) > 0
        low, high = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), self.first)
                     for half in (~upper, upper))
        short = self.size < FOLD
        return np.stack([np.where(short, low ^ high, low),
                         np.where(short, np.uint64(0), high)], axis=1)

    def prefix(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line index, position, key) of every prefix word."""
        n = self.size - np.ceil(threshold * self.size - 1e-9).astype(np.int64) + 1
        of = np.repeat(np.arange(len(n)), n)
        pos = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        return of, pos, self.key[self.first[of] + pos]


def counters(docs: DataFrame, bits: int, keys_of) -> np.ndarray:
    """Table of ``2 ** bits`` counts over the 64-bit values ``keys_of`` yields.

    Every task sends its table in slices, slices are summed apart, and the
    finished table, whose size the parameter fixes, comes to the driver.
    """
    slices = 64

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        held: list[np.ndarray] = []
        for values in itertools.chain.from_iterable(map(keys_of, batches)):
            held.append((values >> np.uint64(64 - bits)).astype(np.int64))
            if sum(map(len, held)) >= 1 << bits:
                total += np.bincount(np.concatenate(held), minlength=1 << bits)
                held.clear()
        if held:
            total += np.bincount(np.concatenate(held), minlength=1 << bits)
        parts = total.reshape(slices, -1)
        some = [i for i in range(slices) if parts[i].any()]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(some, pa.int32()),
            "counts": pa.array([parts[i].tobytes() for i in some], pa.binary())})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in f["counts"])
        return pd.DataFrame({"slice": f["slice"][:1], "counts": [total.tobytes()]})

    out = np.zeros((slices, (1 << bits) // slices), np.int64)
    kind = "slice int, counts binary"
    for r in docs.mapInArrow(count, kind).groupBy("slice").applyInPandas(add, kind).collect():
        out[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)


#: Postings travel in blocks: long columns, byte by byte, so that equal bytes lie together.
#: mark: cell above two bits, null id and probe; place: line above 32 bits of text
#: hash; shape: see ``packed``.
POSTING = ("word", "mark", "id", "place", "shape", "parity_low", "parity_high")
BLOCK = "bucket int, postings binary"
#: Postings that a task holds before it hands them on, and those of a bucket, about.
HELD, BUCKET = 1 << 18, 200_000
_HALF = np.int64(0xFFFFFFFF)


def packed(size: np.ndarray, pos: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Size, position and signature of postings in one long, never 0.

    Lines of fewer than 256 words: 49 bits of signature, 8 of size, 6 of position.
    Longer ones, whose parities tell unlike sets apart: a sign bit, 24 bits of size, 16
    of position, 23 of signature. A larger position counts as the largest.
    """
    sign = sign.view(np.uint64)
    short = (sign >> np.uint64(15)).view(np.int64) << 14 | size << 6 | np.minimum(pos, 63)
    long = (np.iinfo(np.int64).min | size << 39 | np.minimum(pos, 65535) << 23
            | (sign >> np.uint64(41)).view(np.int64))
    return np.where(size < 256, short, long)


def unpacked(shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, position, signature) of ``packed`` ones."""
    short = shape >= 0
    return (np.where(short, shape >> 6 & 255, shape >> 39 & 0xFFFFFF),
            np.where(short, shape & 63, shape >> 23 & 65535),
            np.where(short, shape >> 14, shape & 0x7FFFFF))


def blocks(columns: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Postings, a row of longs for each column, as one block for each of their buckets;
    the same word and cell always go to one bucket."""
    word, mark = columns[0].view(np.uint64), columns[1].view(np.uint64)
    bucket = (_mixed(word + _mixed(mark >> np.uint64(2))) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((columns[0], bucket))
    bucket, columns = bucket[order], columns[:, order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket[edges[:-1]]),
        "postings": pa.array([
            np.ascontiguousarray(columns[:, i:j]).view(np.uint8).reshape(len(POSTING), j - i, 8)
            .transpose(0, 2, 1).tobytes() for i, j in itertools.pairwise(edges.tolist())],
            pa.binary())})


def unblocked(block: bytes) -> np.ndarray:
    """The columns of a block."""
    planes = np.frombuffer(block, np.uint8).reshape(len(POSTING), 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64)[:, :, 0]


def postings(rows: DataFrame, threshold: float, rarity, crowds, cell: int, only=None,
             probes=None) -> DataFrame:
    """Prefix words of the lines of ``rows`` (``id``, ``text_hash``, ``text``), in blocks.

    ``only``: a broadcast bit table; words without their bit are left out. ``probes``:
    one of lines; those without their bit are no probes, without it all are.
    Lines of one batch with equal sets are represented by the earliest; the
    others come out as rows of shape 0, spread over the words, unless ``only`` is given.
    """
    buckets = max(1, int(crowds.value.sum()) // BUCKET)

    def columns_of(batch):
        bits = int(math.log2(len(crowds.value)))
        ids = batch.column(batch.schema.get_field_index("id"))
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        text_hash = batch.column(batch.schema.get_field_index("text_hash")).to_numpy(
            zero_copy_only=False)
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)
        for row, line, h in words_of(batch, "text"):
            if only is not None:  # a line without such a word need not be sorted
                first = line_edges(row, line)
                some = np.logical_or.reduceat(
                    marked(only.value, word_marks(word_keys(h, rarity.value))), first)
                pick = np.repeat(some, np.diff(np.r_[first, len(h)]))
                if not pick.any():
                    continue
                row, line, h = row[pick], line[pick], h[pick]
            ls = Lines(row, line, h, rarity.value)
            of, pos, key = ls.prefix(threshold)
            if only is not None:
                hit = np.zeros(len(ls.row), bool)
                hit[of[marked(only.value, word_marks(key))]] = True
                if not hit.any():
                    continue
                ls = ls.picked(hit)
                of, pos, key = ls.prefix(threshold)
            sign = ls.signatures()
            place = ls.line << np.int64(32) | text_hash[ls.row]
            null = missing[ls.row]
            order = np.lexsort((place, value[ls.row], null, sign[:, 1], sign[:, 0]))
            s = sign[order]
            again = np.r_[False, (s[1:] == s[:-1]).all(axis=1)]
            # a repeated row is the same document: its lines are not each other's copies
            own = np.stack([value[ls.row], null, place], axis=1)[order]
            group = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
            again &= (own != own[group]).any(axis=1)
            copy = np.zeros(len(order), bool)
            copy[order] = again
            stays = ~copy[of]
            if only is not None:
                stays &= marked(only.value, word_marks(key))
            of, pos, key = of[stays], pos[stays], key[stays]
            blocks = -(-crowds.value[((key << np.uint64(8)) >> np.uint64(64 - bits))
                                     .astype(np.int64)] // cell)
            parity = ls.parity().view(np.int64)
            flags = null.astype(np.int64) << 1 | (
                1 if probes is None else marked(probes.value, line_marks(
                    text_hash[ls.row], ls.line)).astype(np.int64))

            def columns(of, key, cells, shape, ls=ls, place=place, parity=parity, flags=flags):
                return np.stack([key.view(np.int64), cells << 2 | flags[of], value[ls.row[of]],
                                 place[of], shape, parity[of, 0], parity[of, 1]])

            one = blocks <= 1
            shape = packed(ls.size[of], pos, np.ascontiguousarray(sign[of, 0]))
            yield columns(of[one], key[one], np.zeros(one.sum(), np.int64), shape[one])
            if not one.all():
                of, key, shape, blocks = of[~one], key[~one], shape[~one], blocks[~one]
                mine = (_mixed(place[of].view(np.uint64))
                        % blocks.astype(np.uint64)).astype(np.int64)
                rep = np.repeat(np.arange(len(of)), blocks)
                other = np.arange(len(rep)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                lo, hi = np.minimum(mine[rep], other), np.maximum(mine[rep], other)
                yield columns(of[rep], key[rep], lo * blocks[rep] + hi + 1, shape[rep])
            gone = np.flatnonzero(copy)
            if len(gone) and only is None:
                yield columns(gone, _mixed(place[gone].view(np.uint64)), gone * 0, gone * 0)

    def emit(batches):
        held, n = [], 0
        for columns in itertools.chain.from_iterable(map(columns_of, batches)):
            held.append(columns)
            n += columns.shape[1]
            if n >= HELD:
                yield from parted(held, n)
                held, n = [], 0
        yield from parted(held, n)

    def parted(held, n):
        columns = np.concatenate(held, axis=1) if n else None
        for i in range(0, n, HELD):
            yield blocks(columns[:, i:i + HELD], buckets)

    return rows.mapInArrow(emit, BLOCK)


def differing(size, parity, x, y) -> np.ndarray:
    """In how many parity bits index pairs differ; folded if one of them is."""
    low, high = parity[x, 0] ^ parity[y, 0], parity[x, 1] ^ parity[y, 1]
    folded = np.minimum(size[x], size[y]) < FOLD
    low, high = np.where(folded, low ^ high, low), np.where(folded, np.uint64(0), high)
    return np.bitwise_count(low).astype(np.int64) + np.bitwise_count(high)


def passing(size, pos, parity, x, y, threshold: float) -> np.ndarray:
    """Which index pairs (x later, y earlier) of one word pass the three filters."""
    sx, sy = size[x], size[y]
    need = np.ceil(threshold / (1 + threshold) * (sx + sy) - 1e-9).astype(np.int64)
    # enough words left includes a size that is large enough
    ok = np.minimum(sx - pos[x], sy - pos[y]) >= need
    at = np.flatnonzero(ok)
    ok[at] = differing(size, parity, x[at], y[at]) <= (sx + sy - 2 * need)[at]
    return ok


def equal_lines(group, rank, size, sign, parity) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by (group, rank): which rows stand for their equals in
    the group, and which are later copies; the same line again is neither."""
    if not len(group):
        return np.zeros(0, bool), np.zeros(0, bool)
    keys = (group, size, sign, parity[:, 0], parity[:, 1])
    mix = np.zeros(len(group), np.uint64)
    for v in keys:
        mix = _mixed(mix + v.astype(np.uint64))
    order = np.argsort(mix, kind="stable")  # equal rows lie together, by rank
    again = np.r_[False, np.all([v[order][1:] == v[order][:-1] for v in keys], axis=0)]
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(again))))
    first, copy = np.zeros(len(group), bool), np.zeros(len(group), bool)
    first[order] = ~again
    copy[order] = again & (rank[order] != rank[order[head]])
    return first, copy


def likely_pairs(group, rank, probe, size, pos, parity, threshold: float, kept: int):
    """For rows sorted by (group, rank): index pairs (x, y), y before x, that pass.

    For every x at most ``kept`` pairs, those whose parities differ least for
    their size, and whether more pass or may; ``WEAK`` times as many if even the
    first uses up half of the bits it may differ in. Only rows marked in ``probe`` act
    as x. Rows lie by size within their group, so the partners that the length and
    positional filters leave a row are a range. Those of most groups are
    compared all at once; large groups block by block, and a row that has
    enough pairs takes no part in further blocks.
    """
    n = len(group)
    key = group.astype(np.int64) << 24 | size
    by = np.argsort(key, kind="stable")
    key, s = key[by], size[by]
    own = key - s
    # of two rows the longer one, at i, meets the shorter one, at lo[i] or later
    most = np.minimum(s, np.floor((s - pos[by]) * (1 + threshold) / threshold - s + 1e-6))
    lo = np.searchsorted(key, own + np.ceil(threshold * s - 1e-6).astype(np.int64))
    hi = np.searchsorted(key, own + np.maximum(most, 0).astype(np.int64), "right")
    many = np.maximum(np.minimum(hi, np.arange(n)) - lo, 0)
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if n else np.zeros(0, np.int64)
    length = np.diff(np.r_[start, n])
    large = np.add.reduceat(many, start) > LARGE if n else np.zeros(0, bool)
    many[np.repeat(large, length)] = 0
    xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    upto = np.cumsum(many)
    cuts = np.searchsorted(upto, np.arange(0, upto[-1] if n else 0, PAIRS), "left")
    for a, b in itertools.pairwise(np.unique(np.r_[0, cuts, n]).tolist()):
        i = np.repeat(np.arange(a, b), many[a:b])
        j = np.arange(len(i)) + np.repeat(lo[a:b] - (upto[a:b] - many[a:b] - (upto[a] - many[a])),
                                          many[a:b])
        i, j = by[i], by[j]
        x, y = np.maximum(i, j), np.minimum(i, j)
        ok = (rank[x] != rank[y]) & probe[x]
        x, y = x[ok], y[ok]
        ok = passing(size, pos, parity, x, y, threshold)
        xs.append(x[ok])
        ys.append(y[ok])
    for a, m in zip(start[large].tolist(), length[large].tolist(), strict=True):
        for at in range(a, a + m, 512):
            till = min(at + 512, a + m)
            x_all = np.sort(by[at:till][probe[by[at:till]]])
            if not len(x_all):
                continue
            found = np.zeros(len(x_all), np.int64)
            # sizes of these rows and what they allow
            first, last = np.searchsorted(key, own[a] + np.r_[
                math.ceil(threshold * s[at] - 1e-6),
                math.floor(s[till - 1] / threshold + 1e-6) + 1])
            y_of = np.sort(by[first:last])
            y_of = y_of[y_of < x_all[-1]]
            for c in range(0, len(y_of), 2048):
                open_ = np.flatnonzero(found <= WEAK * kept)
                if not len(open_):
                    break
                x, y = (v.ravel() for v in np.meshgrid(x_all[open_], y_of[c:c + 2048],
                                                       indexing="ij"))
                before = (y < x) & (rank[x] != rank[y])
                x, y = x[before], y[before]
                ok = passing(size, pos, parity, x, y, threshold)
                xs.append(x[ok])
                ys.append(y[ok])
                found += np.bincount(np.searchsorted(x_all, x[ok]), minlength=len(found))
    x, y = np.concatenate(xs), np.concatenate(ys)
    differ, both = differing(size, parity, x, y), size[x] + size[y]
    spare = both - 2 * np.ceil(threshold / (1 + threshold) * both - 1e-9)
    order = np.lexsort((y, differ / both, x))
    x, y = x[order], y[order]
    head = np.searchsorted(x, x, "left")
    total = np.searchsorted(x, x, "right") - head
    limit = np.where((2 * differ >= spare)[order][head], WEAK * kept, kept)
    few = np.arange(len(x)) - head < limit
    return x[few], y[few], (total > limit)[few]


PAIR = ("id long, text_hash long, line int, y_id long, y_hash long, y_line int, copy boolean, "
        "more boolean")


def candidates(found: DataFrame, threshold: float, kept: int) -> DataFrame:
    """Pairs that pass the filters, from blocks of postings.

    Lines with equal sets share all their prefix words, so only the first word
    reports them, and only the earliest of them meets other lines. Equal sets
    are told by size, parities and signature together.
    """
    def scan(f: pd.DataFrame) -> pd.DataFrame:
        columns = np.concatenate([unblocked(b) for b in f["postings"]], axis=1)
        word, mark, ids, place = columns[:4]
        columns = columns[:, np.lexsort((place, ids, mark >> 1, word))]
        word, mark, ids, place, shape = columns[:5]
        parity = np.ascontiguousarray(columns[5:].T).view(np.uint64)
        size, pos, sign = unpacked(shape)
        cell, missing, probe = mark >> 2, (mark & 2) > 0, (mark & 1) > 0
        new = (word[1:] != word[:-1]) | (cell[1:] != cell[:-1])
        group = np.cumsum(np.r_[True, new])
        rank = np.cumsum(np.r_[True, np.any(
            [p[1:] != p[:-1] for p in (missing, ids, place)], axis=0)])
        live = np.flatnonzero(size > 0)
        first, copy = equal_lines(group[live], rank[live], size[live], sign[live], parity[live])
        gone = np.r_[np.flatnonzero(size == 0), live[copy & (pos[live] == 0)]]
        keep = live[first]
        x, y, more = likely_pairs(
            group[keep], rank[keep], probe[keep], size[keep], pos[keep],
            parity[keep], threshold, kept)
        x, y = np.r_[keep[x], gone], np.r_[keep[y], gone]

        def known(at):
            return pd.arrays.IntegerArray(ids[at], missing[at])

        return pd.DataFrame({
            "id": known(x), "text_hash": place[x] & _HALF,
            "line": (place[x] >> 32).astype(np.int32), "y_id": known(y),
            "y_hash": place[y] & _HALF, "y_line": (place[y] >> 32).astype(np.int32),
            "copy": np.arange(len(x)) >= len(x) - len(gone),
            "more": np.r_[more, np.zeros(len(gone), bool)]})

    return found.groupBy("bucket").applyInPandas(scan, PAIR)


#: A filter has 64 bits for each of its rows, and at most 2 ** MOST_BITS (64 MB).
LEAST_BITS, MOST_BITS = 16, 29


def line_marks(text_hash: np.ndarray, line: np.ndarray) -> np.ndarray:
    return _mixed(text_hash.view(np.uint64) + _mixed(line.astype(np.uint64)))


def word_marks(word: np.ndarray) -> np.ndarray:
    return _mixed(word.view(np.uint64))


def _places(marks: np.ndarray, bits: int) -> np.ndarray:
    return (marks >> np.uint64(64 - bits)).astype(np.int64)


def marked(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = _places(marks, len(table).bit_length() + 2)
    return ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def bit_table(df: DataFrame, marks) -> np.ndarray:
    """Packed table of bits, those for the 64-bit ``marks(frame)`` set.

    A few others pass it too, and meet no partner later. Sized by the rows of ``df``;
    beyond some 10^7 of them more and more others pass, which costs their shuffle.
    """
    bits = min(max((64 * df.count()).bit_length(), LEAST_BITS), MOST_BITS)
    slices = 64
    width = (1 << bits) // slices

    def mark(frames):
        for f in frames:
            at = np.unique(_places(marks(f), bits))
            yield pd.DataFrame({"slice": (at // width).astype(np.int32), "at": at % width})

    def union(f: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(width, bool)
        table[f["at"].to_numpy()] = True
        return pd.DataFrame({"slice": f["slice"][:1], "bits": [np.packbits(table).tobytes()]})

    table = np.zeros((slices, width // 8), np.uint8)
    found = df.mapInPandas(mark, "slice int, at long").distinct()
    for r in found.groupBy("slice").applyInPandas(union, "slice int, bits binary").collect():
        table[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return table.reshape(-1)


def sets_of(rows: DataFrame, wanted: DataFrame, rarity) -> DataFrame:
    """Word keys of the lines in ``wanted`` (``id``, ``text_hash``, ``line``), rare
    ones first, and of a few others that the bit table lets through."""
    held = rows.sparkSession.sparkContext.broadcast(bit_table(
        wanted.select("text_hash", "line"),
        lambda f: line_marks(f["text_hash"].to_numpy(), f["line"].to_numpy())))

    def emit(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("id"))
            text_hash = b.column(b.schema.get_field_index("text_hash")).to_numpy(
                zero_copy_only=False)

            def wanted(row, line, text_hash=text_hash):
                return marked(held.value, line_marks(text_hash[row], line))

            for row, line, h in words_of(b, "text", wanted):
                ls = Lines(row, line, h, rarity.value)
                offsets = pa.array(np.r_[ls.first, len(ls.key)].astype(np.int32))
                yield pa.RecordBatch.from_pydict({
                    "id": ids.take(pa.array(ls.row)), "text_hash": pa.array(text_hash[ls.row]),
                    "line": pa.array(ls.line.astype(np.int32)),
                    "words": pa.ListArray.from_arrays(offsets, pa.array(ls.key.view(np.int64)))})

    # by one column, so that both sides of ``verified`` share this shuffle
    return (rows.mapInArrow(emit, "id long, text_hash long, line int, words array<long>")
            .select(_mark("id", "text_hash", "line").alias("mark"), "words")
            .dropDuplicates(["mark"]))


def _mark(*line: str) -> Column:
    """64 bits that stand for a line, told by id, text hash and number."""
    return F.xxhash64(F.col(line[0]).isNull(), *line)


def sets_of_pairs(rows: DataFrame, pairs: DataFrame, rarity) -> DataFrame:
    """Word keys of both lines of all ``pairs``."""
    at = ["id", "text_hash", "line"]
    other = ["y_id", "y_hash", "y_line"]
    wanted = pairs.select(*at).unionByName(pairs.select(
        *[F.col(o).alias(a) for o, a in zip(other, at, strict=True)])).distinct()
    return sets_of(rows, wanted, rarity)


def verified(sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` with ``match``: whether the two full sets are alike enough, and the
    prefix words (``own``) of lines of which more pairs may match."""
    at = ["id", "text_hash", "line"]
    other = ["y_id", "y_hash", "y_line"]

    x, y = (sets.select(F.col("mark").alias(m), F.col("words").alias(w))
            for m, w in (("x_mark", "x_words"), ("y_mark", "y_words")))
    both = (pairs.withColumn("x_mark", _mark(*at)).withColumn("y_mark", _mark(*other))
            .join(x, "x_mark").join(y, "y_mark"))
    common = F.size(F.array_intersect("x_words", "y_words"))
    n = F.size("x_words")
    match = common >= threshold * (n + F.size("y_words") - common) - 1e-9
    own = F.slice("x_words", 1, n - F.ceil(threshold * n - 1e-9).cast("int") + 1)
    return both.select(*at, "more", match.alias("match"),
                       F.when(F.col("more") & ~match, own).alias("own"))


def matching_lines(rows: DataFrame, threshold: float, sketch_bits: int, cell: int,
                   kept: int = KEPT) -> DataFrame:
    """Lines that match an earlier one: ``id``, ``text_hash``, ``line``."""
    sc = rows.sparkSession.sparkContext
    texts = rows.select("text")
    seen = counters(texts, sketch_bits, lambda b: (h for _, _, h in words_of(b, "text")))
    # four classes to a doubling of the count, 255 at most
    rarity = sc.broadcast(np.minimum(4 * np.log2(seen + 1), 255).astype(np.uint8))

    def prefix_words(b):
        for row, line, h in words_of(b, "text"):
            yield Lines(row, line, h, rarity.value).prefix(threshold)[2] << np.uint64(8)

    crowds = sc.broadcast(counters(texts, sketch_bits, prefix_words))
    at = ["id", "text_hash", "line"]
    pairs = materialize(candidates(
        postings(rows, threshold, rarity, crowds, cell), threshold, kept), "line_pairs")
    unsure = materialize(pairs.where("not copy").drop("copy").distinct(), "unsure_pairs")
    judged = materialize(
        verified(sets_of_pairs(rows, unsure, rarity), unsure, threshold), "judged")
    copies = pairs.where("copy").select(*at)
    settled = judged.where("match").select(*at).unionByName(copies)
    open_ = (judged.groupBy(*at).agg(F.max("match").alias("m"), F.max("more").alias("more"),
                                     F.max("own").alias("own"))
             .where("more and not m").select(*at, "own"))
    same = ((F.col("f.text_hash") == F.col("c.text_hash"))
            & (F.col("f.line") == F.col("c.line")) & F.col("f.id").eqNullSafe(F.col("c.id")))
    failed = materialize(open_.alias("f").join(copies.alias("c"), same, "left_anti"), "failed")
    if not failed.isEmpty():
        # these lines meet every line that passes the filters, at their own prefix words
        words = materialize(failed.select(F.explode("own").alias("word")).distinct(),
                            "failed_words")
        only = sc.broadcast(bit_table(words, lambda f: word_marks(f["word"].to_numpy())))
        # a few other lines pass this table; what they match is a match as well
        probes = sc.broadcast(bit_table(failed, lambda f: line_marks(
            f["text_hash"].to_numpy(), f["line"].to_numpy())))
        rest = materialize(candidates(
            postings(rows, threshold, rarity, crowds, cell, only, probes), threshold, 1 << 40),
            "line_pairs")
        unsure = materialize(rest.where("not copy").drop("copy").distinct(), "unsure_pairs")
        settled = settled.unionByName(
            verified(sets_of_pairs(rows, unsure, rarity), unsure, threshold)
            .where("match").select(*at))
    return settled.distinct()


def _text_hash(text: Column) -> Column:
    """32 bits: tells apart rows that share an id."""
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


#: Blocks of 64 bits that tell documents that may lose lines, for the broadcast.
MOST_BLOCKS = 1 << 20


def _joined(docs: DataFrame, lines: DataFrame, on: Column, doc_key: Column, line_key: Column,
            gone: str) -> DataFrame:
    """``docs`` with ``gone`` of ``lines``, without moving texts that lose nothing.

    One bit of a hash of every document in ``lines`` is set in blocks of 64, at most
    ``MOST_BLOCKS`` of them, which are broadcast; a document without its bit is passed
    on where it is. With more documents than a quarter of the bits that would spare
    little, so all are joined.
    """
    n = lines.count()
    if not 0 < n <= 16 * MOST_BLOCKS:
        return docs.join(lines, on, "left")
    blocks = min(1 << (n // 4).bit_length(), MOST_BLOCKS)
    block, bits, bit, hit = free_names(docs.join(lines.limit(0), on, "left"),
                                       "block", "bits", "bit", "hit")

    def at(df: DataFrame, key: Column) -> DataFrame:
        return (df.withColumn(block, F.shiftrightunsigned(key, 6).bitwiseAND(F.lit(blocks - 1)))
                .withColumn(bit, F.call_function("shiftleft", F.lit(1).cast("long"),
                                                 key.bitwiseAND(F.lit(63)).cast("int"))))

    held = at(lines, line_key).groupBy(block).agg(F.bit_or(bit).alias(bits))
    seen = at(docs, doc_key).join(F.broadcast(held), block, "left").withColumn(
        hit, F.coalesce(col(bits).bitwiseAND(col(bit)) != 0, F.lit(False)))
    moved = seen.where(col(hit)).select(*[col(c) for c in docs.columns]).join(lines, on, "left")
    return moved.select(*[col(c) for c in docs.columns], col(gone)).unionByName(
        seen.where(~col(hit)).select(*[col(c) for c in docs.columns], F.lit(None).cast(
            "array<int>").alias(gone)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.8, sketch_bits: int = 18, cell: int = 100_000) -> DataFrame:
    """``docs`` with matching later lines removed from the text.

    Adds ``n_lines`` (lines of the input text) and ``n_removed``; all columns
    pass through, an input column with one of these names is replaced. The id
    must be integral. ``sketch_bits`` and ``cell`` change the work, never the
    result: at 100 TB take 22 bits (32 MB) and a cell of some million.

    Defined cases: a null text stays null with no lines; an empty or blank
    text stays as it is; a text all of whose lines go becomes empty; rows equal
    in id and text are one document and get equal results; null ids order last;
    an empty table gives an empty result. A very long text is read in pieces of whole
    rows, so a task holds its largest text and the word hashes of it; a line may have up
    to 2**24 words.
    """
    text_hash, gone, key, parts = free_names(docs, "text_hash", "gone", "gone_key", "parts")
    rows = docs.select(col(id_col).cast("long").alias("id"),
                       _text_hash(col(text_col)).alias("text_hash"),
                       col(text_col).alias("text"))
    lines = materialize(
        matching_lines(rows, threshold, sketch_bits, cell)
        .groupBy("id", "text_hash").agg(F.collect_set("line").alias("gone")), "gone")
    lines = lines.select(F.col("id").alias(key), F.col("text_hash").alias(key + "_hash"),
                         F.col("gone").alias(gone))
    joined = _joined(
        docs.withColumn(text_hash, _text_hash(col(text_col))), lines,
        (col(text_hash) == col(key + "_hash")) & col(id_col).cast("long").eqNullSafe(col(key)),
        F.xxhash64(col(id_col).cast("long"), col(text_hash)),
        F.xxhash64(col(key), col(key + "_hash")), gone)
    # a column of its own, or a text would be split again for each of its lines
    joined = joined.withColumn(parts, F.split(col(text_col), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), col(gone))
    cleaned = F.when(col(gone).isNull(), col(text_col)).otherwise(F.array_join(
        F.transform(stay, lambda i: F.get(col(parts), i)), "\n"))
    added = ("n_lines", "n_removed")
    return joined.select(
        *[cleaned.alias(c) if c == text_col else col(c) for c in docs.columns
          if c.lower() not in added],
        F.when(col(text_col).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"))
