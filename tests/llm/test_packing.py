"""Packing: exact token round trip, gapless sequences, honest bounds."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewater.llm import packing

from .frames import SCHEMA, documents, prose, rows

TRICKY = ["a  b", " lead", "trail ", "\n\n x \t y", "it's we'll 'd", "a b c", "<|endoftext|>",
          "x\n y", "12 3.4, !! ?", "é ǘ 漢 字", "\x1c \x85 end", " ", "  "]


@pytest.fixture(scope="module")
def reference_ids():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_reference_tokenizer(reference_ids):
    tokens = packing.tokens_of(packing.default_ranks())
    for text in [*TRICKY, *(r[1] or "" for r in rows())]:
        got = np.frombuffer(tokens(text) + b"\0\0\0\0", "<u4").tolist()
        assert got == reference_ids(text)


@pytest.mark.parametrize(("capacity", "per_partition"), [(64, 5), (2048, 20_000)])
def test_pieces_round_trip_and_fill_sequences(spark, reference_ids, capacity, per_partition):
    data = rows() + [(400 + i, prose(i, 5 + i), "en", "s", 1) for i in range(60)]
    got = packing.pack_documents(documents(spark, data, extra=True), capacity=capacity,
                                 with_ids=True, per_partition=per_partition).collect()
    want = sorted(tuple(reference_ids(r[1])) for r in data)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        if r["piece"]:
            assert r["length"] == capacity
    assert sum(r["length"] for r in got) == sum(map(len, want))
    single = [k for k in by_doc if k is not None and sum(d[0] == k for d in data) == 1]
    texts = {d[0]: d[1] for d in data}
    for k in single:
        pieces = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [p["start"] for p in pieces] == [0, *itertools.accumulate(
            p["length"] for p in pieces)][:-1]
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in pieces), "<u4").tolist()
        assert ids == reference_ids(texts[k])
        assert len(pieces) == -(-len(ids) // capacity)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) >= -(-sum(map(len, want)) // capacity)


def test_sequences_hold_all_ids(spark, reference_ids):
    data = [(i, prose(i, 30), "en", "s", 1) for i in range(30)]
    got = packing.packed_sequences(documents(spark, data), capacity=128).collect()
    assert sum(len(r["ids"]) for r in got) == 4 * sum(len(reference_ids(r[1])) for r in data)
    assert sum(len(r["documents"]) for r in got) >= 30


def plain_best(sizes, capacity):
    """Fewest bins, by trying everything."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += sizes[i]
                place(i + 1, bins)
                bins[k] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_bound_never_exceeds_the_optimum_and_packing_is_valid():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = rng.integers(1, 20, rng.integers(1, 9))
        bins, offsets, free = packing.best_fit_decreasing(sizes, 20)
        best = plain_best(sorted(sizes.tolist(), reverse=True), 20)
        assert packing.lower_bound(sizes, 20) <= best <= len(free)
        for b in range(len(free)):
            own = sorted(zip(offsets[bins == b], sizes[bins == b], strict=True))
            assert sum(s for _, s in own) == 20 - free[b]
            assert [o for o, _ in own] == [0, *np.cumsum([s for _, s in own])][:-1]
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_added_tokens_have_their_ids_as_loaded(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [*TRICKY, f"a {end} b", f"{end}{end} x", f"x  y{end}\n z", f"<|endoftext{end}|>", end[:-1]]
    got = packing.pack_documents(documents(spark, [(i, x, "en", "s", 1)
                                                   for i, x in enumerate(texts)]), with_ids=True)
    ids = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in got.collect()}
    assert ids == {i: [*t.encode(x, add_special_tokens=False).ids, 0]
                   for i, x in enumerate(texts)}
    assert ids[len(TRICKY)] == [64, 220, 50256, 275, 0]


def test_numbers_stay_apart_in_any_number_of_rounds(spark):
    import numpy as np

    from tidewater.llm.packing import pack_sizes
    rng = np.random.default_rng(4)
    items = [(i, int(s), int(w)) for i, (s, w) in enumerate(
        zip(rng.integers(0, 60, 400), rng.integers(0, 3, 400), strict=True))]
    df = spark.createDataFrame(items, "uid long, size long, whole long")
    placed = {r["uid"]: r for r in pack_sizes(df, 100, 25, 6).collect()}
    taken, used = {}, set()
    for uid, size, whole in items:
        r = placed[uid]
        if size:
            taken.setdefault(r["sequence"], []).append((r["offset"], size))
        numbers = set(range(r["first_whole"], r["first_whole"] + whole))
        assert not numbers & used
        used |= numbers
    assert not used & set(taken)
    for parts in taken.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= 100
