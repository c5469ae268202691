"""SimHash near-dedup against all pairs of fingerprints."""

import numpy as np
import pytest
import xxhash

from tidewater.llm import simhash
from tidewater.llm.common import connected_components

from .frames import SCHEMA, documents, prose, rows


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=3):
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    best = {}
    for i in range(n):
        if ids[i] is not None:
            best[find(i)] = min(best.get(find(i), ids[i]), ids[i])
    return [best.get(find(i)) for i in range(n)]


def near_rows():
    base = rows()
    for i in range(40):  # one word in many changed: fingerprints a few bits apart
        words = prose(5, 400).split(" ")
        words[i * 7] = "changed"
        base.append((200 + i, " ".join(words), "en", "s0", 1))
    return base


@pytest.mark.parametrize("limit", [simhash.NODE_LIMIT, 4])
def test_matches_all_pairs(spark, limit):
    data = near_rows()
    got = simhash.simhash_near_dedup(documents(spark, data, extra=True), node_limit=limit).collect()
    fps = [plain_fingerprint(r[1]) for r in data]
    want = plain_components([r[0] for r in data], fps)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(
        [(r[0], f"{f:016x}", c) for r, f, c in zip(data, fps, want, strict=True)], key=key)
    assert len({c for c in want}) < len({r[0] for r in data})


def test_one_row_of_each_group_stays(spark):
    data = near_rows()
    got = simhash.keep_one_per_group(documents(spark, data, extra=True))
    assert got.columns == documents(spark, data, extra=True).columns
    comps = plain_components(list(range(len(data))), [plain_fingerprint(r[1]) for r in data])
    assert got.count() == len(set(comps))
    kept = {r["doc_id"] for r in got.collect()}
    want = plain_components([r[0] for r in data], [plain_fingerprint(r[1]) for r in data])
    assert {c for c in want if c is not None} <= kept


def test_walk_finds_all_near_codes_in_dense_and_sparse_tries():
    rng = np.random.default_rng(1)
    dense = np.uint64(0xABCD) << np.uint64(48) | rng.integers(0, 1 << 9, 300).astype(np.uint64)
    sparse = rng.integers(0, 1 << 63, 700).astype(np.uint64)
    code = np.unique(np.concatenate([dense, sparse]))
    top = code >> np.uint64(48)
    start = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    end = np.r_[start[1:], len(code)]
    u, v = simhash.walk(code, start, end, end, np.zeros(len(start), bool),
                        np.full(len(start), 16), 3)
    from tidewater.llm.common import local_components
    i, j = np.nonzero(np.triu((np.bitwise_count(code[:, None] ^ code) <= 3)
                              & (top[:, None] == top), 1))
    assert (local_components(len(code), u, v) == local_components(len(code), i, j)).all()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_near_dedup(empty).count() == 0
    assert simhash.keep_one_per_group(empty).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1200)]
    edges += [(None, 3), (5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(1000, 1200)}, 7: 7}
