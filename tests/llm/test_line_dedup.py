"""Line de-duplication against all pairs of lines."""

import pytest

from tidewater.llm import line_dedup

from .frames import SCHEMA, documents, prose, rows


def plain(data, threshold=0.8):
    """Cleaned texts by document (id and text), comparing every pair of lines."""
    docs = {(r[0], r[1]) for r in data}
    lines = sorted(((d, n, frozenset(x.encode().lower().split())) for d in docs
                    for n, x in enumerate((d[1] or "").split("\n"))),
                   key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1]))
    lines = [x for x in lines if x[2]]
    gone = set()
    for i, (d, n, a) in enumerate(lines):
        for _, _, b in lines[:i]:
            o = len(a & b)
            if o >= threshold * (len(a) + len(b) - o) - 1e-9:
                gone.add((d, n))
                break
    return {d: None if d[1] is None else "\n".join(
        x for n, x in enumerate(d[1].split("\n")) if (d, n) not in gone) for d in docs}


def data():
    out = rows()[:-3]  # distinct ids but for the null ones
    out = [r for r in out if r[0] not in (None, 1, 107)] + [out[1], (None, prose(3, 40), None, None, 1)]
    base = prose(50, 240).split("\n")
    for i in range(30):  # near copies: one word changed in every line
        out.append((300 + i, "\n".join(" ".join([*x.split(" ")[:-1], f"new{i}"]) if n % 2 else x
                                       for n, x in enumerate(base)), "en", "s", 1))
    out += [(400, "a b c d\nA b c D\nd c b a x\na b c d x y\n\n \nq", "en", "s", 1)]
    return out


@pytest.mark.parametrize(("cell", "kept"), [(100_000, 3), (4, 1)])
def test_matches_all_pairs(spark, monkeypatch, cell, kept):
    monkeypatch.setattr(line_dedup.matching_lines, "__defaults__", (kept,))
    docs = documents(spark, data(), extra=True)
    got = line_dedup.dedup_lines(docs, cell=cell).collect()
    want = plain(data())
    # same id, several texts: the hash decides which comes first, so compare those apart
    assert len(got) == len(data())
    texts = {r[0]: r[1] for r in data()}
    for r in got:
        assert r["text"] == want[r["doc_id"], texts[r["doc_id"]]]
        assert r["n_lines"] == (0 if texts[r["doc_id"]] is None
                                else len(texts[r["doc_id"]].split("\n")))
    assert sum(r["n_removed"] for r in got) > 100


def test_repeated_rows_are_one_document(spark):
    data_ = [(1, "a b c\nd e f", None, None, 1)] * 3 + [(2, "a b c\nx y z", None, None, 1)]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(
        documents(spark, data_)).collect())
    assert got == [(1, "a b c\nd e f")] * 3 + [(2, "x y z")]


def test_a_line_whose_kept_pairs_all_fail_still_meets_the_rest():
    import numpy as np
    rank = np.arange(5)
    one = np.zeros(5, np.int64)
    x, y, more = line_dedup.likely_pairs(one, rank, np.ones(5, bool), one + 10, one,
                                           np.zeros((5, 2), np.uint64), 0.8, 2)
    # equally likely: the earliest come first
    assert list(zip(x, y, strict=True)) == [(1, 0), (2, 0), (2, 1), (3, 0), (3, 1), (4, 0), (4, 1)]
    assert more.tolist() == [False, False, False, True, True, True, True]
    big = np.zeros(3000, np.int64)
    x, y, more = line_dedup.likely_pairs(big, np.arange(3000), np.ones(3000, bool), big + 10, big,
                                           np.zeros((3000, 2), np.uint64), 0.8, 2)
    assert len(x) == 1 + 2 * 2998 and set(y.tolist()) == {0, 1} and more.sum() == 2 * 2997


def test_words_are_cut_as_specified(spark):
    import pyarrow as pa
    texts = ["a b\tc\x0bd\n\ne", None, "", "é f g", "A a"]
    b = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    got = [(r, n) for rs, ns, _ in line_dedup.words_of(b, "text") for r, n in zip(rs, ns, strict=True)]
    assert got == [(0, 0)] * 4 + [(0, 2)] + [(3, 0)] * 2 + [(4, 0)] * 2
    hashes = [h for _, _, hs in line_dedup.words_of(b, "text") for h in hs]
    assert hashes[-1] == hashes[-2] == hashes[0] and len(set(hashes)) == 7


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shapes_survive_packing():
    import numpy as np
    size = np.array([1, 2, 255, 256, 5000, (1 << 24) - 1])
    pos = np.array([0, 1, 51, 52, 1000, 1 << 20])
    sign = np.array([0, 1 << 63, (1 << 64) - 1, 5 << 60, 1, (1 << 64) - 1], np.uint64)
    shape = line_dedup.packed(size, pos, sign)
    assert (shape != 0).all()
    got = line_dedup.unpacked(shape)
    assert got[0].tolist() == size.tolist()
    assert got[1].tolist() == [0, 1, 51, 52, 1000, 65535]
    assert got[2].tolist() == [0, 1 << 48, (1 << 49) - 1, 5 << 19, 0, (1 << 23) - 1]


def test_unlike_lines_that_agree_in_parities_and_24_bits_are_not_equal():
    import numpy as np
    one, rank = np.zeros(3, np.int64), np.arange(3)
    sign = np.array([7 << 40, 7 << 40 | 1 << 20, 7 << 40], np.uint64)
    shape = line_dedup.packed(one + 2, one, sign)
    size, _, told = line_dedup.unpacked(shape)
    first, copy = line_dedup.equal_lines(one, rank, size, told, np.zeros((3, 2), np.uint64))
    assert first.tolist() == [True, True, False] and copy.tolist() == [False, False, True]


def test_parities_never_outnumber_differing_words():
    import numpy as np
    rng = np.random.default_rng(3)
    rarity = np.zeros(1 << 4, np.uint64)
    sizes = [5, 31, 32, 33, 200]
    sets, row = [], []
    base = rng.integers(1, 1 << 63, 300).astype(np.uint64)
    for i, n in enumerate([*sizes, *sizes]):
        words = base[:n].copy()
        words[:1 + i % 3] = rng.integers(1, 1 << 63, 1 + i % 3).astype(np.uint64)
        sets.append(words)
        row += [i] * n
    ls = line_dedup.Lines(np.array(row), np.zeros(len(row), np.int64), np.concatenate(sets), rarity)
    parity, n = ls.parity(), len(sets)
    x, y = (v.ravel() for v in np.meshgrid(range(n), range(n)))
    real = [len(set((sets[a] >> np.uint64(8)).tolist()) ^ set((sets[b] >> np.uint64(8)).tolist()))
            for a, b in zip(x, y, strict=True)]
    assert (line_dedup.differing(ls.size, parity, x, y) <= real).all()


def test_only_texts_that_may_lose_lines_are_moved(spark):
    from pyspark.sql import functions as F
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    lines = spark.range(0, 3000, 100).select(
        F.col("id").alias("k"), F.xxhash64("id").alias("k_h"),
        F.array(F.lit(0), F.lit(2)).alias("gone"))
    on = (F.col("doc_id") == F.col("k")) & (F.col("h") == F.col("k_h"))
    got = line_dedup._joined(docs, lines, on, F.xxhash64("doc_id", "h"), F.xxhash64("k", "k_h"),
                             "gone").collect()
    assert len(got) == 3000 and {r["doc_id"] for r in got} == set(range(3000))
    assert {r["doc_id"] for r in got if r["gone"] == [0, 2]} == set(range(0, 3000, 100))
    assert sum(r["gone"] is None for r in got) == 2970


def test_blocks_keep_postings_and_their_groups():
    import numpy as np
    some = np.random.default_rng(1)
    columns = some.integers(-1 << 62, 1 << 62, (len(line_dedup.POSTING), 3000))
    columns[0], columns[1] = columns[0] % 90 - 45, columns[1] % 8
    batch = line_dedup.blocks(columns, 7)
    parts = [line_dedup.unblocked(b.as_py()) for b in batch.column(1)]
    assert len(parts) == len(set(batch.column(0).to_pylist())) == 7
    key = sorted(map(tuple, columns.T.tolist()))
    assert sorted(tuple(x) for p in parts for x in p.T.tolist()) == key
    groups = [{(w, m >> 2) for w, m in p[:2].T.tolist()} for p in parts]
    assert sum(map(len, groups)) == len(set().union(*groups))


def test_a_text_is_split_once(spark, capsys):
    # within array_join it would be split again for each line that stays
    line_dedup.dedup_lines(documents(spark, data())).explain()
    joins = [x for x in capsys.readouterr().out.splitlines() if "array_join" in x]
    assert joins and not any("split(" in x for x in joins)


def test_only_lines_of_like_size_are_compared(monkeypatch):
    import numpy as np
    some = np.random.default_rng(5)
    n = 1200
    size = some.integers(5, 200, n)
    pos = some.integers(0, 1 + size // 5)
    group, rank, probe = np.repeat([0, 1, 2], [30, 170, n - 200]), np.arange(n), some.random(n) < 0.9
    parity = np.zeros((n, 2), np.uint64)
    x, y = np.tril_indices(n, -1)
    keep = (group[x] == group[y]) & probe[x]
    x, y = x[keep], y[keep]
    all_pairs = len(x)
    real = line_dedup.passing
    ok = real(size, pos, parity, x, y, 0.8)
    want = set(zip(x[ok].tolist(), y[ok].tolist(), strict=True))
    compared = []

    def counted(size, pos, parity, x, y, threshold):
        compared.append(len(x))
        return real(size, pos, parity, x, y, threshold)

    monkeypatch.setattr(line_dedup, "passing", counted)
    for large in (1 << 17, 10):  # all at once, and block by block
        monkeypatch.setattr(line_dedup, "LARGE", large, raising=False)
        compared.clear()
        x, y, more = line_dedup.likely_pairs(group, rank, probe, size, pos, parity, 0.8, 1 << 40)
        assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(x) == len(want)
        assert not more.any()
        if large > 10:
            assert sum(compared) < all_pairs / 2


def test_only_wanted_lines_are_cut_into_words():
    import pyarrow as pa
    texts = ["a b\nc d\n\ne", None, "", "f\ng averylongwordindeed", "\n\nh"]
    b = pa.RecordBatch.from_pydict({"text": pa.array(texts)})

    def words(*more):
        return [w for p in line_dedup.words_of(b, "text", *more)
                for w in zip(*(v.tolist() for v in p), strict=True)]

    got = words(lambda row, line: (row + line) % 2 == 0)
    assert got == [w for w in words() if (w[0] + w[1]) % 2 == 0]
    assert [w[:2] for w in got] == [(0, 0), (0, 0), (3, 1), (3, 1), (4, 2)]


def test_sets_are_shuffled_once_for_both_lines_of_a_pair(spark):
    pairs = spark.createDataFrame(
        [(1, 5, 0, 2, 6, 1, True), (None, 7, 0, 1, 5, 0, True)],
        "id long, text_hash long, line int, y_id long, y_hash long, y_line int, more boolean")
    texts = spark.createDataFrame(
        [(1, 5, "a b c d e"), (2, 6, "x\na b c d"), (None, 7, "a b")],
        "id long, text_hash long, text string")
    rarity = spark.sparkContext.broadcast(line_dedup.np.zeros(1 << 16, line_dedup.np.uint8))
    judged = line_dedup.verified(line_dedup.sets_of_pairs(texts, pairs, rarity), pairs, 0.8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = judged.collect()
        plan = judged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r["id"], r["match"], r["own"] and len(r["own"])) for r in got} == {
        (1, True, None), (None, False, 1)}
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_few_other_lines_pass_a_filter(spark):
    import numpy as np
    lines = spark.range(2000).selectExpr("id * 7919 as text_hash", "cast(id % 9 as int) as line")

    def marks(f):
        return line_dedup.line_marks(f["text_hash"].to_numpy(), f["line"].to_numpy())

    table = line_dedup.bit_table(lines, marks)
    assert line_dedup.marked(table, marks(lines.toPandas())).all()
    others = line_dedup.line_marks(np.arange(1 << 40, (1 << 40) + 100_000), np.zeros(100_000, int))
    assert line_dedup.marked(table, others).mean() < 0.02
