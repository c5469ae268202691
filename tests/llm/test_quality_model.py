"""Quality classifier: traversal against node by node, held-out quality, edge cases."""

import numpy as np

from tidewater.llm import quality_model as Q

from .frames import SCHEMA, documents, rows

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_flat_trees_equal_a_walk_by_hand():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, len(Q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = Q.fit(x, y, trees=30, depth=3)

    def by_hand(row):
        total = m.start
        for f, t, leaf in zip(m.feature, m.threshold, m.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(m.scores(x), [by_hand(r) for r in x])
    assert ((m.scores(x) > 0.5) == y).mean() > 0.95
    assert m.scores(np.zeros((0, len(Q.FEATURES)))).shape == (0,)


def test_first_split_is_the_best_one():
    x = np.zeros((200, len(Q.FEATURES)))
    x[:, 4] = np.arange(200)
    y = (x[:, 4] >= 60).astype(float)
    m = Q.fit(x, y, trees=1, depth=1)
    assert m.feature[0, 0] == 4 and 56 <= m.threshold[0, 0] < 64


def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in Q.score_quality(docs, labels).collect()}
    out = [r for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in out]
    assert len(out) > 50 and np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
               for r in got.values())


def test_awkward_rows_and_labels(spark):
    marks = [(i, i % 2, 0) for i in range(24)] + [(None, 1, 0), (3, None, 0), (4, 1, 1), (4, 1, 1)]
    got = Q.score_quality(documents(spark, extra=True), spark.createDataFrame(marks, LABELS)).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], LABELS)
    got = Q.score_quality(documents(spark), none).collect()
    assert {r["score"] for r in got} == {0.5}
    assert Q.score_quality(spark.createDataFrame([], SCHEMA), none).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert all(r["score"] > 0.9 for r in Q.score_quality(documents(spark), one).collect())
