"""Language ID: filter answers, held-out accuracy on the given tables, edge cases."""

import zlib

import numpy as np

from tidewater.llm import language_id as L

from .frames import SCHEMA, documents, rows

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in L.identify_languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    out = [k for k, r in got.items() if r["held_out"]]
    assert out == [k for k in got if zlib.crc32(str(k).encode()) % 4 == 2] and len(out) > 20
    assert np.mean([got[k]["lang_pred"] == truth[k] for k in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_awkward_rows(spark):
    got = L.identify_languages(documents(spark, extra=True)).collect()
    assert len(got) == len(rows())
    texts = {r[0]: r[1] for r in rows()}
    for r in got:
        if r["doc_id"] is None:
            assert not r["held_out"]
        else:
            assert (r["lang_pred"] == "und") == (not L.has_letter(texts[r["doc_id"]]))
        assert r["lang_pred"] in ("en", "de", "und")
    assert L.identify_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    unlabelled = documents(spark, [(i, "some text", None, None, 1) for i in range(5)])
    assert {r["lang_pred"] for r in L.identify_languages(unlabelled).collect()} == {"und"}


def test_filter_has_every_language_of_an_ngram_and_corrects_false_hits(spark):
    texts = {f"l{i}": "".join(chr(97 + (i * 7 + k * k) % 26) for k in range(60)) for i in range(70)}
    docs = documents(spark, [(i, t, lang, None, 1) for i, (lang, t) in enumerate(texts.items())])
    f = L.learn(docs, ratio=0.0)
    assert f.langs == sorted(texts) and f.table.shape[1] == 2  # more than one word of bits
    for lang, t in list(texts.items())[::9]:
        g = L.grams(t)
        share = f.shares(g, np.array([0]))[0]
        assert share[f.langs.index(lang)] > 0.999
        sets = {k: set(L.grams(v).tolist()) for k, v in texts.items()}
        true = np.array([np.mean([x in sets[k] for x in g.tolist()]) for k in f.langs])
        assert np.abs(share - true).max() < 0.06


def test_counts_are_exact(spark):
    from collections import Counter
    data = [(i, r[1], r[2], None, 1) for i, r in enumerate(rows()) if r[2]]
    got = {(r["lang"], r["gram"]): r["n"]
           for r in L.gram_counts(documents(spark, data)).collect()}
    want = Counter((r[2], int(g)) for r in data if L.has_letter(r[1]) for g in L.grams(r[1]))
    assert got == dict(want)


def test_numerals_are_no_letters(spark):
    from tidewater.llm import language_id as L
    assert not any(map(L.has_letter, ("½ ²", "①", "12 _", "", None))) and L.has_letter("1 ß")
