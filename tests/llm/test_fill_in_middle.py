"""Fill-in-middle against a regular expression over whole texts."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import fill_in_middle as fim

from .frames import SCHEMA, documents, rows

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def data():
    r = random.Random(3)
    out = rows() + [(200 + i, "".join(r.choice(" \n\tab<P>é漢\U0001f600 \x85")
                                      for _ in range(r.randrange(60))), "en", "s", 1)
                    for i in range(400)]
    return out + [(700, "a <P> b", None, None, 1), (701, "  ", None, None, 1),
                  (702, "x<P", None, None, 1), (703, "S> <", None, None, 1)]


def test_query_matches_plain_version(spark):
    got = fim.fill_in_middle_summary(documents(spark, data(), extra=True)).collect()
    want = [(d[0], *plain(d[0], d[1])[:4], hashlib.sha256(plain(d[0], d[1])[4].encode()).hexdigest(),
             hashlib.sha256((d[1] or "").encode()).hexdigest()) for d in data()]

    def key(r):
        return str(tuple(r))

    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_outputs_and_columns(spark):
    docs = documents(spark, data()[:60], extra=True)
    out = fim.fill_in_middle(docs)
    assert out.columns[:len(docs.columns)] == docs.columns
    for r in out.collect():
        assert r["fim_text"] == plain(r["doc_id"], r["text"])[4]
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    again = fim.fill_in_middle(out)
    assert again.columns == out.columns


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\rabé漢\U0001f600 ", max_size=80),
       st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1), st.integers(1, 9))
def test_cuts(text, h1, h2, block):
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    assert fim.cuts_of(text, h1, h2, block) == (
        len(units), len("".join(units[:a])), len("".join(units[a:b])))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=70))
def test_tree_and_descent(counts):
    points = [7 * c + 1 for c in counts]
    units, chars = fim.fenwick(np.array(counts, int)), fim.fenwick(np.array(points, int))
    for k in range(1, sum(counts) + 1):
        at, before, passed = fim.descend(units, chars, k)
        assert sum(counts[:at]) == before < k <= before + counts[at]
        assert passed == sum(points[:at])


def test_very_long_text():
    text = "wörd " * 400_000 + "\n"
    n, p, m = fim.cuts_of(text, 123_456, 399_999)
    assert (n, p, m) == (400_001, 123_456 * 5 - 1, (399_999 - 123_456) * 5)
