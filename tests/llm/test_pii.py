"""Personal data against Python's regular expressions and plain checksums."""

import hashlib
import random
import re
import time

from tidewater.llm import pii

from .frames import SCHEMA, documents, rows

TEXTS = [
    "a@b.c_x@d.e.f, ünï 1.2.3.4.5 256.1.1.1 001.2.3.255 0000000000000255.1.1.1",
    "+1 (555) 123-4567 +49 30 12 x +12 +1234567890123456 +44.20.7946.0958",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004 1234567890123456789012",
    "é" * 50 + " bob@mail.com tel (555) 123-4567 \U0001f600 c@d.ef",
    "iban DE89 3704 0044 0532 0130 00 and DE89 3704 0044 0532 0130 01 GB82WEST12345698765432",
    "my ssn 123-45-6789" + " and" * 15 + " version 123-45-6788, 000-12-3456", "x@y", "@", "+", "...", "1.2.3",
    "call 555-123-4567 now", "4111 1111 1111 1111", "a@b.c" * 200,
    "\n\n12.34.56.78\r\n+15551234567\n",
]


def plain(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_match_python(spark):
    data = rows() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    texts = {r[0]: r[1] for r in data if r[0] is not None}
    got = pii.pii_summary(documents(spark, data, extra=True)).collect()
    assert len(got) == len(data)
    for r in got:
        if r["doc_id"] is None:
            continue
        want = plain(texts[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["spans"] == text or r["spans"].startswith(text + "," if text else "")
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want)


def test_added_kinds_need_checksum_or_context(spark):
    data = [(i, t, None, None, 1) for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r["pii"] for r in pii.find_pii(documents(spark, data)).collect()}

    def added(i):
        return [(s["kind"], TEXTS[i][s["start"]:s["end"]]) for s in got[i]
                if s["kind"] in ("iban", "ssn", "localphone")]

    assert added(4) == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert added(5) == [("ssn", "123-45-6789")]
    assert added(3) == [("localphone", "(555) 123-4567")]
    assert added(11) == [("localphone", "555-123-4567")]
    assert all(0 <= s["score"] <= 1 for spans in got.values() for s in spans)


def test_columns_pass_and_empty_table(spark):
    docs = documents(spark, extra=True)
    assert pii.find_pii(docs).columns == [c for c in docs.columns if c != "pii"] + ["pii"]
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_random_texts(spark):
    r = random.Random(5)
    data = [(i, "".join(r.choice("a1.@+- 2_b") for _ in range(r.randrange(120))), None, None, 1)
            for i in range(1500)]
    texts = {d[0]: d[1] for d in data}
    for row in pii.pii_summary(documents(spark, data)).collect():
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(texts[row["doc_id"]]))
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_runs_neither_crash_nor_stall(spark):
    texts = ["7" * 10**6, "a" * 10**6 + "@", "x@a" + ".b" * 10**5, "1." * 120_000 + "x",
             "a@b.cd " * 10_000, "4 " * 10**5, "0" * 10**6 + ".1.1.1"]
    data = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    start = time.monotonic()
    got = {r["doc_id"]: r for r in pii.pii_summary(documents(spark, data)).collect()}
    assert time.monotonic() - start < 60
    assert [(got[i]["n_email"], got[i]["n_ip"], got[i]["n_card"]) for i in range(7)] == [
        (0, 0, 0), (0, 0, 0), (1, 0, 0), (0, 30_000, 0), (10_000, 0, 0), (0, 0, 0), (0, 1, 0)]
    assert got[2]["spans"] == f"email:0:{3 + 2 * 10**5}"
    assert got[4]["spans"].endswith("email:69993:69999")
