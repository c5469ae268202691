"""Secrets: fixed patterns, and strings that do not compress where one would stand.

Beside the spans of the fixed patterns, every long run of token characters with
letters and digits in it is a candidate if a sensitive word (key, token,
password, ...) stands close by. Its novelty is the number of compressed bytes
that it adds, per byte of its own: zstandard, primed with the corpus'
identifiers and the text around the string, compresses it. Names, paths and
phrases are found in dictionary or surroundings and add little; random strings
cost what they are long.

The dictionary holds the identifiers that occur most often in all texts, the
most frequent last, where matches are cheapest. Identifiers are letters and
underscores only, so that a secret that was copied a thousand times does not
become one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col

KIND = "array<struct<kind:string,start:int,end:int,novelty:double>>"


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base patterns, and what a match must hold.
_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 24 and more: shorter ones fail, and do not change where later ones start.
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
ADDED = "novel"
#: One of these stands in a text with an ``assign`` match, once lower-cased.
_TELLS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_SENSITIVE = ("key", "secret", "token", "password", "passwd", "pwd", "passphrase", "credential",
              "auth", "authorization", "bearer", "private", "signature", "session", "cookie",
              "login", "salt")
_WORD = "|".join(f"{w}|{w.upper()}" for w in _SENSITIVE)
_INNER = "|".join(w.capitalize() for w in _SENSITIVE)
SENSITIVE = re.compile(rf"(?<![A-Za-z])(?:{_WORD})s?(?![a-z])|(?:{_INNER})s?(?![a-z])")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{16,}={0,2}")
#: Stands alone: a stretch of letters inside a random string is no identifier.
IDENTIFIER = re.compile(rb"(?<![A-Za-z0-9+/=_-])[A-Za-z_]{4,}+(?![A-Za-z0-9+/=_-])")
LONGEST_IDENTIFIER = 32
#: Identifiers that a task counts before it hands on partial sums.
HELD = 1 << 17


def identifier_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word``, ``n`` over all texts; tasks add up before the shuffle."""
    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "word": pa.array([w.decode() for w in counts], pa.string()),
            "n": pa.array(list(counts.values()), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                raw = text.as_buffer() if text.is_valid else None
                if not raw:
                    continue
                counts.update(IDENTIFIER.findall(raw))
                if len(counts) > HELD:
                    yield batch(counts)
                    counts = Counter()
        yield batch(counts)

    return (docs.select(col(text_col).cast("string").alias("text"))
            .mapInArrow(count, "word string, n long")
            .where(F.length("word") <= LONGEST_IDENTIFIER)
            .groupBy("word").agg(F.sum("n").alias("n")))


def dictionary(counts: DataFrame, words: int = 4096) -> list[str]:
    """The most frequent identifiers, ties by name, the most frequent last."""
    top = counts.orderBy(F.col("n").desc(), F.col("word")).limit(words).collect()
    return [r["word"] for r in reversed(top)]


class Novelty:
    """Marginal compressed size of a string, with the identifiers and what surrounds
    the string as zstandard's dictionary.

    The string follows a fixed stretch of bytes that no text holds, whose own cost is
    taken off. These bytes keep zstandard from coding literals by frequency and from
    storing the frame as it is, so a byte that matches nothing costs a byte, however
    short the string.
    """

    STRETCH = bytes(range(128, 256)) * 2

    def __init__(self, words: list[str], level: int = 12, around: int = 256):
        self.known, self.level, self.around = " ".join(words), level, around

    def surroundings(self, text: str, start: int, end: int) -> tuple[str, str]:
        """The text on either side. Other copies of the string are left out, also
        ones that the stretch cuts through: they do not make it known."""
        s, n = text[start:end], end - start
        first, last = max(0, start - self.around - n), end + self.around + n
        before, after = text[first:start].split(s), text[end:last].split(s)
        if first:
            before[0] = before[0][n - 1:]
        if last < len(text):
            after[-1] = after[-1][:max(0, len(after[-1]) - n + 1)]
        return "".join(before)[-self.around:], "".join(after)[:self.around]

    def of(self, text: str, start: int, end: int) -> float:
        s = text[start:end]
        before, after = self.surroundings(text, start, end)
        held = zstandard.ZstdCompressionDict(
            f"{self.known} {after} {before}".encode("utf-8", "surrogatepass").rjust(8),
            dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        z = zstandard.ZstdCompressor(level=self.level, dict_data=held, write_content_size=False,
                                     write_checksum=False, write_dict_id=False)
        return (len(z.compress(self.STRETCH + s.encode())) - len(z.compress(self.STRETCH))) / len(s)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in _TELLS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def candidates(text: str, left: int = 64, right: int = 24) -> Iterator[tuple[int, int]]:
    """Runs of token characters with letters and digits, and a sensitive word nearby."""
    for m in CANDIDATE.finditer(text):
        if "@" in (text[m.start() - 1:m.start()], text[m.end():m.end() + 1]):
            continue  # half of a mail address
        s = m[0].lstrip("./_-")
        start = m.end() - len(s)
        end = start + len(s.rstrip("./_-"))
        s = text[start:end]
        if (len(s) >= 16 and any("0" <= c <= "9" for c in s) and any(c.isalpha() for c in s)
                and (SENSITIVE.search(text[max(0, start - left):start])
                     or SENSITIVE.search(text[end:end + right]))):
            yield start, end


def scan(text: str | None, novelty: Novelty, least: float) -> list[dict]:
    """All spans of a text by start, then kind as listed."""
    found = base_spans(text) if text else []
    taken = sorted((a, b) for _, a, b in found)
    spans = [(a, BASE.index(kind), b, None) for kind, a, b in found]
    i, reached = 0, -1
    for start, end in candidates(text or ""):
        while i < len(taken) and taken[i][0] < end:
            reached = max(reached, taken[i][1])
            i += 1
        if reached > start:
            continue
        score = novelty.of(text, start, end)
        if score >= least:
            spans.append((start, len(BASE), end, round(score, 3)))
    return [{"kind": (*BASE, ADDED)[k], "start": a, "end": b, "novelty": score}
            for a, k, b, score in sorted(spans, key=lambda s: s[:3])]


def find_secrets(docs: DataFrame, text_col: str = "text", words: int = 4096,
                 least: float = 0.92) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``kind, start, end, novelty``.

    By start, then kind (``assign``, ``access``, ``hex``, ``novel``); positions in
    code points, end exclusive; ``novelty`` is null for the fixed patterns. ``novel``
    spans reach ``least`` added bytes a byte and overlap no other span. The
    dictionary has ``words`` identifiers, the only thing the driver receives.

    Defined cases: a null or empty text has no spans; a very long text is
    searched whole, each candidate against a bounded stretch around it; repeated
    rows get equal results; an empty table gives an empty result; all columns pass
    through, an input column named ``secrets`` is replaced.
    """
    known = dictionary(identifier_counts(docs, text_col), words)

    def typed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        novelty = Novelty(known)
        for s in texts:
            yield pd.Series([scan(t, novelty, least) for t in s], dtype=object)

    spans = F.pandas_udf(typed, KIND)(col(text_col).cast("string"))
    return docs.select(*[col(c) for c in docs.columns if c.lower() != "secrets"],
                       spans.alias("secrets"))


def secrets_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the kinds, a digest of the base spans and all spans as text."""
    found = find_secrets(docs.select(col(id_col).alias("id"), col(text_col).alias("text")))

    def counted(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda x: x["kind"] != ADDED)
    return found.select(
        F.col("id").alias(id_col), *[counted(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
        counted(ADDED).alias(f"n_{ADDED}"))
