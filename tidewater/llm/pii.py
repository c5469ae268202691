"""Personal data: patterns propose spans, checksums confirm, context scores.

Built-in functions only. The spans of a pattern come from two readings of the
text, the matches and the pieces between them; their lengths, added up in turn
over runs of bounded size, are the positions. A text without a kind's tell-tale character skips that kind.

Base kinds (email, ip, card, phone) are kept whenever their check holds. The
added kinds are kept if they also reach a score: a start value for the kind,
plus a bonus if a word that speaks for it stands nearby, less a malus if one
that speaks against it does. An added span that overlaps a base span or an
earlier kind's is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, free_names


@dataclass(frozen=True)
class Kind:
    """``tell``: a pattern every text with a match contains, cheap to search."""

    name: str
    pattern: str
    tell: str
    start: float
    speaks_for: str
    speaks_against: str = "version|isbn|issn|build|chapter|page"


# The base patterns, in a form that takes time in proportion to the
# text. Repeats are possessive (what follows them cannot start inside them), and a
# match starts where a run starts or the last match ended: inside a run that has
# failed, every later start fails too.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "e-?mail|mail|contact|write|correo|courriel"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"\.[0-9]+\.[0-9]", 0.6,
         "ip|address|server|host|login|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){12}[0-9]", 0.8,
         "card|visa|mastercard|credit|debit|payment|tarjeta|carte|karte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7,
         "tel|phone|call|fax|mobile|telefon|telefono|telephone"),
)
ADDED = (
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
         r"[A-Z]{2}[0-9]{2}", 0.7, "iban|account|bank|konto|compte|cuenta|bic"),
    Kind("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
         r"[0-9]-[0-9]{2}-[0-9]", 0.4, "ssn|social security|tax id"),
    Kind("localphone", r"(?:\([0-9]{3}\)\x20?|\b[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}\b",
         r"[0-9][\x20.-][0-9]{4}", 0.4,
         "tel|phone|call|fax|mobile|telefon|telefono|telephone"),
)
#: Characters on either side that count as nearby, and the score to reach.
NEAR, BONUS, MALUS, REACH = 40, 0.3, 0.4, 0.6
#: Matches whose positions are added up in one go.
RUN = 256


def matches(text: Column, kind: Kind) -> Column:
    """Matches of a pattern with the gap before each, ``array<struct<s, gap>>``."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)
    none = F.array().cast("array<struct<s:string,gap:string>>")
    return F.when(text.rlike(kind.tell), F.arrays_zip(
        found.alias("s"), F.slice(between, 1, F.size(found)).alias("gap"))).otherwise(none)


def runs_of(pairs: Column) -> Column:
    """An array of matches in runs of ``RUN``."""
    none = F.array().cast("array<array<struct<s:string,gap:string>>>")
    return F.when(F.size(pairs) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / RUN)),
        lambda i: F.slice(pairs, (i * RUN + 1).cast("int"), F.lit(RUN)))).otherwise(none)


def placed(text: Column, runs: Column, starts: Column) -> Column:
    """Each run with its place and the text that its spans and their contexts lie in.

    Positions and contexts are then found inside a run's own text, so that the
    time does not grow with the square of the number of matches.
    """
    def cut(run: Column, i: Column) -> Column:
        first = F.greatest(starts[i] - NEAR, F.lit(0))
        return F.struct(run.alias("run"), starts[i].alias("at"), first.alias("first"),
                        F.substr(text, first + 1, starts[i + 1] + NEAR - first).alias("part"))
    return F.transform(runs, cut)


def run_starts(runs: Column) -> Column:
    """Where each run of matches starts (the gap before it included), and the end."""
    def width(run: Column) -> Column:
        return F.aggregate(run, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["s"]))
    return F.aggregate(runs, F.array(F.lit(0)), lambda at, run: F.concat(
        at, F.array(F.element_at(at, -1) + width(run))))


def spans_of(run: Column, at: Column) -> Column:
    """The spans of one run as ``array<struct<s, start, end>>`` (code points)."""
    none = F.array().cast("array<struct<s:string,start:int,end:int>>")
    return F.aggregate(
        run, F.struct(at.alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["s"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                x["s"].alias("s"), (acc["at"] + F.length(x["gap"])).alias("start"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["s"])).alias("end")))).alias("out")),
        lambda acc: acc["out"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + weighed(i)) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an account number without spaces leaves 1 modulo 97."""
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))

    def step(a: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 65, (a * 10 + code - 48) % 97).otherwise((a * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, s: Column) -> Column:
    """The check of a kind on a proposed match."""
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    digits = _digits(s)
    checks = {
        "ip": s.rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False),
        "phone": F.length(digits).between(9, 15),
        "iban": F.when(F.length(F.replace(s, F.lit(" "), F.lit(""))).between(15, 34),
                       mod97(F.replace(s, F.lit(" "), F.lit("")))).otherwise(False),
        "ssn": ~s.rlike("^(?:000|666|9)|-00-|0000$"),
    }
    return checks.get(kind, F.lit(True))


def _has_word(text: Column, words: str) -> Column:
    return text.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")


def score(part: Column, first: Column, kind: Kind, x: Column) -> Column:
    """Start value, raised or lowered by words around the span; ``part`` is the
    text from position ``first`` on."""
    left = F.greatest(x["start"] - NEAR, F.lit(0))
    around = F.lower(F.concat(
        F.substr(part, left - first + 1, x["start"] - left), F.lit(" "),
        F.substr(part, x["end"] - first + 1, F.lit(NEAR))))
    s = (F.lit(kind.start) + F.when(_has_word(around, kind.speaks_for), BONUS).otherwise(0.0)
         - F.when(_has_word(around, kind.speaks_against), MALUS).otherwise(0.0))
    return F.round(F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0)), 2)


def _scored(kind: Kind, runs: Column) -> Column:
    """The confirmed ones of the proposed spans, with kind and score."""
    return F.flatten(F.transform(runs, lambda r: F.transform(
        F.filter(spans_of(r["run"], r["at"]), lambda x: confirmed(kind.name, x["s"])),
        lambda x: F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"),
                           x["end"].alias("end"),
                           score(r["part"], r["first"], kind, x).alias("score")))))


def _apart(spans: Column, taken: Column) -> Column:
    """The spans that reach the score and overlap none of ``taken``."""
    return F.filter(spans, lambda x: (x["score"] >= REACH) & ~F.exists(
        taken, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))


def _counted(kind: str) -> Column:
    return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii``: an array of ``kind, start, end, score``.

    By kind as listed, then start; positions in code points, end exclusive.

    Defined cases: a null or empty text has no spans; a very long text is searched
    whole, in time that grows with its length; repeated rows get equal results; an empty table gives an empty result; all columns pass through, an
    input column named ``pii`` is replaced.
    """
    kinds = BASE + ADDED
    text, *names = free_names(docs, "whole text", *[f"{k.name} spans" for k in kinds],
                              *[f"{k.name} spans starts" for k in kinds])
    names, starts = names[:len(kinds)], names[len(kinds):]
    df = docs.withColumn(text, F.coalesce(col(text_col), F.lit("")))
    df = df.withColumns({n: matches(col(text), k) for k, n in zip(kinds, names, strict=True)})
    # each step on a column of its own: inside a lambda it would run once per element
    df = df.withColumns({n: runs_of(col(n)) for n in names})
    df = df.withColumns({at: run_starts(col(n)) for at, n in zip(starts, names, strict=True)})
    df = df.withColumns({n: placed(col(text), col(n), col(at))
                         for at, n in zip(starts, names, strict=True)})
    df = df.withColumns({n: _scored(k, col(n)) for k, n in zip(kinds, names, strict=True)})
    whole = F.concat(*[col(n) for n in names[:len(BASE)]])
    for name in names[len(BASE):]:
        df = df.withColumn(names[0], F.concat(whole, _apart(col(name), whole)))
        whole = col(names[0])
    # generated, so that a later filter on the spans is not pushed into the steps above
    return df.select(*[col(c) for c in docs.columns if c.lower() != "pii"],
                     F.explode_outer(F.array(whole)).alias("pii"))


def pii_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of their spans and all spans as text."""
    found = find_pii(docs.select(col(id_col).alias("id"), col(text_col).alias("text")))
    base = F.filter("pii", lambda x: x["kind"].isin(*[k.name for k in BASE]))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select(
        F.col("id").alias(id_col),
        *[_counted(k.name).alias(f"n_{k.name}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",")
        .alias("scores"))
