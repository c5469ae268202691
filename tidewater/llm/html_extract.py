"""Main text of web pages by deducing each host's template.

A page is a sequence of tokens: tags with their place in the page, and words
with the place they stand in. Over all pages of a host, every token has an
occurrence vector, its number of occurrences in each page. Tokens with the same
vector that occur equally often in nearly all pages form an equivalence class,
if there are enough of them. A page meets a class with the tokens that occur
as often as they should and come in the class's order.

The tokens of the classes cut a page into slots, from each to the next. A token
plays another role in every slot: a word of a notice may occur in articles as
well, but in its slot it occurs once. So the tokens are counted again by slot;
classes found this way nest in the slots of the earlier ones, and tokens with
the vector of an earlier class join it. This goes on until no host has new
classes. The classes are the host's template; what stands between two
neighbouring tokens of it is a slot.

Words are template by their position between other tokens of it, so the same
word stays where it stands in an article; runs of them are cut. Of the rest,
slots inside page furniture (by element, role or class name) go, slots of
an article or main element stay where a page has one, and the remaining slots
are the main text, block by block.

Candidates are all tokens that can occur in nearly all pages of the host: one that
does is missing in few pages, so it occurs in most of any larger group of them,
and one that does not is no candidate. Candidates are then counted over all pages; only
their vectors are kept, and pages are read as sequences of them. Equal pages of a host count once. Vectors are
never gathered: a vector is kept as the sum over pages of count
times a hash of the page, so a token's vector comes from one aggregate with
partial sums in each task, whatever the number of pages of a host.
"""

from __future__ import annotations

import bisect
import functools
import html
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize

#: Distinct pages a host needs for its template to be deduced, and those from
#: which ``MIN_TOKENS`` are enough; hosts with fewer need more tokens.
MIN_PAGES = 3
FULL_PAGES = 8
#: Share of the host's pages that a template token occurs in.
SUPPORT = 0.95
#: Tokens a class needs, and template words in a row to count as boilerplate.
MIN_TOKENS = 3
#: Sums a task holds before it hands them on.
FLUSH = 200_000
MASK = (1 << 64) - 1

#: What follows a tag's name; a ">" inside a quoted value does not end the tag.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style)\b{_REST}>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_REST})(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
#: Elements and roles that are page furniture whatever their names.
_FURNITURE = frozenset(
    "head title nav footer aside button dialog menu label select textarea noscript template "
    "iframe svg object".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu "
                   "menubar toolbar".split())
#: Words in a class or id that mark page furniture, unless most of the page is in it.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar widget widgets "
    "related recommended footer comment comments respond disqus cookie cookies consent notice "
    "notices notification newsletter subscribe signup login popup modal overlay share sharing "
    "social toolbar search masthead".split())
_MAIN = frozenset({"article", "main"})
#: Elements that stand in a head; any other one, and any text, ends it.
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Words outside articles that a page may lose to its articles in any case.
FEW_WORDS = 20


class Element:
    """An open element. ``hard``: page furniture whatever it holds; ``soft``:
    furniture by a class word or as a form, unless :func:`settle` lifts it."""

    __slots__ = ("chars", "content", "furniture", "hard", "holds", "name", "parent", "place",
                 "soft")

    def __init__(self, name: str, place: str, parent: Element | None, hard: bool, soft: bool):
        self.name, self.place, self.parent = name, place, parent
        self.hard, self.soft = hard, soft
        self.chars, self.holds, self.furniture, self.content = 0, False, False, False


def events(page: str, elements: list[Element] | None = None
           ) -> Iterator[tuple[str, str, int, Element]]:
    """(place, text, block, element) of every tag and text run; elements are
    added to ``elements`` as they start.

    A tag's text is empty. Open elements are kept on a stack: an end tag closes
    its element and what is open inside, a block start closes an open
    paragraph. Comments, scripts, styles and the like yield nothing. Two text
    runs are in one block if no block element starts or ends between them.
    """
    elements = [] if elements is None else elements
    stack = [Element("", "", None, False, False)]
    elements.append(stack[0])
    block = 0
    for m in _TOKEN.finditer(page):
        text = m["text"]
        top = stack[-1]
        if text is not None:
            if top.name == "head" and text.strip():
                _close(stack, "head", until=())
                top = stack[-1]
            top.chars += len(text.strip())
            yield top.place, text, block, top
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in _BLOCK:
            block += 1
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    yield stack[i].place + "/", "", block, stack[i]
                    del stack[i:]
                    break
            continue
        if name == "body" or (stack[-1].name == "head" and name not in _IN_HEAD):
            _close(stack, "head", until={"body"})
        if name in _BLOCK:
            _close(stack, "p", until=_BLOCK - {"p"})
        if name in ("li", "td", "th", "tr", "dt", "dd", "option"):
            _close(stack, name, until={"ul", "ol", "dl", "table"})
        top = stack[-1]
        words: set[str] = set()
        roles: set[str] = set()
        if m["rest"].strip():
            for kind, value in _NAMES.findall(m["rest"]):
                (roles if kind.lower() == "role" else words).update(
                    _PARTS.findall(value.lower()))
        hard = (name in _FURNITURE or not _ROLES.isdisjoint(roles)
                or (name == "header" and all(e.name not in _MAIN for e in stack)))
        soft = name == "form" or not _MARKS.isdisjoint(words)
        # a hash, or the place of a deep element would be as long as its path
        path = f"{top.place}/{name}" + "".join(f".{w}" for w in sorted(words))
        place = xxhash.xxh64_hexdigest(path.encode("utf-8", "surrogatepass"))
        element = Element(name, place, top, hard, soft)
        elements.append(element)
        yield place, "", block, element
        if name not in _VOID and not m["rest"].endswith("/"):
            stack.append(element)


def settle(elements: list[Element]) -> None:
    """Set ``furniture`` and ``content`` of a page's elements, given as they start.

    A class word or form makes no furniture of the body, or of an element that
    holds an article or main element or most of the page's text.
    """
    for e in reversed(elements[1:]):
        if not e.hard:
            e.parent.chars += e.chars
            e.parent.holds |= e.holds or (e.name in _MAIN and not e.soft)
    for e in elements[1:]:
        soft = e.soft and not (e.name in ("html", "body") or e.holds
                               or 2 * e.chars > elements[0].chars)
        e.furniture = e.parent.furniture or e.hard or soft
        e.content = e.parent.content or (e.name in _MAIN and not e.furniture)


def _close(stack: list[Element], name: str, until) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            del stack[i:]
            return
        if stack[i].name in until:
            return


def page_tokens(page: str, places=None) -> Iterator[tuple[str, str]]:
    """(place, word) of all tags (no word) and words of a page, in order; of
    the given places only, if any are given."""
    for place, text, _, _ in events(page):
        if places is None or place in places:
            if text:
                for word in text.split():
                    yield place, word
            else:
                yield place, ""


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)",
                                               1)), F.lit(""))


def telling_pages(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``host``, ``share`` and ``needed``: which pages of a host tell its candidates.

    A token of the template may be missing in ``missed`` of the host's distinct pages,
    so of any ``picked`` of them it occurs in ``picked - missed`` or more: a token that
    does not is in no template. Those picked are the pages whose hash lies in the lowest
    ``share`` of all hashes, about four times as many as may miss a token. A host that
    has fewer than ``missed + 2`` there takes all of its pages.
    """
    keys = materialize(pages.select("host", "page").distinct(), "page_keys")
    limits = (keys.groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
              .withColumn("missed", F.col("all_pages") - F.ceil(support * F.col("all_pages")))
              .withColumn("share", (4 * F.col("missed") + 4) / F.col("all_pages")))
    few = F.col("picked") < F.col("missed") + 2
    return (keys.join(limits, "host").groupBy("host", "all_pages", "missed", "share")
            .agg(F.count_if(_picked()).alias("picked"))
            .select("host", F.when(few, 1.0).otherwise(F.col("share")).alias("share"),
                    (F.when(few, F.col("all_pages")).otherwise(F.col("picked"))
                     - F.col("missed")).alias("needed")))


def _picked() -> Column:
    """Whether the page's hash lies in the lowest ``share`` of all."""
    return (F.col("share") >= 1) | (F.col("page") / F.lit(2.0 ** 64) + 0.5 < F.col("share"))


def seed_tokens(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """``host`` and ``tokens``: what may belong to the host's template, as
    JSON pairs of place and word.

    A token of the template, in whatever role, occurs in at least ``support`` of the
    host's distinct pages; no such token is left out. Others may come with them, which
    occur nearly as often in the :func:`telling_pages`, at most twice as many as a page
    has; :func:`role_vectors` counts all of them over all pages. A task adds up its
    pages and lets go of its sums at a fixed number.
    """
    telling = materialize(telling_pages(pages, support), "telling_pages")

    def frame(sums):
        keys = [(host, *t, n) for host, own in sums.items() for t, n in own.items()]
        for i in range(0, len(keys), FLUSH // 4):
            yield pd.DataFrame(keys[i:i + FLUSH // 4], columns=["host", "place", "word", "n"])

    def scan(frames):
        sums: dict[str, Counter] = {}
        held = 0
        for f in frames:
            for host, text in zip(f["host"], f["html"], strict=True):
                own = sums.setdefault(host, Counter())
                held -= len(own)
                own.update(set(page_tokens(text)))
                held += len(own)
                if held >= FLUSH:
                    yield from frame(sums)
                    sums, held = {}, 0
        yield from frame(sums)

    return (pages.join(telling, "host").where(_picked()).dropDuplicates(["host", "page"])
            .select("host", "html")
            .mapInPandas(scan, "host string, place string, word string, n long")
            .groupBy("host", "place", "word").agg(F.sum("n").alias("n"))
            .join(telling.select("host", "needed"), "host").where(F.col("n") >= F.col("needed"))
            .groupBy("host").agg(F.sort_array(F.collect_list(F.array("place", "word"))).alias("t"))
            .select("host", F.to_json("t").alias("tokens")))


def sequences(pages: DataFrame) -> DataFrame:
    """``host``, ``page`` and ``ids``: the page's candidates in order, by their
    numbers, little-endian 32-bit. ``pages``: ``host``, ``page``, ``html``,
    ``tokens``."""
    def scan(frames):
        for f in frames:
            known: dict[str, tuple[frozenset, dict]] = {}
            out = []
            for host, text, tokens in zip(f["host"], f["html"], f["tokens"], strict=True):
                if host not in known:
                    number = {tuple(t): i for i, t in enumerate(json.loads(tokens))}
                    known[host] = frozenset(p for p, _ in number), number
                places, number = known[host]
                out.append(np.array([number[t] for t in page_tokens(text, places) if t in number],
                                    "<i4").tobytes())
            yield pd.DataFrame({"host": f["host"], "page": f["page"], "ids": out})

    return pages.mapInPandas(scan, "host string, page long, ids binary")


def _classes(level: str) -> list[list[tuple[int, int, int, int]]]:
    """The classes of a round: slot, token, times in the slot and which of them,
    in the order of the page they were taken from."""
    out = []
    for c in json.loads(level):
        own = sorted((at, t["slot"], t["token"], t["n"], j)
                     for t in c["own"] for j, at in enumerate(t["at"]))
        out.append([x[1:] for x in own])
    return out


def _in_order(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of (number, position) whose positions rise."""
    if all(a[1] < b[1] for a, b in itertools.pairwise(places)):
        return places
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, (_, at) in enumerate(places):
        k = bisect.bisect_left(ends, at)
        before.append(last[k - 1] if k else -1)
        ends[k:k + 1], last[k:k + 1] = [at], [i]
    out = []
    i = last[-1]
    while i >= 0:
        out.append(places[i])
        i = before[i]
    return out[::-1]


def align(ids: list[int], levels: list[list[list[tuple]]]) -> tuple[list[bool], list[int]]:
    """Which of a page's candidates are template tokens, and the slot of each:
    the number of the template token before it.

    Round after round, a class is met by the tokens that occur as often in
    their slots as they should and come in its order; if these are less than
    half of it, the page does not have the class.
    """
    fixed, slots = [False] * len(ids), [-1] * len(ids)
    base = 0
    for level in levels:
        where = _by_role(ids, fixed, slots)
        anchors: dict[int, int] = {}
        for own in level:
            met = []
            for number, (slot, token, n, j) in enumerate(own, base):
                at = where.get((slot, token))
                if at and len(at) == n:
                    met.append((number, at[j]))
            base += len(own)
            met = _in_order(met)
            if 2 * len(met) >= len(own):
                anchors.update((at, number) for number, at in met)
        # a slot reaches from its token to the next one of this round or before
        slot, old = -1, -1
        for i in range(len(ids)):
            if slots[i] != old:
                slot = old = slots[i]
            if i in anchors:
                fixed[i], slot = True, anchors[i]
            slots[i] = slot
    return fixed, slots


def _by_role(ids, fixed, slots) -> dict[tuple[int, int], list[int]]:
    out: dict[tuple[int, int], list[int]] = {}
    for i, token in enumerate(ids):
        if not fixed[i]:
            out.setdefault((slots[i], token), []).append(i)
    return out


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """Vectors of the candidates in the page as a whole, the first round of
    :func:`role_vectors`. ``pages``: ``host``, ``page`` (a hash), ``html``,
    ``tokens``."""
    return role_vectors(sequences(pages).withColumn("levels", F.array().cast("array<string>")))


def role_vectors(pages: DataFrame) -> DataFrame:
    """``host``, ``slot``, ``token``, ``n`` (its times in the slot), pages with
    it, vector hash, and where it stands in one of them (the least hash).

    ``pages``: ``host``, ``page``, ``ids``, ``levels`` (the classes of earlier
    rounds, whose tokens make the slots). A task adds up its part of every
    vector before anything is shuffled.
    """
    def frame(sums):
        return pd.DataFrame([(*k, v[0], v[1] - ((v[1] >> 63) << 64), v[2], v[3])
                             for k, v in sums.items()],
                            columns=["host", "slot", "token", "n", "pages", "vector", "least",
                                     "at"])

    def scan(frames):
        sums: dict[tuple, list] = {}
        for f in frames:
            known: dict[str, list] = {}
            for host, page, ids, levels in zip(f["host"], f["page"], f["ids"], f["levels"],
                                               strict=True):
                if host not in known:
                    known[host] = [_classes(x) for x in levels]
                seen = np.frombuffer(ids, "<i4").tolist()
                for (slot, token), at in _by_role(seen, *align(seen, known[host])).items():
                    v = sums.get(key := (host, slot, token, len(at)))
                    if v is None:
                        sums[key] = [1, page & MASK, page, at]
                        continue
                    v[0] += 1
                    v[1] = (v[1] + page) & MASK
                    if (page, at) < (v[2], v[3]):
                        v[2:] = page, at
                if len(sums) >= FLUSH // 4:
                    yield frame(sums)
                    sums = {}
        if sums:
            yield frame(sums)

    # the hash sums are added as two halves; a carry out of the upper one drops
    low, high = F.col("vector").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("vector", 32)
    carry = F.shiftrightunsigned("low", 32)
    return (pages.select("host", "page", "ids", "levels")
            .mapInPandas(scan, "host string, slot int, token int, n int, pages long, vector long, "
                               "least long, at array<int>")
            .groupBy("host", "slot", "token", "n")
            .agg(F.sum("pages").alias("pages"), F.sum(low).alias("low"), F.sum(high).alias("high"),
                 F.min(F.struct("least", "at")).alias("first"))
            .select("host", "slot", "token", "n", "pages",
                    F.shiftleft(F.col("high") + carry, 32)
                    .bitwiseOR(F.col("low").bitwiseAND(F.lit(0xFFFFFFFF))).alias("vector"),
                    F.col("first.at").alias("at")))


def tokens_needed(pages: int, min_tokens: int) -> int:
    """Tokens of a class, and template words in a row to cut, for a host of so
    many distinct pages: the fewer pages, the more is equal by chance."""
    return max(min_tokens, -(-FULL_PAGES * min_tokens // pages))


def templates(pages: DataFrame, min_pages: int, support: float, min_tokens: int) -> DataFrame:
    """``host`` and ``template``: its tokens, pages and rounds of classes, as JSON.

    A class is as large as :func:`tokens_needed` says or has the vector of one
    from an earlier round, which it then belongs to. Hosts with new classes are counted again,
    until there are none. A template is no longer than a page of its host.

    Equal pages of a host count once, so an article is not taken for a template
    because it stands in many copies.
    """
    hosts = materialize(pages.groupBy("host").agg(F.count_distinct("page").alias("all_pages"))
                        .where(F.col("all_pages") >= min_pages), "hosts")
    large = pages.join(hosts.select("host"), "host", "left_semi")
    state = materialize(
        seed_tokens(large, support).join(hosts, "host")
        .withColumns({"levels": F.array().cast("array<string>"),
                      "vectors": F.array().cast("array<long>")}), "seed_tokens")
    # copies go once they are sequences, which are much smaller than pages
    seen = materialize(sequences(
        pages.join(state.select("host", "tokens"), "host")
        .select("host", "page", "html", "tokens")).dropDuplicates(["host", "page"]), "sequences")
    parts = [state.limit(0)]
    while True:
        vectors = role_vectors(seen.join(state.select("host", "levels"), "host"))
        own = F.sort_array(F.collect_list(F.struct("slot", "token", "n", "at"))).alias("own")
        new = (vectors.join(state.select("host", "all_pages", "vectors"), "host")
               .where(F.col("pages") >= support * F.col("all_pages"))
               .groupBy("host", "vector")
               .agg(own, F.sum("n").alias("size"), F.first("vectors").alias("vectors"),
                    F.first("all_pages").alias("all_pages"))
               .where((F.col("size") * F.least("all_pages", F.lit(FULL_PAGES))
                       >= min_tokens * FULL_PAGES) | F.array_contains("vectors", F.col("vector")))
               .groupBy("host")
               .agg(F.to_json(F.sort_array(F.collect_list(F.struct("vector", "own"))))
                    .alias("level"), F.collect_set("vector").alias("more")))
        both = materialize(state.join(new, "host", "left"), "round")
        parts.append(both.where("level is null and size(levels) > 0").select(state.columns))
        state = both.where("level is not null").select(
            "host", "tokens", "all_pages",
            F.concat("levels", F.array("level")).alias("levels"),
            F.array_union("vectors", "more").alias("vectors"))
        if state.isEmpty():
            break
    return functools.reduce(DataFrame.unionByName, parts).select(
        "host", F.to_json(F.struct("tokens", "all_pages", "levels")).alias("template"))


class Template:
    """A host's classes, ready to be met by a page."""

    def __init__(self, template: str):
        t = json.loads(template)
        self.number = {tuple(x): i for i, x in enumerate(json.loads(t["tokens"]))}
        self.levels = [_classes(x) for x in t["levels"]]
        self.pages = t["all_pages"]
        self.places = frozenset(p for p, _ in self.number)
        words = {i for (_, word), i in self.number.items() if word}
        self.has_words = any(x[1] in words for level in self.levels for own in level for x in own)

    def fixed_words(self, runs) -> dict[int, list[bool]]:
        """By number of a text run, which of its words are template tokens: by
        their position between the others, not by what they are."""
        ids: list[int] = []
        spots: list[tuple[int, int]] = []
        sizes: dict[int, int] = {}
        for r, (place, text, *_) in enumerate(runs):
            if place not in self.places:
                continue
            words = text.split() if text else [""]
            sizes[r] = len(words)
            for w, word in enumerate(words):
                if (i := self.number.get((place, word))) is not None:
                    ids.append(i)
                    spots.append((r, w))
        out: dict[int, list[bool]] = {}
        for (r, w), hit in zip(spots, align(ids, self.levels)[0], strict=True):
            if hit:
                out.setdefault(r, [False] * sizes[r])[w] = True
        return out


def main_text(page: str, template: Template | None = None, min_tokens: int = MIN_TOKENS) -> str:
    """The blocks of the page's slots that hold its main text."""
    elements: list[Element] = []
    runs = list(events(page, elements))
    settle(elements)
    words = {True: 0, False: 0}
    for _, text, _, e in runs:
        if text and not e.furniture:
            words[e.content] += len(text.split())
    # articles stand for the page if they hold most of it; a teaser does not
    in_article = words[True] > 0 and (words[True] >= words[False] or words[False] < FEW_WORDS)
    fixed = template.fixed_words(runs) if template and template.has_words else {}
    need = tokens_needed(template.pages, min_tokens) if fixed else min_tokens
    blocks: dict[int, list[str]] = {}
    bare: dict[int, list[str]] = {}
    for r, (place, text, block, element) in enumerate(runs):
        if element.furniture or (in_article and not element.content):
            continue
        if not text:
            if element.name == "br":  # a line break inside a block is white space
                blocks.setdefault(block, []).append(" ")
            continue
        shown = html.unescape(text)
        blocks.setdefault(block, []).append(shown)
        if r in fixed:
            left = _outside(text, fixed[r], need, need == min_tokens)
            if left != text:
                bare[block] = [*bare.get(block, blocks[block][:-1]), html.unescape(left)]
                continue
        if block in bare:
            bare[block].append(shown)
    return _joined(blocks | bare)


def _outside(text: str, fixed: list[bool], min_tokens: int, whole: bool) -> str:
    """The text without runs of template words; with ``whole``, shorter ones go
    too if they are all there is."""
    words = text.split()
    out: list[str] = []
    i = 0
    while i < len(words):
        j = i
        while j < len(words) and fixed[j] == fixed[i]:
            j += 1
        if not fixed[i] or (j - i < min_tokens and not (whole and j - i == len(words))):
            out += words[i:j]
        i = j
    if len(out) == len(words):
        return text
    return " " * text[:1].isspace() + " ".join(out) + " " * text[-1:].isspace()


def _joined(blocks: dict[int, list[str]]) -> str:
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(x for x in lines if x)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html", min_pages: int = MIN_PAGES,
                      support: float = SUPPORT, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Main text of every page.

    Returns ``id_col``, ``url_col``, ``text`` (blocks joined by a newline; empty
    if none) and ``n_chars`` (its code points).

    Defined cases: null html counts as empty and gives an empty text; a page
    without a host (null or odd url) belongs to the host ``""``; a host with
    fewer than ``min_pages`` distinct pages has no template, and its pages are
    read by their elements alone; a very long page, or one with very many
    unclosed elements, is read whole, in time that grows with its length; text without any markup is the main text;
    equal pages of a host all give a text but count once for its template, which
    is applied to every page that has it; an empty table gives an empty result;
    only the three named columns are read.
    """
    rows = pages.select(col(id_col).alias("id"), col(url_col).alias("url"),
                        F.coalesce(col(html_col), F.lit("")).alias("html"),
                        host_of(col(url_col)).alias("host"))
    hashed = rows.select("host", F.xxhash64("html").alias("page"), "html")
    found = materialize(templates(hashed, min_pages, support, min_tokens), "templates")

    def extract(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for host, page, classes in columns:
            known: dict[str, Template | None] = {}
            out = []
            for h, text, c in zip(host, page, classes, strict=True):
                if h not in known:
                    known[h] = None if c is None else Template(c)
                out.append(main_text(text, known[h], min_tokens))
            yield pd.Series(out, dtype=object)

    text = F.pandas_udf(extract, "string")(F.col("host"), F.col("html"), F.col("template"))
    return (rows.join(found, "host", "left")
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col), text.alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
