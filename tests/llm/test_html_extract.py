"""Main text of pages: the given pages against a plain reading, and templates."""

import html
import itertools
import json
import re

from tidewater.llm import html_extract as H

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def plain(page):
    """The given pages have one article; its paragraphs and heading are its blocks."""
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    out = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
    return "\n".join(x for x in out if x)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract_main_text(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == plain(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(plain(r["html"]))


def test_furniture_and_broken_markup():
    cases = {
        "<p>a&nbsp;b <b>c</b>d<br>e<p>f<div class='ad'>x</div><nav>z</nav>g": "a b cd e\nf\ng",
        "<main><h1>T</h1><form>q<input></form><ul><li>1<li>2</ul></main>zz": "T\n1\n2",
        "plain  text &amp; more": "plain text & more", "": "", "<p>": "", "<": "<",
        "<aside>x</aside><div id=comments><p>c</p></div><section>ok<!-- c --></section>": "ok",
        "<script>var a='<p>no</p>'</script><style>p{}</style><p>yes": "yes",
        "<head><title>t</title><body><p>text</p>": "text",
        "<header>top</header><article><header><h1>H</h1></header><p>x</p></article>": "H\nx",
        "<article><p>a</p><div class='newsletter-signup'>b</div><section class=comments>c"
        "</section></article><footer>d": "a", "<p>5 &lt; 6 &#233; &amp;lt;</p>": "5 < 6 é &lt;",
        "<p>x</b></i></p></div>y": "x\ny", "a<!-- open": "a", "<p>a<script>b": "a",
        "<div role=navigation>n</div><div>t</div>": "t",
    }
    assert {k: H.main_text(k) for k in cases} == cases


def site(i, host="h.example", notice="Please read our house rules first"):
    words = " ".join(f"word{i}x{k}" for k in range(20 + i))
    return (i, f"https://{host}/p{i}", f"<html><body><div><p>{notice}</p></div><div><h1>Title {i}"
            f"</h1><p>{words}</p></div><div><p>{notice} then mind the gap</p></div></body></html>")


def test_template_text_goes_wherever_it_stands(spark):
    rows = [site(i) for i in range(12)] + [site(i, "small.example") for i in range(20, 23)]
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(12):
        words = " ".join(f"word{i}x{k}" for k in range(20 + i))
        assert got[i].replace("Title ", "") == f"{i}\n{words}"
    assert "house rules" in got[20]  # too few pages for a template


def test_copies_of_one_page_are_not_all_template(spark):
    rows = [(i, f"http://copies.example/{i}", site(1)[2]) for i in range(15)]
    got = {r["text"] for r in H.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 1 and "word1x5" in got.pop()


def test_vectors_do_not_depend_on_partitions(spark):
    rows = [(f"h{i % 3}", 1 << 62 if i % 2 else -i * 7919, site(i)[2]) for i in range(30)]
    pages = spark.createDataFrame(rows, "host string, page long, html string")
    pages = pages.join(H.seed_tokens(pages), "host")
    a = H.occurrence_vectors(pages.repartition(1)).collect()
    b = H.occurrence_vectors(pages.repartition(9)).collect()
    assert len(a) > 10 and sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    rows = [(None, None, None), (1, None, "<p>x</p>"), (2, "no url", ""), (3, "http://a/", None),
            (1, None, "<p>x</p>"), (4, "//A.example", "<p>" + "long " * 50_000 + "</p>")]
    pages = spark.createDataFrame(rows, SCHEMA)
    for c in ("host", "template", "page", "text", "n_chars", "id", "token"):
        pages = pages.withColumn(c, F.lit("z"))
    got = H.extract_main_text(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [
        (0, 0), (1, 1), (1, 1), (2, 0), (3, 0), (4, 249_999)]
    assert H.extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_candidates_are_counted_over_all_pages(spark):
    # a word that two pages lack is in 38 of 40, whichever pages a sample would pick
    pairs = list(itertools.combinations(range(40), 2))
    rows = [("h", i, "<p>" + " ".join(f"w{a}x{b}" for a, b in pairs if i not in (a, b))
             + f" own{i}</p>") for i in range(40)]
    got = H.seed_tokens(spark.createDataFrame(rows, "host string, page long, html string"))
    [found] = [json.loads(r["tokens"]) for r in got.collect()]
    assert {w for _, w in found if w} == {f"w{a}x{b}" for a, b in pairs}


def noticed(i, host, notice, article):
    return (i, f"https://{host}/p{i}", f"<html><body><div><p>{notice}</p><p>{article}</p></div>"
            f"<div><p>{notice}</p></div></body></html>")


def test_words_of_the_template_have_roles_by_slot(spark):
    notice = "we value your privacy and the peace of our readers"
    articles = [" ".join(f"word{i}x{k} the" if (k + i) % 3 else f"of word{i}x{k} and our"
                         for k in range(12 + i)) + " privacy" * (i % 4 == 1) for i in range(12)]
    rows = [noticed(i, "roles.example", notice, a) for i, a in enumerate(articles)]
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == dict(enumerate(articles))


def test_slots_nest():
    # token 5 stands for a word that is template in one slot and free in another
    first = [[(-1, 0, 1, 0), (-1, 1, 1, 0), (-1, 2, 1, 0)]]
    second = [[(0, 5, 1, 0)]]
    assert H.align([0, 5, 1, 5, 5, 2], [first, second]) == (
        [True, True, True, False, False, True], [0, 3, 1, 1, 1, 2])
    assert H._in_order([(0, 4), (1, 1), (2, 2), (3, 9), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]


def test_template_goes_from_short_pages_and_copies_count_once(spark):
    notice = " ".join(f"note{k}" for k in range(60))
    short = {i: " ".join(f"word{i}x{k}" for k in range(10 if i < 9 else 300)) for i in range(10)}
    rows = [noticed(i, "short.example", notice, a) for i, a in short.items()]
    rows += [(100 + i, *rows[9][1:]) for i in range(200)]
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == short | {100 + i: short[9] for i in range(200)}


def test_small_hosts_have_templates(spark):
    notice = " ".join(f"note{k}" for k in range(12))
    want, rows = {}, []
    for host in (3, 5, 7):
        for i in range(host):
            want[10 * host + i] = " ".join(f"word{i}x{k} same{k % 3}" for k in range(10 + i))
            rows.append(noticed(10 * host + i, f"h{host}.example", notice, want[10 * host + i]))
    got = {r["page_id"]: r["text"] for r in H.extract_main_text(
        spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_marks_do_not_take_the_article():
    text = "<p>some words of the text</p>"
    cases = {
        f"<body class='single no-sidebar'>{text}<div class=sidebar>x</div>": "some words of the text",
        f"<div class='content with-sidebar'>{text}</div><p>z": "some words of the text\nz",
        f"<div id='search-result-article'><article>{text}</article></div><p>{'z' * 99}":
            "some words of the text",
        f"<form><main>{text}</main><div class=ad>x</div></form>{'z' * 99}": "some words of the text",
        f"<body><form><nav>{'z' * 99}</nav>{text}</form>": "some words of the text",
        f"<div class=promo><div class=related><article>x</article></div>y</div>{text}":
            "x",
        f"<nav class=menu><article>x</article></nav>{text}": "some words of the text",
    }
    assert {k: H.main_text(k) for k in cases} == cases


def test_a_quoted_bracket_does_not_end_a_tag():
    cases = {
        """<p><a title="a > b">link</a> text""": "link text",
        """<p><a title='x>y' class = "u > v">link</a>""": "link",
        """<p><a title=don't>link</a> it's""": "link it's",
        """<p><a title="open>link</a> text""": "link text",
        """<script data-x="</p>>">var a = "<p>";</script><p>text""": "text",
        """<p a="1>2" b>x</p><p>y""": "x\ny",
    }
    assert {k: H.main_text(k) for k in cases} == cases


def test_a_head_without_end_loses_no_text():
    cases = {
        "<html><head><title>T</title><meta x><p>story</p>": "story",
        "<html><head><title>T</title>story <b>goes</b> on": "story goes on",
        "<head><link a><style>x{}</style><div>one</div><p>two": "one\ntwo",
        "<html><head><title>T</title></head><p>story": "story",
        "<head><title>T<body><p>story": "story",
    }
    assert {k: H.main_text(k) for k in cases} == cases


def test_a_teaser_is_no_article():
    story = " ".join(f"word{i}" for i in range(100))
    assert H.main_text(f"<article>teaser</article><p>{story}</p>") == f"teaser\n{story}"
    assert H.main_text(f"<p>by someone</p><article>{story}</article><p>a caption") == story
    half = " ".join(f"other{i}" for i in range(90))
    assert H.main_text(f"<main>{story}</main><p>{half}") == story


def test_deep_and_unclosed_markup():
    import time
    start = time.monotonic()
    deep = "<b>" * 30_000 + "text"
    assert H.main_text(deep) == "text"
    assert sum(len(place) for place, *_ in H.events(deep)) < 17 * 30_002
    assert H.main_text("<a b='" * 20_000 + "x") == ""
    assert H.main_text("<p>" * 30_000 + "text") == "text"
    assert time.monotonic() - start < 20


def test_no_candidate_is_lost_with_the_telling_pages(spark):
    # words lack the 20 of 400 pages with the lowest hashes, which tell the candidates first
    low = -(1 << 63)
    hashes = [low + i * ((1 << 64) // 400) for i in range(400)]
    rows = [("h", h, "<p>" + "most " * (i >= 20) + "all fair " * (i >= 21) + f"all own{i}</p>")
            for i, h in enumerate(hashes)]
    rows += [("few", h, f"<p>all own{i}</p>") for i, h in enumerate(hashes[200:204])]
    pages = spark.createDataFrame(rows * 2, "host string, page long, html string")
    told = {r["host"]: (r["share"], r["needed"]) for r in H.telling_pages(pages).collect()}
    assert told == {"h": (84 / 400, 64), "few": (1.0, 4)}
    found = {r["host"]: {w for _, w in json.loads(r["tokens"]) if w}
             for r in H.seed_tokens(pages).collect()}
    assert found == {"h": {"most", "all"}, "few": {"all"}}
