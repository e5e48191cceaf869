"""Main-text extraction: tag soup, exclusions, host consensus."""

import html
import re

from dimstack.llm import html_extract as hx
from dimstack.llm import queries

SF = "/root/testdata/sf0.001"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><article>";</script>
</head><body><header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav>
<div class="cookie-notice">We use cookies, many, many cookies, really a lot of text, more, and more.</div>
<div class='content post-%d'><article><h2>Title &amp; more</h2><p>One,&nbsp;two
three <b>bold<br>line</b><p>Unclosed <a href="u">link</a> para<!-- <p>no</p> -->
<div class="ad">Buy, buy, buy, buy, buy</div><ul><li>a<li>b &lt;i&gt; &eacute;&#8364;</ul>
<table><tr><td>c1<td>c2</tr></table><form><p>Name</p><input></form></article>
<div id="comments"><p>Nice, very nice, so nice, what a long comment, really, long, long</p></div></div>
<aside>Side</aside><footer>&copy; foot</footer></body></html>"""
TEXT = "Title & more\nOne, two three bold line\nUnclosed link para\na\nb <i> é€\nc1\nc2"


def test_blocks_and_exclusions():
    path, score = hx.best_path(PAGE % 7)
    assert path == "/body/div.content.post-#/article" and score > 0
    assert hx.main_text(PAGE % 7, path) == TEXT


def test_soup_never_fails():
    for raw in ("", "plain & text", "<", "<p", "<p class=\"x>a", "</div></div>", "<script>never closed", "<a><b></a></b>x",
                "<!-- open", "<div " + "a" * 1000, "<p>" * 3000 + "x", "a<br>b", "&#0;&bogus;&#x41;"):
        path, _ = hx.best_path(raw)
        assert isinstance(hx.main_text(raw, path), str)
    assert hx.main_text("<body><p>a<br>b &#x41;", "/body") == "a b A"


def test_host_consensus(spark):
    body = "<p>" + "word, " * 30 + "end.</p>"
    usual = '<body><div class="story">' + body + '</div><div class="x">' + "<p>short</p>" + "</div></body>"
    odd = '<body><div class="story"><p>Brief.</p></div><div class="x">' + body * 3 + "</div></body>"
    other = '<body><div class="own">' + body + "</div></body>"
    rows = [(i, "http://a.example/1", usual, 1) for i in range(5)] + [(5, "http://A.example:80/2", odd, 1),
            (6, "http://a.example/3", other, 1), (7, "http://b.example/", odd, 1), (8, None, None, 1), (9, "nohost", "", 1),
            (None, "http://a.example/1", usual, 1), (0, "http://a.example/1", usual, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted((str(r.page_id), r.path, len(r.text.split())) for r in hx.extract_main_text(pages.repartition(3)).collect())
    story, own, x = "/body/div.story", "/body/div.own", "/body/div.x"
    want = [*((str(i), story, 31) for i in range(5)), ("0", story, 31), ("None", story, 31), ("5", story, 1), ("6", own, 31),
            ("7", x, 93), ("8", None, 0), ("9", None, 0)]
    assert got == sorted(want, key=str) or got == sorted(want, key=lambda t: (t[0], str(t[1])))
    assert hx.extract_main_text(pages.limit(0)).count() == 0


def test_consensus_of_a_host_with_many_templates(spark):
    """Each of nine templates has its own consensus, also the one with fewest votes."""
    body = "<p>" + "word, " * 30 + "end.</p>"
    page = lambda k, a, b: f'<body><div class="story{"abcdefghi"[k]}">{a}</div><div class="x{"abcdefghi"[k]}">{b}</div></body>'
    rows = [(100 * k + i, "http://a.example/1", page(k, body, "<p>short</p>")) for k in range(9) for i in range(12 - k)]
    rows += [(1000 + k, "http://a.example/2", page(k, "<p>Brief.</p>", body * 3)) for k in range(9)]
    # a host where every page has a class of its own
    slug = lambda i: "".join("abcdefghij"[int(c)] for c in str(1000 + i))
    rows += [(2000 + i, "http://b.example/", f'<body><div class="{slug(i)}"><div>{body}</div></div></body>') for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.path, len(r.text.split())) for r in hx.extract_main_text(pages.repartition(3)).collect()}
    assert len(got) == len(rows)
    for k in range(9):
        story = f"/body/div.story{'abcdefghi'[k]}"
        assert all(got[100 * k + i] == (story, 31) for i in range(12 - k)) and got[1000 + k] == (story, 1)
    assert all(got[2000 + i] == (f"/body/div.{slug(i)}/div", 31) for i in range(50))


def test_query_against_the_pages_own_markup(spark):
    """The driver's pages have one article each: its paragraphs are the text."""
    got = {r.page_id: r for r in queries.op7_html_extraction(spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in parts if x)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)


def test_sections_inside_an_article_keep_compound_names(spark):
    names = ["social-history", "search-results", "related-work", "menu-of-the-day", "ad-banner", "share"]
    body = "".join(f'<div class="{n}"><p>Text of the part named {n}.</p></div>' for n in names)
    html = f"<html><body><div class='related-links'><p>Elsewhere</p></div><article><p>{'Long body text. ' * 20}</p>{body}</article></body></html>"
    df = spark.createDataFrame([(1, "http://a/1", html)], "page_id long, url string, html string")
    text = hx.extract_main_text(df).first().text
    assert [n for n in names if f"named {n}." in text] == names[:4] and "Elsewhere" not in text
