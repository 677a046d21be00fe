import html
import re
import time

import pytest
from pyspark.sql import Row

from rulebeam.llm.html_text import extract_text, main_text, op3_html_extraction

SF001 = "/root/testdata/sf0.001"
P1 = "The first paragraph of the story, which is long enough, says a few things about the matter at hand."
P2 = "A second paragraph follows, with more to tell, and it ends here after a good number of plain words."
P3 = "The third one is also prose, of the same kind, so that the container gathers enough points to win."
BODY = f"<p>{P1}</p><p>{P2}</p><p>{P3}</p>"
TEXT = "\n".join((P1, P2, P3))
MENU = '<ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul>'


def brute(page):
    """The given pages hold one article of headings and paragraphs."""
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    out = []
    for x in re.split(r"</?(?:p|h1)>", m[1]):
        x = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>?", "", x.replace("<br>", " ")))).strip()
        if x:
            out.append(x)
    return "\n".join(out)


def test_query_matches_brute_force(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = op3_html_extraction(spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == brute(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("page, want", [
    (f"<html><body><header><h1>Site</h1></header><nav>{MENU}</nav><main><h1>Title</h1>{BODY}</main>"
     "<footer>foot</footer></body></html>", f"Title\n{TEXT}"),
    (f'<body><div id="top">{MENU}</div><div class="post-content"><h2>Title</h2>{BODY}</div>'
     f'<div class="sidebar"><p>{P1}</p><p>{P2}</p></div><div id="comments"><p>{P3} I think so.</p></div></body>',
     f"Title\n{TEXT}"),
    (f'<div class="cookieNotice"><p>{P1}</p></div><article><header><h1>T &amp; t</h1></header>{BODY}'
     f'<section class="reader-comments"><article class="comment"><p>{P2}</p></article></section></article>',
     f"T & t\n{TEXT}"),
    (f"<body><div><div><p>{P1}<p>{P2}<ul><li>One, item<li>Two</ul><p>{P3}</div></div>"
     f"<form><p>{P1}</p><input name=q></form><div>{MENU}</div></body>", f"{P1}\n{P2}\nOne, item\nTwo\n{P3}"),
    (f'<table><tr><td>{MENU}</td><td class="content">{BODY}</td></tr></table>', TEXT),
    (f"<article><div style='display: none'>{P1}</div><!-- <p>no</p> --><script>var t='</p><p>x';</script>{BODY}"
     f"<aside>{P2}</aside></article>", TEXT),
    ("<p>caf&eacute; &#65;&#x42;\n\t two<b>bold</b> <i>it</i>alic<br>next &lt;tag&gt;</p>",
     "café AB twobold italic next <tag>"),
    ("<article><p>cut in the mid", "cut in the mid"),
    ("<article><p>cut in a tag</p><p cla", "cut in a tag"),
    ("plain text &amp; no tag", "plain text & no tag"),
    ("", ""), (" \n ", ""), ("<html><head><title>only</title></head><body></body></html>", ""), ("<", "<"),
])
def test_page_shapes(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page, want", [
    *[(f'<body><div id="top">{MENU}</div><div class="{names}"><h2>Title</h2>{BODY}</div>'
       f'<div class="sidebar"><p>{P2}</p></div></body>', f"Title\n{TEXT}")
      for names in ("content has-sidebar", "post no-comments", "page-with-menu", "entry share-enabled", "no-comments")],
    (f'<body><div class="with-sidebar"><main><h1>Title</h1>{BODY}</main><div class="sidebar"><p>{P2}</p></div></div>'
     f"</body>", f"Title\n{TEXT}"),
    (f'<body><div class="post"><p>{P1}</p></div><div class="post-comments">{BODY}{BODY}</div></body>', P1),
    (f'<article><p>{P1}</p><div class="comments">{BODY}</div></article>', P1),
    (f"<article><p>{P1}</p>{MENU}</article>", f"{P1}\nOne\nTwo\nThree"),
    (f"<body><div><p>{P1}</p><p>{P2}</p>{MENU}<p>{P3}</p></div></body>", f"{P1}\n{P2}\nOne\nTwo\nThree\n{P3}"),
    (f"<body><div>{MENU}<p>{P1}</p><p>{P2}</p><p>{P3}</p></div></body>", TEXT),
])
def test_names_and_lists_of_links_do_not_take_the_article(page, want):
    assert main_text(page) == want


def test_edge_rows(spark):
    deep = "<div>" * 5000 + f"<p>{P1}</p>"
    long = "<article>" + "<p>word, word.</p>" * 100_000 + "</article>"
    rows = [(1, None, "u"), (2, "", "u"), (None, f"<p>{P1}</p>", None), (3, deep, "u"), (4, long, "u"), (4, long, "u"),
            (5, "<a " * 3000, "u"), (6, '<p title="' + "x" * 100_000, "u")]
    df = spark.createDataFrame([Row(page_id=i, html=h, url=u, text=1, n_chars="x") for i, h, u in rows],
                               "page_id long, html string, url string, text long, n_chars string")
    got = [(r.page_id, r.text, r.n_chars) for r in extract_text(df).collect()]
    by = {i: (t, n) for i, t, n in got}
    assert len(got) == 8 and by[1] == by[2] == ("", 0) and by[None] == by[3] == (P1, len(P1))
    assert by[4][0].count("\n") == 99_999
    assert extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ['id="discussion"', 'class="search-results"', 'class="related-work"', 'class="menu"'])
def test_sections_of_an_article_stay(name):
    section = f"<section {name}><h2>What it is about</h2><p>{P3}</p></section>"
    want = f"T\n{P1}\n{P2}\nWhat it is about\n{P3}"
    assert main_text(f"<article><h1>T</h1><p>{P1}</p><p>{P2}</p>{section}</article>") == want
    assert main_text(f"<body><nav>{MENU}</nav><main><h1>T</h1><div class='post-body'><p>{P1}</p><p>{P2}</p></div>{section}"
                     "</main></body>") == want


@pytest.mark.parametrize("part", [
    f'<section id="discussion"><h2>Discussion</h2><div class="comment"><p>{P3}</p></div></section>',
    f'<section id="discussion"><h2>Discussion</h2><p>{P3}</p><form><input name=c></form></section>',
    f'<section id="discussion"><p>{P3}</p></section>',
    f'<div class="related-posts"><h2>More</h2><p>{P3}</p></div>',
    f'<div class="search-results"><h2>More</h2><p><a href="/x">{P3}</a></p></div>',
    f'<div class="promo"><h2>Buy</h2><p>{P3}</p></div>', f'<div class="cookie-notice"><h2>We</h2><p>{P3}</p></div>',
    f'<aside class="related-work"><h2>More</h2><p>{P3}</p></aside>',
])
def test_other_parts_inside_an_article_go(part):
    assert main_text(f"<article><h1>T</h1><p>{P1}</p>{part}<p>{P2}</p></article>") == f"T\n{P1}\n{P2}"


def test_formulas_stay():
    page = f"<article><p>{P1} <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math></p><p>{P2}</p></article>"
    assert main_text(page) == f"{P1} x=1\n{P2}"


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 100_000 + "<hr>" * 100_000,
    "<li><ul>" + "<b>" * 100_000 + "<li></li>" * 50_000, "<b>" * 100_000 + "<option></option>" * 50_000,
    "<table><tr><td>" * 20_000 + "<tr>" * 50_000, '<a "' * 50_001, "<a '\"" * 50_001, "<p>" * 100_000, "<div>" * 100_000,
])
def test_broken_markup_takes_linear_time(page):
    t = time.process_time()
    main_text(page + f"<p>{P1}</p>")
    assert time.process_time() - t < 5
