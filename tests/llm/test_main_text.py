from __future__ import annotations

import re
from html import unescape

from pyspark.sql import functions as F

from stayrate.llm.main_text import extracted, main_text

SOUP = """<html><body class="with-sidebar"><header><h2>Site</h2></header><div class="menu"><a href=1>a</a> <a href=2>b</a></div>
<div id=wrap class="has-sidebar"><div class=content><h2>Title</h2><p>Some long text here that is an article,
with <a href=x>one link</a> in it.<p>Another &lt;b&gt; paragraph&nbsp;of a certain length too.<ul><li>one<li>two</ul></div>
<div class="sidebar">side text</div><div class="comments"><p>I like it a lot</p></div></div>
<form><input><p>subscribe</p></form><footer>foot</footer></body></html>"""


def test_without_article_elements():
    assert main_text(SOUP) == (
        "Title Some long text here that is an article, with one link in it. Another <b> paragraph of a certain length too. one two"
    )


def test_article_with_furniture_inside():
    page = """<body><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div><main><article><header><h1>Head</h1></header>
    <p>First <b>bold</b><i>er</i> text.<script>var t="</p>";</script><aside>Aside</aside><div class="ad">Buy</div>
    <p>Second<br>line.</p><style>p{}</style><table><tr><td>c1<td>c2</table><section id="comments"><article class="comment"><p>Nice</p></article></section>
    </article></main><footer>(c)</footer>"""
    assert main_text(page) == "Head First bolder text. Second line. c1 c2"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("   ") == ""
    assert main_text("plain text &amp; more") == "plain text & more"
    assert main_text("<p>a<p>b") == "a b"
    assert main_text("<article><p>cut off &am") == "cut off &am"
    assert main_text("<article><p>cut <a href='x") == "cut"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<script>only()</script>") == ""
    assert len(main_text("<article><p>" + "word " * 200_000)) == 999_999


def test_pages_of_the_table(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    out = extracted(pages.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))).collect()
    assert len(out) == len(html)
    for r in out:
        body = re.search(r"<article>(.*?)(?:</article>|$)", html[r["page_id"]], re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1)[^>]*>", body.replace("<br>", " "))
        texts = (" ".join(unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in blocks)
        assert r["text"] == " ".join(t for t in texts if t)
        assert r["n_chars"] == len(r["text"])


def test_nulls_and_no_pages(spark):
    df = spark.createDataFrame([(None, None, None), (1, "u", "<p>x")], "page_id long, url string, html string")
    assert sorted(tuple(r) for r in extracted(df).where("page_id is not null").collect()) == [(1, "u", "x", 1)]
    assert extracted(df).count() == 2
    assert extracted(df.limit(0)).count() == 0


STORY = [f"Paragraph {i} of a story with many words in it, which goes on for a while and has no link at all." for i in range(8)]


def test_teaser_article_beside_a_story_in_a_div():
    paragraphs = "".join(f"<p>{p}</p>" for p in STORY)
    teaser = '<article><h3><a href="/x">Another story</a></h3><p><a href="/x">Read it</a></p></article>'
    for page in (f"<div>{paragraphs}</div>{teaser}", f"{teaser}<div><div>{paragraphs}</div></div>", f"<main><div>{paragraphs}</div></main>{teaser}"):
        assert main_text(f"<html><body>{page}</body></html>") == " ".join(STORY)


def test_article_in_several_parts():
    first, second = ("".join(f"<p>{p}</p>" for p in part) for part in (STORY[:5], STORY[5:]))
    for page in (f"<article>{first}</article><article>{second}</article>", f"<div><article>{first}</article></div><div><article>{second}</article></div>"):
        assert main_text(f"<html><body><nav><a href=/>Home</a></nav>{page}</body></html>") == " ".join(STORY)
