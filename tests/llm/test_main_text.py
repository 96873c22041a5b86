"""Main text of planted pages of several layouts, and of broken pages."""

import pytest
from pyspark.sql import functions as F

from recordloom.llm.main_text import main_text, with_main_text

LONG = "The committee met on Tuesday to discuss the plans, and after several hours it agreed on most of them."
MORE = "Nobody had expected the outcome, which came after a long night of talks; the papers wrote of little else."
LAST = "What follows from it remains to be seen, but the first steps were taken within the week, as promised."
LINKS = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(9))
NOISE = "Buy two of these fine products today and get the third one for nothing, only while the stock lasts."


@pytest.mark.parametrize("page", [
    # The layout of the given pages, with tags left open.
    f'<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul>{LINKS}</ul></nav><div class="ad">{NOISE}</div>'
    f"<article><h1>A title</h1><p><b>{LONG}<br><p>{MORE}</p><p>{LAST}</p></article><footer>&copy; x {NOISE}</footer>",
    # Blocks named by classes only.
    f'<div id="top-menu"><ul>{LINKS}</ul></div><div id="page"><div class="leftSidebar"><p>{NOISE}</p></div><div class="post"><h1>A title</h1>'
    f'<p>{LONG}</p><p>{MORE}</p><div><p>{LAST}</p></div></div></div><div class="comments"><p>{NOISE}</p><p>{NOISE}</p><p>{NOISE}</p></div>',
    # A list of links without any name, forms, scripts, hidden parts, a cookie notice.
    f'<body><div><ul>{LINKS}{LINKS}</ul></div><form action="/s"><p>Search the archive</p><input name=q></form><div style="display: none">{NOISE}</div>'
    f'<div id="cookieNotice"><p>{NOISE}</p></div><div><h1>A title</h1><p>{LONG} </p><script>var t = "</p>";</script><p>{MORE}</p><p>{LAST}</p></div>',
    # Header and reader comments within the main element, each comment an article.
    f'<header><h1>The site</h1><p>{NOISE}</p></header><main><article><header><h1>A title</h1></header><section><p>{LONG}</p></section><section><p>{MORE}</p>'
    f'<p>{LAST}</p></section></article><section id="comments"><article class="comment"><p>{NOISE}</p></article></section></main>',
    # Class of the body and of a wrapper name a sidebar, yet hold the article.
    f'<body class="no-sidebar"><div class="has-sidebar"><article class="menu-less"><h1>A title</h1><p>{LONG}<p>{MORE}<p>{LAST}</article></div></body>',
])
def test_layouts(page):
    assert main_text(page) == f"A title {LONG} {MORE} {LAST}"


def test_lines_and_references():
    assert main_text("<p>a<b>b</b> c\n\t d<br>e</p><ul><li>f<li>g</ul><table><tr><td>h<td>i</table>") == "ab c d e f g h i"
    assert main_text("<p>x &amp; y &#65;&eacute;&nbsp;z &unknown; &lt;p&gt;</p>") == "x & y Aé z &unknown; <p>"
    assert main_text(f"<article><p>{LONG}</p><ul><li>one</li><li>two</li></ul><p>{MORE}</p></article>") == f"{LONG} one two {MORE}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("no tags", "no tags"), ("<", "<"), ("<![x <p>a</p>", "a"), ("<!-- open <p>a</p>", ""), ("<a href=x>only a link</a>", "only a link"),
    ("<script>never closed <p>a</p>", ""), ("<nav>all of it</nav>", ""), ("</div></p></b>a", "a"), ("<title>t</title>a <i>b</i>", "a b"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"), ("<p>" + "word " * 200_000, ("word " * 200_000).strip()),
])
def test_odd_pages(page, text):
    assert main_text(page) == text


def test_column_of_a_table(spark):
    rows = [(1, f"<article><p>{LONG}</p></article>"), (1, f"<article><p>{LONG}</p></article>"), (None, None), (2, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("main_text", F.lit("mine")).repartition(3)
    got = with_main_text(pages)
    assert got.columns == ["page_id", "html", "main_text"]
    assert sorted((str(r.page_id), r.main_text) for r in got.collect()) == [("1", LONG), ("1", LONG), ("2", ""), ("None", "")]
    assert with_main_text(pages.limit(0)).count() == 0
