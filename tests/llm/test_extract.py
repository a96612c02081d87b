"""Main text of pages: whole pages against their articles, and the rules one by one."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest

from roundscope.llm import extract

SF = "/root/testdata/sf0.001"

PROSE = ["The first paragraph has quite a few words that tell something at some length.", "Short one.", "A third, again long enough to be taken for prose by anyone."]


def article_of(page: str) -> str:
    """The blocks of the only article, by cutting at tags."""
    inner = re.search(r"(?s)<article>(.*?)</article>", page).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {r.page_id: (r.url, article_of(r.html)) for r in pages.collect()}
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in extract.extract(pages).collect()}
    assert found == {i: (url, text, len(text)) for i, (url, text) in expected.items()}


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>",
        "<header><h1>The Site</h1><p>Our slogan is long enough to look like prose, is it not?</p></header>",
        "<footer><p>All rights of this site belong to its owner, whoever that may be.</p></footer>",
        "<aside><p>Something else that happened today and which nobody asked about.</p></aside>",
        "<div class='cookie-notice'><p>We use small files to remember you, and we hope that you agree.</p></div>",
        "<div id=sidebarLeft><p>Most read: a long story about another thing altogether.</p></div>",
        "<div class='ad'>Buy this thing now, it is much better than all the other things.</div>",
        "<form><label>Name</label><input name=q><button>Send it now</button><select><option>One<option>Two</select></form>",
        "<script>document.write('<p>no prose</p>');</script><style>p{color:red}</style>",
        "<section id='comments'><div class=comment><p>I do not agree with a word of this article, says a reader.</p></div></section>",
        "<div role='complementary'><p>More stories from elsewhere, told at some length.</p></div>",
        "<p hidden>Not seen by anyone who reads this page in a browser.</p>",
        "<!-- <p>a comment of the author of the page, not shown</p> -->",
        "<noscript><p>Turn on scripts to read this page as it was meant.</p></noscript>",
    ],
)
@pytest.mark.parametrize("frame", ["<article><h1>Title</h1>%s</article>", "<main>%s</main>", "<div><div class=text>%s</div></div>"])
def test_noise(noise, frame):
    body = frame % paragraphs(*PROSE)
    want = "\n".join((["Title"] if "h1" in frame else []) + PROSE)
    for page in (noise + body, body + noise, f"<html><head><title>T</title></head><body>{noise}{body}{noise}</body></html>"):
        assert extract.main_text(page) == want
    inside = frame % (paragraphs(*PROSE[:2]) + noise + paragraphs(PROSE[2]))
    if "<header>" not in noise:  # an article's own header holds its headline
        assert extract.main_text(inside) == want


def test_article_keeps_all():
    page = "<article class='post has-sidebar comments-open'><header><h1>Title</h1></header><p>Yes.<p>No.<ul><li><a href=x>A link</a></ul><h2>Next</h2><table><tr><td>1<td>2</table></article>"
    assert extract.main_text(page) == "Title\nYes.\nNo.\nA link\nNext\n1 2"


def test_menu_without_a_name():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(8)) + "</ul>"
    prose = [" ".join(f"word{i}{j}" for j in range(30)) for i in range(6)]
    page = f"<body><div><h1>Title</h1></div>{menu}<div>{paragraphs(*prose)}</div>{menu}</body>"
    assert extract.main_text(page) == "\n".join(["Title", *prose])


def test_space_and_references():
    assert extract.main_text("<p> a&nbsp;&amp;\n\tb<br>c </p><p>&#x41;&lt;p&gt;&eacute;&copy</p>") == "a & b c\nA<p>é©"
    assert extract.main_text("just text\n of  a file") == "just text of a file"
    assert extract.main_text("") == extract.main_text("<nav>x</nav>") == extract.main_text("<br><img src=x>") == ""
    assert extract.main_text("<p>whole</p><p>cut o<a hre") == "whole\ncut o"
    assert extract.main_text("<p>whole</p><!-- never closed <p>x</p>") == "whole"
    assert extract.main_text("<p>one<![foo[x]]>two<?php x ?></p></b></div></article>") == "onetwo"


def test_smoothing_by_loops():
    rng = random.Random(3)
    ratios = np.array([rng.random() * 50 for _ in range(9)])
    for i, value in enumerate(extract.smoothed(ratios)):
        near = [(np.exp(-((j - i) ** 2) / (2 * extract.SIGMA**2)), r) for j, r in enumerate(ratios) if abs(j - i) <= extract.REACH]
        assert value == pytest.approx(sum(w * r for w, r in near) / sum(w for w, _ in near))
    for n in (1, 2, 3):
        assert extract.smoothed(np.ones(n)) == pytest.approx(np.ones(n))


def test_edges(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    rows = [(1, "u", None, "x", "y"), (1, "u", None, "x", "y"), (None, None, "", None, None), (3, "v", long, None, None), (4, "w", "<div>" * 3000 + "deep", None, None)]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract.extract(spark.createDataFrame(rows, schema)).collect()}
    assert found[(1, "u")] == found[(None, None)] == ("", 0) and found[(4, "w")] == ("deep", 4)
    assert found[(3, "v")][0].count("\n") == 49_999
    assert extract.extract(spark.createDataFrame(rows, schema)).count() == 5
    assert extract.extract(spark.createDataFrame([], schema)).collect() == []
