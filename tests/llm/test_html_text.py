"""Main text: whole pages by hand, the given pages against their known form, and broken markup."""

import html
import random
import re
import time

from acctlake.llm.common import table
from acctlake.llm.html_text import _inherited, blocks, extract, labels, main_text

PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><div id="header"><b>Site name</b><ul><li><a href=/>Home</a></ul></div>
<div class="cookie-banner">We use cookies and the like to make it good for you and for the rest of us all.</div>
<div class="content"><h2>My Title</h2><p>This is the first of the many paragraphs that are in the article and it is long enough.</p>
<p>Short one.</p><div class=ad>Buy now the best of the products in the world and be happy with it for all the days</div>
<p>And the second is also here for us to read  and it has many of the usual words, &lt;b&gt; &eacute;&#8364; AT&T.</p><ul><li>First</li><li>Second</li></ul>
<p>The last of the paragraphs was written by the author on a day that was not like the others.</p></div>
<div id="comments"><p>I think that this is the best of the articles that I have read in the last of the years.</p></div>
<div id=sidebar><p>Related: the story of the man and the sea that was told by the people of the land</p></div>
<form><p>Subscribe to the news of the day and get it in the mail that is yours</p></form>
<footer>Copyright &copy; 2020 all rights to the owner of the site and the others</footer><script>if(a<b){"</p>"}</script></body>"""


def test_page_without_article():
    assert main_text(PAGE).split("\n") == [
        "My Title",
        "This is the first of the many paragraphs that are in the article and it is long enough.",
        "Short one.",
        "And the second is also here for us to read and it has many of the usual words, <b> é€ AT&T.",
        "First", "Second",
        "The last of the paragraphs was written by the author on a day that was not like the others.",
    ]


def test_article_keeps_all_but_marked_parts():
    page = (
        "<nav>menu</nav><article><header><h1>Head</h1></header><p>x y <a href=1>z</a><br>w</p><p>12 34 !!</p>"
        "<section class='comment-list'><p>Nice.</p></section><aside>no</aside><p style='display: none'>shown</p>"
        "<div hidden>no</div><pre> a\n  b </pre></article><article class='comment'>me too</article><p>after</p>"
    )
    assert main_text(page) == "Head\nx y z w\n12 34 !!\nshown\na b"


def test_given_pages(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    got = extract(table(spark, sf_dir, "pages")).collect()
    assert len(got) == len(pages)
    for row in got:
        page = pages[row.page_id].html
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = re.split(r"</?(?:h1|p)>", article)
        texts = (" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", p)).split()) for p in parts)
        assert row.text == "\n".join(t for t in texts if t)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_given_pages_without_article(spark, sf_dir):
    """The rules alone find what the page marks as its article."""
    for row in table(spark, sf_dir, "pages").collect():
        assert main_text(re.sub(r"<(/?)(article|main)\b", r"<\1div", row.html)) == main_text(row.html)


def test_second_pass_against_nearest_by_distance():
    rng = random.Random(3)
    for _ in range(300):
        first = [rng.choice([True, False, None, None]) for _ in range(rng.randint(1, 12))]
        heads = [rng.random() < 0.3 for _ in first]
        decided = [i for i, x in enumerate(first) if x is not None]
        if not decided:
            continue
        for i, (x, got) in enumerate(zip(first, _inherited(first, heads), strict=True)):
            near = [j for j in decided if abs(i - j) == min(abs(i - k) for k in decided)]
            assert got == (first[near[-1]] if heads[i] else any(first[j] for j in near)) if x is None else got == x


def test_damaged_pages_take_linear_time():
    n = 100_000
    began = time.monotonic()
    for page in ("<div>" * n + "</span>" * n, "<div><a>" * n, "<span>" * n + "</div>" * n, "<div><a>" * n + "</div>" * n):
        # Text in a link that is never closed is a link.
        assert main_text(page + "<p>end") == ("" if page.endswith("<a>") else "end")
    assert time.monotonic() - began < 30


def test_open_blocks_take_the_nearest_label():
    good = "the one and the other of the two that was here in the house and at the sea for all of them"
    bad = "<a href=x>" + "link " * 30 + "</a>"
    page = f"<p>{bad}</p><p>a</p><p>b</p><p>c</p><p>{good}</p><p>d</p><p>e</p><p>{bad}</p>"
    kept = [b.text for b, keep in zip(blocks(page), labels(blocks(page))) if keep]
    assert kept == ["b", "c", good, "d"]


def test_teaser_articles_beside_plain_text():
    good = "the one and the other of the two that was here in the house and at the sea for all of them"
    teaser = "<article><h3>Other story</h3><p>Read on</p></article>"
    assert main_text(f"<div>{good}</div><div>{good} too</div>{teaser}") == f"{good}\n{good} too"
    assert main_text(f"<div>{good}</div><aside><article><p>{good} aside</p></article></aside>") == good
    assert main_text(f"<form><div>no</div><main><p>{good}</p></main></form>") == good
    dull = "Zirkon Quarz Glimmer Feldspat Basalt Granit Marmor Gneis Schiefer Kalk Sand Ton Lehm"
    assert main_text(f"<article><p>{dull}</p><p>{good}</p></article><div>{dull}</div>") == f"{dull}\n{good}"


def test_broken_markup():
    assert main_text(None) == main_text("") == main_text("<!-- x") == main_text("<script>never closed") == ""
    assert main_text("plain text & nothing") == "plain text & nothing"
    assert main_text("a < b and <p>c<b>d</i></div></p") == "a < b and\ncd"
    assert main_text("<p title='a>b'>x</p><p title=\"open>y</p>") == "x\ny"
    assert main_text("<div " * 3000 + "x" * 3000) == ""
    assert len(main_text("<article>" + "<p>word word" * 20000)) == 20000 * 10 - 1


def test_nulls_and_columns(spark):
    rows = [(None, None, None, "t"), (1, "u", None, "t"), (1, "u", "<p>a b</p>", "t"), (1, "u", "<p>a b</p>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(str, extract(pages).collect()))
    assert got == sorted(map(str, extract(pages.select("html", "url", "page_id")).collect()))
    assert extract(pages).where("n_chars = 3 and text = 'a b'").count() == 2
    assert extract(pages).where("n_chars = 0 and text = ''").count() == 2
    assert extract(pages.limit(0)).collect() == []
