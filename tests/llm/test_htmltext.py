import html
import itertools
import random
import re

import pytest

from daybridge.llm.htmltext import Weights, best_stretch, extract, learn_weights, main_text
from daybridge.llm.queries import QUERIES


def test_best_stretch_against_all():
    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(rng.randrange(12))]
        a, b = best_stretch(scores)
        best = max([0, *(sum(scores[i:j]) for i, j in itertools.combinations(range(len(scores) + 1), 2))])
        assert sum(scores[a:b]) == pytest.approx(best)


def _article(page):
    """The test pages mark their text; its blocks are the headings and paragraphs within."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", inner))
    blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = QUERIES["op7_html_extraction"](spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == _article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>Home</a></li><li>About us and more</li></ul></nav>
<div id="cookie-notice">We use cookies to improve this and that and many other things of the site</div>
<div class="content"><h2>The &amp; title</h2><p>First   <b>bold</b>ly said &lt;here&gt;&nbsp;now.<br>Next line<p>Second paragraph with some more words in it
<script>if (a < b) document.write("<p>no</p>")</script> and its end.</p>
<div class="advert-box">Buy this thing today because it is cheap and very good</div><ul><li>item one of the list</li><li>item two</li></ul>
<form><input value=x><label>Your mail</label></form></div>
<aside>Other stories that you might like to read as well, many of them</aside>
<section class="comments"><p>I like this article very much, said a reader at length</p></section>
<footer>&copy; all kinds of legal words that nobody ever reads to the end</footer></body></html>"""


def test_page_without_article():
    weights = Weights(1.0, {"other": -1.0})
    assert main_text(PAGE, weights) == ("The & title\nFirst boldly said <here> now. Next line\n"
                                        "Second paragraph with some more words in it and its end.\nitem one of the list\nitem two")


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "plain text only", "<script>x", "<!-- open", "</p></div>text", "&am &copy", "a < b > c",
                                  "<article></article>", "<div " + "x=\"" * 50, "<p>" * 500 + "deep", "<article><p>" + "word " * 200000])
def test_odd_pages(page):
    text = main_text(page, Weights(1.0, {"other": -1.0}))
    assert text == "\n".join(" ".join(x.split()) for x in text.split("\n") if x)
    if page == "plain text only":
        assert text == page
    if page.endswith("word "):
        assert len(text.split()) == 200000


def test_hostile(spark):
    rows = [(1, None), (2, ""), (3, PAGE), (3, PAGE), (None, "<article><p>alone</p></article>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, html string, main_text string")
    found, name = extract(df)
    assert found.columns == [*df.columns, "_main_text"]
    texts = sorted((str(r.page_id), r[name]) for r in found.collect())
    assert texts[0] == ("1", "") and texts[1] == ("2", "") and texts[2] == texts[3] and texts[4] == ("None", "alone")
    assert extract(df.limit(0))[0].count() == 0
    weights = learn_weights(df)
    assert weights.word > 0 and all(w < 0 for w in weights.tags.values())


_WEIGHTS = Weights(1.0, {"other": -1.0})
_STORY = "<h1>The title</h1><p>" + "Some words of the story. " * 8 + "</p>"
_STORY_TEXT = "The title\n" + " ".join(["Some words of the story."] * 8)


@pytest.mark.parametrize("open_, close", [
    ('<div class="content has-sidebar">', "</div>"), ('<div id="page-no-ads">', "</div>"), ('<div class="sidebar">', "</div>"),
    ('<div class="ad"><div class="hidden">', "</div></div>"), ('<form id="aspnetForm">', "</form>"),
    ('<div style="visibility:hidden">', "</div>"),
])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "{}"])
def test_wrappers_do_not_empty_a_page(open_, close, inner):
    page = f"<html><body><nav>Home and more</nav>{open_}{inner.format(_STORY)}{close}<footer>Legal words</footer></body></html>"
    assert main_text(page, _WEIGHTS) == _STORY_TEXT


def test_marks_are_whole_tokens():
    page = ('<body><article><div class="post-header"><h1>Title of it</h1></div><h2 id="related">Related</h2><h2 id="related-work">Work</h2>'
            '<p class="social-impact">The social impact of it</p><div class="advert-box">Buy this</div><div class="ad">Buy that</div>'
            '<div id="leftSidebar">Other stories</div><p>The end of it all</p></article>'
            '<section class="comments"><article class="comment">' + "I say this. " * 50 + "</article></section></body>")
    assert main_text(page, _WEIGHTS) == "Title of it\nRelated\nWork\nThe social impact of it\nThe end of it all"


def test_marks_within_labelled_articles_stay(spark):
    page = ('<body><article><p>Words before it here</p><div class="notice">Mind the step</div><p>and after</p></article>'
            '<div class="ad">Buy this</div></body>')
    weights = learn_weights(spark.createDataFrame([(page,)] * 5, "html string"))
    assert weights.marks["notice"] > 0 > weights.marks["ad"]
    assert main_text(page, weights) == "Words before it here\nMind the step\nand after"


@pytest.mark.parametrize("name", ["related-posts", "post-comments", "commentlist", "entry-comments", "ad-slot", "advert-slot",
                                  "google-ads", "sponsored-content", "recommended-stories", "cookie-policy", "author-bio", "read-more",
                                  "breadcrumb-trail"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_boilerplate_within_the_story_goes(name, tag):
    page = f'<body><{tag}>{_STORY}<div class="{name}">Words that are none of it</div><p>And its end here.</p></{tag}></body>'
    assert main_text(page, _WEIGHTS) == _STORY_TEXT + "\nAnd its end here."


_CARDS = "".join(f'<article class="card"><h3><a href="/{i}">Card number {i}</a></h3><p>What the card {i} is about</p></article>' for i in range(4))


@pytest.mark.parametrize("story", [f"<article>{_STORY}</article>", f"<div>{_STORY}</div>", _STORY])
@pytest.mark.parametrize("page", ["<body><main>{story}{cards}</main></body>", "<body><main>{cards}{story}</main></body>",
                                  "<body>{story}<div>{cards}</div></body>"])
def test_teaser_cards_go(story, page):
    assert main_text(page.format(story=story, cards=_CARDS), _WEIGHTS) == _STORY_TEXT


def test_a_page_of_items_stays_whole():
    items = "".join(f"<article><h2>Item number {i} here</h2><p>{'What it is about. ' * 5}</p></article>" for i in range(4))
    text = main_text(f"<body><main>{items}</main></body>", _WEIGHTS)
    assert [line for line in text.split("\n") if line.startswith("Item")] == [f"Item number {i} here" for i in range(4)]


def test_weights_decide():
    page = f'<body><div>{_STORY}<div class="ad">{"Buy this. " * 30}</div><p>And its end here.</p></div><ul><li>Home</li><li>News</li></ul></body>'
    assert main_text(page, _WEIGHTS) == _STORY_TEXT + "\nAnd its end here."
    assert "Buy this." in main_text(page, Weights(1.0, {"other": -1.0}, {"ad": 0.5}))
    assert main_text(page, Weights(1.0, {"other": -0.1})).endswith("\nHome\nNews")


def test_an_advert_longer_than_the_text_goes():
    page = f'<body><div class="ad">{"Buy this. " * 60}</div><div>{_STORY}</div></body>'
    assert main_text(page, _WEIGHTS) == _STORY_TEXT


def test_scan_finds_the_text_without_article_tags(spark, sf):
    """With the tags that the stretch is widened to taken away, the learned weights alone find the marked text."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    weights = learn_weights(pages)
    for r in pages.collect():
        assert main_text(re.sub(r"</?(?:article|main)\b[^>]*>", "", r.html), weights) == _article(r.html)
