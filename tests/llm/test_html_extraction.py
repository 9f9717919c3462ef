import html
import itertools
import random
import re
import time

import pytest

from landspark.llm import html_extraction as h

PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{margin:0}</style></head><body class="has-sidebar">
<header class="site-header"><a href="/">Site</a><p>A tag line of the site, which is long enough to be a sentence.</p></header>
<div class="cookie-notice"><p>We use cookies to make this site better for you, and for no other purpose.</p></div>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<main><div class="breadcrumbs"><a>Home</a></div><h1>Title &amp; more</h1><p>First paragraph of&nbsp;the text,
   with a <a href="x">link</a> in it.<p>Second<br>line.<!-- <p>none</p> -->
<div class="advert">Buy this now, it is the best thing you will ever have seen in your life.</div>
<blockquote>Quote.</blockquote><ul><li>one item<li>two <b>items</ul><p>Of.</p>
<script>var t = "<p>no</p>";</script><form><label>Your mail</label><input><p>We will never send you anything that you did not ask for.</p></form>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I like this very much, and I think that you should write more about it.</p></article></section></main>
<aside><p>Related: some other text that is long and that has a full stop at its end.</p></aside><footer>&copy; all rights.</footer></body></html>"""


def test_page():
    assert h.main_text(PAGE).split("\n") == ["Title & more", "First paragraph of the text, with a link in it.", "Second line.", "Quote.", "one item", "two items", "Of."]


def test_page_without_structure():
    page = "<div><a href=1>Home</a> <a href=2>About</a></div><div><p>This page has no structure at all, but it has paragraphs of text.</p><p>Short one here.</p><p>Another paragraph which is quite long, and so on and so forth, as they are.</p></div><div><a>Imprint</a></div>"
    assert h.main_text(page).count("\n") == 2 and "Short one here." in h.main_text(page) and "Home" not in h.main_text(page)


def test_names_of_elements():
    p = "<p>A paragraph with a good many words in it, and a full stop at its end.</p>"
    kept = lambda page: len(h.main_text(page.replace("P", p))) > 0
    assert kept('<div class="has-sidebar"><div id="content">P</div></div>') and kept("<form><main>P</main></form>") and kept('<article><header><h1>Head line</h1></header>P</article>')
    for page in ('<div class="sidebar"><div class="content">P</div></div>', '<div id="comments"><article>P</article></div>', "<form>P</form>", "<div hidden>P</div>", '<div class="cookieConsent">P</div>', "<header>P</header>"):
        assert not kept(page), page


PROSE = ["The first of these paragraphs says what the page is about, at some length.", "A second one goes on from there and gives the reasons that one may have for it.", "In the end there is a third paragraph, which sums up what was said before it."]


def paragraphs(own=PROSE):
    return "".join(f"<p>{p}</p>" for p in own)


@pytest.mark.parametrize(
    "page,want",
    [
        (f'<article><h2 id="related-work">Related work</h2>{paragraphs()}</article>', ["Related work", *PROSE]),
        (f'<article><h1>A title of it</h1>{paragraphs()}<h2 id="sharing">Sharing</h2>{paragraphs()}</article>', ["A title of it", *PROSE, "Sharing", *PROSE]),
        (f'<section id="comments-on-theory">{paragraphs()}</section>', PROSE),
        (f'<div class="ad-hoc-networks">{paragraphs()}</div>', PROSE),
        ("<article><p>It holds that</p><p><math><mi>a</mi><mo>=</mo><mi>b</mi><annotation>a=b</annotation></math></p><p>for all of them, as was shown.</p></article>", ["It holds that", "a=b", "for all of them, as was shown."]),
    ],
)
def test_names_that_only_look_like_asides(page, want):
    assert h.main_text(page).split("\n") == want


#: Pages without article or main, as people write them, with the text that a reader would take.
BY_HAND = [
    (
        f"""<body><div id="top"><a href="/">Home</a> | <a href="/x">Archive</a> | <a href="/y">Contact</a></div>
        <table><tr><td><font size=5>On the keeping of bees</font></td></tr><tr><td>{paragraphs()}<p>See also:</p><p><a href="/q">The book of hives</a></p>{paragraphs()}</td></tr></table>
        <div class="copyright">Copyright 2003 by the keeper of this site, who reserves all rights to it.</div></body>""",
        ["On the keeping of bees", *PROSE, "See also:", "The book of hives", *PROSE],
    ),
    (
        f"""<body><div class="site-header"><div>My journal</div><p>Notes from a small town on the coast, and of the people in it.</p></div>
        <div class="sidebar-left"><p>About me: I live here, and I write down what happens in this town.</p><ul><li><a>June</a></li><li><a>May</a></li></ul></div>
        <div><h2>Rain</h2><p>It rained.</p>{paragraphs()}<p>Wet feet</p><p>It was good that I had taken the old boots along with me, after all.</p></div>
        <div id="comments"><p>What a fine piece this is, I have read it with great pleasure today.</p><p>Me too, and I hope that there will be more of these notes soon.</p></div></body>""",
        ["Rain", "It rained.", *PROSE, "Wet feet", "It was good that I had taken the old boots along with me, after all."],
    ),
    (
        f"""<body><ul><li><a>News</a></li><li><a>Sport</a></li><li>Weather</li><li><a>Money</a></li></ul><div class="story"><h1>Bridge opens</h1><h3>By a writer</h3>{paragraphs()}
        <div class="ad-banner">Cars at half the price, but only until the end of this month, so come and see.</div>{paragraphs()}<blockquote>It stands</blockquote>{paragraphs()}</div>
        <div class="newsletter-signup"><p>Get the best of our stories in your mail on every morning of the week.</p></div></body>""",
        ["Bridge opens", "By a writer", *PROSE, *PROSE, "It stands", *PROSE],
    ),
]


@pytest.mark.parametrize("name", ["reader-comments", "comment-thread", "user_comments", "commentlist", "share-buttons", "socialMedia", "related-posts", "sidebar-left", "cookie-bar", "latest-comments-list", "newsletter-box", "comments-wrapper", "comment-wrap", "sidebar-wrapper", "footer-wrapper", "nav-wrap", "cookie-wrap", "comments-open", "is-advert", "comments-page", "discussion", "feedback", "byline", "trending", "outbrain", "user-reviews"])
def test_names_of_asides_within_an_article(name):
    for key in ("class", "id"):
        page = f'<article><h1>A title of it</h1>{paragraphs()}<div {key}="{name}"><p>A sentence of some length that is not of the article, though it is in it.</p><p>And so is this.</p></div></article>'
        assert h.main_text(page).split("\n") == ["A title of it", *PROSE]


@pytest.mark.parametrize("name", ["comments-wrapper", "comment-wrap", "sidebar-wrapper", "footer-wrapper", "nav-wrap", "cookie-wrap", "is-advert", "comments-page", "trending", "user-reviews"])
def test_names_of_asides_beside_an_article(name):
    page = f'<body><div class="{name}"><p>A sentence of some length that is not of the article, and stands before it.</p></div><div>{paragraphs()}</div></body>'
    assert h.main_text(page).split("\n") == PROSE


@pytest.mark.parametrize(
    "page",
    [
        f'<article id="comment-policy">{paragraphs()}</article>',
        f'<article class="post promo">{paragraphs()}</article>',
        f'<main><article class="post promo">{paragraphs()}</article></main>',
        f'<table class="menu"><tr><td>{paragraphs()}</td></tr></table>',
        f'<body class="no-comments has-sidebar"><div class="page-with-sidebar"><div class="content-sidebar-wrap">{paragraphs()}</div></div></body>',
    ],
)
def test_articles_are_not_lost(page):
    assert h.main_text(page).split("\n") == PROSE


def test_page_of_one_short_line():
    assert h.main_text("<body><p>Hello world</p></body>") == "Hello world"
    assert h.main_text('<body><p><a href="/">Hello world</a></p></body>') == "" == h.main_text(f'<div class="comments">{paragraphs()}</div>')


@pytest.mark.parametrize("many", ["<b>" * 50_000 + "<p>x</p>" * 50_000, "<b><p>Some words." * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<div>" * 50_000 + "text", "<body><p>" * 50_000, "<li><b>x" * 50_000])
def test_unclosed_elements_take_linear_time(many):
    began = time.perf_counter()
    h.main_text(many)
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize("page,want", BY_HAND)
def test_pages_without_article(page, want):
    assert h.main_text(page).split("\n") == want


def test_the_cut_decides_blocks_of_weak_markup():
    blocks = [b for page, _ in BY_HAND for b in h.labelled(page)]
    flipped = [(text, keep) for text, odds, keep in blocks if keep != (odds > 0)]
    assert len(flipped) >= 0.1 * len(blocks) and ("The book of hives", True) in flipped and ("Wet feet", True) in flipped


@pytest.mark.parametrize("page", [None, "", "  \n", "<html></html>", "<p>", "<!-- never closed", "<script>x", "<p><b><i></p></b>", "&#0; &#xD800; &bogus; <", "</p></div></html>"])
def test_odd_pages(page):
    assert isinstance(h.main_text(page), str)


def test_very_long_page():
    text = h.main_text("<article>" + "<p>Some words of text here.</p>" * 20_000 + "</article>")
    assert text.count("\n") == 19_999


def cost(odds, edges, keep):
    return sum(max(x, 0) for x, k in zip(odds, keep, strict=True) if not k) + sum(max(-x, 0) for x, k in zip(odds, keep, strict=True) if k) + sum(w for a, b, w in edges if keep[a] != keep[b])


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 9)
        odds = [rng.choice([-1, 1]) * rng.random() * 3 for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        best = min(cost(odds, edges, keep) for keep in itertools.product([False, True], repeat=n))
        assert cost(odds, edges, h.minimum_cut(odds, edges)) == pytest.approx(best)


def test_pages_are_labelled_at_least_cost(spark):
    given = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    small = [p for p in [page for page, _ in BY_HAND] + given if 0 < len(h.read_blocks(p)) <= 12]
    cut = [re.sub(r"</?(nav|aside|footer|header|article|main)\b[^>]*>", "<div>", p) for p in small[:20]]  # less markup, so that neighbours count
    for page in small[:20] + [p for p in cut if len(h.read_blocks(p)) <= 12]:
        blocks, got = h.read_blocks(page), h.labelled(page)
        odds, edges = [x for _, x, _ in got], h.smoothness(blocks)
        costs = {keep: cost(odds, edges, keep) for keep in itertools.product([False, True], repeat=len(blocks))}
        least = min(costs.values())
        best = ["\n".join(t for (_, t, _), k in zip(blocks, keep, strict=True) if k) for keep, x in costs.items() if x < least + 1e-9]
        assert h.main_text(page) in best


def test_all_given_pages(spark):
    from landspark.llm.queries import op1_html_extraction

    given = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = op1_html_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(given)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", given[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(filter(None, parts)) and r["n_chars"] == len(r["text"])


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", PAGE, "y"), (1, None, None, "x"), (3, "u", "", None)], "page_id long, url string, html string, text string")
    got = h.extract(df).collect()
    assert sorted((r["n_chars"] for r in got)) == [0, 0, 0, len(h.main_text(PAGE))] and all(r["text"] is not None for r in got)
    assert h.extract(df.limit(0)).count() == 0
