import html
import itertools
import random
import re
import time

import pytest

from georisk.llm import catalog, html_extract as hx
from georisk.llm.common import read_table

PAGE = """<!DOCTYPE html><html lang=en><head><title>Site name</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="home has-sidebar"><header><h1>My blog</h1><p>The header of every page, with a sentence.</p></header>
<nav><ul><li><a href="/a">Home</a><li><a href='/b>c'>News and more</a></ul></nav>
<div class="cookie-notice">We use cookies. Please accept them all.</div>
<article class="post has-comments"><h2>A   title &amp; more</h2><p>First <b>bold</b> paragraph&nbsp;of the text.
<p>Short.<br>Second line &lt;tag&gt; a &lt b, 2 < 3 here.<!-- hidden > comment --><div class="ad">Buy this now. It is cheap.</div>
<ul><li>one point<li>another point</ul><form action="/s"><label>Mail</label><input name=m><button>Send it</button></form>
<aside>Related: something else that is long enough to look like text.</aside><table><tr><td>cell 1<td>cell 2</table></article>
<section id="comments"><article class="comment"><p>Great article. I liked it a lot, thank you.</p></article></section>
<div role="complementary"><p>Sidebar text with a whole sentence in it.</p></div>
<footer>&copy; 2024 &middot; all rights</footer></body></html>"""

TEXT = """A title & more
First bold paragraph of the text.
Short. Second line <tag> a < b, 2 < 3 here.
one point
another point
cell 1
cell 2"""


def test_main_text_of_an_article_page():
    assert hx.main_text(PAGE) == TEXT


def test_page_without_semantic_elements():
    body = " ".join(["A sentence of the story that goes on for some time."] * 6)
    page = (f"<div><a href=/>Home</a></div><div><a href=/x>Some links</a> | <a href=/y>Others</a></div><div><p>{body}</p>"
            f"<p>Yes.</p><p>{body}</p></div><div><a href=/z>Imprint</a></div>")
    assert hx.main_text(page) == f"{body}\nYes.\n{body}"  # smoothness keeps the short paragraph in between


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<p", ""), ("<script>x", ""), ("<!-- x", ""), ("</div></p>", ""),
    ("<article><p>One two three four. Five</", "One two three four. Five"),
    ("<article><p>Cut entity &am", "Cut entity &am"),
    ("<article><p title=\"a>b\">Kept as a whole.</p><p title=\"open>Also kept.</p></article>", "Kept as a whole.\nAlso kept."),
    ("<ARTICLE><P>&#x48;ello &#119;orld&hellip;</P></ARTICLE>", "Hello world…"),
])
def test_odd_pages(page, text):
    assert hx.main_text(page) == text


STORY = ["The committee met on Tuesday and agreed that the old bridge would have to be closed for repairs.",
         "Nobody could say how long the work would take, although most expected that it would last until spring.",
         "A second crossing, further down the river, is to open next week, with a lane for buses and bicycles."]
LINKS = '<a href="/1">Home</a> <a href="/2">World news</a> <a href="/3">Sport</a> <a href="/4">Contact us</a>'
WRAPPERS = ["post", "entry-content", "story-body", "main content no-sidebar", "c-17", "page-with-sidebar"]
EXTRAS = [  # markup inside the story and what it adds to the text
    ("<p>Yes.</p>", "Yes."), ('<p><a href="/s">Read the report</a></p>', "Read the report"), ("<p>***</p>", "***"),
    ("<h2>Later</h2>", "Later")]
PARTS = ["main-menu", "entry-footer", "post-navigation", "content-sidebar", "story-share", "article-ad", "main-header", "post-meta"]


def plain_pages():
    """Pages of div and p only: 24 of a wrapper and an extra, each with two of the named parts around or inside the story."""
    for i, (wrapper, (markup, text)) in enumerate(itertools.product(WRAPPERS, EXTRAS)):
        before, inside = PARTS[i % 8], PARTS[(i * 3 + 1) % 8]
        page = (f'<body><div class="{before}">{LINKS}</div><div>{LINKS}</div><div class="{wrapper}"><p>{STORY[0]}</p>{markup}'
                f'<p>{STORY[1]}</p><div class="{inside}"><p>Sign up for our letter. It comes every day.</p></div><p>{STORY[2]}</p>'
                f'</div><div>{LINKS}</div><div><a href="/i">Imprint</a></div></body>')
        yield page, "\n".join([STORY[0], text, *STORY[1:]])


def test_pages_without_semantic_elements_come_from_the_cut():
    pages, flipped, w = list(plain_pages()), 0, hx.Weights()
    assert len(pages) >= 20
    for page, text in pages:
        assert hx.main_text(page) == text, page
        found = hx.blocks(page)
        scores = [hx.score(b, w) for b in found]
        flipped += sum((s > 0) != x for s, x in zip(scores, hx.minimum_cut(scores, hx.smoothness(found, w))))
    assert flipped >= 12  # blocks whose own score says otherwise


@pytest.mark.parametrize("name,bad", [(x, True) for x in PARTS + ["body-ad", "related-content", "comment-body"]] + [
    ("entry-header", False), ("has-comments", False), ("content-with-sidebar", False), ("post", False), ("readable", False)])
def test_names_of_parts(name, bad):
    page = f'<article><p>{STORY[0]}</p><div class="{name}"><p>{STORY[1]}</p></div><p>{STORY[2]}</p></article>'
    assert hx.main_text(page) == "\n".join([STORY[0], STORY[2]] if bad else STORY)


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_linked_items_of_an_article_stay(n):
    items = "".join(f"<li><a href=/{i}>source {i}</a>" for i in range(n))
    page = f"<nav><ul>{items}</ul></nav><article><p>{STORY[0]}</p><ul>{items}</ul><p>{STORY[1]}</p></article>"
    assert hx.main_text(page).split("\n") == [STORY[0], *(f"source {i}" for i in range(n)), STORY[1]]


def test_nested_pages_take_linear_time():
    def seconds(n):
        page = "<div>" * n + "</span></p>" * n + "<h1><center>" * n + "<li>x" * n + "</b></form>" * n
        start = time.process_time()
        hx.blocks(page)
        return time.process_time() - start
    small = max(min(seconds(1_000) for _ in range(3)), 0.01)
    assert seconds(8_000) < 24 * small  # quadratic: 64


def cut_cost(labels, scores, edges):
    return (sum(abs(s) for s, x in zip(scores, labels) if (s > 0) != x and s != 0)
            + sum(c for a, b, c in edges if labels[a] != labels[b]))


def test_minimum_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 9)
        scores = [rng.choice([rng.uniform(-2, 2), 0.0, float(rng.randint(-3, 3))]) for _ in range(n)]
        edges = [(i - 1, i, rng.uniform(0, 2)) for i in range(1, n)]
        edges += [tuple(rng.sample(range(n), 2)) + (rng.choice([0.5, 1.0]),) for _ in range(rng.randint(0, n)) if n > 1]
        got = hx.minimum_cut(scores, edges)
        best = min(cut_cost(x, scores, edges) for x in itertools.product([False, True], repeat=n))
        assert cut_cost(got, scores, edges) == pytest.approx(best)


def test_long_page_is_kept_whole():
    page = "<body><nav><a href=/>x</a></nav><article>" + "<p>Word after word.</p>" * 20_000 + "</article>"
    assert hx.main_text(page) == "\n".join(["Word after word."] * 20_000)
    nested = "<div>" * 3000 + "<article><p>Deep inside the page, a sentence.</p>"
    assert hx.main_text(nested) == "Deep inside the page, a sentence."
    loose = hx.main_text("<div>" + "<p>maybe</p><p><a href=/>link</a></p>" * 3000)  # undecided blocks all through
    assert loose == "" or set(loose.split("\n")) <= {"maybe", "link"}


def plain(page):
    """The article of the given tables' pages by pattern: they nest nothing inside but h1, p, b and br."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    if not body:
        return ""
    out = []
    for piece in re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", body[1])):
        t = " ".join(html.unescape(re.sub(r"</?b>", "", piece.replace("<br>", " "))).split())
        if t:
            out.append(t)
    return "\n".join(out)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    want = {r["page_id"]: (r["url"], plain(r["html"])) for r in read_table(spark, sf, "pages").collect()}
    got = catalog.QUERIES["op1_html_extraction"](spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["url"], r["text"]) == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_edge_rows(spark):
    d = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (1, None, PAGE, None), (1, None, PAGE, None)],
                              "page_id long, url string, html string, text string")
    got = hx.extract(d)
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [(0, ""), (1, ""), (1, TEXT), (1, TEXT)]
    assert hx.extract(d.limit(0)).count() == 0
