"""Main text of HTML pages by a minimum cut over their blocks.

A page is read into blocks of text in page order.  A small linear classifier
turns what is known of a block (its containers, length, links, punctuation)
into a signed score, which becomes the capacity to the content terminal or to
the boilerplate terminal: the cost of giving the block the other label.  The
names of the page's parts are one feature of that score; the edges around a
block can outweigh it.  Smoothness edges cost their capacity if the two blocks
they join get different labels: between neighbours in page order, and between
blocks that are close in the element tree; they are weak where a part begins.  The cheapest labelling is the minimum cut; maximum flow
finds it, and the blocks that can still be reached from the content terminal
are the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and words that name parts of a page.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_CONTENT = frozenset("""nav footer aside form button select option menu dialog noscript svg math canvas audio video object
    fieldset head map legend datalist""".split())
CONTENT = frozenset("article main".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul""".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
CLOSABLE = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("ul ol dl table tbody thead tfoot select div section article main body".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BAD_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
    navigation menu sidebar footer header masthead comment comments commentlist disqus cookie cookies consent gdpr notice popup
    modal overlay meta newsletter subscribe subscription share sharing social related recommended recommendations breadcrumb
    breadcrumbs pagination pager login signup signin widget toolbar disclaimer search reply replies respond""".split())
TITLED = frozenset("article entry post story".split())
STATES = frozenset("has no not with without".split())  # has-sidebar says what the page has, not what the element is

ATTRIBUTES = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+"""
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<raw>script|style|textarea|title|template|iframe|noembed|noframes|xmp)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\b[^>]*>|\Z)
    |<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>{ATTRIBUTES})>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>
    |</?[a-zA-Z][^>]*\Z|</?\Z|</[^a-zA-Z>][^>]*>?|</>""", re.S | re.I | re.X)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME = re.compile(r"[a-z0-9]+")
SENTENCE_END = re.compile("[.!?…。！？]")


@dataclass(frozen=True)
class Weights:
    """Classifier weights and capacities of the smoothness edges."""

    content_part: float = 3.0
    other_part: float = -3.5
    header_in_content: float = -1.0
    paragraph: float = 0.6
    heading: float = 0.2
    list_item: float = -0.4
    per_word: float = 0.05
    most_words: int = 40
    links: float = -1.8
    sentence: float = 0.5
    start: float = -0.8
    neighbour: float = 0.6
    other_parent: float = 0.3
    across: float = 0.15
    same_parent: float = 0.4
    same_grandparent: float = 0.2


@dataclass
class Block:
    text: str
    tag: str
    good: bool
    bad: bool
    header: bool
    parent: int
    grandparent: int
    linked: int  # characters inside links


def _names_other_part(token: str) -> bool:
    """Whether a class or id names boilerplate; a bad word beside a good one is bad (main-menu, entry-footer).

    An entry-header, like a header element, holds the title of what it heads.
    """
    words = NAME.findall(token)
    stop = next((i for i, x in enumerate(words) if x in STATES), len(words))
    words = set(words[:stop])
    return bool(words & BAD_NAMES) and not (words & TITLED and words & BAD_NAMES == {"header"})


def _part(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether the element names itself a content part, or another part of the page."""
    good, bad = name in CONTENT, name in NOT_CONTENT
    if attributes and "=" in attributes or "hidden" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "role":
                bad |= value in BAD_ROLES
                good |= value in ("main", "article")
            elif key in ("class", "id") and name not in ("html", "body"):
                bad |= not good and any(map(_names_other_part, value.split()))
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                bad = True
            elif key == "style":
                bad |= "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", "")
    return good, bad


def blocks(page: str) -> list[Block]:
    """Text blocks in page order, white space collapsed, character references decoded."""
    out: list[Block] = []
    # of each open element: name, number, good, bad, header, and which elements that a start tag can close are open in its scope
    stack = [("", 0, False, False, False, frozenset())]
    opened: Counter[str] = Counter()  # only what is open is searched for, and then closed: a page takes linear time
    parts: list[str] = []
    linked, in_link, count, at = 0, False, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                name, _, good, bad, header, _ = stack[-1]
                out.append(Block(text, name, good, bad, header, stack[-2][1] if len(stack) > 1 else 0,
                                 stack[-3][1] if len(stack) > 2 else 0, linked))
            parts.clear()
        linked = 0

    def pop_to(depth: int):
        flush()
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    def text(piece: str):
        nonlocal linked
        if piece:
            parts.append(piece)
            if in_link:
                linked += len(piece.strip())

    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            if m["raw"]:
                parts.append(" ")
            continue
        name, attributes = name.lower(), m["attributes"] or m["attributes2"] or ""
        if m["end"] or m["end2"]:
            if name == "a":
                in_link = False
            if opened[name] > 0:
                pop_to(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == name))
            elif name not in INLINE:
                flush()
            continue
        if name == "br" or name in INLINE or name in VOID:
            if name == "a":
                in_link = True
            if name == "hr":
                flush()
            elif name == "br":
                parts.append(" ")
            if name in VOID or not attributes:
                continue
            good, bad = _part(name, attributes)
            if not bad:
                continue
            # an inline advert is a block of its own
        else:
            good, bad = _part(name, attributes)
            in_link = False
        flush()
        if name in CLOSES_P and "p" in stack[-1][5]:
            pop_to(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == "p"))
        if name == "body" and opened["head"] > 0:
            pop_to(next(d for d in range(1, len(stack)) if stack[d][0] == "head"))
        closes = SAME_CLOSES.get(name, frozenset())
        while stack[-1][5] & closes:
            pop_to(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] in closes))
        if attributes.endswith("/") and name in INLINE:
            continue
        count += 1
        top = stack[-1]
        header = top[4] or name == "header"
        inside = top[2] or good
        opened[name] += 1
        stack.append((name, count, inside, top[3] or bad or name == "header" and not inside, header,
                      frozenset() if name in SCOPES else top[5] | {name} if name in CLOSABLE else top[5]))
    text(page[at:])
    flush()
    return out


def score(b: Block, w: Weights) -> float:
    """Positive for content, negative for boilerplate."""
    n = len(b.text.split(None, w.most_words))
    s = w.start + w.per_word * n + w.links * min(b.linked / len(b.text), 1.0)
    if SENTENCE_END.search(b.text):
        s += w.sentence
    if b.tag in ("p", "blockquote", "pre"):
        s += w.paragraph
    elif b.tag == "li":
        s += w.list_item
    elif len(b.tag) == 2 and b.tag[0] == "h":
        s += w.heading
    if b.bad:  # a part of its own, inside an article too
        return s + w.other_part
    return s + (w.content_part + (w.header_in_content if b.header else 0) if b.good else 0)


def smoothness(found: list[Block], w: Weights) -> list[tuple[int, int, float]]:
    """Edges between neighbours, and from a block to the last one under the same parent or grandparent.

    Between blocks of different parts no edge is stronger than ``across``.
    """
    edges, by_parent, by_grandparent = [], {}, {}

    def join(i: int, j: int, capacity: float):
        a, b = found[i], found[j]
        edges.append((i, j, capacity if (a.bad, a.good) == (b.bad, b.good) else min(capacity, w.across)))

    for i, b in enumerate(found):
        if i:
            join(i - 1, i, w.neighbour if b.parent == found[i - 1].parent else w.other_parent)
        for table, key, capacity in ((by_parent, b.parent, w.same_parent), (by_grandparent, b.grandparent, w.same_grandparent)):
            if key in table:
                join(table[key], i, capacity)
            table[key] = i
    return edges


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of the cheapest cut; True is the content side, the smallest one if several are cheapest.

    A block whose score is larger than all its edges together has its label in
    every cheapest cut, so it is joined to its terminal first: its edges become
    scores of its neighbours.  What is left goes through maximum flow.
    """
    n = len(scores)
    r = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(r[i]) > sum(near[i].values()):
            label[i] = r[i] > 0
            for j, c in near[i].items():
                r[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    side = _source_side(r, near, [i for i in range(n) if label[i] is None])
    return [i in side if label[i] is None else label[i] for i in range(n)]


def _source_side(r: list[float], near: list[dict[int, float]], nodes: list[int]) -> set[int]:
    """Maximum flow from nodes of positive score to nodes of negative score along ``near``'s capacities.

    Changes ``r`` and ``near`` to the residual graph and returns the nodes that
    still reach an unused positive score.  A node that reaches no negative
    score any more can't do so later, so its region is settled at once.
    """
    small, settled = 1e-9, set()
    for source in nodes:
        while r[source] > small and source not in settled:
            came, queue, goal = {source: source}, [source], None
            for i in queue:
                if r[i] < -small:
                    goal = i
                    break
                for j, c in near[i].items():
                    if c > small and j not in came and j not in settled:
                        came[j] = i
                        queue.append(j)
            if goal is None:
                settled.update(queue)
                break
            path, i = [], goal
            while i != source:
                path.append((came[i], i))
                i = came[i]
            flow = min(r[source], -r[goal], min(near[a][b] for a, b in path))
            for a, b in path:
                near[a][b] -= flow
                near[b][a] += flow
            r[source] -= flow
            r[goal] += flow
    return settled


def main_text(page: str | None, w: Weights = Weights()) -> str:
    """The content blocks of a page joined by newlines; empty for null, empty and text-free pages."""
    found = blocks(page) if page else []
    labels = minimum_cut([score(b, w) for b in found], smoothness(found, w))
    return "\n".join(b.text for b, kept in zip(found, labels) if kept)


def extract(pages: DataFrame, w: Weights = Weights(), id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``; a null html is an empty page.

    The whole html is read, nothing is cut or capped.  Repeated rows and null
    ids stay as they are; other columns are not read.
    """
    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py(), w) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return (rows.mapInArrow(run, "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
