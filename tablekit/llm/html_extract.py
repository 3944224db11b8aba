"""Main text of HTML pages by a minimum cut.

A page is cut into blocks of text at its block-level tags.  A classifier, a
logistic regression trained here on labelled blocks of generated pages, gives
each block the cost of calling it content or boilerplate; these are the
capacities of its edges to source and sink.  Neighbouring blocks, and blocks
that are close in the DOM, are joined by smoothness edges.  The maximum flow
separates content from boilerplate; what remains on the source's side is the
main text.

Edge cases: null and empty pages have the empty text.  Truncated markup ends
where the page does; unclosed elements are closed by what must end them.
Repeated rows are worked on one by one; an empty table gives an empty result;
ids and URLs may be null; further columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The names of HTML elements by their part in a page.
BLOCK_TAGS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template iframe object svg math canvas audio video title head textarea select button".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog header button fieldset".split())
MAIN_TAGS = frozenset("article main".split())
#: Words in class and id attributes, and roles, that tell what an element is for.
BOILER_WORDS = re.compile(r"(?<![a-z])(?:ads?|advert\w*|banner|breadcrumbs?|byline|comments?|consent|cookies?|copyright|disqus|footer|gdpr|header|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|popup|promo\w*|related|replies|reply|responses|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|tags|toolbar|topbar|widget)(?![a-z])")
MAIN_WORDS = re.compile(r"(?<![a-z])(?:article|body|content|entry|main|post|story|text)(?![a-z])")
COMMENT_NAMES = frozenset("comment comments commentlist comment-list comments-list comment-thread disqus replies responses".split())
BOILER_ROLES = re.compile(r"banner|complementary|contentinfo|dialog|form|navigation|search|alert|menu")

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(!|\?)[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_NAMING = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE = re.compile(r"(?:^|\s)role\s*=\s*[\"']?([\w-]+)", re.I)
_HIDING = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
#: An end tag of a paragraph, list item or cell is implied by what follows it.
_IMPLIED = {"p": BLOCK_TAGS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}

FEATURES = ("bias", "in_main", "in_boiler", "boiler_names", "main_names", "link_share", "words", "stops", "heading", "list_item", "hidden", "near_words", "near_links", "unmarked_words", "unmarked_near_words")


class Block:
    """A run of text between block-level tags, with the path of elements that hold it."""

    __slots__ = ("text", "path", "linked", "chars", "features")

    def __init__(self, text: str, path: tuple, linked: int):
        self.text, self.path, self.linked, self.chars = text, path, linked, len(text)


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; white space inside a block is one blank."""
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, is boilerplate, names of boilerplate, names of content, hidden, number, names of comments)
    text: list[str] = []
    linked = links = number = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html_lib.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, tuple(stack), linked))
            text.clear()
        linked = 0

    at, n, raw_until = 0, len(page), None
    while at < n:
        if raw_until:
            m = re.compile(rf"</{raw_until}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            if m is None:
                break
            at, raw_until = m.end(), None
            continue
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            chunk = page[at:end]
            text.append(chunk)
            if links:
                linked += len(chunk)
        if m is None:
            break
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            links = sum(x[0] == "a" for x in stack)
            continue
        if tag in BLOCK_TAGS:
            flush()
            while stack and (stack[-1][0] not in BLOCK_TAGS and any(x[0] == "p" for x in stack) and tag != "br" or tag in _IMPLIED.get(stack[-1][0], ())):
                stack.pop()
            links = sum(x[0] == "a" for x in stack)
        if tag in RAW_TAGS:
            raw_until = tag
            continue
        if tag in VOID_TAGS or m[4].endswith("/") and tag not in BLOCK_TAGS:
            continue
        names = " ".join(a or b or c for a, b, c in _NAMING.findall(m[4])).lower().replace("_", "-")
        role = _ROLE.search(m[4])
        boiler = tag in BOILER_TAGS or bool(role and BOILER_ROLES.match(role[1].lower()))
        number += 1
        comments = not COMMENT_NAMES.isdisjoint(names.split())
        stack.append((tag, boiler, comments or bool(names and BOILER_WORDS.search(names)), bool(names and MAIN_WORDS.search(names)), tag in HIDDEN_TAGS or bool(_HIDING.search(m[4])), number, comments))
        links += tag == "a"
    flush()
    return out


def featurize(found: list[Block]) -> None:
    sizes = [math.log1p(b.text.count(" ") + 1) / 4 for b in found]
    links = [min(1.0, b.linked / max(1, b.chars)) for b in found]
    marked = False  # whether the page says anywhere what is its content
    rows = []
    for b in found:
        inside = next((i for i, x in enumerate(b.path) if x[0] in MAIN_TAGS), None)
        said = next((i for i, x in enumerate(b.path) if x[6]), len(b.path))
        if inside is not None and said <= inside:
            inside = None  # a comment is no article, whatever its element
        inner = None  # the innermost element that says what it is for
        for tag, boiler, bad, good, _, _, comments in reversed(b.path):
            own = boiler and not (tag == "header" and inside is not None)
            if own or bad or tag in MAIN_TAGS or good:
                inner = "boiler" if own or comments or bad and tag not in MAIN_TAGS else "main"
                break
        after = b.path[inside + 1 :] if inside is not None else b.path
        marked = marked or inner == "main"
        rows.append((inside, inner, after))
    for k, (b, (inside, inner, after)) in enumerate(zip(found, rows)):
        words = b.text.count(" ") + 1
        around = [i for i in (k - 2, k - 1, k + 1, k + 2) if 0 <= i < len(found)]
        near_words = max((sizes[i] * (1 - links[i]) for i in around), default=0.0)
        b.features = (
            1.0,
            float(inside is not None),
            float(any(x[1] and not (x[0] == "header" and inside is not None) for x in after)),
            float(any(x[2] for x in after)),
            float(inner == "main"),
            links[k],
            sizes[k],
            min(1.0, sum(b.text.count(c) for c in ".,;:!?") / words),
            float(any(x[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for x in b.path)),
            float(any(x[0] == "li" for x in b.path)),
            float(any(x[4] for x in b.path)),
            near_words,
            sum(links[i] for i in around) / max(1, len(around)),
            0.0 if marked else sizes[k],
            0.0 if marked else near_words,
        )


def _labelled_pages(n: int, seed: int) -> Iterator[tuple[str, list[bool]]]:
    """Generated pages with a mark on each block: is it content?  Content is written in [..], boilerplate in {..}."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(2, 9)))
    say = lambda a, b: " ".join(word() for _ in range(rnd.randint(a, b))).capitalize() + rnd.choice([".", ".", "", "?"])
    link = lambda: f'<a href="/{word()}">{say(1, 4)}</a>'
    names = lambda *some: rnd.choice([f' class="{x}"' for x in some] + [f' id="{x}"' for x in some])
    for _ in range(n):
        parts: list[tuple[str, bool | None]] = []
        add = lambda markup, content=None: parts.append((markup, content))  # noqa: E731, B023

        def menu(tag: str = "nav", attrs: str = "") -> None:
            add(f"<{tag}{attrs}><ul>")
            for _ in range(rnd.randint(2, 7)):
                add(f"<li>{link()}</li>", False)
            add(f"</ul></{tag}>")

        def boxes(k: int) -> None:
            for _ in range(k):
                kind = rnd.randrange(7)
                if kind == 0:
                    menu("div", names("sidebar", "related-posts", "widget"))
                elif kind == 1:
                    add(f"<div{names('ad', 'advert', 'promo', 'sponsored')}>{say(3, 25)}</div>", False)
                elif kind == 2:
                    add(f"<aside>{say(3, 30)}</aside>", False)
                elif kind == 3:
                    add(f"<div{names('cookie-notice', 'notice', 'newsletter', 'banner')}><p>{say(5, 25)}</p></div>", False)
                elif kind == 4:
                    add(f"<form action=x><label>{say(1, 5)}</label></form>", False)
                elif kind == 5:
                    add(f"<p><a href=x>{say(2, 6)}</a></p>", False)
                else:
                    add(f"<p{rnd.choice([' hidden', ' style="display:none"', ' aria-hidden=true'])}>{say(2, 30)}</p>", False)

        if rnd.random() < 0.6:
            add(f"<header{rnd.choice(['', names('masthead')])}><h1>{say(1, 4)}</h1></header>", False)
        if rnd.random() < 0.8:
            menu()
        boxes(rnd.randint(0, 2))
        tag = rnd.choice(["article", "article", "main", "div", "div", "td"])
        plain = tag == "td" or tag == "div" and rnd.random() < 0.5  # nothing says what is content
        if tag == "td":
            add(f"<table><tr><td>{link()}</td>", False)
        add(f"<{tag}{names('content', 'post-body', 'entry-content', 'article-text') if tag == 'div' and not plain or tag != 'td' and not plain and rnd.random() < 0.3 else ''}>")
        if tag == "article" and rnd.random() < 0.3:
            add(f"<header><h1>{say(2, 12)}</h1></header>", True)
        else:
            add(f"<h1>{say(2, 12)}</h1>", True)
        for _ in range(rnd.randint(1, 14)):
            kind = rnd.random()
            if kind < 0.7:
                add(f"<p>{say(1, 90)}{link() if rnd.random() < 0.2 else ''}</p>", True)
            elif kind < 0.8:
                add(f"<h2>{say(1, 8)}</h2>", True)
            elif kind < 0.88:
                add(f"<ul><li>{say(2, 20)}</li></ul>", True)
            elif kind < 0.93:
                add(f"<blockquote>{say(5, 40)}</blockquote>", True)
            else:
                boxes(1)
        add("</td></tr></table>" if tag == "td" else f"</{tag}>")
        if rnd.random() < 0.4:
            each = rnd.choice(["p", "p", "article", 'article class="comment"'])
            add(f"<section{names('comments', 'comment-list', 'responses')}>")
            for _ in range(rnd.randint(1, 4)):
                add(f"<{each}>{say(3, 50)}</{each.split()[0]}>", False)
            add("</section>")
        boxes(rnd.randint(0, 2))
        if rnd.random() < 0.8:
            add(f"<footer>&copy; {say(2, 14)}</footer>", False)
        labels = [c for _, c in parts if c is not None]
        yield "<html><body>" + "".join(m for m, _ in parts) + "</body></html>", labels


@lru_cache(4)
def train(pages: int = 400, seed: int = 7, steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> tuple[float, ...]:
    """Weights of the block classifier, from `pages` generated, labelled pages: the same on every run."""
    import numpy as np

    rows, labels = [], []
    for page, marks in _labelled_pages(pages, seed):
        found = blocks(page)
        if len(found) != len(marks):
            continue  # a block that came out empty
        featurize(found)
        rows += [b.features for b in found]
        labels += marks
    x, y = np.array(rows), np.array(labels, float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= rate * (x.T @ (p - y) / len(y) * 4 + decay * w)
    return tuple(w.tolist())


def minimum_cut(costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: (cost of leaving it, cost of staying) by node, and undirected edges.

    Dinic's algorithm.  What both terminal edges of a node can carry goes straight
    through, so that only the rest is searched for.
    """
    n = len(costs)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(forth)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (leave, stay) in enumerate(costs):
        if leave > stay:
            join(source, i, leave - stay, 0.0)
        elif stay > leave:
            join(i, sink, stay - leave, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        after = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                cut = len(path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= least and k < cut:
                        cut = k
                a = to[path[cut] ^ 1]
                del path[cut:]
            elif after[a] < len(head[a]):
                e = head[a][after[a]]
                if room[e] > least and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                else:
                    after[a] += 1
            elif a == source:
                break
            else:
                a = to[path.pop() ^ 1]
                after[a] += 1


#: Capacity between neighbours, and between blocks one after the other below one parent.
ADJACENT, SIBLING = 0.3, 0.4
#: The classifier's log odds are cut off here, so that no single block outweighs its surroundings without end.
MOST_ODDS = 12.0


def label(found: list[Block], weights: tuple[float, ...]) -> list[bool]:
    """Content or not, for each block, by the minimum cut."""
    featurize(found)
    costs, edges, last = [], [], {}
    for i, b in enumerate(found):
        odds = max(-MOST_ODDS, min(MOST_ODDS, sum(f * w for f, w in zip(b.features, weights))))
        costs.append((max(0.0, odds), max(0.0, -odds)))
        # neighbours of alike use hold together; a semantic border between them lets go
        if i and b.features[1:5] == found[i - 1].features[1:5]:
            shared = sum(x[5] == y[5] for x, y in zip(b.path, found[i - 1].path))
            edges.append((i - 1, i, ADJACENT * (1 + shared) / (1 + max(len(b.path), len(found[i - 1].path)))))
        parent = b.path[-2][5] if len(b.path) > 1 else 0
        if parent in last and last[parent] != i - 1 and found[last[parent]].features[1:5] == b.features[1:5]:
            edges.append((last[parent], i, SIBLING))
        last[parent] = i
    return minimum_cut(costs, edges)


def main_text(page: str, weights: tuple[float, ...]) -> str:
    found = blocks(page)
    return " ".join(b.text for b, content in zip(found, label(found, weights)) if content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and the main text of every page."""
    source = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).cast("string").alias("__html"))
    weights = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [main_text(x, weights) if x else "" for x in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string())], ["__id", "__url", "text"])

    kinds = [source.schema[c].dataType.simpleString() for c in ("__id", "__url")]
    found = source.mapInArrow(run, f"__id {kinds[0]}, __url {kinds[1]}, text string")
    return found.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), "text")
