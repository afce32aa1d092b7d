"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of events: words score positive, tags negative, and the enclosing elements
(names, classes, ids) shift the score of their words.  All weights are log-odds counted on labelled
pages.  Only tags of blocks count, without the two that part one paragraph from the next, so that
short paragraphs and headings of a plain page do not end its content.  One linear scan finds the contiguous region
with the highest sum; inside it, blocks that their enclosing elements set apart (an advert between
two paragraphs) are left out, and nothing else.

Labelled pages are ``(html, content blocks)`` pairs.  ``labelled_pages`` makes a documented set from
rules; ``fit`` takes any other.

Defined results: null, empty or blank pages and pages without content give an empty text; unclosed
and misnested tags are taken as a browser would roughly take them; a quote that never closes ends
with its tag; scripts, styles, comments and tags end at their end, or with the page.  Of regions with
equal sums the first one counts.  Repeated rows give repeated results, an empty table gives none, and
columns of other names are not read.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is never text of the page.
SILENT = ("script", "style", "noscript", "template", "title", "svg", "math", "textarea", "select",
          "button", "iframe", "object", "canvas", "audio", "video")
# Elements that end the block before them.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre"
    " section summary table tbody tfoot thead tr ul".split())
# Block elements that hold blocks; only these enclose what follows them.
CONTAINERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 pre dt dd li tr summary legend".split())
SPACED = frozenset("br td th".split())
# Elements whose names, like classes and ids, tell content from the rest.
TELLING = frozenset("article main nav header footer aside form menu dialog address".split())
_MAIN = frozenset(("article", "main"))

# A quote counts after "=" only, and only if it is closed again.
_ATTRIBUTES = r"(?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+"
_EVENT = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(SILENT) + r")(?=[\s/>])" + _ATTRIBUTES + r"(?:>|\Z).*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(" + _ATTRIBUTES + r")(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|([^<]+|<)", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(
    r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[a-z]+|\d+")


@dataclass
class Block:
    text: str
    words: int
    linked: int             # words inside links
    tags: int               # block tags since the block before, but for two
    context: frozenset[str]  # names, classes and ids of enclosing elements


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str], bool]] = []
    text: list[str] = []
    own: frozenset[str] = frozenset()
    tags = linked = links = hidden = 0

    def end() -> None:
        nonlocal tags, linked
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                around = own.union(*(names for _, names, _ in stack))
                out.append(Block(" ".join(words), len(words), min(linked, len(words)),
                                 max(tags - 2, 0), around))
                tags = 0
            linked = 0

    for event in _EVENT.finditer(page):
        _, closing, name, rest, chars = event.groups()
        if chars is not None:
            if not hidden:
                text.append(chars)
                if links:
                    linked += len(chars.split())
            continue
        if name is None:
            continue
        name = name.lower()
        tags += name in BLOCKS
        if name == "a":
            links = 0 if closing else 1
        elif name in SPACED:
            text.append(" ")
        elif name in BLOCKS:
            end()
            own = frozenset()
            if closing:
                if name in CONTAINERS and any(n == name for n, _, _ in stack):
                    while stack:
                        last, _, was_hidden = stack.pop()
                        hidden -= was_hidden
                        if last == name:
                            break
                continue
            names = {name} & TELLING
            for found in _NAMES.findall(rest):
                names.update("." + p for p in _PART.findall("".join(found).lower()))
            names = frozenset(names)
            if name in CONTAINERS:
                unseen = bool(_HIDDEN.search(rest))
                hidden += unseen
                stack.append((name, names, unseen))
            else:
                own = names
    end()
    if any(b.context & _MAIN for b in out):
        for b in out:
            if not b.context & _MAIN:
                b.context |= {"outside-main"}
    return out


@dataclass(frozen=True)
class Weights:
    word: float
    tag: float
    link: float
    context: dict[str, float]
    holders: frozenset[str]  # names, classes and ids that content elements have

    def around(self, block: Block) -> float:
        """What the enclosing elements add to the score of each word and tag."""
        own = [self.context.get(c, 0.0) for c in block.context]
        return sum(w for w in own if w > 0) / 2 + 2 * sum(w for w in own if w < 0)

    def apart(self, block: Block) -> bool:
        """Whether the enclosing elements tell that the block is not content."""
        return self.word + self.around(block) <= 0

    def inside(self, block: Block) -> bool:
        """Whether a content element holds the block."""
        return any(self.context.get(c, 0.0) > 0 for c in block.context if c in self.holders)

    def region(self, block: Block) -> tuple[float, float]:
        """Scores of the tags before the block and of its words and links.

        Inside a content element neither links nor tags end the content; what is set apart there
        does not end it either, and does not belong to it.
        """
        around = self.around(block)
        words = block.words * (self.word + around)
        if self.inside(block):
            return 0.0, max(words, 0.0)
        return block.tags * min(self.tag + around, 0.0), words + block.linked * self.link


def fit(pages: Iterable[tuple[str, list[str]]]) -> Weights:
    """Log-odds of words, tags, links and contexts inside against outside the content."""
    words, tags, linked = [1.0, 1.0], [1.0, 1.0], [1.0, 1.0]
    context: tuple[Counter, Counter] = (Counter(), Counter())
    holders: set[str] = set()
    for page, content in pages:
        wanted = Counter(content)
        for block in blocks(page):
            inside = int(wanted[block.text] > 0)
            wanted[block.text] -= inside
            words[inside] += block.words
            tags[inside] += block.tags
            linked[inside] += block.linked
            context[inside].update(block.context)
            if inside:
                holders.update(c for c in block.context if c[0] == "." or c in _MAIN)
    events = [words[k] + tags[k] for k in (0, 1)]
    n = [1 + sum(context[k].values()) for k in (0, 1)]
    odds = {name: log(((context[1][name] + 0.5) / n[1]) / ((context[0][name] + 0.5) / n[0]))
            for name in context[0].keys() | context[1].keys()}
    # Contexts seen about as often inside as outside say nothing.
    told = {c: max(-3.0, min(3.0, w)) for c, w in odds.items() if abs(w) > 1.2}
    return Weights(
        word=max(0.1, log((words[1] / events[1]) / (words[0] / events[0]))),
        tag=min(-0.1, log((tags[1] / events[1]) / (tags[0] / events[0]))),
        link=min(-0.1, log((linked[1] / words[1]) / (linked[0] / words[0]))),
        context=told, holders=frozenset(holders))


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous part with the highest positive sum; the first of equals."""
    best = total = 0.0
    bounds, start = (0, 0), 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(page: str | None, weights: Weights) -> str:
    found = blocks(page or "")
    first, last = best_region([score for b in found for score in weights.region(b)])
    return "\n\n".join(b.text for b in found[first // 2:last // 2] if not weights.apart(b))


# Names under which page makers put what is not the article; fixed values of the labelled set.
ASIDES = (
    ("nav", "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs pagination toc"),
    ("header", "header masthead site-header page-header top topbar branding banner"),
    ("footer", "footer site-footer page-footer bottom copyright legal imprint"),
    ("aside", "sidebar side-bar widget widgets related related-posts recommended trending popular"
              " more-stories rail teaser"),
    ("div", "ad ads advert advertisement adverts sponsored promo promotion banner-ad adslot"
            " outbrain taboola"),
    ("div", "notice cookie cookies cookie-notice consent gdpr alert popup modal overlay paywall"
            " warning message disclaimer"),
    ("form", "form search search-form login signup newsletter subscribe subscription contact"
             " comment-form"),
    ("section", "comments comment reader-comments replies responses discussion respond disqus"
                " comment-list reviews"),
    ("div", "share sharing social social-links tags meta byline author-box author-bio"),
)
HOLDERS = ("article", "main", "div class=content", "div class=post", "div id=article-body",
           "section class=story", "div class=entry-content", "div class=text", "div role=main")


def labelled_pages(count: int = 400, seed: int = 11) -> Iterator[tuple[str, list[str]]]:
    """Pages put together from rules, with the blocks that are their content."""
    rng = random.Random(seed)

    def words(n: int) -> str:
        return " ".join("".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randint(2, 9)))
                        for _ in range(n))

    def tag(name: str, kind: str | None, inner: str) -> str:
        return f"<{name}" + (f' class="{kind}"' if kind else "") + f">{inner}</{name}>"

    def aside(k: int) -> str:
        name, kinds = ASIDES[k]
        kind = rng.choice(kinds.split())
        element = rng.choice([name, "div", name])
        if element == name and name != "div" and rng.random() < 0.4:
            kind = None
        if k in (0, 3) or rng.random() < 0.2:
            inner = "<ul>" + "".join(f'<li><a href="/{i}">{words(rng.randint(1, 4))}</a></li>'
                                     for i in range(rng.randint(2, 9))) + "</ul>"
        elif k == 7:
            inner = "".join(tag("div", "comment", f"<p>{words(rng.randint(3, 40))}</p>")
                            for _ in range(rng.randint(1, 6)))
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<h3>{}</h3>"]).format(words(rng.randint(3, 25)))
        return tag(element, kind, inner)

    for _ in range(count):
        content = [words(rng.randint(4, 9))] + [words(rng.randint(5, 120))
                                                for _ in range(rng.randint(1, 9))]
        body = [f"<h1>{content[0]}</h1>"]
        for text in content[1:]:
            if rng.random() < 0.2:
                start, rest = text.split(" ", 1)
                text = f'<a href="/{start}">{start}</a> {rest}'
            body.append(rng.choice(["<p>{}</p>"] * 6 + [
                "<p><b>{}<br>", "<h2>{}</h2>", "<h3>{}</h3>", "<ul><li>{}</li></ul>",
                "<ol><li>{}</li></ol>", "<blockquote>{}</blockquote>"]).format(text))
            if rng.random() < 0.12:
                body.append(aside(rng.choice((3, 4, 5, 8))))
        holder = rng.choice(HOLDERS + ("article", "article"))
        before = "".join(aside(k) for k in (1, 0, 5, 4) if rng.random() < 0.6)
        after = "".join(aside(k) for k in (8, 3, 7, 6, 4, 2) if rng.random() < 0.6)
        page = (f"<html><head><title>{content[0]}</title></head><body>{before}<{holder}>"
                + "".join(body) + f"</{holder.split()[0]}>{after}</body></html>")
        yield page, content


def extracted(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id",
              url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text``, ``n_chars``; no shuffle."""
    weights = weights or fit(labelled_pages())

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return (
        pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                     F.col(f"`{html_col}`").cast("string").alias("html"))
        .mapInArrow(batches, f"id {kind}, url string, text string, n_chars long")
        .withColumnsRenamed({"id": id_col, "url": url_col}))
