"""HTML extraction by consensus host paths.

Pages of a host share templates.  Each page scores its containers by the running text
below them against links and boilerplate, and votes for their generalised paths (tags
and classes from the body down, digits masked).  Spark adds the votes per host, and all
pages are extracted anew from the container with the winning path; a page on which it
holds little falls back on its own best container, as does a page without a host.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_if_small
from tidemark.session import staged

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|object|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<rest2>[^>]*)>"
    r"|<[!?][^>]*>"
    r"|<(?=[a-z/!?])[^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CONTAINERS = frozenset(
    "body main article section div nav header footer aside form ul ol dl menu table fieldset "
    "blockquote figure details dialog button".split()
)
_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre tr td th tbody thead tfoot figcaption address hr caption "
    "summary legend center html head option label".split()
)
_NEVER = frozenset("nav footer aside form menu dialog button head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_NAMES = frozenset(
    "nav navbar navigation menu menubar topbar toolbar sidebar side rail footer foot colophon masthead header "
    "siteheader ad ads advert adverts advertisement advertising adbox banner promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay subscribe subscription "
    "newsletter signup login share sharing social related recommended recommendations breadcrumb breadcrumbs "
    "crumbs comment comments commentlist disqus replies respond reply pagination pager paging widget widgets "
    "legal copyright search skip tags taglist outbrain taboola".split()
)
_PARTS = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
MENU_LINKS = 3  # links that make a list a menu, if nearly all its text is in them
MENU_SHARE = 0.8
LEAST_TEXT = 40  # letters outside links that make a block running text
PENALTY = 0.1  # of a container's text that boilerplate next to it can cost
SHARE = 0.5  # of the best score of a page, from which a path is voted for and taken


@dataclass
class Page:
    """Containers (parent, path, whether boilerplate) and blocks of a page in order.

    ``never`` marks what is boilerplate by its tag or role, or is a menu; ``named`` what only its
    names say so of.  ``skipped`` is the outcome for a container and all below it.
    """

    parents: list[int] = field(default_factory=lambda: [-1])
    tags: list[str] = field(default_factory=lambda: [""])
    paths: list[str] = field(default_factory=lambda: [""])
    never: list[bool] = field(default_factory=lambda: [False])
    named: list[bool] = field(default_factory=lambda: [False])
    article: list[bool] = field(default_factory=lambda: [False])
    skipped: list[bool] = field(default_factory=lambda: [False])
    links: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _never(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element is a menu, form or the like by its tag or role."""
    if tag in _NEVER or (tag == "header" and not inside):
        return True
    return attributes.get("role", "").lower() in _ROLES or attributes.get("aria-hidden") == "true"


def _named(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether the names of an element are those of a notice, advert, menu or the like."""
    if tag in ("body", "main", "article"):
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    found = _NAMES.intersection(_PARTS.split(names))
    return bool(found - {"header"} if inside else found)  # an article's own header has its title


def parse(text: str) -> Page:
    """One pass over the markup; unclosed and stray tags are tolerated."""
    page = Page()
    stack, words, at, link, linked = [0], [], 0, 0, 0

    def flush() -> None:
        nonlocal linked
        block = " ".join("".join(words).split())
        if block:
            page.blocks.append((stack[-1], block, linked))
        words.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            words.append(piece)
            if link:
                linked += len(piece)

    for found in _MARKUP.finditer(text):
        add(text[at : found.start()])
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        ends = bool(found["end"] or found["end2"])
        if tag == "a":
            link = 0 if ends else 1
            if not ends:
                page.links[stack[-1]] += 1
        elif tag == "br":
            words.append(" ")
        elif tag in _BLOCKS:
            flush()
        elif tag in _CONTAINERS:
            flush()
            link = 0
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    if page.tags[stack[depth]] == tag:
                        del stack[depth:]
                        break
            else:
                rest = found["rest"] or found["rest2"] or ""
                attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
                above = stack[-1]
                inside = any(page.tags[k] in ("article", "main") for k in stack)
                name = ".".join([tag, *_DIGITS.sub("#", attributes.get("class", "")).split()[:2]])
                page.parents.append(above)
                page.tags.append(tag)
                page.paths.append(f"{page.paths[above]}/{name}" if tag != "body" else "/body")
                page.never.append(_never(tag, attributes, inside))
                page.named.append(_named(tag, attributes, inside))
                page.article.append(page.article[above] or tag in ("article", "main"))
                page.skipped.append(False)
                page.links.append(0)
                stack.append(len(page.tags) - 1)
                if rest.rstrip().endswith("/") and tag in ("div", "section"):
                    stack.pop()
    add(text[at:])
    flush()
    _mark_menus(page)
    _decide(page)
    return page


def _mark_menus(page: Page) -> None:
    """Lists of links outside an article are menus whatever they are called."""
    size, linked, links = defaultdict(int), defaultdict(int), list(page.links)
    for where, block, n in page.blocks:
        while where >= 0:
            size[where] += len(block)
            linked[where] += n
            where = page.parents[where]
    for k in range(len(page.parents) - 1, 0, -1):
        links[page.parents[k]] += links[k]
    for k in range(1, len(page.parents)):
        menu = page.tags[k] in ("ul", "ol", "div", "section", "table") and links[k] >= MENU_LINKS
        page.never[k] |= menu and not page.article[k] and linked[k] >= MENU_SHARE * size[k] > 0


def _decide(page: Page) -> None:
    """Spreads the marks to what lies below.

    Names alone don't empty an article: while it has no running text outside of containers that are named
    like boilerplate, the one of them with most text loses its mark.
    """
    while True:
        for k in range(1, len(page.parents)):
            page.skipped[k] = page.skipped[page.parents[k]] or page.never[k] or page.named[k]
        if any(not page.skipped[k] and len(block) - linked >= LEAST_TEXT for k, block, linked in page.blocks):
            return
        held: dict[int, int] = defaultdict(int)
        for where, block, linked in page.blocks:
            chain = []
            while where > 0:
                chain.append(where)
                where = page.parents[where]
            if not any(page.never[k] for k in chain):
                for k in chain:
                    if page.named[k] and page.article[k] and len(block) - linked >= LEAST_TEXT:
                        held[k] += len(block) - linked
        if not held:
            return
        page.named[max(held, key=lambda k: (held[k], -k))] = False


def _values(page: Page) -> list[float]:
    """Running text less links below each container; 0 for boilerplate.

    Boilerplate is not extracted, so it costs an ancestor no more than ``PENALTY`` of its text: enough
    to prefer the article to the whole body, never so much that a part is preferred to the whole.
    """
    n = len(page.parents)
    text, size, bad = [0.0] * n, [0] * n, [0] * n
    for where, block, linked in page.blocks:
        skipped = page.skipped[where]
        while where >= 0:
            if skipped:
                bad[where] += len(block)
            else:
                size[where] += len(block)
                text[where] += len(block) - 2 * min(linked, len(block))
            where = page.parents[where]
    out = []
    for k in range(n):
        good = max(text[k], 0.001 * size[k])
        out.append(0.0 if page.skipped[k] or not size[k] else good * (1 - PENALTY * bad[k] / (bad[k] + size[k])))
    return out


def scores(page: Page) -> dict[str, float]:
    """The value of the containers with each path, best of equal paths."""
    out: dict[str, float] = {}
    for path, value in zip(page.paths, _values(page), strict=True):
        if value > 0:
            out[path] = max(value, out.get(path, 0.0))
    return out


def best_path(found: dict[str, float]) -> str | None:
    """The path of the highest score; of equal ones the deepest."""
    return max(found, key=lambda p: (found[p], p.count("/"), p)) if found else None


def extract(page: Page, path: str | None) -> str:
    """Blocks below the containers with a path, in page order."""
    inside = [False] * len(page.parents)
    for k in range(len(page.parents)):
        inside[k] = page.paths[k] == path or (k > 0 and inside[page.parents[k]])
    return "\n\n".join(b for k, b, _ in page.blocks if inside[k] and not page.skipped[k])


def text_of(source: str | None, consensus: str | None) -> tuple[str, str]:
    """``text, path`` by the host's path where it has a large share of the page's text.

    All containers with the host's path together must have ``SHARE`` of the score of the
    page's own best path, which is taken otherwise.
    """
    page = parse(source or "")
    found = scores(page)
    own = best_path(found)
    if consensus is not None:
        here = sum(v for p, v in zip(page.paths, _values(page), strict=True) if p == consensus)
        if here >= SHARE * found.get(own, 0.0) and (text := extract(page, consensus)):
            return text, consensus
    return (extract(page, own), own) if own is not None else ("", "")


def _host():
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(host, "^.*@|:[0-9]*$", "")


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of a batch by host and path.

    A page gives a whole vote to its best path and up to half a vote, by their share of the best,
    to the others.
    """
    for batch in batches:
        votes: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0])
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = scores(parse(source or ""))
            own = best_path(found)
            for path, value in found.items():
                if value >= SHARE * found[own]:
                    vote = votes[host, path]
                    vote[0] += 1.0 if path == own else value / found[own] / 2
                    vote[1] += 1
        keys = list(votes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.string()),
                pa.array([votes[k][0] for k in keys], pa.float64()),
                pa.array([votes[k][1] for k in keys], pa.int64()),
            ],
            names=["host", "path", "vote", "pages"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: the winning path of each host, the deepest of equal ones."""
    votes = (
        pages.select(_host().alias("host"), "html")
        .filter("host != ''")
        .mapInArrow(_votes, "host string, path string, vote double, pages long")
        .groupBy("host", "path")
        .agg(F.round(F.sum("vote"), 6).alias("vote"))
    )
    order = F.struct("vote", F.length(F.regexp_replace("path", "[^/]", "")), "path")
    return votes.groupBy("host").agg(F.max_by("path", order).alias("path"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, sources, paths = batch.columns
        found = [text_of(s, p) for s, p in zip(sources.to_pylist(), paths.to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                urls,
                pa.array([t for t, _ in found], pa.string()),
                pa.array([len(t) for t, _ in found], pa.int64()),
                pa.array([p for _, p in found], pa.string()),
            ],
            names=["page_id", "url", "text", "n_chars", "path"],
        )


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, path`` for every row of ``pages``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are not read.  A null or
    empty page gives an empty text; pages with a null or malformed address have no host
    and no consensus.  Repeated pages are extracted alike.  An empty table gives no rows.
    """
    winners = broadcast_if_small(staged(host_paths(pages), "host-paths"))
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(_texts, "page_id long, url string, text string, n_chars long, path string")
