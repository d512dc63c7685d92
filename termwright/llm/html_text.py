"""The main text of web pages by tree scoring.

A page becomes a tree of elements. Its paragraphs pass points for their length and commas to their
ancestors, the farther the less; an element's points are discounted by the share of its text that stands
in links. The element with the most points is the article's container, and what stands beside it and looks like it is kept with it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termwright.llm._shared import extended

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; nothing in them is text of the page.
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
#: Elements that are never part of an article.
OUTSIDE = frozenset("head nav aside footer form button select dialog menu object canvas svg math datalist fieldset audio video".split())
#: Words in the class or id of what is not part of an article.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe"
    " subscription sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs footer footnav masthead topbar toolbar comment comments disqus reply replies respond"
    " share sharing social discussion copyright related recommended popup modal overlay widget widgets login signin signup pagination pager skip rail outbrain taboola paywall".split()
)
#: Beginnings and ends of such words that are written in one with others, and words that only look like it.
OUTSIDE_STEMS, OUTSIDE_ENDS, NOT_OUTSIDE = ("comment", "advert", "sidebar", "sponsor", "newsletter", "cookie", "breadcrumb", "navig", "footer", "disqus", "pagin", "subscri"), ("nav", "menu", "navbar", "banner", "sidebar", "ads"), frozenset(("commentary", "commentator", "heads", "threads", "reads", "leads", "roads", "loads", "downloads"))
#: Values of the role attribute that say the same.
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words before which such a word says what else a page has.
NEUTRAL = frozenset("has with no without is not hide".split())
#: Elements that say themselves that they hold the article, and words in a class or id that do.
INSIDE, INSIDE_WORDS = frozenset(("article", "main")), frozenset("article content entry main post story text body".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: What starting an element closes: the open elements of the first set, if none of the second is nearer.
_P = frozenset(("p",))
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset()),
}
#: An open paragraph ends at these.
_P_ENDS = frozenset(("table", "td", "th", "caption", "button", "object"))

#: Characters of a paragraph that are worth a point, as a comma is; the least of a paragraph that gives points.
PER_POINT, LEAST = 100, 25
#: The share of its points that a paragraph passes to its ancestors, nearest first.
PASSED = (1.0, 0.5, 1 / 3, 1 / 4, 1 / 5)
#: A sibling is kept that has this share of the best container's points; a paragraph beside it with at most this share of links.
SIBLING, LINKED = 0.2, 0.25
#: A list or table whose text stands in links by more than this, in at least so many links, is a menu.
MENU, MENU_LINKS = 0.66, 3

_COMMAS = re.compile("[,،、，﹐︐⹁]")
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([A-Za-z][\w-]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """A page's elements in their order (``parent`` before child), and its blocks: (element, text, characters in links)."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def parsed(source: str) -> Page:
    """The tree of a page. Missing end tags are supplied, end tags of nothing are ignored, what never ends goes to the end of the page."""
    page = Page()
    stack: list[int] = []
    opened: dict[str, list[int]] = {}  # of each tag, the places on the stack
    around: list[int] = []  # the places of the elements that make blocks
    run: list[tuple[str, bool]] = []
    owner = -1
    at, size, tag_form = 0, len(source), _TAG

    def flush() -> None:
        nonlocal run
        if run:
            text = " ".join(html.unescape("".join(t for t, _ in run)).split())
            if text:
                linked = sum(len(" ".join(html.unescape(t).split())) for t, inside in run if inside)
                page.blocks.append((owner, text, min(linked, len(text))))
            run = []

    def push(tag: str, attributes: str) -> None:
        nonlocal owner
        page.tag.append(tag)
        page.parent.append(stack[-1] if stack else -1)
        page.attributes.append(attributes)
        page.links.append(0)
        opened.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS or not stack:
            around.append(len(stack))
            owner = len(page.tag) - 1
        stack.append(len(page.tag) - 1)

    def pop_to(depth: int) -> None:
        nonlocal owner
        changed = False
        while len(stack) > depth:
            tag = page.tag[stack.pop()]
            opened[tag].pop()
            if tag in BLOCKS:
                if not changed:
                    flush()
                changed = True
                around.pop()
        if changed:
            owner = stack[around[-1]]

    def nearest(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=-1)

    push("root", "")
    owner = 0
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            run.append((source[at:lt], bool(opened.get("a"))))
        if lt == size:
            break
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            if source[lt + 4 : lt + 5] == ">" or source[lt + 4 : lt + 6] == "->":
                end = source.index(">", lt) - 2
            at = size if end < 0 else end + 3
            continue
        if source[lt + 1 : lt + 2] in ("!", "?"):
            end = source.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        m = tag_form.match(source, lt)
        if m is None and tag_form is _TAG and source[lt + 1 : lt + 2].isalpha():
            # No end of the tag: from here on, none is sought beyond quotes.
            tag_form = _PLAIN_TAG
            m = tag_form.match(source, lt)
        if m is None:
            if (c := source[lt + 1 : lt + 3].lstrip("/")[:1]) and c.isascii() and c.isalpha():
                break
            if source.startswith("</", lt):
                end = source.find(">", lt)
                at = size if end < 0 else end + 1
                continue
            run.append(("<", bool(opened.get("a"))))
            at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                run.append((" ", False))
            elif opened.get(tag) and tag != "root":
                if tag in BLOCKS:
                    flush()
                # The end of an inline element doesn't end a block in it.
                if tag in BLOCKS or opened[tag][-1] > around[-1]:
                    pop_to(opened[tag][-1])
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(source, at)
            stop = source.find(">", end.end()) if end else -1
            at = size if stop < 0 else stop + 1
            continue
        if tag in VOID:
            if tag == "br":
                run.append((" ", False))
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            flush()
            if (p := nearest(_P)) > nearest(_P_ENDS):
                pop_to(p)
        if tag in CLOSES:
            ends, fence = CLOSES[tag]
            if (depth := min((opened[t][-1] for t in ends if opened.get(t) and opened[t][-1] > nearest(fence)), default=-1)) >= 0:
                pop_to(depth)
        if tag in HEADINGS and (h := nearest(HEADINGS)) >= 0 and h == len(stack) - 1:
            pop_to(h)
        if tag == "a":
            if (a := nearest(("a",))) > around[-1]:
                pop_to(a)
            page.links[owner] += 1
        push(tag, m[3])
    pop_to(1)
    flush()
    return page


def _named(attributes: str) -> tuple[list[list[str]], dict[str, str]]:
    """The words of each class name and of the id, and the other attributes."""
    found = {m[1].lower(): html.unescape(next((x for x in m.groups()[1:] if x is not None), "")) for m in _ATTRIBUTE.finditer(attributes)}
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    return [[w.lower() for w in _WORDS.findall(n)] for n in names], found


def _outside(tag: str, attributes: str, in_article: bool, holds: bool) -> bool:
    """Whether an element says of itself that it is not part of an article; by its class alone, not if it ``holds`` an article or a page's heading, and neither is a form then."""
    if tag in OUTSIDE and not (tag == "form" and holds) or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main", "root"):
        return False
    names, found = _named(attributes)
    if found.get("role", "").strip().lower() in OUTSIDE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if holds:
        return False
    if not in_article and any("header" in words and not INSIDE_WORDS & set(words) for words in names):
        return True
    return any(_says_outside(w) and not (i and words[i - 1] in NEUTRAL) for words in names for i, w in enumerate(words))


def _says_outside(word: str) -> bool:
    return word in OUTSIDE_WORDS or word not in NOT_OUTSIDE and (word.startswith(OUTSIDE_STEMS) or len(word) > 4 and word.endswith(OUTSIDE_ENDS))


def main_blocks(source: str) -> list[str]:
    """The blocks of a page's main text, in page order."""
    page = parsed(source)
    n = len(page.tag)
    gone, article, holds = [False] * n, [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] |= holds[i] or page.tag[i] in ("article", "main", "h1")
    for i in range(n):
        up = page.parent[i]
        article[i] = page.tag[i] in INSIDE or (up >= 0 and article[up])
        gone[i] = (up >= 0 and gone[up]) or _outside(page.tag[i], page.attributes[i], article[i], holds[i])
    blocks = [b for b in page.blocks if not gone[b[0]]]
    if not blocks:
        return []
    chars, linked, links, points = [0] * n, [0] * n, page.links[:], [0.0] * n
    for node, text, inside in blocks:
        chars[node] += len(text)
        linked[node] += inside
        if len(text) >= LEAST and page.tag[node] not in HEADINGS:
            own = (1 + len(text) / PER_POINT + len(_COMMAS.findall(text))) * (1 - inside / len(text))
            # Text of its own makes an element a paragraph, whose container is above it; a text right in a container is that container's.
            up = page.parent[node] if page.tag[node] in ("p", "pre", "li", "dd", "dt", "td", "th", "blockquote", "figcaption") else node
            for share in PASSED:
                if up < 0:
                    break
                points[up] += own * share
                up = page.parent[up]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        links[up] += links[i]
    menu = [False] * n
    for i in range(1, n):
        listed = page.tag[i] in ("ul", "ol", "dl", "table") and links[i] >= MENU_LINKS and linked[i] > MENU * chars[i]
        menu[i] = menu[page.parent[i]] or listed
    for i in range(n):
        points[i] *= 1 - linked[i] / max(1, chars[i])
        if points[i] and (page.tag[i] in INSIDE or any(w in INSIDE_WORDS for words in _named(page.attributes[i])[0] for w in words)):
            points[i] *= 1.25
    best = max(range(n), key=lambda i: (points[i], -i))
    if not points[best]:
        # No paragraph is long enough: what calls itself the article, the longest of several.
        best = max((i for i in range(n) if page.tag[i] in INSIDE and chars[i] and not gone[i]), key=lambda i: (page.tag[i] == "article", chars[i]), default=0)
    # A container within an article is part of it.
    up = best
    while up > 0 and page.tag[up] != "article":
        up = page.parent[up]
    if up > 0:
        best = up
    kept = _with_siblings(page, best, points, chars, linked, gone)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in kept or (page.parent[i] >= 0 and inside[page.parent[i]])
    # The text right in the parent, beside the container, is a sibling too.
    beside = page.parent[best]
    return [t for node, t, link in blocks if not menu[node] and (inside[node] or (node == beside and page.tag[best] != "article" and len(t) >= LEAST and link <= LINKED * len(t)))]


def _with_siblings(page: Page, best: int, points: list[float], chars: list[int], linked: list[int], gone: list[bool]) -> set[int]:
    """``best`` and the elements beside it that are kept: paragraphs and headings with few links, and what has points enough.

    An element ``article`` holds the whole article: nothing beside it is kept.
    """
    kept = {best}
    up = page.parent[best]
    if up < 0:
        return kept
    whole = page.tag[best] == "article"
    for i in range(up + 1, len(page.tag)):
        if page.parent[i] != up or i == best or gone[i] or not chars[i]:
            continue
        few = linked[i] <= LINKED * chars[i]
        if whole:
            good = False
        elif page.tag[i] in HEADINGS or page.tag[i] in ("p", "pre", "blockquote"):
            good = few
        else:
            good = few and points[i] >= SIBLING * points[best]
        if good:
            kept.add(i)
    return kept


def main_text(source: str) -> str:
    return "\n\n".join(main_blocks(source))


def extracted(pages: DataFrame, source: str = "html") -> DataFrame:
    """``pages`` with ``text``, a page's main text, and ``n_chars``, its code points, in place of ``source``.

    Blocks of text are joined by an empty line; white space in a block is one space; character references are decoded. A null or
    empty page, and one without main text, has an empty ``text``. A page of any length is read whole, in time that grows
    with its length. Repeated rows are rows each, an empty table stays empty, and columns named ``text`` or ``n_chars`` give way.
    """

    def make(sources):
        texts = [*map(main_text, sources)]
        return [texts, [*map(len, texts)]]

    return extended(pages, make, source, T.StructType().add("text", "string").add("n_chars", "long"))
