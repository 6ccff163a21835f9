"""The main text of web pages, by scores that paragraphs pass up the tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics annotation".split()
)
# What an opening element closes: elements that end where the next of their kind begins.
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
    "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
WITHIN = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
    "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"},
    "tfoot": {"table"},
}
# Elements and names that mark what is not the article.
DROPPED = set(
    "nav aside footer form head script style noscript template iframe textarea select button svg "
    "embed canvas audio video dialog menu input".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notification popup modal overlay newsletter subscribe "
    "sidebar sidebars aside widget widgets related recommended recommendations share sharing "
    "social menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead "
    "comment comments disqus discussion replies respond login signup signin toolbar".split()
)
# Names that layouts give to the article's own container as well need less to be taken for it.
SHARED_NAMES = set(
    "sponsor promo promotion banner notice notification sidebar sidebars aside widget widgets "
    "related recommended recommendations share sharing social menu nav navigation footer masthead".split()
)
# Names of what readers wrote, the only ones that count for an article element: each may be a comment.
COMMENTS = set("comment comments disqus discussion replies respond".split())
# With one of these a value tells the state of a page, not the role of an element.
STATES = set(
    "no not non without has have with open opened closed enabled disabled active inactive allowed "
    "off hidden full".split()
)
HEADERS = set("header".split())
WHOLE = ("article", "main")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
BLANKS = re.compile(r"\s+")

LEAST = 25  # characters of a paragraph that counts
LEVELS = 40  # ancestors that get points of a paragraph, the last of them under a hundredth
SHARED = 0.6  # of the best score, for a parent to stand for the article's parts
SIBLING = 0.2  # of the best score, for a sibling to be kept
OUTSIDE = 0.25  # of the text in a named element, that the rest of the page has if it is not the article
LINKED = 0.5  # share of link text from which a block of links is left out


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "names", "score", "length", "linked")

    def __init__(self, tag: str, parent: Element | None, dropped: bool, names: set[str] | None = None):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.names = names or set()
        self.children: list[Element | str] = []
        self.score = self.length = self.linked = 0.0


def _is_dropped(tag: str, attributes: str, parent: Element) -> bool:
    if parent.dropped or tag in DROPPED:
        return True
    if tag in HEADERS and not _above(parent, WHOLE):
        return True
    if not attributes or tag in ("html", "body", *WHOLE):
        return False
    for name, *values, bare in ATTRIBUTE.findall(attributes):
        name, value = (name or bare).lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in ROLES:
            return True
    return False


def _names(tag: str, attributes: str) -> set[str]:
    """Names in class and id that may mark what is not the article; values of a state have none."""
    found: set[str] = set()
    if not attributes or tag in ("html", "body", "main"):
        return found
    for name, *values, _ in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for value in "".join(values).lower().split():
                parts = set(re.split(r"[^a-z0-9]+", value))
                if not parts & STATES:
                    found |= parts & (COMMENTS if tag == "article" else NAMES)
    return found


def _above(element: Element | None, tags) -> Element | None:
    """The outermost of the element and its ancestors with one of the tags."""
    found = None
    while element is not None:
        if element.tag in tags:
            found = element
        element = element.parent
    return found


def parse(html: str) -> Element:
    """A tree of elements and raw texts; open elements end as HTML lets them."""
    root = Element("#root", None, False)
    at, here = 0, root
    opened: Counter = Counter()  # open elements by tag

    def up(there: Element) -> Element:
        """The element, with all below it closed."""
        one = here
        while one is not there:
            opened[one.tag] -= 1
            one = one.parent
        return there

    last = html.rfind(">")
    while True:
        # Behind the last bracket only a comment can begin, so nothing else is tried there.
        found = TOKEN.search(html, at) if at <= last or "<!--" in html[at:] else None
        end = found.start() if found else len(html)
        if end > at:
            here.children.append(html[at:end])
        if not found:
            return root
        at, tag = found.end(), (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            there = here if opened[tag] else None
            while there is not None and there.tag != tag:
                there = there.parent
            # A closing tag without an open element does nothing.
            here = up(there.parent) if there is not None else here
            continue
        if tag in ENDS_P and opened["p"]:
            there = here
            while there.tag in INLINE:
                there = there.parent
            here = up(there.parent) if there.tag == "p" else here
        if tag in ENDS and any(opened[t] for t in ENDS[tag]):
            there = here
            while there.tag not in ENDS[tag] and there.tag not in WITHIN[tag] and there.parent:
                there = there.parent
            if there.tag in ENDS[tag]:
                there = there.parent
                while there.tag in ENDS[tag]:
                    there = there.parent
                here = up(there)
        child = Element(tag, here, _is_dropped(tag, found[3], here), _names(tag, found[3]))
        here.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            inside = html[at : close.start()] if close else html[at:]
            if tag in ("title", "textarea"):
                child.children.append(inside)
            child.dropped = True
            at = close.end() if close else len(html)
        elif tag not in VOID and not found[3].endswith("/"):
            here = child
            opened[tag] += 1


def _blocks(element: Element) -> Iterator[tuple[Element, str, int]]:
    """Runs of text between block borders, in page order: block, text, length of link text."""
    parts: list[str] = []
    linked, owner = 0, element
    stack: list[tuple[Element, Iterator, bool]] = [(element, iter(element.children), False)]

    def take() -> tuple[Element, str, int] | None:
        text = BLANKS.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        return (owner, text, linked) if text else None

    while stack:
        here, children, in_link = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if here.tag not in INLINE:
                if row := take():
                    yield row
                linked = 0
                owner = stack[-1][0] if stack else element
                while owner.tag in INLINE and owner.parent:
                    owner = owner.parent
        elif isinstance(child, str):
            parts.append(child)
            linked += len(child.strip()) * in_link
        elif child.tag == "br":
            parts.append(" ")
        elif not child.dropped:
            if child.tag not in INLINE:
                if row := take():
                    yield row
                linked, owner = 0, child
            if child.tag not in VOID:
                stack.append((child, iter(child.children), in_link or child.tag == "a"))


def _settle_names(root: Element) -> None:
    """Drop elements with a telling name, unless they hold the article.

    One that holds ``main`` stays. Another one stays if the rest of the page has
    little text against its own, and if it looks like an article: a top heading
    in it, or, where layouts give such names to containers, two paragraphs. The
    largest are settled first, so what stays counts as the rest for the others.
    An article named as a comment goes if the page has another one, or if it
    lies within one.
    """
    order: list[Element] = []
    stack = [root]
    while stack:
        one = stack.pop()
        order.append(one)
        stack += [c for c in reversed(one.children) if isinstance(c, Element) and not c.dropped]
    named = [one for one in order if one.names]
    if not named:
        return
    below: dict[Element, set[str]] = {}
    for one in reversed(order):
        found = below.get(one, set()) | ({one.tag} & {"h1", "main", "article"})
        if found and one.parent:
            below.setdefault(one.parent, set()).update(found)
    marks = {one: below[one] for one in named if one in below}
    # Most pages have no such element that could be the article.
    if not any(one in marks or one.tag == "article" or one.names <= SHARED_NAMES for one in named):
        for one in named:
            one.dropped = True
        return
    # The nearest named element, and whether a comment or an article is around.
    nearest: dict[Element, Element | None] = {}
    comment: dict[Element, bool] = {}
    article: dict[Element, bool] = {}
    for one in order:
        up = one.parent
        nearest[one] = one if one.names else nearest.get(up)
        comment[one] = comment.get(up, False) or bool(one.names & COMMENTS)
        article[one] = article.get(up, False) or one.tag == "article"
    size, own, paragraphs = Counter(), Counter(), Counter()
    free, plain = 0, False
    for block, text, linked in _blocks(root):
        length = max(len(text) - linked, 0)
        counts = length >= LEAST and 2 * length >= len(text)
        size[block] += length
        paragraphs[block] += counts
        plain = plain or (counts and article[block] and not comment[block])
        if nearest[block] is None:
            free += length
        else:
            own[nearest[block]] += length
    for one in reversed(order):
        if one.parent:
            size[one.parent] += size[one]
            paragraphs[one.parent] += paragraphs[one]
    named.sort(key=lambda one: -size[one])
    gone: dict[Element, bool] = {}
    for one in named:
        if one.tag == "article":
            stays = not (plain or article.get(one.parent, False))
        else:
            heads = marks.get(one, set()) - ({"article"} if one.names & COMMENTS else set())
            alike = heads or (one.names <= SHARED_NAMES and paragraphs[one] > 1)
            stays = "main" in heads or bool(alike and OUTSIDE * size[one] > free)
        # Elements around this one are as large at least, and come before it.
        above = nearest.get(one.parent)
        gone[one] = not stays or (above is not None and gone[above])
        one.dropped = gone[one]
        if not gone[one]:
            free += own[one]


def _scored(root: Element) -> Element | None:
    """Pass the points of all paragraphs to their ancestors; the best element, if any."""
    best, touched = None, []
    for block, text, linked in _blocks(root):
        block.length += len(text)
        block.linked += min(linked, len(text))
        if len(text) < LEAST:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - min(linked / len(text), 1)
        inner = block.tag in ("p", "pre", "td", "li", "dd", "dt", "blockquote", "figcaption") or (
            len(block.tag) == 2 and block.tag[0] == "h"
        )
        one, share = (block.parent if inner else block), 1.0
        level = 0
        while one is not None and one.tag not in ("html", "#root") and level < LEVELS:
            one.score += points * share
            touched.append(one)
            level += 1
            share = 0.5 if level == 1 else 1 / (3 * level)
            one = one.parent
    order, stack = [], [root]
    while stack:
        order.append(stack.pop())
        stack += [c for c in order[-1].children if isinstance(c, Element)]
    for one in reversed(order):
        if one.parent:
            one.parent.length += one.length
            one.parent.linked += one.linked
    for one in touched:
        if best is None or _weight(one) > _weight(best):
            best = one
    return best


def _weight(element: Element) -> float:
    return element.score * (1 - element.linked / element.length) if element.length else 0.0


def _kept(best: Element) -> list[Element]:
    """The whole article around the best container, or it and its good siblings."""
    for tag in WHOLE:
        if whole := _above(best, (tag,)):
            return [whole]
    top = _weight(best)
    while best.parent is not None and best.parent.tag not in ("body", "html", "#root"):
        if _weight(best.parent) < SHARED * top:
            break
        best = best.parent
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    out = []
    for child in best.parent.children:
        if isinstance(child, str) or child.dropped:
            continue
        wide = child.length > 80 and child.linked < 0.25 * child.length
        heading = len(child.tag) == 2 and child.tag[0] == "h" and child.length > 0
        good = _weight(child) >= max(2, SIBLING * _weight(best))
        if child is best or good or heading or (child.tag == "p" and wide):
            out.append(child)
    return out


def _links_only(block: Element, top: Element, known: dict, follows: dict) -> bool:
    """Whether the block lies in a list, or a part below the top, that is made of links.

    An article keeps those, such as its references; other containers keep the
    ones that follow a paragraph, or a section of text if they are sections.
    """
    if top.tag == "article":
        return False
    # What the elements up to the top have told before is kept with them.
    path, one = [], block
    while one is not None and one is not top and one not in known:
        path.append(one)
        one = one.parent
    found = None if one is None or one is top else known[one]
    for one in reversed(path):
        parts = one.tag in ("ul", "ol", "dl", "table", "div", "section") and one.length
        if found is None and parts and one.linked > LINKED * one.length:
            found = one
        known[one] = found
    if found is None:
        return False
    if top.tag == "#root":
        return True
    if found not in follows:
        follows[found] = False
        for other in found.parent.children:
            if other is found:
                break
            if isinstance(other, Element) and not other.dropped:
                alike = other.tag == "p" or other.tag == found.tag == "section"
                if alike and other.length - other.linked >= LEAST:
                    follows[found] = True
                    break
    return not follows[found]


def main_text(html: str | None) -> str:
    """Blocks of the main text of a page, one per line."""
    if not html:
        return ""
    root = parse(html)
    _settle_names(root)
    best = _scored(root)
    follows: dict[Element, bool] = {}
    if best is None:
        known: dict[Element, Element | None] = {}
        blocks = [(b, t) for b, t, linked in _blocks(root) if linked < LINKED * len(t)]
        return "\n".join(t for b, t in blocks if not _links_only(b, root, known, follows))
    lines = []
    for top in _kept(best):
        known = {}
        lines += [t for b, t, _ in _blocks(top) if not _links_only(b, top, known, follows)]
    return "\n".join(lines)


def extract(
    pages: DataFrame, keep: list[str] | None = None, html_col: str = "html"
) -> DataFrame:
    """The columns ``keep`` (all but the page, if None) with ``text`` and ``n_chars`` of each page.

    Paragraphs pass points for their length and commas to their ancestors, less
    the share of link text; the article around the best container, or the
    container with its good siblings, is the main text. Menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, hidden parts and comments are left
    out wherever they are; a class or id that names one of these drops an element
    unless that holds the article. Lists of links within an article's text stay.
    A page whose text has no paragraph gives all of its
    text that is none of these.

    Null and empty pages, and pages without text, give an empty text. Rows are
    kept as they are, repeated ones and null keys included; columns of the input
    called ``text`` or ``n_chars`` are replaced. An empty table gives no rows.
    """
    keep = [c for c in (keep or pages.columns) if c not in (html_col, "text", "n_chars")]
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(x) for x in frame[html_col]]
            yield frame[keep].assign(text=texts, n_chars=[len(x) for x in texts])

    schema = ", ".join(x for x in (fields, "text string, n_chars long") if x)
    return pages.select(*keep, F.col(html_col)).mapInPandas(run, schema)
