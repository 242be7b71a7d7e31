"""Main text of web pages by tree scoring.

A page is read into a tree that forgives missing and misplaced end tags. Parts that are never article text are left
out by element, role or name: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader
comments, hidden parts. A name counts on containers only, never on headings, paragraphs, list items, cells or inline
elements, and only if a whole class or id is made of words that name such parts; adverts, reader comments and hidden
parts then go, parts of the layout go outside ``article`` and ``main``, and others only if they are mostly links or hold no
paragraph. Ids inside ``article``, ``main`` or the best container do not count. Of what remains, each paragraph passes points for its length and commas to its ancestors: all
to its container, half to the next, and less to those above. A container's points are discounted by its link
density. The article (else the main part) that the best container lies in is kept. Without either, the best container
is kept, and what lies beside it and its ancestors, up to the nearest that holds more prose (and on, while that adds
a fifth or more): headings, parts that score enough by themselves, prose of any element with few links, and what has few
links and lies between such parts. Outside of these, and in a page without a container, lists of nothing but links are
menus; within them only lists of page steps (next, last, 1, 2) are.

White space inside a block becomes one space; blocks are joined in page order by an empty line. Nothing else is
dropped or cut.

Cases: a null, empty or textless page gives an empty text. A page without tags is one block. An element that never
ends lasts until its parent ends. Pages are read one by one, so repeated rows and other columns play no part.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from hoopline.llm.frames import Columns, annotate

SCHEMA = "text string, n_chars long"

_TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*+)((?>(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*))>)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s]*))?""")

# Element names by role in HTML; fixed values of the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas video audio".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption legend option optgroup select".split()
)
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd figcaption summary caption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl menu".split())
#: A start tag of the first closes an open element of the second, if no element of the third lies between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
    "body": (("head",), ()),
}
LEFT_OUT = frozenset("nav header footer aside form head button select option fieldset dialog menu search".split())
LEFT_OUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
#: Words of class or id that name parts outside the article.
LEFT_OUT_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar footer bottom sidebar side aside "
    "notice notices cookie cookies consent gdpr banner alert popup modal overlay toast ad ads advert adverts advertisement "
    "advertising advertorial adsense adslot sponsor sponsored promo promotion promoted form login signup subscribe "
    "subscription newsletter paywall search comment comments comentarios commentaires kommentare disqus replies reply respond "
    "share sharing social related recommended recommendations pagination pager toc skip widget hidden".split()
)
#: Of these, words whose parts are left out wherever they are, and those whose parts are left out around the article.
SURE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense adslot advertorial sponsored comments comentarios commentaires kommentare disqus "
    "hidden".split()
)
LAYOUT_WORDS = frozenset(
    "nav navbar navigation submenu breadcrumb breadcrumbs header masthead topbar footer sidebar paywall newsletter pagination "
    "pager".split()
)
#: Words that may stand beside one of these in a name; with any other word the name says what a part is about.
PART_WORDS = frozenset(
    "area bar block box button buttons container content form global group holder icons inner item items left link links list main "
    "outer page panel primary right row secondary section site slot top unit wrap wrapper".split()
)
SURE, LAYOUT, MAYBE, UNNAMED = 3, 2, 1, 0
#: Elements whose class and id say what the page is about, not what a part is.
NEVER_LEFT_OUT = frozenset("html body article main".split())

#: Labels of links from page to page.
STEPS = frozenset("next previous prev first last back newer older".split())
#: These hold the whole page, so they are no container of the article.
WHOLE = frozenset("#root html body".split())

MIN_PARAGRAPH = 25
MIN_SIBLING_SHARE = 0.2
MIN_SIBLING_CHARS = 80
MAX_PROSE_LINKS = 0.25
MAX_MENU_TEXT = 0.1
MAX_PART_LINKS = 0.33
MIN_PART_POINTS = 1.0
MAX_PART_SHARE = 0.5


class Tree:
    """Elements as parallel lists: tag, parent, whether left out, what class and id say; text blocks as (element, text,
    link characters)."""

    def __init__(self) -> None:
        self.tags, self.parents, self.outside, self.names = ["#root"], [-1], [False], [(UNNAMED, UNNAMED)]
        self.blocks: list[tuple[int, str, int]] = []


def _named(tokens: str) -> int:
    """How surely a class or id names a part outside the article."""
    said = UNNAMED
    for token in tokens.split():
        words = {w for w in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", token) if w and not w[0].isdigit()}
        hits = words & LEFT_OUT_WORDS
        if hits and words <= LEFT_OUT_WORDS | PART_WORDS:
            sure, layout = hits & SURE_WORDS, hits & LAYOUT_WORDS or len(hits) > 1
            said = max(said, SURE if sure else LAYOUT if layout else MAYBE)
    return said


def _left_out(tag: str, attributes: str) -> tuple[bool, tuple[int, int]]:
    """Whether an element is left out whatever it holds, and what its class and its id say."""
    unnamed = UNNAMED, UNNAMED
    if tag in LEFT_OUT:
        return True, unnamed
    if not attributes or attributes.isspace():
        return False, unnamed
    values = {k.lower(): html.unescape((v or "").strip("\"'")).lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true":
        return True, unnamed
    if "display:none" in values.get("style", "").replace(" ", ""):
        return True, unnamed
    if tag in NEVER_LEFT_OUT:
        return False, unnamed
    if values.get("role") in LEFT_OUT_ROLES:
        return True, unnamed
    if tag in PARAGRAPH or tag not in BLOCK:
        return False, unnamed
    return False, (_named(values.get("class", "")), _named(values.get("id", "")))


def parse(page: str) -> Tree:
    tree = Tree()
    tags, parents, outside = tree.tags, tree.parents, tree.outside
    stack, links = [0], 0
    parts: list[str] = []
    linked = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                owner = next(e for e in reversed(stack) if tags[e] in BLOCK or not e)
                tree.blocks.append((owner, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        nonlocal links
        for e in stack[depth:]:
            links -= tags[e] == "a"
        del stack[depth:]

    # No tag ends after the last '>', so no search looks past it: a '<' without any '>' after it costs nothing.
    last = page.rfind(">", 0, end) + 1
    while at < end:
        token = _TOKEN.search(page, at, last) if at < last else None
        if token is not None and token.group(0).startswith("<!--") and not token.group(0).endswith("-->"):
            token = None  # a comment left open runs to the end
            begin = page.find("<!--", at)
        elif token is None:
            opened = page.find("<!--", at)
            begin = opened if opened >= 0 else end
        else:
            begin = token.start()
        if begin > at and not outside[stack[-1]]:
            text = page[at:begin]
            if "&" in text:
                text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(" ".join(text.split()))
        if not token:
            break
        at = token.end()
        closing, tag, attributes = token.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            inline = tag not in BLOCK
            for depth in range(len(stack) - 1, 0, -1):
                if tags[stack[depth]] == tag:
                    if not inline:
                        flush()
                    pop(depth)
                    break
                if inline and tags[stack[depth]] in BLOCK:
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at) if attributes[-1:] != "/" else None
            at = stop.end() if stop else at if attributes[-1:] == "/" else end
            continue
        if tag in VOID:
            if tag in BLOCK:
                flush()
            else:
                parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            closed, within = CLOSES.get(tag, ((), ()))
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[depth]]
                if open_tag == "p" or open_tag in closed:
                    pop(depth)
                    break
                if open_tag in within or not closed and open_tag in BLOCK:
                    break
        parents.append(stack[-1])
        tags.append(tag)
        left_out, names = _left_out(tag, attributes)
        outside.append(outside[stack[-1]] or left_out)
        tree.names.append(names)
        stack.append(len(tags) - 1)
        links += tag == "a"
    flush()
    return tree


def _value(text: str, link: int) -> float:
    """The points of a block of text."""
    size = len(text)
    value = 1 + text.count(",") + min(size / 100, 3) if size >= MIN_PARAGRAPH else size / 100
    return value * (1 - link / size)


def _dropped(tree: Tree) -> tuple[list[bool], list[bool]]:
    """Whether each element is left out by name: by classes and ids, and by classes alone."""
    n, tags, parents = len(tree.tags), tree.tags, tree.parents
    if all(names == (UNNAMED, UNNAMED) for names in tree.names):
        return [False] * n, [False] * n
    value, chars, linked = [0.0] * n, [0] * n, [0] * n
    for owner, text, link in tree.blocks:
        value[owner] += _value(text, link)
        chars[owner] += len(text)
        linked[owner] += link
    for e in range(n - 1, 0, -1):
        for total in (value, chars, linked):
            total[parents[e]] += total[e]
    within = [False] * n
    out: tuple[list[bool], list[bool]] = [False] * n, [False] * n
    for e in range(1, n):
        inside = within[e] = within[parents[e]] or tags[e] in ("article", "main")
        by_class, by_id = tree.names[e]
        poor = linked[e] > MAX_PART_LINKS * chars[e] or value[e] < MIN_PART_POINTS
        for drop, said in zip(out, (by_class if inside else max(by_class, by_id), by_class)):
            gone = said == SURE or said == LAYOUT and not inside or said != UNNAMED and poor
            # a wrapper of most of the page is named after one of its parts
            wraps = said != SURE and value[e] > MAX_PART_SHARE * value[0]
            drop[e] = drop[parents[e]] or gone and not wraps
    return out


_SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u0964\u061f][\"'\u201d\u2019\u00bb)\]]*$")


def _beside(tree: Tree, above: list[int], score: list[float], dropped: list[bool]) -> tuple[set[int], set[int]]:
    """What is kept with the best container, the first of ``above``, which lists it and its ancestors: elements to keep
    with all that they hold, and ancestors of which only the text of their own is kept."""
    n, tags, parents = len(tree.tags), tree.tags, tree.parents
    chars, linked, value, ends = [0] * n, [0] * n, [0.0] * n, [False] * n
    for owner, text, link in tree.blocks:
        if not dropped[owner]:
            chars[owner] += len(text)
            linked[owner] += link
            value[owner] += _value(text, link)
            ends[owner] = ends[owner] or bool(_SENTENCE.search(text))
    own = [(c, k) for c, k in zip(chars, linked)]
    children: dict[int, list[int]] = {e: [] for e in above}
    for e in range(n - 1, 0, -1):
        for total in (chars, linked, value):
            total[parents[e]] += total[e]
        ends[parents[e]] = ends[parents[e]] or ends[e]
        if parents[e] in children:
            children[parents[e]].insert(0, e)

    def few_links(e: int) -> bool:
        return linked[e] <= MAX_PROSE_LINKS * chars[e]

    top, held, found = min(1, len(above) - 1), value[above[0]], False
    for k in range(1, len(above)):
        others = [value[e] for e in children[above[k]] if e != above[k - 1] and chars[e] and few_links(e) and value[e] >= 1]
        worth = not found or tags[above[k]] not in WHOLE and sum(others) >= MIN_SIBLING_SHARE * held
        if others and worth:
            top, found = k, True
            held += sum(others)

    enough = max(1.0, MIN_SIBLING_SHARE * score[above[0]])
    kept, texts = set(), set()
    for k in range(1, top + 1):
        at = above[k]
        parts = [e for e in children[at] if chars[e]]
        sure = [
            e == above[k - 1] or tags[e] in HEADING or score[e] >= enough
            or few_links(e) and (chars[e] >= MIN_SIBLING_CHARS or not linked[e] and ends[e])
            for e in parts
        ]
        if True not in sure:
            continue
        first, last = sure.index(True), len(sure) - sure[::-1].index(True)
        kept |= {e for i, e in enumerate(parts) if e != above[k - 1] and (sure[i] or first < i < last and few_links(e))}
        if own[at][0] and own[at][1] <= MAX_PROSE_LINKS * own[at][0]:
            texts.add(at)
    return kept, texts


def _is_menu(texts: list[str]) -> bool:
    """Whether a list of links leads from page to page."""
    return all(t.lower().strip(" \u2039\u203a\u00ab\u00bb<>\u2190\u2192") in STEPS or not re.search(r"[^\W\d_]", t) for t in texts)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    if not page:
        return ""
    tree = parse(page)
    tags, parents = tree.tags, tree.parents
    dropped, dropped_within = _dropped(tree)
    n = len(tags)
    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    for owner, text, link in tree.blocks:
        if dropped[owner]:
            continue
        size = len(text)
        value = _value(text, link)
        at, level = parents[owner] if tags[owner] in PARAGRAPH else owner, 0
        while at >= 0:
            points[at] += value / (1 if level == 0 else 2 if level == 1 else 3 * level)
            at, level = parents[at], level + 1
        at = owner
        while at >= 0:
            chars[at] += size
            linked[at] += link
            at = parents[at]
    if not chars[0]:
        return ""
    density = [k / c if c else 0.0 for k, c in zip(linked, chars)]
    score = [p * (1 - d) for p, d in zip(points, density)]
    best = max(range(n), key=lambda e: (score[e], e))
    above = []
    at = best
    while at >= 0:
        above.append(at)
        at = parents[at]
    named = [e for e in above if tags[e] == "article"] or [e for e in above if tags[e] == "main"]
    best = named[0] if named else best
    kept, within = [False] * n, [False] * n
    kept[best] = within[best] = True
    texts: set[int] = set()
    if not named:
        beside, texts = _beside(tree, above, score, dropped)
        for e in beside:
            kept[e] = True
    bare = not named and tags[best] in WHOLE
    labels: dict[int, list[str]] = {}
    for owner, text, _ in tree.blocks:
        at = owner
        while at > 0:
            if tags[at] in LISTS and linked[at]:
                labels.setdefault(at, []).append(text)
            at = parents[at]
    for e in range(1, n):
        within[e] = within[e] or within[parents[e]]
        links = tags[e] in LISTS and chars[e] and linked[e] and chars[e] - linked[e] <= MAX_MENU_TEXT * chars[e]
        # without a container nothing tells a list of links of the article from a menu
        kept[e] = (kept[e] or kept[parents[e]]) and not (links and (bare or _is_menu(labels[e])))
    return "\n\n".join(
        text
        for owner, text, _ in tree.blocks
        if (kept[owner] or owner in texts) and not (dropped_within if within[owner] else dropped)[owner]
    )


def _texts(pages: pa.Array) -> Columns:
    texts = [main_text(p.as_py()) for p in pages]
    return {"text": texts, "n_chars": [len(t) for t in texts]}


def extract_pages(pages: DataFrame, keep: list[str] | None = None, page: str = "html") -> DataFrame:
    """One row per page: the columns ``keep``, the main text and its number of code points."""
    return annotate(pages, page, keep or ["page_id", "url"], _texts, SCHEMA)
