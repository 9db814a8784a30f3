"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, half to each further one; an ancestor's
sum is discounted by its share of link text and by marks of boilerplate, and raised where the element is made for
main text. The best container stays, with those siblings that score as text too. All passes over a page are
linear in its length, however it is nested or broken.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_column

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR_NAME = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)\s*(=?)\s*")
_BARE_VALUE = re.compile(r"[^\s>]*")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# What HTML defines about elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul head".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that never hold the article.
BOILERPLATE = frozenset("nav footer aside button dialog menu search".split())
#: Elements that hold no text of a page at all, and those whose content is no markup.
MARKUP = frozenset("script style title textarea noscript template iframe svg math object select head".split())
TEXT_ONLY = frozenset("script style title textarea noscript iframe".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words in a class or id that mark an element as something else than the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus respond reply replies feedback discussion discussions responses share sharing social related recommended recommendations widget widgets toolbar pagination pager skip".split()
)
#: Of these, what marks content of readers and notices, which may be longer than the article.
NEVER_MOST = frozenset("ad ads adv advert adverts advertisement advertising adsense cookie cookies consent gdpr newsletter comment comments commentlist disqus respond reply replies feedback discussion discussions responses".split())
#: What only tells the shape of an element, so that a class of such words and marks is a mark and nothing else.
SHAPES = frozenset("area aside bar block body bottom box button buttons card cards col column container content footer form group head heading header holder inner item items left link links list main module outer panel post posts right row section slot stories top unit wrap wrapper zone".split())
#: Text is next to nothing under this share of the page's paragraph text.
TINY = 0.1
#: What of its points an element keeps, and passes on, that only a mark, a role, or being a form or header speaks against.
DISCOUNT = 0.25
#: How much more the elements count that are made for a page's main text.
MADE_FOR_TEXT = {"article": 3.0, "main": 2.0}
#: Elements nested deeper stand beside each other instead, as in browsers.
DEEPEST = 512
#: A class such as "with-sidebar" tells about an element's surroundings.
_ABOUT = ("with-", "has-", "no-", "without-", "with_", "has_", "no_", "without_")
_WORD = re.compile(r"[a-z]+")
#: A start tag of the first closes an open element of the second, unless one of the third is in between.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
_TEXT_HOLDERS = BLOCK - HEADINGS - {"html", "head", "ul", "ol", "table", "tr", "tbody", "thead", "tfoot", "dl", "hr"}


class Node:
    __slots__ = ("tag", "parent", "items", "marked", "hidden", "other", "role", "plain", "owner", "linked", "out", "text", "link", "body", "points")

    def __init__(self, tag: str, parent: Node | None, marked: bool = False, hidden: bool = False, other: bool = False, role: str = "", plain: bool = False):
        self.tag, self.parent, self.items, self.marked, self.hidden, self.other, self.role, self.plain = tag, parent, [], marked, hidden, other, role, plain
        self.owner = self if parent is None or tag in BLOCK else parent.owner  # the block whose text an element's own is
        self.linked = tag == "a" or parent is not None and parent.linked

    def worth(self) -> float:
        if not self.text:
            return 0.0
        made = 2.0 if self.role == "main" else MADE_FOR_TEXT.get(self.tag, 1.0)
        return self.points * (1 - self.link / self.text) * made


class _Page:
    """A forward scanner over the source of a page."""

    def __init__(self, html: str):
        self.html, self.at, self.lower = html, 0, None
        self.quotes = {'"': 0, "'": 0}  # from where on a quote is known to be missing, -1; else the last place found

    def _quote(self, mark: str, at: int) -> int:
        if self.quotes[mark] >= 0:
            self.quotes[mark] = self.html.find(mark, at)
        return self.quotes[mark]

    def attributes(self) -> tuple[list[tuple[str, str]], bool]:
        """(name, value) up to the end of a tag, and whether it closes itself; moves behind the tag."""
        html, out = self.html, []
        while m := _ATTR_NAME.match(html, self.at):
            self.at, value = m.end(), ""
            if m[2]:
                mark = html[self.at : self.at + 1]
                end = self._quote(mark, self.at + 1) if mark and mark in "\"'" else -1
                if end >= 0:
                    value, self.at = html[self.at + 1 : end], end + 1
                else:
                    bare = _BARE_VALUE.match(html, self.at)
                    value, self.at = bare[0], bare.end()
            out.append((m[1].lower(), value))
        end = html.find(">", self.at)
        closed = html[self.at : end].rstrip().endswith("/") if end >= 0 else False
        self.at = end + 1 if end >= 0 else len(html)
        return out, closed

    def skip_raw(self, name: str) -> None:
        """Moves to the end tag of an element whose content is no markup, or to the end of the page."""
        self.lower = self.lower if self.lower is not None else self.html.lower()
        if len(self.lower) == len(self.html):
            end = self.lower.find(f"</{name}", self.at)
        else:
            end = m.start() if (m := re.compile(f"</{name}", re.I).search(self.html, self.at)) else -1
        self.at = len(self.html) if end < 0 else end


def _meaning(attributes: list[tuple[str, str]]) -> tuple[bool, bool, bool, str, bool]:
    """(whether attributes mark boilerplate or hidden content, hidden content, content of readers and notices; role; whether a mark says nothing else)."""
    words, hidden, role, plain = set(), False, "", False
    for name, value in attributes:
        if name in ("class", "id"):
            for item in unescape(value).lower().split():
                if not item.startswith(_ABOUT):
                    own = set(_WORD.findall(item))
                    words |= own
                    plain = plain or not MARKS.isdisjoint(own) and all(w in MARKS or w in SHAPES or w.isdigit() for w in own)
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDING.search(value.lower()):
            hidden = True
    return hidden or not MARKS.isdisjoint(words) or role in ROLES, hidden, not NEVER_MOST.isdisjoint(words), role, plain or role in ROLES


def parse(html: str) -> list[Node]:
    """All elements in page order, the first a root; tags left open or closed out of order are mended."""
    page, root = _Page(html), Node("#", None)
    nodes, stack, open_tags = [root], [root], {}

    def cut(depth: int) -> None:
        for n in stack[depth:]:
            open_tags[n.tag] -= 1
        del stack[depth:]

    def close(which: set[str], until: set[str]) -> None:
        if any(open_tags.get(t) for t in which):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in which:
                    return cut(depth)
                if stack[depth].tag in until:
                    return

    def say(text: str) -> None:
        if text:
            stack[-1].items.append(unescape(text) if "&" in text else text)

    while page.at < len(html):
        start = html.find("<", page.at)
        say(html[page.at : start] if start >= 0 else html[page.at :])
        if start < 0:
            break
        page.at = start + 1
        if html.startswith("!--", page.at):
            end = html.find("-->", page.at + 3)
            page.at = len(html) if end < 0 else end + 3
            continue
        if html[page.at : page.at + 1] in ("!", "?"):
            end = html.find(">", page.at)
            page.at = len(html) if end < 0 else end + 1
            continue
        ending = html.startswith("/", page.at)
        m = _NAME.match(html, page.at + ending)
        if not m:
            say("<")
            continue
        page.at, name = m.end(), m[0].lower()
        attributes, closed = page.attributes()
        if ending:
            for depth in range(len(stack) - 1, 0, -1) if open_tags.get(name) else ():
                if stack[depth].tag == name:
                    cut(depth)
                    break
                if name not in BLOCK and stack[depth].tag in BLOCK:
                    break
            continue
        if name in BLOCK:
            close({"p"}, {"table", "td", "th", "button", "article", "section", "div"})
        if name in _CLOSES:
            close(*_CLOSES[name])
        node = Node(name, stack[-1], *_meaning(attributes))
        stack[-1].items.append(node)
        nodes.append(node)
        if name in VOID:
            continue
        if name in TEXT_ONLY and not (closed and name != "title"):
            page.skip_raw(name)
        if name in RAW and closed:
            continue
        if len(stack) > DEEPEST:
            cut(len(stack) - 1)
        stack.append(node)
        open_tags[name] = open_tags.get(name, 0) + 1
    return nodes


def _mild(node: Node) -> bool:
    """Whether only a mark, a role, or being a form or header speaks against an element."""
    return (node.tag in ("form", "header") or node.marked) and node.tag not in ("html", "body", "main")


def _score(nodes: list[Node], lenient: bool) -> None:
    """Marks what takes no part (``out``), sums text, link text and paragraph text, and passes the points up."""
    for n in nodes:
        n.text = n.link = n.body = 0
        n.points = 0.0
        never = n.tag in MARKUP or n.tag in BOILERPLATE or (n.hidden or n.other and not lenient) and n.tag not in ("html", "body", "main")
        n.out = never or n.parent is not None and n.parent.out
    own: dict[Node, list[int]] = {}
    for n in nodes:
        if n.out:
            continue
        for x in n.items:
            if isinstance(x, str) and not x.isspace():
                size = len(x.strip())
                n.text += size
                n.link += size if n.linked else 0
                held = own.setdefault(n.owner, [0, 0, 0])
                held[0] += size
                held[1] += x.count(",") + x.count("，") + x.count("、")
                held[2] += 0 if n.linked else size
    for n, (size, commas, unlinked) in own.items():
        if n.tag in _TEXT_HOLDERS or n.tag == "#":
            n.body += unlinked if unlinked >= 25 else 0
            holder = (n.parent or n) if n.tag in ("p", "pre", "li", "td", "dd", "blockquote") else n
            holder.points += 1 + commas + min(3, size / 100) if size >= 25 else size / 100
    for n in reversed(nodes):
        if n.out:
            continue
        if _mild(n):
            n.points *= DISCOUNT
        if n.parent is not None:
            n.parent.text += n.text
            n.parent.link += n.link
            n.parent.body += n.body
            n.parent.points += n.points / 2


def main_text(html: str | None) -> str:
    """Blocks of the article joined by \\n, in page order; empty if the page has no text.

    What is no article whatever it says (scripts, menus, footers, hidden content) takes no part, nor do notices and
    reader comments, unless next to nothing is left without them.
    """
    nodes = parse(html or "")
    _score(nodes, lenient=False)
    text = _best_text(nodes)
    _score(nodes, lenient=True)
    if len(text) < TINY * nodes[0].body or not text:
        text = max(text, _best_text(nodes), key=len)
    return text


def _best_text(nodes: list[Node]) -> str:
    best = max((n for n in nodes if not n.out and n.text), key=Node.worth, default=None)
    if best is None:
        return ""
    kept = [best]
    if best.parent is not None:
        bar = max(10.0, 0.2 * best.worth())
        kept = [s for s in best.parent.items if s is best or isinstance(s, Node) and not s.out and s.text and _sibling(s, bar)]
    blocks: list[str] = []
    for top in kept:
        _blocks(top, max(n.body for n in kept), blocks)
    return "\n".join(blocks)


def _prose(n: Node) -> bool:
    """Whether a marked element reads like part of an article: paragraphs, hardly a link, and a mark that is part of a longer name."""
    return n.body > 0 and not n.plain and not n.hidden and 5 * n.link <= n.text and n.tag not in ("form", "header")


def _sibling(n: Node, bar: float) -> bool:
    density = n.link / n.text
    return (not _mild(n) or _prose(n)) and (n.worth() >= bar or n.tag in HEADINGS and density == 0 or n.tag in ("p", "pre", "blockquote") and density < 0.25)


def _menu(n: Node, top: Node, after_text: bool) -> bool:
    """A list of nothing but links that stands before the text, or beside it in a page without containers."""
    only_links = n.tag in ("ul", "ol") and n.text > 0 and n.link == n.text and sum(isinstance(x, Node) for x in n.items) > 1
    return only_links and top.tag != "article" and (not after_text or top.tag in ("#", "html", "body"))


def _blocks(top: Node, body: int, out: list[str]) -> None:
    """Text of each block below ``top``; of marked elements those that read like prose or hold most of the paragraph text ``body``."""
    held: list[str] = []
    after_text = bool(out)

    def flush() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    todo: list = [top]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            held.append(x)
            continue
        if x is None:
            flush()
            continue
        dropped = x.out or x is not top and _mild(x) and 2 * x.body <= body and not _prose(x)
        if dropped and x.tag == "header" and not x.marked and not x.out:
            todo.extend(reversed(_titles(x)))  # an article's own header holds its title
        elif dropped or _menu(x, top, after_text):
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br" or x.tag == "img":
            held.append(" ")
        else:
            if x.tag in BLOCK:
                flush()
                todo.append(None)
                after_text = after_text or x.owner is x and x.body >= 25 and x.tag in ("p", "blockquote", "pre")
            todo.extend(reversed(x.items))
    flush()


def _titles(header: Node) -> list[Node]:
    """The headings of a header that nothing speaks against."""
    found, todo = [], list(reversed(header.items))
    while todo:
        x = todo.pop()
        if isinstance(x, Node) and not x.out and not _mild(x):
            if x.tag in HEADINGS:
                found.append(x)
            elif x.tag in ("div", "hgroup", "section"):
                todo.extend(reversed(x.items))
    return found


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with text: the main text of each whole page, replacing a column of that name.

    Null and empty pages give an empty text, repeated rows each their own, an empty table no rows.
    """
    def run(pages_of_batch):
        import pyarrow as pa

        return pa.array([main_text(h.as_py()) for h in pages_of_batch], pa.string())

    return pages.withColumn("text", arrow_column(run, "string", F.coalesce(F.col(html_col), F.lit(""))))


def op9(spark: SparkSession, pages: DataFrame) -> DataFrame:
    out = extract(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text").withColumn("n_chars", F.length("text").cast("long"))
