"""Main text of web pages by composite text density.

Every block of the document tree has a density: characters per tag, corrected by the share of link
characters and link tags. The densities of a block's children are summed, the block with the largest sum
holds the article, and the least density on its way up to the body is the threshold that blocks beside it
must reach to belong to the article as well. As the logarithm in the density grows with the size of a block,
a block beside the best one may reach the threshold in characters per tag alone instead.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "page_id long, url string, text string, n_chars long"
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"""|</?(?P<loose>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are no part of an article.
_NOISE = frozenset("head nav header footer aside button select option dialog menu svg canvas object label".split())
#: Elements that are noise unless they hold the page's text.
_WRAPPERS = frozenset(("form", "fieldset"))
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
    "sup time tt u var wbr ruby rb rt rp img br nobr".split()
)
#: Words of class, id and role names that mark menus, notices, adverts, comments and the like.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice alert menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars comment comments "
    "commentlist disqus respond reply replies footer masthead share sharing social related recommended newsletter subscribe "
    "subscription signup login popup modal overlay widget pagination pager toolbar contentinfo complementary search "
    "topbar copyright".split()
)
#: Words that name parts of a layout: an id is a mark only if it has no others, else it names what a section is about.
_LAYOUT = frozenset(
    "area bar block bottom box button buttons container content div footer form global group header icons inner item items left "
    "link links list main message outer page panel post posts right root section site slot text top unit wrap wrapper".split()
)
#: Parts of a name after which the next part is a property of the layout, not what the block is.
_MODIFIERS = frozenset("has no with without hide hides show shows".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HEADER = frozenset(("site", "page", "top", "main", "global"))
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}


class Block:
    """An element that starts a line of its own, with the text, links and blocks directly in it."""

    __slots__ = ("name", "parent", "parts", "noise", "chars", "tags", "link_chars", "link_tags", "density", "sum", "own")

    def __init__(self, name: str, parent: Block | None, noise: str):
        self.name, self.parent, self.noise = name, parent, noise
        self.parts: list = []  # strings (text), None (a line break) and blocks, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = self.own = 0
        self.density = self.sum = 0.0


def _is_noise(name: str, rest: str) -> str:
    """'noise' for elements that never hold an article, 'marked' for those that ``settle`` decides on, else ''."""
    if name in _NOISE:
        return "noise"
    if name in _WRAPPERS:
        return "marked"
    if name in ("html", "body") or name in _HEADINGS or not rest:
        return ""
    words: set[str] = set()
    for found in _NAMES.finditer(rest):
        for one in (found[2] or found[3] or found[4] or "").lower().split():
            parts = re.findall(r"[a-z0-9]+", one)
            if found[1].lower() == "id" and not all(w in _MARKS or w in _LAYOUT or w in _MODIFIERS or w.isdigit() for w in parts):
                continue
            words.update(w for before, w in zip(["", *parts], parts, strict=False) if before not in _MODIFIERS)
    if name in ("article", "main"):
        return "" if words.isdisjoint(("comment", "comments", "reply", "ad", "advert", "sponsored")) else "marked"
    if not words.isdisjoint(_MARKS) or ("header" in words and (len(words) == 1 or not words.isdisjoint(_HEADER))):
        return "marked"
    return ""


def settle(root: Block) -> None:
    """Decide which marked blocks are noise: not those with most of the page's text outside links, and, on
    a page whose only article or main elements are in marked blocks, not those with one."""
    blocks = [root]
    for b in blocks:  # grows on the way; parents before children
        blocks += [p for p in b.parts if isinstance(p, Block) and p.noise != "noise"]
    plain = {id(b): b.chars - b.link_chars for b in blocks}
    holds = {id(b): b.name in ("article", "main") and not b.noise for b in blocks}
    for b in reversed(blocks[1:]):
        plain[id(b.parent)] += plain[id(b)]
        holds[id(b.parent)] |= holds[id(b)]
    for b in blocks:
        if b.noise and 2 * plain[id(b)] > plain[id(root)]:
            b.noise = ""
    if not any(b.name in ("article", "main") for b in _blocks(root)):
        for b in blocks:
            if holds[id(b)]:
                b.noise = ""


def parse(html: str) -> Block:
    """The tree of blocks of a page. Inline elements only count; unclosed elements end where HTML says,
    and stray end tags are skipped."""
    root = at = Block("body", None, "")
    links: list[Block] = []  # open links, by the block they were opened in
    pos, size = 0, len(html)

    def close_to(block: Block) -> Block:
        while links and links[-1] is not block and not _inside(block, links[-1]):
            links.pop()
        return block

    while pos < size:
        tag = _TAG.search(html, pos)
        text = html[pos : tag.start() if tag else size]
        if text:
            if "&" in text:
                text = unescape(text)
            at.parts.append(text)
            n = len("".join(text.split())) if text else 0
            at.own += n
            at.chars += n
            if links:
                at.link_chars += n
        if tag is None:
            break
        pos = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name, rest = name.lower(), tag["rest"]
        if tag["end"]:
            if name == "a":
                if links:
                    links.pop()
            elif name == "br":
                at.parts.append(None)
            elif name in _INLINE:
                # only inline noise is a block of its own
                if at.name == name and at.parent is not None:
                    at = close_to(at.parent)
            elif name not in ("html", "body"):
                up = at
                while up is not None and up.name != name:
                    up = up.parent
                if up is not None and up.parent is not None:
                    at = close_to(up.parent)
            continue
        if name in _RAW:
            if not rest.endswith("/") or name in ("script", "style"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, pos)
                pos = end.end() if end else size
            continue
        if name in ("html", "body"):
            continue
        at.tags += name not in _INLINE or name == "a"
        if name in _VOID:
            at.parts.append(None)
            continue
        if name == "a":
            at.link_tags += 1
            links.append(at)
            continue
        if name in _INLINE and not _is_noise(name, rest):
            continue
        if name in _CLOSES_P:
            up = at
            while up.parent is not None and up.name not in ("p", "td", "th", "li", "div", "article", "section", "table"):
                up = up.parent
            if up.name == "p" and up.parent is not None:
                at = close_to(up.parent)
        if name in _SAME:
            up = at
            while up.parent is not None and up.name not in _SAME[name] and up.name not in _SCOPE[name]:
                up = up.parent
            if up.name in _SAME[name] and up.parent is not None:
                at = close_to(up.parent)
        # the header of an article has its title
        block = Block(name, at, _is_noise("div" if name == "header" and _within(at, "article") else name, rest))
        at.parts.append(block)
        at = block
    settle(root)
    return root


def _inside(block: Block, other: Block) -> bool:
    """Whether ``block`` is ``other`` or lies in it."""
    up: Block | None = block
    while up is not None:
        if up is other:
            return True
        up = up.parent
    return False


def _within(block: Block, name: str) -> bool:
    up: Block | None = block
    while up is not None and up.name != name:
        up = up.parent
    return up is not None


def _blocks(root: Block) -> list[Block]:
    """Blocks in page order without noise."""
    out, todo = [], [root]
    while todo:
        block = todo.pop()
        out.append(block)
        todo += [p for p in reversed(block.parts) if isinstance(p, Block) and not p.noise]
    return out


def _composite(b: Block, body: Block) -> float:
    """Characters per tag by a logarithm whose base grows with the share of link characters."""
    if not b.chars:
        return 0.0
    per_tag = b.chars / max(1, b.tags)
    ratio = b.chars / max(1, b.link_chars) * max(1, b.tags) / max(1, b.link_tags)
    plain = max(1, b.chars - b.link_chars)
    base = math.log(b.chars / plain * b.link_chars + body.link_chars / max(1, body.chars) * b.chars + math.e)
    # base is 1 without any links; the logarithm to a base below e would only add scale
    return per_tag * max(0.0, math.log(ratio)) / max(1.0, math.log(base))


def weigh(root: Block) -> list[Block]:
    """Blocks in page order with counts over their subtrees, densities and the sums of their children's."""
    blocks = _blocks(root)
    for b in reversed(blocks):  # children before parents
        if b.parent is not None:
            for k in ("chars", "tags", "link_chars", "link_tags"):
                setattr(b.parent, k, getattr(b.parent, k) + getattr(b, k))
    for b in blocks:
        b.density = _composite(b, root)
    for b in blocks:
        # text directly in a block counts as a child without tags
        b.sum += b.own
        if b.parent is not None:
            b.parent.sum += b.density
    return blocks


def _per_tag(b: Block) -> float:
    """Characters outside links per tag, less by the share of links, whatever the size of the block."""
    plain = b.chars - b.link_chars
    return plain / max(1, b.tags) * plain / b.chars if b.chars else 0.0


def _texts_of(b: Block) -> list[Block]:
    """The parts of a block in page order, with the text between two blocks as a block of its own. Where links
    have a third of the text directly in a block, all of it counts as links."""
    inside = [p for p in b.parts if isinstance(p, Block)]
    links = 3 * (b.link_chars - sum(p.link_chars for p in inside if not p.noise)) >= max(1, b.own)
    out: list[Block] = []
    for p in b.parts:
        if isinstance(p, Block):
            if not p.noise:
                out.append(p)
        else:
            if not out or out[-1].name != "":
                out.append(Block("", b, ""))
            out[-1].parts.append(p)
    for p in out:
        if p.name == "":
            p.chars = sum(len("".join(t.split())) for t in p.parts if t)
            p.link_chars = p.chars if links else 0
    return out


def article(root: Block) -> list[Block]:
    """The blocks that make up the article: disjoint subtrees in page order."""
    blocks = weigh(root)
    best = max(blocks, key=lambda b: b.sum)  # the first of equal ones
    threshold, even, up, top = best.density, _per_tag(best), best, None
    path: set[int] = set()
    while up is not None:
        if up.name in ("article", "main"):
            top = up
        path.add(id(up))
        threshold, even = min(threshold, up.density), min(even, _per_tag(up))
        up = up.parent

    def belongs(b: Block) -> bool:
        # without links half the least is enough, as a block of few lines has more tags for its text
        return b.chars > 0 and (b.name != "" and b.density >= threshold or _per_tag(b) * (1 if b.link_chars else 2) >= even)

    if top is not None:
        if top.name == "main":
            return [top]
        # other articles of the page
        return [b for b in blocks if b is top or (b.name == "article" and not _inside(b, top) and not _within(b.parent, "article") and belongs(b))]
    if best is root:
        return [best]
    # what stands beside the way up, in page order, and whether it belongs to the article
    beside: list[tuple[Block, bool]] = []
    todo = [root]
    while todo:
        b = todo.pop()
        if b is not best and id(b) in path:
            todo += reversed(_texts_of(b))
        else:
            beside.append((b, b is best or belongs(b)))
    first = next(i for i, (_, taken) in enumerate(beside) if taken)
    # a title outside opens the article: what stands from it to the text belongs to it, but for links
    titles = [i for i, (b, _) in enumerate(beside) if any(x.name == "h1" for x in _blocks(b))]
    opens = titles[-1] if titles and titles[-1] < first else first
    return [b for i, (b, taken) in enumerate(beside) if taken or (opens <= i < first and 3 * b.link_chars < b.chars)]


def block_texts(blocks: list[Block]) -> list[str]:
    """Texts of the lines of the blocks in page order, white space as one space, without empty ones."""
    out: list[str] = []
    for top in blocks:
        line: list[str] = []
        todo: list = [top]
        while todo:
            p = todo.pop()
            if isinstance(p, Block):
                if p.noise and p is not top:
                    continue
                out.append("".join(line))
                line = []
                todo.append(0)
                todo += reversed(p.parts)
            elif p == 0 and not isinstance(p, str):
                out.append("".join(line))
                line = []
            else:
                line.append(" " if p is None else p)
        out.append("".join(line))
    return [x for x in (" ".join(t.split()) for t in out) if x]


def main_text(html: str | None) -> str:
    return " ".join(block_texts(article(parse(html)))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (``page_id, url, html``; other columns are ignored).

    ``text`` is empty if there is none, ``n_chars`` counts its code points. A null html counts as empty.
    Pages are read whole and row by row; broken markup never fails. Repeated rows give repeated results, an empty
    table an empty one.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = [main_text(h) for h in f.html]
            out = {"page_id": f.page_id.astype("Int64"), "url": f.url, "text": texts, "n_chars": list(map(len, texts))}
            yield pd.DataFrame(out)

    return pages.select("page_id", "url", "html").mapInPandas(run, RESULT)
