"""Main text of web pages by tag-path ratios.

A page is cut into text blocks, each with its tag path: the open block elements from the root, with the class
of a ``div`` or ``section``, so that what a template repeats shares a path. Then, per page,

1. elements whose tag or ARIA role says that they are no main text go: navigation, page headers and footers, asides, dialogs,
   hidden ones, and forms unless they hold most of the page's paragraphs. A class or id goes by its share of the page: an
   element named advert, menu, sidebar, cookie or comment (as a whole word or the last part of one) goes if it holds less than
   a quarter of the text, or, if the word stands alone, up to three quarters or beside an article; readers' comments go
   wherever a paragraph stands outside of them. Otherwise such names, and names that main text has too (widget, search, alert, discussion, tags, related), weigh half;
2. for every remaining path the text ratio (characters of text per text block) and the punctuation ratio (sentence
   marks per text block) are summed over all its blocks, link text counting against it;
3. both, scaled by the page's largest, are fused. What stands outside of ``article`` and ``main`` elements weighs less, the
   less the more of the page's text stands inside (down to half). Values are smoothed along the page with a small
   Gaussian, not across the border of such or doubtful elements, so a short paragraph or a heading between long ones keeps its place;
4. blocks whose value reaches the threshold, a share of the page's standard deviation, are content, unless they are
   mostly links. They select nodes: paragraphs, lists, tables and headings that stand directly in the flow of an element of which
   selected blocks hold most text belong to it, however short (a cell "2001", a list item "one", a paragraph of one long link).

Character references are decoded, white space inside a block becomes one space, blocks join in page order by an empty
line. Pages come one by one, in Arrow batches, on whatever tasks read them: no shuffle, no state between pages.

Defined cases: null, empty and text-free html give the empty text; html without any tag is one block of content;
repeated rows are treated alike; an empty table gives no rows; further columns stay, except that ``text`` and
``n_chars`` are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set(
    "script style textarea title xmp iframe noembed noframes noscript template svg object canvas annotation annotation-xml".split()
)
SKIPPED = set("head nav aside dialog menu button select label script style".split())
FORMS = {"form", "fieldset"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr ruby rt rp img picture source br "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mtable mtr mtd mpadded "
    "mphantom semantics".split()
)
#: Elements of running text; what stands in these and nothing else belongs to the element around them.
FLOW = set(
    "p li ul ol dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption h1 h2 h3 h4 h5 h6 center "
    "address summary details".split()
)
TABLES = set("table thead tbody tfoot tr".split())
CLOSED_BY = {
    "p": set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
             "pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
#: Closing these looks no further than the nearest of them.
WALLS = set("table td th article main section div body html".split())
#: Words in class, id or role that name what is not main text.
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies disqus footer gdpr header masthead menu menus nav navbar newsletter pager pagination popup promo promos "
    "sidebar sidebars signup sponsored subscribe topbar".split()
)
#: Roles of the ARIA standard that say it.
ASIDE_ROLES = set(
    "alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split()
)
#: Words that may also name main text, as page builders, papers and manuals do.
DOUBTFUL_WORDS = set(
    "alert banner banners complementary consent contentinfo copyright dialog disclaimer discussion modal navigation notice "
    "notices notification notifications promoted promotion recommended related replies reply responses search share "
    "sharing social sponsor subscription tags toolbar widget widgets".split()
)
#: Of these, the ones for readers' comments.
COMMENT_WORDS = set("comment comments commentlist disqus".split())
#: Last words of a name that say only that something is a box: ``cookie-notice`` is named by ``cookie``.
BOX_WORDS = set("area banner bar block box container inner list notice panel section widget wrap wrapper".split())
#: Words that say it of an ``article`` too: readers' comments and teasers are often articles of their own.
ASIDE_ARTICLES = set("ad advert comment comments promo related replies reply sponsored".split())
#: ``with-sidebar`` and the like describe the layout around the main text.
LAYOUT = set("with has no without".split())
OWN = {"article", "main"}
MARKS = re.compile(r"[.,;:!?…。，；：！？、]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>?", re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
HEADINGS = re.compile(r"h[1-6]$")
#: Characters of a block that counts as a paragraph, and of a paragraph that may be one link.
LONG, LONG_LINK = 80, 25


@dataclass
class Element:
    """An open element: its path, whether it is left out, stands in an article or is doubtful, and what it may fall to."""

    name: str
    path: str
    gone: bool
    own: bool
    doubt: bool
    number: int
    trail: tuple[int, ...]  # numbers of the elements down to this one
    cuts: tuple[int, ...]  # those of them that go if they hold little


@dataclass
class Block:
    path: str
    text: str
    links: int
    own: bool
    doubt: bool
    trail: tuple[int, ...]
    cuts: tuple[int, ...]


class Page:
    """The text blocks of a page in order, the names of its elements, and the ones that may be cut."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.names: list[str] = []
        self.cuts: dict[int, str] = {}  # element: form, comments, alone or last


ROOT = Element("", "", False, False, False, -1, (), ())


def _names(attrs: str) -> tuple[set[str], set[str], set[str], set[str], str, bool]:
    """Words of class and id: all, the last of each token, those that are a token; the roles; the class; whether it is hidden."""
    found, last, alone, roles, css, hidden = set(), set(), set(), set(), "", False
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), a or b or c
        if key in ("class", "id", "itemprop"):
            for one in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
                parts = [w for w in re.split(r"[\W_]+", one) if w]
                if parts and parts[0] not in LAYOUT:
                    found.update(parts)
                    while len(parts) > 1 and parts[-1] in BOX_WORDS:
                        parts.pop()
                    last.add(parts[-1])
                    if len(parts) == 1:
                        alone.add(parts[0])
            if key == "class":
                css = " ".join(sorted(value.lower().split()))
        elif key == "role":
            roles.update(value.lower().split())
        elif key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    if re.search(r"(?:^|\s)hidden(?:\s|$)", ATTRIBUTE.sub(" ", attrs), re.I):
        hidden = True
    return found, last, alone, roles, css, hidden


def _opened(page: Page, parent: Element, name: str, attrs: str) -> Element:
    words, last, alone, roles, css, hidden = _names(attrs)
    number = len(page.names)
    page.names.append(name)
    own = parent.own or name in OWN or "articlebody" in words
    gone = parent.gone or hidden or name in SKIPPED or bool(roles & ASIDE_ROLES)
    gone = gone or (name in ("header", "footer") and not (name == "header" and parent.own))
    doubt, cut = parent.doubt, "form" if name in FORMS else ""
    if name not in ("html", "body", "main") and not HEADINGS.match(name):
        aside = ASIDE_ARTICLES if name == "article" else ASIDE_WORDS - {"header", "masthead"} if parent.own else ASIDE_WORDS
        if last & aside:
            cut = cut or ("comments" if last & COMMENT_WORDS else "alone" if alone & aside else "last")
        elif name != "article":
            doubt = doubt or bool(words & (DOUBTFUL_WORDS | aside))
    if cut and not gone:
        page.cuts[number] = cut
    step = f"{name}.{css}" if css and name in ("div", "section", "td") else name
    path = f"{parent.path}/{step}{'?' if doubt else ''}"
    return Element(name, path, gone, own, doubt, number, (*parent.trail, number), (*parent.cuts, number) if cut else parent.cuts)


def blocks_of(html_text: str) -> Page:
    """Text blocks of a page in order, without those that tags and roles rule out."""
    out, page = Page(), html_text
    stack: list[Element] = []
    text: list[str] = []
    links, in_link = 0, 0

    def end_block() -> None:
        nonlocal links
        if text:
            at = stack[-1] if stack else ROOT
            if not at.gone:
                whole = SPACE.sub(" ", html.unescape("".join(text))).strip()
                if whole:
                    out.blocks.append(Block(at.path, whole, links, at.own, at.doubt, at.trail, at.cuts))
            text.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        if piece and not (stack and stack[-1].gone):
            text.append(piece)
            if in_link:
                links += len(piece.strip())

    at, n = 0, len(page)
    while at < n:
        next_tag = page.find("<", at)
        if next_tag < 0:
            add(page[at:])
            break
        add(page[at:next_tag])
        token = TOKEN.match(page, next_tag)
        if token is None or token.end() == next_tag:
            add("<")
            at = next_tag + 1
            continue
        at = token.end()
        name = token["name"]
        if name is None:
            if token["cdata"]:
                add(html.escape(token["cdata"]))
            continue
        name, attrs = name.lower(), token["attrs"] or ""
        if token["close"]:
            if name == "a":
                in_link = 0
            elif name == "p" and not any(e.name == "p" for e in stack):
                end_block()
            elif name not in INLINE:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
                if depth is not None and (name in WALLS or not any(e.name in WALLS for e in stack[depth + 1 :])):
                    end_block()
                    del stack[depth:]
                elif depth is None:
                    end_block()
            continue
        if name in RAW:
            if name == "svg" and attrs.rstrip().endswith("/"):
                continue  # closed by itself
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = close.end() if close else (n if name in ("script", "style", "textarea", "title", "xmp") else at)
            continue
        if name == "br":
            add(" ")
            continue
        if name in INLINE:
            if name == "a":
                in_link = 1
            continue
        end_block()
        in_link = 0
        if name in VOID:
            continue
        while stack and name in CLOSED_BY.get(stack[-1].name, ()):
            stack.pop()
        stack.append(_opened(out, stack[-1] if stack else ROOT, name, attrs))
    end_block()
    return out


def remaining(page: Page) -> list[Block]:
    """Without the elements that go by name and share, and without forms that do not hold the page."""
    size, prose = Counter(), Counter()
    for b in page.blocks:
        for e in b.cuts:
            size[e] += len(b.text)
            prose[e] += len(b.text) if len(b.text) >= LONG else 0
    total = sum(len(b.text) for b in page.blocks)
    paragraphs = sum(len(b.text) for b in page.blocks if len(b.text) >= LONG)
    named = {e for e, kind in page.cuts.items() if kind == "comments"}
    outside = any(len(b.text) >= LONG and not named.intersection(b.cuts) for b in page.blocks)
    article = any(b.own and not b.cuts for b in page.blocks)

    def goes(e: int) -> bool:
        kind = page.cuts[e]
        if kind == "form":
            return 2 * prose[e] <= paragraphs
        return 4 * size[e] < total or (kind == "comments" and outside) or (kind != "last" and (article or 4 * size[e] <= 3 * total))

    gone = {e for e in page.cuts if goes(e)}
    out = []
    for b in page.blocks:
        if not gone.intersection(b.cuts):
            half = any(page.cuts[e] != "form" for e in b.cuts)
            out.append(replace(b, doubt=True, path=f"{b.path}?") if half and not b.doubt else b)
    return out


def path_values(found: list[Block], radius: int = 2, sigma: float = 1.0) -> np.ndarray:
    """Fused and smoothed ratio of each block's path."""
    paths: dict[str, int] = {}
    at = np.array([paths.setdefault(b.path, len(paths)) for b in found])
    n = np.bincount(at)
    chars = np.bincount(at, [max(0, len(b.text) - 2 * b.links) for b in found]) / n
    marks = np.bincount(at, [len(MARKS.findall(b.text)) for b in found]) / n
    scale = lambda x: np.log1p(x) / max(np.log1p(x).max(), 1e-9)
    fused = (scale(chars) * (1 + scale(marks)) / 2)[at]
    own = np.array([b.own for b in found])
    doubt = np.array([b.doubt for b in found])
    fused = np.where(doubt, fused / 2, fused)
    plain = np.array([max(0, len(b.text) - b.links) for b in found])
    fused = np.where(own, fused, fused * (1 - plain[own].sum() / max(plain.sum(), 1) / 2))
    run = np.append(0, np.cumsum((own[1:] != own[:-1]) | (doubt[1:] != doubt[:-1])))
    total, weight = fused.copy(), np.ones(len(fused))
    for d in range(1, min(radius + 1, len(fused))):
        w = np.exp(-0.5 * (d / sigma) ** 2) * (run[d:] == run[:-d])
        total[d:] += w * fused[:-d]
        total[:-d] += w * fused[d:]
        weight[d:] += w
        weight[:-d] += w
    return total / weight


def in_flow(found: list[Block], kept: np.ndarray, names: list[str]) -> np.ndarray:
    """``kept`` and the blocks that stand in the flow of an element most of whose text is kept."""
    size, held, doubtful = Counter(), Counter(), {}
    for b, k in zip(found, kept):
        for e in b.trail:
            size[e] += len(b.text)
            held[e] += len(b.text) * bool(k)
            doubtful[e] = doubtful.get(e, True) and b.doubt
    at = np.flatnonzero(kept)
    out = kept.copy()
    for i, b in enumerate(found):
        if kept[i]:
            continue
        for e in reversed(b.trail):
            if held[e]:
                around = not (names[e] in TABLES and not b.own) and (names[e] not in ("body", "html") or at[0] < i < at[-1])
                out[i] = around and 2 * held[e] >= size[e] and b.doubt == doubtful[e]
                break
            if names[e] not in FLOW:
                break
    return out


def main_text(page: str | None, share: float = 1.0) -> str:
    """The article of a page; ``share`` scales the threshold."""
    whole = blocks_of(page or "")
    found = remaining(whole)
    if not found:
        return ""
    values = path_values(found)
    linked = np.array([b.links >= 0.8 * len(b.text) for b in found])
    kept = (values >= share * values.std()) & ~linked
    if not kept.any():
        kept = values >= values.max()
    paragraph = np.array([b.path.rstrip("?").endswith("/p") and len(b.text) >= LONG_LINK for b in found])
    kept = kept | in_flow(found, kept, whole.names) & (~linked | paragraph)
    return "\n\n".join(b.text for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points)."""
    pages = pages.drop("text", "n_chars")
    names = pages.columns
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                piece = batch.slice(begin, 256)
                texts = [main_text(x) for x in piece.column(page).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*names, "text", "n_chars"],
                )

    return pages.mapInArrow(run, schema)
