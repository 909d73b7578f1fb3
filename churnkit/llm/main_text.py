"""Main text of HTML pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard-library parser streams events; every block element begins a new line, which records its text,
the tags met in it and its place in the element tree. The ratio of text to tags per line is smoothed along the
page and cut by a two-class threshold: lines above it are content. The region is then every article (or main) element
that is not a comment, and the heading before it, or, without one, the lowest element that holds all content lines, their
heading and the paragraphs beside them (the page's ends without lines of links only). Every line of the region
is given out, short ones too, but for those in menus, headers, footers, sidebars, notices, adverts, forms and reader
comments, which tags, roles and class names tell. The text overrules names and forms: see ``_cleared``.

Null or empty html, or a page without an article: empty text. Null ids and repeated rows: each row is a page. Ties
between regions: the first of the page. Broken markup (unclosed or stray tags) never fails. Very long pages are read
whole. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from churnkit.llm.common import field, per_text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre search section summary table tbody td tfoot th thead tr ul""".split())
# text in these is never part of an article
NEVER = frozenset("""aside audio button canvas datalist dialog footer form head iframe input label menu nav noscript
object option script search select style svg template textarea title video""".split())
# parts of class names, ids and roles
JUNK = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments
consent contentinfo complementary cookie cookies copyright dialog disqus footer form gdpr masthead menu menubar modal nav
navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted
promotion reactions recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored
subscribe subscription tabs toolbar topbar widget""".split())
# parts of names that say nothing of their own, and states of a page rather than names ('no-sidebar', 'comments-open')
FILLER = frozenset("""area bar block body bottom box button buttons container content footer group header hidden icon icons inner item
items left link links list main outer page post posts primary right row secondary section site text title top wrap wrapper""".split())
STATES = frozenset("allowed closed disabled enabled has hide no off on open opened show with without".split())
READERS = frozenset("comment comments disqus replies respond".split())
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTS = HEADINGS | {"p", "blockquote"}
WRAPS = frozenset("div section".split())
REGIONS = frozenset("article body center div fieldset html main section table tbody td".split())
PARAGRAPH_ENDS = frozenset("p dt dd li option tr td th".split())


MAYBE, NAMED, SURE = 1, 2, 3


@lru_cache(maxsize=4096)
def _fused(name: str) -> tuple[str, ...]:
    """The two parts of a junk name written as one word ('cookiebanner'); none for other words."""
    known = JUNK | FILLER
    if name not in known:
        for at in range(2, len(name) - 1):
            a, b = name[:at], name[at:]
            if a in known and b in known and (a in JUNK or b in JUNK):
                return a, b
    return ()


class Page(HTMLParser):
    """Elements as (parent, tag, junk) in page order and lines as (element, pieces of text, tags,
    characters in links).

    ``junk`` is 0, MAYBE (a junk word among others in a name), NAMED (a junk name, or a form), or SURE."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.junk = [-1], [""], [0]
        self.within = [False]                       # junk, or inside it
        self.open: list[int] = [0]
        self.link = [False]
        self.lines: list[list] = [[0, [], 0, 0]]
        self.block: list | None = None              # the line that an inline part set aside for its junk interrupts

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)          # <![...: never an error

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._end_paragraph(tag)
        if tag not in VOID:
            self.parent.append(self.open[-1])
            self.tag.append(tag)
            self.link.append(tag == "a" or self.link[self.open[-1]])
            self.junk.append(self._is_junk(tag, attrs))
            if self.junk[-1] and tag not in BLOCKS and not self.within[self.open[-1]]:
                self.block = self.block or self.lines[-1]
            self.within.append(bool(self.junk[-1]) or self.within[self.open[-1]])
            self.open.append(len(self.tag) - 1)
        if tag in BLOCKS:
            self._new_line()
        elif tag == "br":
            (self.block or self.lines[-1])[1].append(" ")
        self.lines[-1][2] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1][2] += 1
        for at in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[at]] == tag:
                del self.open[at:]
                break
        else:
            return
        if tag in BLOCKS:
            self._new_line()

    def _new_line(self) -> None:
        self.lines.append([self.open[-1], [], 0, 0])
        if not self.within[self.open[-1]]:
            self.block = None

    def handle_data(self, data: str) -> None:
        line = self.lines[-1]
        if line[0] != self.open[-1] and self._apart(line[0]):
            if self.block is not None and not self.within[self.open[-1]]:
                line = self.block                   # behind an inline script or button the block goes on
            else:
                self.lines.append(line := [self.open[-1], [], 0, 0])
        line[1].append(data)
        if self.link[self.open[-1]]:
            line[3] += len("".join(data.split()))

    def _apart(self, element: int) -> bool:
        """Text of a script, form or advert inside a block is not text of the block."""
        inner = self.open[-1]
        return self.junk[inner] or self.junk[element] and inner != element

    def _end_paragraph(self, tag: str) -> None:
        """A block ends an open paragraph; an item, cell or row ends the one before it."""
        for at in range(len(self.open) - 1, 0, -1):
            was = self.tag[self.open[at]]
            if was == "p" or was == tag and tag in PARAGRAPH_ENDS:
                del self.open[at:]
                return
            if was in BLOCKS or was in NEVER:
                return

    def _is_junk(self, tag: str, attrs: list) -> int:
        if tag in NEVER:
            return NAMED if tag == "form" else SURE
        inside = any(self.tag[i] in ("article", "main") for i in self.open)
        if tag == "header":
            return 0 if inside else SURE
        if tag in ("html", "body", "main", "h1"):
            return 0
        names = [{p.lower() for p in PART.findall(x)} for k, v in attrs if k in ("class", "id", "role") and v for x in v.split()]
        if tag == "article":
            return SURE if any(x & {"comment", "ad", "advert", "promo", "related", "sponsored", "teaser"} for x in names) else 0
        worst = 0
        if tag in ("ol", "ul", "li") and any(x & {"thread", "response", "responses"} for x in names):
            return SURE                                 # a list of what readers wrote
        for x in names:
            if x & STATES:
                continue
            x = x | {part for name in x for part in _fused(name)}
            if x & READERS:
                return SURE
            if x & JUNK or "header" in x and not inside:
                plain = {name for name in x if not _fused(name)}
                worst = max(worst, NAMED if plain <= JUNK | FILLER else MAYBE)
        return worst


def _cleared(page: Page) -> None:
    """Names and forms are overruled by what they hold, never by how long they are beside an article.

    Content are a form and an element with a junk word in its name that hold the page's main part, its largest article or its title,
    where none of these lies outside junk. Parts of an article or main element outside junk, or of a page that has none
    and no title either, are judged by density: a form, or a junk word among others, is content if it holds most
    of the dense text there or its own is dense, and a plain junk name if no dense text there lies elsewhere."""
    n = len(page.tag)
    held = [0] * n                                     # the worst of each element and its parents
    for i in range(1, n):
        held[i] = max(page.junk[i], held[page.parent[i]])
    lines = [(e, len(" ".join("".join(pieces).split())), tags) for e, pieces, tags, _ in page.lines]
    lines = [(e, size, tags, math.log1p(size / max(1, tags))) for e, size, tags in lines if size and held[e] < SURE]
    dense, every, free = [0] * n, [0] * n, [0] * n
    cut = _threshold([r for *_, r in lines]) if lines else 0.0
    for e, size, _, r in lines:
        dense[e] += size if r >= cut else 0
        free[e] += size if r >= cut and not held[e] else 0
        every[e] += size
    for i in range(n - 1, 0, -1):
        dense[page.parent[i]] += dense[i]
        every[page.parent[i]] += every[i]
        free[page.parent[i]] += free[i]
    articles = [i for i in range(n) if page.tag[i] == "article" and held[i] < SURE]
    largest = max(articles, key=lambda i: every[i], default=-1)
    mains = [i for i in range(1, n) if page.tag[i] == "main" or i == largest]
    titles = [i for i in range(1, n) if page.tag[i] == "h1"]
    clear = lambda i: not held[i] and every[i] > 0
    within = [0] * n                                   # the part that decides for each element: 0 is the page
    if any(clear(i) for i in mains):
        for i in range(1, n):
            within[i] = i if page.tag[i] in ("article", "main") and clear(i) else within[page.parent[i]]
        judged = [i for i in range(1, n) if within[i]]
    else:
        for i in mains + ([] if any(clear(i) for i in titles) else titles):
            at = page.parent[i]
            while at > 0:
                if page.tag[at] != "header" and (page.tag[at] not in NEVER or page.tag[at] == "form"):
                    page.junk[at] = 0
                at = page.parent[at]
        judged = [] if any(every[i] for i in mains) or free[0] and any(clear(i) for i in titles) else list(range(1, n))
    low = min((r for *_, r in lines), default=0.0)
    for i in judged:
        part = within[page.parent[i]]
        if dense[i] and (page.junk[i] == MAYBE or page.junk[i] == NAMED and page.tag[i] == "form"):
            if 2 * dense[i] > dense[part] or page.junk[i] == MAYBE and 2 * dense[i] >= every[i] and cut > low:
                page.junk[i] = 0
        elif dense[i] and page.junk[i] == NAMED and not free[part] and 2 * dense[i] > dense[part]:
            page.junk[i] = 0


def _smooth(values: list[float], sigma: float) -> list[float]:
    """Gaussian mean along the page; at its ends the weights that remain are scaled up."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        weights = [kernel[abs(i - j)] for j in range(low, high)]
        out.append(sum(w * v for w, v in zip(weights, values[low:high])) / sum(weights))
    return out


def _threshold(values: list[float]) -> float:
    """The cut between the two clusters of one-dimensional two-means; below all values if they are one."""
    low, high = min(values), max(values)
    for _ in range(20):
        cut = (low + high) / 2
        under, over = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not under or not over:
            return min(values)
        low, high = sum(under) / len(under), sum(over) / len(over)
    return (low + high) / 2


def _outermost(page: Page, elements: list[int]) -> list[int]:
    under = [False] * len(page.tag)
    for i in elements:
        under[i] = True
    for i in range(1, len(page.tag)):
        under[i] = under[i] or under[page.parent[i]]
    return [i for i in elements if not i or not under[page.parent[i]]]


def _common(page: Page, elements: list[int]) -> int:
    """The lowest element that holds all of them."""
    held = [0] * len(page.tag)
    for i in elements:
        held[i] += 1
    for i in range(len(held) - 1, -1, -1):             # children come after their parents
        if held[i] == len(elements):
            return i
        held[page.parent[i]] += held[i]
    return 0


def _heading(page: Page, lines: list[tuple], used: list[bool], linked: list[bool], kept: list[bool], at: int) -> int | None:
    """The heading that the text at line ``at`` follows: nothing but junk and short lines lie between."""
    found = None
    for j in range(at, -1, -1):
        if j < at and kept and kept[j]:
            break
        if used[j]:
            i = lines[j][0]
            while i and page.tag[i] not in BLOCKS:
                i = page.parent[i]
            if page.tag[i] == "h1":
                return j
            if page.tag[i] in HEADINGS and found is None:
                found = j
            elif j < at and linked[j]:
                break
    return found


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The article's blocks joined by an empty line."""
    page = Page()
    page.feed(html or "")
    page.close()
    n = len(page.tag)
    _cleared(page)
    for i in range(1, n):
        page.junk[i] = page.junk[i] or page.junk[page.parent[i]]
    texts = [(e, " ".join("".join(pieces).split()), tags, links) for e, pieces, tags, links in page.lines]
    texts = [x for x in texts if x[1]]
    lines = [x[:3] for x in texts]
    if all(page.junk[e] for e, _, _ in lines):
        return ""
    own = [0.0 if page.junk[e] else math.log1p(len(text) / max(1, tags)) for e, text, tags in lines]
    ratio = _smooth(own, sigma)
    cut = _threshold([r for r, (e, _, _) in zip(ratio, lines) if not page.junk[e]])
    ratio = [max(r, o) for r, o in zip(ratio, own)]    # a dense line between junk is content too
    mass = [0] * n
    for r, (e, text, _) in zip(ratio, lines):
        if r >= cut and not page.junk[e]:
            mass[e] += len(text)
    for i in range(n - 1, 0, -1):                      # children come after their parents
        mass[page.parent[i]] += mass[i]
    inside = [False] * n                               # elements given out whole
    used = [not page.junk[e] for e, _, _ in lines]
    linked = [links >= len("".join(text.split())) for _, text, _, links in texts]
    first, last = 0, len(lines) - 1
    outer = _outermost(page, [i for i in range(n) if page.tag[i] in ("article", "main") and not page.junk[i]])
    spoken = [0] * n                                   # text that is no link
    for u, link, (e, text, _) in zip(used, linked, lines):
        spoken[e] += len(text) if u and not link else 0
    for i in range(n - 1, 0, -1):
        spoken[page.parent[i]] += spoken[i]
    if any(mass[i] or spoken[i] for i in outer):
        for i in outer:
            inside[i] = True
        for i in range(1, n):
            inside[i] = inside[i] or inside[page.parent[i]]
        kept = [u and inside[e] for u, (e, _, _) in zip(used, lines)]
        top = list(range(n))                           # the outermost part of each element
        for i in range(1, n):
            top[i] = top[page.parent[i]] if inside[page.parent[i]] else i
        starts: dict[int, int] = {}
        for j, (e, _, _) in enumerate(lines):
            if kept[j]:
                starts.setdefault(top[e], j)
        titled = {top[i] for i in range(n) if page.tag[i] == "h1"}
        for at in [j for i, j in starts.items() if i not in titled]:
            title = _heading(page, lines, used, linked, kept, at)
            for j in range(at if title is None else title, at):
                kept[j] = used[j]
        used = kept
    else:
        above = [j for j, (r, (e, _, _)) in enumerate(zip(ratio, lines)) if r >= cut and used[j]]
        region = _common(page, [lines[j][0] for j in above])
        title = _heading(page, lines, used, linked, [], above[0])
        if title is not None:
            region = _common(page, [region, lines[title][0]])
        while region and page.tag[region] not in REGIONS:
            region = page.parent[region]
        beside = {page.parent[e] for j, (e, _, _) in enumerate(lines) if used[j] and not linked[j] and page.tag[e] in TEXTS}
        beside |= {page.parent[i] for i in beside if page.tag[i] == "section"}
        while page.tag[region] not in ("", "html", "body") and page.parent[region] in beside and page.tag[page.parent[region]] in WRAPS:
            region = page.parent[region]               # paragraphs and sections beside the content
        inside[region] = True
        for i in range(region + 1, n):
            inside[i] = inside[page.parent[i]]
        used = [u and inside[e] for u, (e, _, _) in zip(used, lines)]
        if page.tag[region] in ("", "html", "body"):    # of the page's own ends, not what is links only
            while first < above[0] and (linked[first] or not used[first]):
                first += 1
            while last > above[-1] and (linked[last] or not used[last]):
                last -= 1
    out = [text for j, (_, text, _) in enumerate(lines) if used[j] and first <= j <= last]
    return "\n\n".join(out)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", **how) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``."""
    def make():
        def one(text: str | None) -> tuple:
            found = main_text(text, **how)
            return found, len(found)
        return one

    return per_text(pages, [page_id, url], html, make, [field("text", T.StringType()), field("n_chars", T.LongType())])
