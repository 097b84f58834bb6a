"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering.

The standard library's streaming parser feeds a line builder: a block element begins a new line, inline tags only count as tags
of the line. Text inside elements that are no article text by their own account (nav, footer, aside, script, style, ...) never
becomes a line. Each line has a ratio of text to tags; the ratios are smoothed with a Gaussian, and lines above the threshold
(``spread`` standard deviations, capped at the mean) form the content cluster.

The cluster selects content regions. Where a page has article elements, those that hold cluster text are selected, less the ones that
are mostly links and hold under a quarter of the largest one's share, and less comments and teasers (below); all lines of a
selected article stay. Elsewhere the smallest container that holds nearly all of the cluster is opened, and each container inside
it is judged by the lines that reach the threshold by themselves: it stays if they make up half of its text, if they stand under
a plain heading of its own, or if a container of the same kind beside it stays; a list, table or quotation stays next to cluster
lines, and a container with the page's first heading always. So menus, share bars, adverts, notices and author boxes go
whatever they are called, and short paragraphs beside long ones stay. Containers of two or more like items, each with a short line
(who, when) beside its text and without headings, are comments or teasers and go, unless they hold most of the text.

Names are a second witness. Containers are marked off by a form element or a whole class, id or role token (menu, ad,
cookie-notice, comments), or by a class token with a telling word in it (user-comments, share-tools), which a plain heading over text
that reaches the threshold outweighs. An article, main, heading, paragraph or inline element never is by its name; but an article
whose name says comment or related beside another one of twice its text goes, as does any article of less text beside a main
element. The mark of a container that holds most of the page's text is overruled.

White space inside a block becomes one space, blocks are trimmed and joined by two line feeds; character references are
decoded by the parser. Edge cases: null, empty and tag-free pages work (plain text is one block); unclosed tags, stray end tags
and unclosed scripts follow the parser; repeated rows give repeated results; very long pages are parsed whole, in time and memory proportional to
them; extra columns stay as they are, those named like a result are replaced.
"""
from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIP = frozenset("head title script style noscript template svg math iframe object embed nav footer aside button select "
                 "textarea input dialog menu canvas audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that hold others and so may be regions.
HOLDER = frozenset("html body article main section div header center td table tbody blockquote ul ol li dl figure details form".split())
#: Holders whose lines belong together.
LISTS = frozenset("ul ol li dl table tbody blockquote figure details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = HOLDER | frozenset("p h1 h2 h3 h4 h5 h6 dt dd tr th pre address figcaption summary hr fieldset legend caption thead tfoot "
                           "nav footer aside form title dialog menu".split())
#: Elements that no class, id or role marks off: the content itself, headings, paragraphs and what stands within a line.
UNNAMED = ARTICLE | frozenset("html body p h1 h2 h3 h4 h5 h6 a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                              "q s samp small span strong sub sup time tt u var pre".split())
#: A token of class, id or role marks a container off if one of its words is in BOILERPLATE and all others are there or in LAYOUT.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
    "comment comments commentlist disqus replies social share sharing related recommended widget toolbar contentinfo complementary search pagination".split())
LAYOUT = frozenset("container wrapper wrap box block list bar button buttons link links item items icons area section inner outer left right "
                   "top bottom main primary secondary site page global mobile desktop post posts article articles stories entry form thread slot unit".split())
#: Words that tell within a longer class token, unless it states a condition.
TELLING = frozenset("ad ads advert adverts advertisement sponsor sponsored promo newsletter subscribe cookie cookies consent gdpr comment comments "
                    "disqus replies share sharing related recommended breadcrumb breadcrumbs popup modal".split())
CONDITION = frozenset("has have with without no not is are free open closed enabled disabled".split())
#: Containers of these names may be longer than the article they belong to.
COMMENTS = frozenset("comment comments commentlist disqus replies".split())
PAGE_HEADER = frozenset(("header", "topbar", "site-header"))
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SIGMA, SPREAD = 1.0, 1.0


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)


def named(attrs: list[tuple[str, str | None]]) -> str:
    """What class, id and role say of a container: comments, boilerplate, suspect, header or nothing."""
    found = ""
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token) if not w.isdigit()}
                if not words.isdisjoint(BOILERPLATE) and words <= BOILERPLATE | LAYOUT:
                    if not words.isdisjoint(COMMENTS):
                        return "comments"
                    found = "boilerplate"
                elif name != "id" and not words.isdisjoint(TELLING) and words.isdisjoint(CONDITION):
                    if not words.isdisjoint(COMMENTS):
                        return "comments"
                    found = found if found == "boilerplate" else "suspect"
                elif token.lower() in PAGE_HEADER:
                    found = found or "header"
    return found


class Lines(HTMLParser):
    """lines: (text, tags, link characters, region, mark, tag); regions: [parent, tag, class, what its name says]; marks: [parent, what is
    said of it, region]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.regions, self.marks = [], [(-1, "", "", "")], [(-1, "", 0)]
        self.stack: list[tuple[str, bool, int, int]] = []  # open elements that matter: (tag, off, region inside, mark inside)
        self.off = self.links = 0
        self.region = self.mark = 0
        self.block = ""  # the block element that began the line
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append((text, self.tags, self.linked, self.region, self.mark, self.block))
            self.parts = []
        self.tags = self.linked = 0

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            _, off, self.region, self.mark = self.stack.pop()
            self.off -= off

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            self.block = tag
            if self.stack and self.stack[-1][0] == "p":  # a block ends an open paragraph
                self.close_to(len(self.stack) - 1)
            if tag == "li":  # and an item the one before
                for depth in range(len(self.stack) - 1, -1, -1):
                    if self.stack[depth][0] in ("ul", "ol", "menu"):
                        break
                    if self.stack[depth][0] == "li":
                        self.close_to(depth)
                        break
        else:
            self.tags += 1
            if tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.links += 1
        if tag in VOID:
            return
        off = tag in SKIP or bool(attrs) and tag not in ("html", "body") and hidden(attrs)
        said = "form" if tag == "form" else ""
        if attrs and tag not in UNNAMED:
            said = named(attrs) or said
        if tag == "header":
            said = said or "header"
        if said == "header" and any(t in ARTICLE for t, *_ in self.stack):
            said = ""  # a page's header is no article text, an article's is
        if off or said or tag in HOLDER:
            self.stack.append((tag, off, self.region, self.mark))
            self.off += off
            if not self.off:
                if said:
                    self.marks.append((self.mark, said, self.region))
                    self.mark = len(self.marks) - 1
                if tag in HOLDER:
                    kind = next((v for k, v in attrs if k == "class"), None) or ""
                    self.regions.append((self.region, tag, kind, said or (named(attrs) if tag in ARTICLE else "")))
                    self.region = len(self.regions) - 1

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            self.block = ""
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
            self.block = ""
        elif tag == "a":
            self.links = max(0, self.links - 1)
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                self.close_to(depth)
                break
            if self.stack[depth][0] in ARTICLE and tag not in HOLDER and tag not in SKIP:
                break  # a stray end of a paragraph or span does not close the article

    def handle_data(self, data):
        if not self.off:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def content_lines(lengths: np.ndarray, tags: np.ndarray, sigma: float = SIGMA, spread: float = SPREAD) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are in the content cluster: smoothed text-to-tag ratio at or above the threshold; and which reach it unsmoothed."""
    ratio = lengths / np.maximum(1, tags)
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.convolve(np.pad(ratio, reach, mode="edge"), kernel / kernel.sum(), mode="valid")
    threshold = min(spread * smooth.std(), smooth.mean())
    return smooth >= threshold, ratio >= threshold


def outermost(regions: list[tuple]) -> list[int]:
    """The outermost article or main element that each region lies in, or -1."""
    outer: list[int] = []
    for i, (parent, tag, *_) in enumerate(regions):
        outer.append(outer[parent] if parent >= 0 and outer[parent] >= 0 else i if tag in ARTICLE else -1)
    return outer


#: What a marked container must hold, as a multiple of the text that is not marked off, for its mark to be overruled.
OVER = {"form": 0, "header": 4, "boilerplate": 4, "suspect": 1, "comments": 10}


def unmarked(p: Lines, outer: list[int], alone: np.ndarray) -> list[tuple]:
    """Lines outside the containers that are marked off. The mark of one that holds more than half of the page's text is overruled
    unless it stands beside another article or, but for a form, much other text; that of a suspect name also where it has a plain
    heading and text that reaches the threshold (alone). Where only links are left, every mark is."""
    if len(p.marks) == 1:
        return p.lines
    total, own, under = 0, [0] * len(p.marks), [0] * len(p.marks)
    in_articles: list[Counter] = [Counter() for _ in p.marks]
    heading, long = [False] * len(p.marks), [False] * len(p.marks)
    for (text, _, linked, region, mark, tag), reaches in zip(p.lines, alone):
        n = max(0, len(text) - linked)
        plain = linked * 2 <= len(text)
        heading[mark] |= tag in HEADINGS and plain
        long[mark] |= bool(reaches) and plain and tag not in HEADINGS
        total += n
        own[mark] += n
        under[mark] += n
        if n and outer[region] >= 0:
            in_articles[mark][outer[region]] += n
    for m in range(len(p.marks) - 1, 0, -1):
        under[p.marks[m][0]] += under[m]
    off, clear, articles = [False], own[0], set(in_articles[0])
    for m in range(1, len(p.marks)):  # parents come first
        parent, said, region = p.marks[m]
        if said == "suspect" and heading[m] and long[m] and not off[parent]:
            off.append(False)
            continue
        lifted = not off[parent] and 2 * under[m] > total and OVER[said] * clear <= under[m] and not articles - {outer[region]}
        off.append(not lifted)
        if lifted:
            clear += own[m]
            articles |= set(in_articles[m])
    kept = [line for line in p.lines if not off[line[4]]]
    return kept if any(linked * 2 <= len(t) for t, _, linked, *_ in kept) else p.lines


def with_title(lines: list[tuple], rows: list[int]) -> str:
    """The text of the rows; where they have no h1, the last one before them and what follows it in its container lead."""
    if rows and not any(lines[i][5] == "h1" for i in rows):
        h = next((i for i in range(rows[0] - 1, -1, -1) if lines[i][5] == "h1"), None)
        if h is not None:
            rows = [h] + [i for i in range(h + 1, rows[0]) if lines[i][3] == lines[h][3] and lines[i][2] * 2 <= len(lines[i][0])] + rows
    return "\n\n".join(lines[i][0] for i in rows)


class Judge:
    """Which containers below a region hold content, from the lines that reach the threshold."""

    def __init__(self, lines: list[tuple], regions: list[tuple], cluster: np.ndarray, alone: np.ndarray):
        n = len(regions)
        self.lines, self.regions, self.alone = lines, regions, alone
        self.text, self.links, self.long = np.zeros(n), np.zeros(n), np.zeros(n)
        self.plain, self.first, self.near = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
        self.own: list[list[int]] = [[] for _ in range(n)]
        self.count = np.zeros(n, int)
        for i, (text, _, linked, region, _, tag) in enumerate(lines):
            self.own[region].append(i)
            self.count[region] += 1
            self.text[region] += len(text)
            self.links[region] += min(linked, len(text))
            plain = linked * 2 <= len(text)
            self.long[region] += len(text) * bool(alone[i] and plain)
            self.plain[region] |= tag in HEADINGS and plain
            self.first[region] |= tag == "h1"
            self.near[region] |= bool(cluster[i])
        self.children: list[list[int]] = [[] for _ in range(n)]
        for i in range(1, n):
            self.children[regions[i][0]].append(i)
        for i in range(n - 1, 0, -1):  # children come after their parents
            up = regions[i][0]
            for total in (self.text, self.links, self.long, self.count):
                total[up] += total[i]
            for flag in (self.plain, self.first, self.near):
                flag[up] |= flag[i]

        self.items = np.zeros(n, bool)
        for i in range(n - 1, -1, -1):
            self.items[i] = self._items(i)

    def _items(self, region: int) -> bool:
        """Two or more like containers without headings that hold most of the region, each with a short line beside its text; or a
        container of such that holds most of it."""
        kinds: dict[tuple, list[int]] = {}
        for c in self.children[region]:
            if self.count[c]:
                kinds.setdefault(self.regions[c][1:3], []).append(c)
        for alike in kinds.values():
            if len(alike) < 2 or sum(self.text[c] for c in alike) < 0.6 * self.text[region]:
                continue
            if not any(self.plain[c] for c in alike) and sum(self.count[c] > 1 and self.long[c] < self.text[c] for c in alike) * 2 > len(alike):
                return True
        return any(self.items[c] for c in self.children[region] if self.text[c] >= 0.6 * self.text[region])

    def stays(self, region: int, whole: float) -> bool:
        if not self.text[region] or self.links[region] * 2 > self.text[region]:
            return False
        if self.long[region] * 2 < whole and self.items[region]:
            return False
        if self.first[region] or self.long[region] * 2 >= self.text[region] or self.plain[region] and self.long[region]:
            return True
        return self.regions[region][1] in LISTS and bool(self.near[region])

    def rows(self, region: int) -> list[int]:
        """The content lines of a region that is opened."""
        whole, out, open_ = self.long[region], [], [(region, False)]
        while open_:
            region, entire = open_.pop()
            own, children = self.own[region], self.children[region]
            if entire:
                out += own
                open_ += [(c, True) for c in children]
                continue
            out += [i for i in own if self.alone[i] or self.lines[i][5] == "h1" or self.lines[i][2] * 2 <= len(self.lines[i][0])]
            kept = {c for c in children if self.stays(c, whole)}
            # what stands beside long lines of its own kind, with no more lines in it, is a paragraph in a container
            kinds = {self.regions[c][1:3] for c in kept if self.count[c] == 1}
            open_ += [(c, self.regions[c][1] in LISTS) for c in children
                      if c in kept or self.count[c] == 1 and self.regions[c][1:3] in kinds and self.links[c] * 2 <= self.text[c]]
        return sorted(out)

    def all(self, region: int) -> list[int]:
        """Every line of a region."""
        out, open_ = [], [region]
        while open_:
            at = open_.pop()
            out += self.own[at]
            open_ += self.children[at]
        return sorted(out)


def articles_of(lines: list[tuple], regions: list[tuple], outer: list[int], weight: np.ndarray) -> list[int]:
    """Rows of the selected article elements."""
    share, links, text = Counter(), Counter(), Counter()  # of each: cluster weight, link characters less half of all, characters
    for i, line in enumerate(lines):
        if (a := outer[line[3]]) >= 0:
            share[a] += weight[i]
            links[a] += line[2] - len(line[0]) / 2
            text[a] += len(line[0])
    if not share:
        return []
    most = max(share.values())
    main = [a for a in share if regions[a][1] == "main"]
    chosen = set()
    for a, h in share.items():
        beside = max((text[x] for x in share if x != a), default=0)
        if regions[a][3] in ("comments", "boilerplate", "suspect") and beside >= 2 * text[a] or a not in main and any(text[m] > text[a] for m in main):
            continue
        if h and h * 4 >= most or links[a] <= 0:
            chosen.add(a)
    return [i for i, line in enumerate(lines) if outer[line[3]] in chosen] or [i for i, line in enumerate(lines) if outer[line[3]] >= 0]


def extract(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    p = Lines()
    p.feed(html)
    p.close()
    p.flush()
    if not p.lines:
        return ""

    def clustered(lines):
        return content_lines(np.array([len(t) for t, *_ in lines], dtype=float), np.array([n for _, n, *_ in lines]))

    regions, outer = p.regions, outermost(p.regions)
    lines = unmarked(p, outer, clustered(p.lines)[1])
    if not lines:
        return ""
    cluster, alone = clustered(lines)
    weight = np.where(cluster, [len(t) for t, *_ in lines], 0)
    inside = articles_of(lines, regions, outer, weight)
    if inside and not any(regions[outer[lines[i][3]]][1] == "main" and not _articles_in(regions, outer[lines[i][3]]) for i in inside):
        return with_title(lines, inside)
    if inside:  # a main element without articles is a container like others
        keep = set(inside)
        lines, cluster, alone = ([x for i, x in enumerate(v) if i in keep] for v in (lines, cluster, alone))
        cluster, alone = np.array(cluster), np.array(alone)
        weight = np.where(cluster, [len(t) for t, *_ in lines], 0)
    held = np.zeros(len(regions))
    np.add.at(held, [line[3] for line in lines], weight)
    for i in range(len(regions) - 1, 0, -1):  # children come after their parents
        held[regions[i][0]] += held[i]
    judge = Judge(lines, regions, cluster, alone)
    at = 0
    while (best := max(judge.children[at], key=lambda i: held[i], default=None)) is not None and held[best] >= 0.8 * held[0]:
        if regions[best][1] in LISTS - {"table", "tbody"}:
            break
        at = best
    return with_title(lines, judge.rows(at) or judge.all(at))


def _articles_in(regions: list[tuple], region: int) -> bool:
    """Whether an article element stands inside the region."""
    for parent, tag, *_ in regions[region + 1:]:
        if parent < region:
            break
        if tag == "article":
            return True
    return False


def extract_pages(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """pages plus the main text of every whole page."""
    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([extract(h) for h in html], dtype=object)

    return pages.withColumn(out, run(F.col(html_col)))
