"""Main text of web pages by tag-path ratios (operator 6).

A page is read as a sequence of text nodes, each with the path of tags from
the root to it.  Elements that are furniture by their tag, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, comments, code)
are left out.  A class, an id or a form only suggests it: one that holds the
page's article or most of its prose, or that is named like a menu or header
and holds long prose, stays.  Of several articles the one with the most prose
of its own is the page's; others that are named like furniture, hidden or, as
comments are, nested in an article go.  For every tag path the text length and the punctuation are
added up and divided by the number of its nodes; both ratios are fused,
smoothed over neighbouring nodes in page order, averaged again per path, and
paths from a share of the page's weighted mean on are content.

Content nodes mark where the article is.  If the deepest element that holds
nearly all of their text lies in an article or main element, the text is all
of that element's, whatever the ratios of its parts.  Else it is that of the
deepest element that holds all content nodes but links, so a short line between
long paragraphs stays; where that is the page's body, all from the first content
block to the last.  Paragraphs, headings, items and cells right before and
after belong to it, unless they are links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.1
HOLDS = 0.9
SPACE = re.compile(r"[\x20\x09-\x0D]+")
MARKS = re.compile(r"[.,;:!?…、。，！？]")

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?(?:-->|\Z))"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<loose>/?[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr img".split())
FURNITURE = set("head nav footer aside script style noscript template iframe object svg button select "
                "textarea dialog menu title canvas audio video map datalist".split())
LANDMARK = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
            "toolbar".split())
NAMES = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar "
            "nav navbar navigation menu breadcrumb breadcrumbs masthead header footer comment comments reply replies "
            "respond responses reactions discussion commentlist disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup "
            "login share sharing social related recommended recommendations trending widget toolbar pagination pager "
            "copyright skip".split())
# Names of parts that hold no prose by their nature.
NO_PROSE = set("nav navbar navigation menu breadcrumb breadcrumbs masthead header login share sharing social widget "
               "toolbar pagination pager signup skip".split())
ARTICLES = {"article", "named article"}
HEADER_NAMES = {"header", "masthead"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NEGATED = {"has", "no", "with", "without"}
# A block of prose has so many characters, a mark and little link text; long
# prose has so many characters.
PROSE, LONG_PROSE = 40, 200
# Elements that are part of a text, not around it.
TEXT_PARTS = HEADINGS | set("p li ul ol blockquote pre td th tr tbody thead tfoot caption table dl dt dd figure "
                            "figcaption".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}


def _names(value: str) -> set[str]:
    """The names of furniture in a class or id, but those after has, no, with."""
    out = set()
    for word in value.split():
        before = ""
        for part in re.split("[^a-z0-9]+", word):
            if part in NAMES and before not in NEGATED:
                out.add(part)
            before = part
    return out


def _furniture(tag: str, attrs: str, in_article: bool) -> str:
    """"sure" for furniture, "" for what is none; what may be some is a
    "form", "named" like it or named like a part that has "no prose".  An
    article is an "article", a "named article" or, as main too, "hidden"."""
    if tag in FURNITURE or tag == "header" and not in_article:
        return "sure"
    kind = "form" if tag == "form" else ""
    if tag == "article":
        kind = "article"
    if not attrs or tag in ("html", "body"):
        return kind
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
            return "hidden" if tag in LANDMARK else "sure"
        if name == "role" and value in ROLES and tag not in LANDMARK and not (value == "form" == tag):
            return "sure"
        if tag == "article":
            if name in ("class", "id") and _names(value) - HEADER_NAMES or name == "role" and value in ROLES:
                kind = "named article"
        elif name in ("class", "id") and tag not in HEADINGS and tag != "main":
            found = _names(value)
            if in_article:
                found -= HEADER_NAMES
            if found - NO_PROSE:
                kind = "named"
            elif found and kind != "named":
                kind = kind or "no prose"
    return kind


class _Page:
    """Text nodes of a page: (text, block, path, element), furniture left out.

    Paths and elements are numbered; ``parent`` leads from an element to the
    one around it.
    """

    def __init__(self, html: str):
        self.nodes: list[tuple[str, int, int, int]] = []
        self.parent, self.tags, self.depth = [-1], [""], [0]
        # Doubtful elements are numbered too: kind, the one around it, in an
        # article; and for each node the innermost, and whether it is a link's.
        self.kinds: list[tuple[str, int, bool]] = [("", -1, False)]
        self.doubt: list[tuple[int, bool]] = []
        self.landmarks: list[int] = []
        paths: dict[tuple[int, str], int] = {}
        stack = [(0, "", 0, False, False, 0)]  # element, tag, path, in furniture, in article, doubtful
        open_: dict[str, int] = {}
        block, at, lower = 0, 0, None

        def text(a, b):
            element, _, path, dropped, _, doubtful = stack[-1]
            if not dropped and b > a:
                self.doubt.append((doubtful, bool(open_.get("a"))))
                self.nodes.append((unescape(html[a:b]), block, path, element))

        def pop():
            tag = stack.pop()[1]
            open_[tag] -= 1

        while at < len(html):
            m = _TOKEN.search(html, at)
            if not m:
                text(at, len(html))
                break
            text(at, m.start())
            at = m.end()
            tag = (m["tag"] or (m["loose"] or "").lstrip("/")).lower()
            if not tag:
                continue
            if tag not in INLINE:
                block += 1
            if m["close"] or (m["loose"] or "").startswith("/"):
                if open_.get(tag):
                    while stack[-1][1] != tag:
                        pop()
                    pop()
                continue
            if tag in VOID:
                continue
            if tag not in INLINE and open_.get("p"):
                # A block starts: an open paragraph in the same element ends.
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][1] == "p":
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][1] not in INLINE:
                        break
            if tag in CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][1] in CLOSES[tag]:
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][1] not in INLINE and stack[k][1] != "p":
                        break
            element, _, path, dropped, in_article, doubtful = stack[-1]
            if not dropped:
                kind = _furniture(tag, m["attrs"] or "", in_article or tag in LANDMARK)
                dropped = kind == "sure"
                if kind == "article" and open_.get("article"):
                    kind = "named article"
                if kind and not dropped:
                    self.kinds.append((kind, doubtful, in_article))
                    doubtful = len(self.kinds) - 1
                if tag in LANDMARK and not dropped:
                    self.landmarks.append(doubtful)
            in_article = in_article or tag in LANDMARK
            path = paths.setdefault((path, tag), len(paths) + 1)
            self.parent.append(element)
            self.tags.append(tag)
            self.depth.append(self.depth[element] + 1)
            stack.append((len(self.parent) - 1, tag, path, dropped, in_article, doubtful))
            open_[tag] = open_.get(tag, 0) + 1
            if tag in RAW:
                # Its content is text up to its own end tag, whatever it holds.
                lower = html.lower() if lower is None else lower
                end = lower.find(f"</{tag}", at)
                at = len(html) if end < 0 else end
        if len(self.kinds) > 1:
            kept = self._kept()
            keep = [kept[d] for d, _ in self.doubt]
            self.nodes = [n for n, k in zip(self.nodes, keep, strict=True) if k]
            self.doubt = [d for d, k in zip(self.doubt, keep, strict=True) if k]
        self.link = [link for _, link in self.doubt]

    def _prose(self) -> list[bool]:
        """Which nodes are of a block of prose."""
        blocks: dict[int, list[int]] = {}
        for (text, block, _, _), (_, link) in zip(self.nodes, self.doubt, strict=True):
            b = blocks.setdefault(block, [0, 0, 0])
            b[0] += len(SPACE.sub(" ", text))
            b[1] += len(text) if link else 0
            b[2] += len(MARKS.findall(text))
        return [b[0] >= PROSE and b[2] > 0 and 2 * b[1] <= b[0] for b in (blocks[n[1]] for n in self.nodes)]

    def _kept(self) -> list[bool]:
        """Which doubtful elements stay (those around them included)."""
        count = len(self.kinds)
        length, own, held, articles = [0] * count, [0] * count, [0] * count, [0] * count
        for (text, _, _, _), (d, _), prose in zip(self.nodes, self.doubt, self._prose(), strict=True):
            n = len(SPACE.sub(" ", text).strip())
            length[d] += n
            own[d] += n if prose else 0
        for d in self.landmarks:
            articles[d] += 1
        own_articles, prose = list(articles), list(own)
        # The page's article: the one with the most prose, that of articles in it aside.
        alone = list(zip(own, length, strict=True))
        for d in range(count - 1, 0, -1):
            kind, up, _ = self.kinds[d]
            if kind not in ARTICLES:
                alone[up] = (alone[up][0] + alone[d][0], alone[up][1] + alone[d][1])
        shown = [d for d in range(1, count) if self.kinds[d][0] in ARTICLES]
        largest = max(shown, key=lambda d: (alone[d], -d), default=0)
        for d in range(count - 1, 0, -1):
            up = self.kinds[d][1]
            length[up] += length[d]
            prose[up] += prose[d]
            articles[up] += articles[d]
        stays = [True] * count
        for d in range(1, count):
            kind, _, in_article = self.kinds[d]
            if kind in ARTICLES or kind == "hidden":
                stays[d] = kind == "article" or d == largest
                continue
            long = prose[d] >= (1 if in_article else LONG_PROSE) and 2 * prose[d] >= length[d]
            stays[d] = kind != "named" and (
                articles[d] > 0 or 2 * prose[d] > prose[0] or kind == "no prose" and long)

        def through(d: int) -> bool:
            up = self.kinds[d][1]
            held[d] = stays[d] and (up < 0 or held[up])
            return held[d]

        for wanted, own_wanted in ((articles, own_articles), (prose, own)):
            # The page's only article or prose is not furniture, whatever the
            # name around it: the largest is opened until some is found.
            kept = [through(d) for d in range(count)]
            if wanted[0] and not any(n and k for n, k in zip(own_wanted, kept, strict=True)):
                inner: dict[int, list[int]] = {}
                for d in range(1, count):
                    inner.setdefault(self.kinds[d][1], []).append(d)
                at = 0
                while not own_wanted[at] and inner.get(at):
                    at = max(inner[at], key=lambda d: (wanted[d], prose[d], -d))
                    stays[at] = True
                kept = [through(d) for d in range(count)]
            if any(n and k for n, k in zip(own_articles, kept, strict=True)):
                break
        return kept


def content_paths(nodes: list[tuple[str, int, int, int]], share: float = SHARE) -> set[int]:
    """The tag paths whose smoothed ratio reaches ``share`` of the mean."""
    lengths = [len(SPACE.sub(" ", n[0]).strip()) for n in nodes]
    full = [i for i, n in enumerate(lengths) if n]
    if not full:
        return set()
    total: dict[int, list[float]] = {}
    for i in full:
        t = total.setdefault(nodes[i][2], [0.0, 0.0, 0.0])
        t[0] += lengths[i]
        t[1] += len(MARKS.findall(nodes[i][0]))
        t[2] += 1
    fused = {p: a / n * (1 + b / n) for p, (a, b, n) in total.items()}
    raw = [fused[nodes[i][2]] for i in full]
    last = len(raw) - 1
    smooth = [0.25 * raw[max(k - 1, 0)] + 0.5 * r + 0.25 * raw[min(k + 1, last)] for k, r in enumerate(raw)]
    mean = sum(s * lengths[i] for s, i in zip(smooth, full, strict=True)) / sum(lengths[i] for i in full)
    scores: dict[int, list[float]] = {}
    for s, i in zip(smooth, full, strict=True):
        scores.setdefault(nodes[i][2], []).append(s)
    return {p for p, s in scores.items() if sum(s) / len(s) >= share * mean}


def _container(page: _Page, picked: list[int], holds: float) -> int:
    """The deepest element with a share of ``holds`` of the picked nodes' text."""
    mass: dict[int, int] = {}
    for i in picked:
        e = page.nodes[i][3]
        mass[e] = mass.get(e, 0) + len(page.nodes[i][0])
    need = holds * sum(mass.values())
    # Children have larger numbers than the elements around them.
    sums = [0] * len(page.parent)
    for e, n in mass.items():
        sums[e] = n
    best = 0
    for e in range(len(sums) - 1, 0, -1):
        if sums[e] >= need and page.depth[e] > page.depth[best]:
            best = e
        sums[page.parent[e]] += sums[e]
    return best


def _out_of(page: _Page, box: int, tags: set[str]) -> int:
    while page.tags[box] in tags and box > 0:
        box = page.parent[box]
    return box


def _span(page: _Page, first: int, last: int) -> tuple[int, int]:
    """The nodes from ``first`` to ``last``, with all of their blocks and the
    parts of text right before and after."""
    blocks: list[list[int]] = []
    for i, n in enumerate(page.nodes):
        if not blocks or page.nodes[blocks[-1][0]][1] != n[1]:
            blocks.append([i, i])
        blocks[-1][1] = i

    solid = list(range(len(page.parent)))
    for e in range(1, len(solid)):
        if page.tags[e] in INLINE:
            solid[e] = solid[page.parent[e]]

    def belongs(a: int, b: int) -> bool:
        length = of_links = 0
        for i in range(a, b + 1):
            n = len(page.nodes[i][0].strip())
            length += n
            of_links += n if page.link[i] else 0
            if n and page.tags[solid[page.nodes[i][3]]] not in TEXT_PARTS:
                return False
        return not length or 2 * of_links <= length

    low = next(k for k, b in enumerate(blocks) if b[1] >= first)
    high = next(k for k in range(len(blocks) - 1, -1, -1) if blocks[k][0] <= last)
    while low > 0 and belongs(*blocks[low - 1]):
        low -= 1
    while high < len(blocks) - 1 and belongs(*blocks[high + 1]):
        high += 1
    return blocks[low][0], blocks[high][1]


def main_text(html: str | None) -> str:
    """The article's text: blocks in page order, joined by a line feed."""
    page = _Page(html or "")
    paths = content_paths(page.nodes)
    picked = [i for i, n in enumerate(page.nodes) if n[2] in paths and n[0].strip()]
    if not picked:
        return ""
    # If nearly all lies in an article, the article is the box.
    e = _container(page, picked, HOLDS)
    while e > 0 and page.tags[e] not in LANDMARK:
        e = page.parent[e]
    # Links beside the article reach the ratio by their neighbours.
    picked = [i for i in picked if not page.link[i]] or picked
    box = e if e > 0 else _out_of(page, _container(page, picked, 1), INLINE | TEXT_PARTS)
    inside = [False] * len(page.parent)
    inside[box] = True
    for e in range(box + 1, len(inside)):
        inside[e] = inside[page.parent[e]]
    if page.tags[box] in LANDMARK:
        kept = [n for n in page.nodes if inside[n[3]]]
    else:
        if page.tags[box] not in ("", "html", "body"):
            picked = [i for i, n in enumerate(page.nodes) if inside[n[3]] and n[0].strip()]
        a, b = _span(page, picked[0], picked[-1])
        kept = page.nodes[a:b + 1]
    blocks: dict[int, list[str]] = {}
    for n in kept:
        blocks.setdefault(n[1], []).append(n[0])
    lines = (SPACE.sub(" ", "".join(b)).strip(" ") for b in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text,
    n_chars.

    A null or empty page, and one without an article, has empty text.
    Repeated rows are read one by one; null ids and urls are carried through;
    other columns are not read; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                texts = [main_text(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
