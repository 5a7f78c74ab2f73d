"""Main text of web pages by tag-path ratios.

A page is read as blocks, runs of text between block-level tags; each has the
path of block-level tags (with their classes) from the root.  Per path the
text length, punctuation and link text of its blocks are added up; the ratios
of text and of punctuation to blocks are smoothed along the page, fused, and
paths of at least ``THRESHOLD`` of the best are content.  A block is part of
the main text when its path is content, or when it stands in the same article
(or, outside of any, in the same parent element) as content: headings and short
items among paragraphs.  Parts that are furniture by their tag or role
(menus, headers, footers, sidebars, forms, scripts, styles) are no candidates.
A class or id made of words that furniture is named by (notices, adverts, reader
comments) lowers its paths' scores, less inside an article; names of headings,
paragraphs and articles' ids don't.  A form is furniture, too, unless it is wrapped
around the page: it has the best path and more than half of the text.

Paths are numbers of nodes that know their parent, so a page takes memory in
proportion to its elements, however deep its markup is.

Null and empty pages, and pages without text, give an empty string.  A page
that ends inside a tag loses that tag only.  No block is cut short.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.12
SMOOTHING = (0.25, 0.5, 0.25)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
#: Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp title textarea annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img picture br "
                   # formulas
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup "
                   "msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split())
FURNITURE = frozenset("head nav header footer aside menu button select option datalist dialog object applet svg canvas "
                      "audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist "
                  "status tooltip".split())
HINTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promotions "
                  "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side aside footer foot header "
                  "masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion cookie cookies "
                  "consent gdpr notice notices notification popup modal overlay share sharing social related recommended "
                  "recommendation recommendations newsletter subscribe subscription signup login search searchbox widget widgets "
                  "pagination pager skip copyright disclaimer legal alert toast paywall outbrain taboola".split())
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: What a hinted path's score counts, outside and inside of an article.
HINTED_OUTSIDE, HINTED_INSIDE = 0.02, 0.25
#: Elements whose id names a part of the article, and those whose class does, too.
OWN_ID = frozenset(("section", "p"))
UNHINTED = HEADINGS | {"html", "body", "p"}
#: An opening tag ends these, if they are open above the limits.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "tbody": ("tr", "td", "th", "thead", "tbody"), "option": ("option",)}
LIMITS = frozenset("ul ol dl table article main section div body html td th blockquote".split())

#: Marks of hinted elements and of forms in a path.
OUTSIDE, INSIDE, FORM = 1, 2, 4
HINTED = OUTSIDE | INSIDE

PIECE = re.compile(r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
                   r"""|<[a-zA-Z/!?][^>]*(?:>|\Z)|([^<]+|<)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Element:
    __slots__ = ("tag", "path", "dropped", "container", "headings", "number")

    def __init__(self, tag: str, path: int, dropped: bool, container: int, headings: bool, number: int):
        self.tag, self.path, self.dropped, self.container = tag, path, dropped, container
        self.headings, self.number = headings, number


class Paths:
    """Tag paths as numbers; of each its parent and the marks along it."""

    def __init__(self):
        self.up, self.marks, self._known = [-1], [0], {}

    def child(self, path: int, name: str, mark: int) -> int:
        key = (path, name, mark)
        if key not in self._known:
            self._known[key] = len(self.up)
            self.up.append(path)
            self.marks.append(self.marks[path] | mark)
        return self._known[key]


def _hinted(tag: str, classes: str, name: str) -> bool:
    """Whether a whole class or id consists of words that furniture is named by."""
    if tag in UNHINTED:
        return False
    if tag in CONTAINERS:  # an article may be a reader's comment or a card
        return any(c.lower() in ("comment", "comments", "reply", "related", "teaser") for c in classes.split())
    for c in (classes if tag in OWN_ID else f"{classes} {name}").split():
        words = WORDS.findall(c)
        if words and all(w.lower() in HINTS for w in words):
            return True
    return False


def _furniture(tag: str, raw: str) -> tuple[bool, bool, str]:
    """Whether an element is no part of an article, whether its names hint at
    that, and its class for the path."""
    if not raw or raw.isspace():
        return tag in FURNITURE, False, ""
    attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
    classes = attrs.get("class", "")
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
    return (tag in FURNITURE or hidden or attrs.get("role", "").lower() in ROLES, _hinted(tag, classes, attrs.get("id", "")),
            ".".join(classes.split()))


def blocks(page: str) -> tuple[list[tuple[int, str, int, int, int]], Paths]:
    """(path, text, characters of links, container, parent) of each candidate block, and the paths."""
    stack, out, text, links, anchors, number = [_Element("", 0, False, 0, False, 0)], [], [], 0, 0, 0
    paths, open_tags = Paths(), Counter()
    skip = 0

    def close(k: int) -> None:
        open_tags.subtract(e.tag for e in stack[k:])
        del stack[k:]

    def flush() -> None:
        nonlocal links
        if text:
            top = stack[-1]
            joined = " ".join("".join(text).split())
            if joined and not top.dropped:
                parent = stack[-2] if len(stack) > 1 else top
                out.append((top.path, joined, links, top.container, parent.number))
            text.clear()
        links = 0

    for m in PIECE.finditer(page):
        if m.start() < skip:
            continue
        words = m[4]
        if words is not None:
            decoded = entities.unescape(words) if "&" in words else words
            text.append(decoded)
            if anchors:
                links += len(decoded.strip())
            continue
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in RAW and not closing:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, m.end())
            skip = end.start() if end else len(page)
            if not end:
                break
            continue
        if tag in INLINE:
            if tag == "a":
                anchors = 0 if closing else 1
            if tag in ("br", "img"):
                text.append(" ")
            continue
        flush()
        if tag in VOID or tag in RAW:
            continue
        if closing:
            if open_tags[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
                anchors = 0
            continue
        if stack[-1].tag == "p" or stack[-1].tag in HEADINGS and tag in HEADINGS:
            close(len(stack) - 1)
        ended = ENDS.get(tag, ())
        if any(open_tags[t] for t in ended):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    close(k)
                    break
                if stack[k].tag in LIMITS:
                    break
        up = stack[-1]
        dropped, hinted, name = _furniture(tag, m[3])
        mark = FORM if tag == "form" else 0
        if hinted:
            mark |= INSIDE if up.container else OUTSIDE
        number += 1
        # The heading of an article may stand in a header of its own.
        spared = tag in HEADINGS and up.headings
        stack.append(_Element(
            tag, paths.child(up.path, f"{tag}.{name}" if name else tag, mark), (up.dropped and not spared) or dropped,
            number if tag in CONTAINERS and not dropped and not hinted and not (up.container and tag == "main") else up.container,
            up.headings if up.dropped else dropped and tag == "header" and up.container > 0, number))
        open_tags[tag] += 1
    flush()
    return out, paths


def path_scores(page: list[tuple[int, str, int, int, int]], marks: list[int]) -> dict[int, float]:
    """Fused, smoothed text and punctuation ratio of each tag path."""
    total: dict = defaultdict(lambda: [0, 0, 0, 0])
    for path, text, links, _, _ in page:
        t = total[path]
        t[0] += 1
        t[1] += len(text)
        t[2] += len(PUNCTUATION.findall(text))
        t[3] += min(links, len(text))
    ratio = {p: (t[1] / t[0]) * (1 + t[2] / t[0]) * (1 - t[3] / t[1]) for p, t in total.items()}
    line = [ratio[b[0]] for b in page]
    a, b, c = SMOOTHING
    smooth = [a * line[max(k - 1, 0)] + b * x + c * line[min(k + 1, len(line) - 1)] for k, x in enumerate(line)]
    out: dict = defaultdict(float)
    for (path, *_), x in zip(page, smooth):
        out[path] += x / total[path][0]
    # A hinted path takes nothing from the blocks around it.
    factor = {p: HINTED_OUTSIDE if marks[p] & OUTSIDE else HINTED_INSIDE if marks[p] & INSIDE else 0.0 for p in out}
    return {p: (min(x, ratio[p]) * factor[p] if factor[p] else x) if ratio[p] else 0.0 for p, x in out.items()}


def main_text(page: str | None) -> str:
    found, paths = blocks(page or "")
    marks = paths.marks
    inside = [b for b in found if marks[b[0]] & FORM]
    if inside:
        score = path_scores(found, marks)
        wrapped = marks[max(score, key=score.get)] & FORM and 2 * sum(len(b[1]) for b in inside) > sum(len(b[1]) for b in found)
        if not wrapped:
            found = [b for b in found if not marks[b[0]] & FORM]
    if not found:
        return ""
    score = path_scores(found, marks)
    best = max(score.values())
    content = {p for p, x in score.items() if x >= THRESHOLD * best and x > 0}
    plain = {p for p in content if not marks[p] & HINTED}
    top = {c for p, _, _, c, _ in found if p in plain and c}
    homes = {h for p, _, _, c, h in found if p in content and not c}
    # Beside content: what is not hinted itself, unless all of its element is.
    hosts = {paths.up[p] for p in content - plain}
    chosen = [t for p, t, links, c, h in found
              if p in content or (not marks[p] & HINTED or paths.up[p] in hosts)
              and (c in top or not c and h in homes and links < len(t) / 2)]
    return "\n".join(chosen)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
