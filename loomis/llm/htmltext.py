"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with its root-to-leaf path of
block tags (inline markup does not count).  Per path, text length, punctuation
and link text are added up; the ratios per node are smoothed over neighbouring
paths in page order, fused (geometric mean, less the share of link text) and
compared with a threshold relative to the page's text-weighted mean.  The
blocks of the selected paths are the content, in page order.

Parts that are never article text (scripts, styles, forms, navigation, page
header and footer, sidebars, and elements whose class or id names an advert,
notice, menu, comment section and the like) are left out while reading.  Where
a page marks its article (``article``, ``main`` or role=main), paths outside
compete no longer, and inside only paths far below the others go.

Defined cases: null or empty html gives empty text; an unclosed tag or comment
ends with its parent or the page; repeated rows and other columns are harmless;
an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import text_of

# HTML element groups and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
FORMAT = frozenset("b i em strong u s small sup sub font mark big tt cite q abbr time code kbd samp var del ins "
                   "dfn bdi bdo strike center nobr".split())
INLINE = frozenset("a span label".split())
DROP = frozenset("head nav footer aside form button select option dialog menu svg math canvas object audio video "
                 "map fieldset".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul details figcaption".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = frozenset("ul ol dl table div article section main body html td th blockquote".split())
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notices?|popup|modal|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|widget|footer|masthead|share|sharing|social|related|"
    r"recommend(?:ed|ations)?|comments?|commentlist|replies|disqus|newsletter|subscribe|signup|login|search|pager|"
    r"pagination|toolbar|skip)(?:$|[\s_-])", re.I)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_NAME = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PUNCT = re.compile(r"[.,;:!?¿¡…。、，！？；：]")
_SPACES = re.compile(r"\s+")

RADIUS = 2          # paths on either side that smooth a path's ratios
MARKED = 0.02       # threshold inside a marked article, times the weighted mean
UNMARKED = 0.25     # threshold elsewhere


def blocks(page: str):
    """(path, text, link characters, inside a marked article) in page order."""
    out: list[tuple[str, str, int, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, drops its text, link, article
    buf: list[str] = []
    linked = 0
    dropping = links = marked = 0

    def flush():
        nonlocal linked
        if buf:
            text = _SPACES.sub(" ", "".join(buf)).strip()
            if text:
                out.append(("/".join(t for t, _, _, _ in stack if t not in INLINE), text, min(linked, len(text)),
                            marked > 0))
            buf.clear()
        linked = 0

    def pop():
        nonlocal dropping, links, marked
        if stack[-1][0] not in INLINE:
            flush()
        _, d, a, m = stack.pop()
        dropping -= d
        links -= a
        marked -= m

    def add(raw: str):
        nonlocal linked
        if raw and not dropping:
            text = html.unescape(raw)
            buf.append(text)
            if links:
                linked += len(text.strip())

    pos, n = 0, len(page)
    while pos < n:
        m = _TAG.search(page, pos)
        if m is None:
            rest = page[pos:]
            cutoff = re.search(r"<[/!?a-zA-Z]", rest)  # a tag the page's end cuts off is markup
            add(rest[:cutoff.start()] if cutoff else rest)
            break
        add(page[pos:m.start()])
        pos = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in FORMAT:
            continue
        if closing:
            if any(t == tag for t, _, _, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif not dropping:
                buf.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, pos)
            pos = end.end() if end else n
            continue
        if tag not in INLINE:
            if tag in CLOSES_P and any(t == "p" for t, _, _, _ in stack):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or stack[i][0] in SCOPES:
                        break
                if stack[i][0] == "p":
                    while len(stack) > i:
                        pop()
            elif tag in SIBLINGS:
                while stack and (stack[-1][0] in SIBLINGS[tag] or stack[-1][0] in INLINE or stack[-1][0] == "p"):
                    pop()
            flush()
        names = " ".join(x[0] or x[1] or x[2] for x in _NAME.findall(attrs)) if "=" in attrs else ""
        article = tag in ("article", "main") or names == "main"
        drop = tag in DROP or (tag == "header" and not marked) or (
            bool(names) and tag not in ("html", "body", "article", "main") and bool(FURNITURE.search(names)))
        stack.append((tag, drop, tag == "a", article))
        dropping += drop
        links += tag == "a"
        marked += article
    flush()
    return out


def path_scores(found) -> dict[str, float]:
    """Fused, smoothed tag-path ratio of each path."""
    total: dict[str, list[float]] = {}
    for path, text, linked, _ in found:
        s = total.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(_PUNCT.findall(text))
        s[3] += linked
    paths = list(total)
    text = [total[p][1] / total[p][0] for p in paths]
    punct = [(total[p][2] + 0.1) / total[p][0] for p in paths]
    kernel = [math.exp(-d * d / 2) for d in range(RADIUS + 1)]

    def smooth(v):
        out = []
        for i in range(len(v)):
            near = range(max(0, i - RADIUS), min(len(v), i + RADIUS + 1))
            out.append(sum(v[j] * kernel[abs(i - j)] for j in near) / sum(kernel[abs(i - j)] for j in near))
        return out
    return {p: math.sqrt(t * q) * (1 - total[p][3] / total[p][1])
            for p, t, q in zip(paths, smooth(text), smooth(punct))}


def main_text(page: str) -> str:
    """The article's blocks joined by two line feeds ('' if there are none)."""
    found = blocks(page)
    marked = [b for b in found if b[3]]
    found, share = (marked, MARKED) if marked else (found, UNMARKED)
    if not found:
        return ""
    score = path_scores(found)
    mean = sum(score[p] * len(t) for p, t, _, _ in found) / sum(len(t) for _, t, _, _ in found)
    return "\n\n".join(t for p, t, _, _ in found if score[p] >= share * mean and score[p] > 0)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row; a narrow pass."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("q_html"))
    src = src.select("page_id", "url", text_of("q_html").alias("q_html"))
    id_type = src.schema["page_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            text = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()),
                                              pa.array([len(t) for t in text], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
