"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score positive and tags negative, with weights learned from labelled
pages: a page with one ``article`` (or else one ``main``) element is a label by itself, all inside it is content. A
linear scan finds the contiguous regions with the largest sums: the best one is content, and so are those that come
near it, where a page's parts are split. What stands in them inside menus, adverts, forms, comments and the like is
left out, and the rest is given back block by block.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import text_list, tidy, transform_batches

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
PART = re.compile(r"[a-z]+")

# Element names of HTML and the words that sites use for their parts.
RAW = {"script", "style", "template", "noscript", "textarea", "title", "svg", "iframe", "math", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
APART = {"nav", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "label", "input"}
EDGES = {"header", "footer"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}
PARTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "cookie", "cookies", "consent", "gdpr", "popup", "modal",
    "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "newsletter", "signup", "login",
}
#: These words also name parts of articles: such an element is left out where it is short or consists of links.
DOUBTFUL = {
    "promo", "promotion", "banner", "notice", "notices", "notification", "notifications", "alert", "overlay", "subscribe", "subscription",
    "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "form",
}
SHORT, LINKED = 40, 0.4  #: words of a short doubtful element, and the share of its words in links that tells it
VOICES = {"comment", "comments", "commentlist", "reply", "replies", "respond", "responses", "disqus"}

WORD, LINK, OUTSIDE = "word", "link word", "word apart"
LEFT_OUT = "left out"  #: words and tags of an element that stands apart within content: they are dropped, at no cost
MOST = 4.0  #: of a weight
LEAST_WORD, LEAST_LINK, LEAST_TAG = 0.3, 0.1, 0.05  #: words and those in links score so much at least, tags minus so much at most
UNKNOWN_TAG = -1.0
#: Tags that texts are made of, which cost least where no labelled page says otherwise.
TEXTUAL = INLINE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "blockquote", "pre", "table", "tr", "td", "th", "figure", "figcaption", "article", "main"}
KNOWN = TEXTUAL | RAW | VOID | APART | EDGES | {"html", "body", "div", "section", "center", "address", "dl", "dt", "dd", "tbody", "thead", "tfoot", "caption", "colgroup", "details", "summary", "option", "optgroup", "legend", "video", "audio", "picture", "map", "frame", "frameset", "noframes", "hgroup", "output", "progress", "meter", "datalist", "slot", "search"}
OTHER = "other"  #: all other element names are one kind
NEAR = 0.25  #: share of the best region's score that makes another region content


class Element:
    """An open element: where it begins, and what it says of the text inside."""

    __slots__ = ("apart", "at", "content", "doubtful", "name", "outer", "voiced", "within")

    def __init__(self, name: str = "", apart: bool = False, voiced: bool = False, content: bool = False, doubtful: bool = False, within: bool = False, outer: bool = False, at: int = 0):
        self.name, self.apart, self.voiced, self.content, self.outer, self.at = name, apart, voiced, content, outer, at
        self.doubtful, self.within = doubtful, within  # within: it is doubtful or stands in such an element, which is judged as a whole


def tokens(page: str) -> list[tuple[str, str, bool, bool]]:
    """(kind, text, whether it stands apart, whether a block ends here) in page order.

    kind is WORD, LINK or OUTSIDE for text, LEFT_OUT for text and tags, else the tag itself, as ``<p>`` or ``</p>``.
    """
    out: list[tuple[str, str, bool, bool]] = []
    stack: list[Element] = []
    top = root = Element()
    at, n = 0, len(page)

    def close(element: Element) -> None:
        """Leaves a doubtful element out if what it holds is short, or links for the most part."""
        if not element.doubtful:
            return
        words = links = 0
        for kind, text, apart, _ in out[element.at :]:
            if text and not apart:
                words += len(text.split())
                links += len(text.split()) if kind == LINK else 0
        if words < SHORT or links >= LINKED * words:
            for i in range(element.at, len(out)):
                kind, text, _, ends = out[i]
                out[i] = (LEFT_OUT if element.outer else OUTSIDE if text else kind, text, True, ends)

    while at < n:
        found = MARKUP.search(page, at)
        end = found.start() if found else n
        if end > at:
            kind = (LEFT_OUT if top.content else OUTSIDE) if top.apart else LINK if any(s.name == "a" for s in stack) else WORD
            out.append((kind, page[at:end], top.apart, False))
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        said = name if name in KNOWN else OTHER
        if found[1]:
            left_out = top.apart and top.content
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    for element in reversed(stack[i:]):
                        close(element)
                    del stack[i:]
                    break
            top = stack[-1] if stack else root
            out.append((LEFT_OUT if left_out else f"</{said}>", "", False, name not in INLINE))
            continue
        if name in RAW:
            shut = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, at)
            at = shut.end() if shut else n
            out.append((LEFT_OUT if top.content else f"<{said}>", "", False, False))
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and top.name == name:
            close(stack.pop())
            top = stack[-1] if stack else root
        apart, voice, doubtful = stands_apart(name, found[3], top.content)
        begins = name in ("article", "main") and not voice
        now = Element(name, top.voiced if begins else top.apart or apart, top.voiced or voice, top.content or begins and not top.voiced, doubtful and not begins and not top.within, top.within or doubtful and not begins, top.content, len(out))
        out.append((LEFT_OUT if now.apart and top.content else f"<{said}>", "", False, name not in INLINE))
        if name not in VOID and not (found[3].endswith("/") and name not in ("p", "div")):
            stack.append(now)
            top = now
    for element in reversed(stack):
        close(element)
    return out


def stands_apart(name: str, attributes: str, in_content: bool) -> tuple[bool, bool, bool]:
    """Whether an element is no part of the text around it, whether its marks say that readers wrote it, and whether they leave it open."""
    if name in ("html", "body"):
        return False, False, False
    apart, voice, doubtful = name in APART or name in EDGES and not in_content, False, False
    if attributes and not attributes.isspace():
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                parts = set(PART.findall(value))
                voice |= bool(parts & VOICES)
                apart |= bool(parts & PARTS) or not in_content and bool(parts & EDGES)
                doubtful |= bool(parts & DOUBTFUL)
            elif key == "role":
                apart |= value in ROLES
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                apart = True
    return apart or voice, voice, doubtful and not apart


def labelled_counts(page: str) -> dict[tuple[str, bool], int]:
    """How often each kind of token stands inside and outside the content of a labelled page; nothing for others."""
    low = page.lower()
    label = next((x for x in ("article", "main") if len(re.findall(rf"<{x}[\s>]", low)) == 1), None)
    if label is None:
        return {}
    counts: dict[tuple[str, bool], int] = {}
    inside = False
    for kind, text, _, _ in tokens(page):
        if kind == f"<{label}>":
            inside = True
        elif kind == f"</{label}>":
            inside = False
        n = len(text.split()) if text else 0 if kind in (WORD, LINK, OUTSIDE) else 1
        if n and kind != LEFT_OUT:
            counts[kind, inside] = counts.get((kind, inside), 0) + n
    return counts


def learn(pages: DataFrame, column: str = "html", least: int = 20) -> dict[str, float]:
    """The weight of each kind of token: log odds of standing inside content, from all labelled pages.

    There are at most two kinds for each name in KNOWN and a few more, whatever the pages hold. Kinds met fewer than ``least`` times keep the default. Without labelled pages all weights are defaults.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, bool], int] = {}
        for batch in batches:
            for page in text_list(batch.column("html")):
                for key, n in labelled_counts(page).items():
                    total[key] = total.get(key, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], names=["kind", "inside", "n"])

    rows = pages.select(F.col(column).alias("html")).mapInArrow(run, "kind string, inside boolean, n long")
    found = rows.groupBy("kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n")).where(F.col("n") >= least)
    counts = {r.kind: (r.inside, r.n - r.inside) for r in found.collect()}
    return weights(counts)


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    inside, outside = (sum(c[i] for c in counts.values()) + 1 for i in (0, 1))
    out = {WORD: 1.0, LINK: LEAST_LINK, OUTSIDE: -1.0, LEFT_OUT: 0.0}
    for kind, (a, b) in counts.items():
        odds = max(-MOST, min(MOST, math.log((a + 0.5) / inside) - math.log((b + 0.5) / outside)))
        out[kind] = max(LEAST_WORD, odds) if kind == WORD else max(LEAST_LINK, odds) if kind == LINK else min(-LEAST_WORD, odds) if kind == OUTSIDE else min(-LEAST_TAG, odds)
    return out


def default_weight(kind: str) -> float:
    name = kind.strip("</>")
    return -LEAST_TAG if name in TEXTUAL and name != "a" else UNKNOWN_TAG


def regions(scores: Iterable[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences (start, end, sum) in order, in one scan: the best of them is the best of all."""
    out: list[tuple[int, int, float, float, int]] = []  # start, end, sum before it, sum up to the end, the last before with a lesser sum before it
    total = 0.0
    for i, score in enumerate(scores):
        if score > 0:
            start, low, high = i, total, total + score
            j = len(out) - 1
            while True:
                while j >= 0 and out[j][2] >= low:
                    j = out[j][4]
                if j < 0 or out[j][3] >= high:
                    break
                start, low, earlier = out[j][0], out[j][2], out[j][4]
                del out[j:]
                j = earlier
            out.append((start, i + 1, low, high, j))
        total += score
    return [(start, end, high - low) for start, end, low, high, _ in out]


def extract(page: str, weight: dict[str, float]) -> str:
    """The blocks of the content regions of a page, joined by an empty line; '' if it has no words."""
    found = tokens(page)
    scores = []
    for kind, text, _, _ in found:
        n = len(text.split()) if text else 0 if kind in (WORD, LINK, OUTSIDE) else 1
        scores.append(n * (weight[kind] if kind in weight else default_weight(kind)))
    made = regions(scores)
    best = max((r[2] for r in made), default=0.0)
    blocks: list[str] = []
    block: list[str] = []

    def close() -> None:
        words = " ".join(html.unescape("".join(block)).split())
        if words:
            blocks.append(words)
        block.clear()

    for start, end, score in made:
        if score < NEAR * best:
            continue
        for kind, text, apart, ends in found[start:end]:
            if ends:
                close()
            elif kind in ("<br>", "</br>", "<wbr>"):
                block.append(" " if kind != "<wbr>" else "")
            elif text and not apart:
                block.append(text)
        close()
    return "\n\n".join(blocks)


OUTPUTS = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def main_text(pages: DataFrame, weight: dict[str, float], column: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (its code points), from the whole of ``column``.

    A null, empty or wordless page has the text ''. Rows stay as they are; input columns of these names are
    replaced. All regions with at least NEAR of the best one's score count, in page order.
    """

    def make():
        def fn(values: pa.Array) -> list:
            texts = [extract(page, weight) for page in text_list(values)]
            return [texts, [len(t) for t in texts]]

        return fn

    return transform_batches(pages, [column], OUTPUTS, make)
