"""Main text of web pages by maximum-scoring subsequence.

A page is read as a sequence of tags and runs of words. Words score by the kind of element around them, positive where such
elements hold content, nothing in boilerplate, negative in plain elements beside an article; tags score negative. One linear
scan finds the contiguous stretch with the largest sum, and its words of positive kinds are the text. Tags in kinds that are
all content, in boilerplate elements and of elements that are not read (scripts, ...) score nothing.

The scores come from labelled pages: pages with exactly one <article> or <main>, if it holds at least half of the words
outside boilerplate elements. Labels serve training only: every page, labelled or not, gets its region from the scan. Over a
bounded sample (``sample_pages`` pages with the smallest hash of the id) words are counted by kind and tags by name, inside
and outside the content, and added to prior counts, which also score kinds that no label shows. A kind is the name of the
nearest telling element (nav, article, aside, ... or a container whose class, role or, outside articles, id has a telling
word); what stands in an article or main is of its kind. On pages where most words stand in articles, plain elements beside
them are kinds of their own (marked *), so that they say nothing of pages without articles. An <article> in boilerplate (a
reader comment, a card) is boilerplate, unless the page has no other.

Character references are decoded, white space within a block is one space, blocks are joined by an empty line.
Null html counts as empty; pages without content words have an empty text; unclosed or stray tags, comments
and quotes end where a browser would end them or at the page's end; repeated rows each get their row.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.common import pick

# Element names of HTML by use, and words that name parts of pages.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg",
       "object", "select", "button", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "math", "mi", "mn", "mo", "mrow", "msup", "msub", "mfrac", "msqrt", "mtext", "semantics"}
CONTAINERS = {"div", "section", "ul", "ol", "dl", "center", "details", "aside", "header", "footer", "form", "td"}
TELLING = {"article", "main", "nav", "header", "footer", "aside", "form", "head", "dialog", "menu", "fieldset", "figure", "body"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "head", "dialog", "menu", "fieldset"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "sidebar", "side", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer",
    "comment", "comments", "commentlist", "disqus", "discussion", "replies", "reply", "respond", "cookie", "cookies", "consent", "notice", "gdpr", "privacy",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "share", "sharing",
    "social", "related", "recommended", "recommendations", "widget", "toolbar", "pagination", "pager", "copyright", "legal",
    "disclaimer", "alert", "skip", "teaser", "outbrain", "taboola", "contentinfo", "complementary", "hidden",
}
CONTENT_WORDS = {"article", "content", "post", "entry", "story", "main", "maincontent", "articlebody", "body", "text"}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.IGNORECASE)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in RAW}
_PART = re.compile(r"[a-z]+")


def _in_article(kind: str) -> bool:
    return kind in ("article", "main")


def _kind(name: str, attributes: str, around: str) -> str | None:
    """The kind of a telling element, or None where it takes that of the element around it."""
    if "=" in attributes or "hidden" in attributes.lower():
        words = set()
        for what, a, b, c in _ATTRIBUTE.findall(attributes):
            if not (_in_article(around) and what.lower() == "id"):  # ids in an article name its sections
                words.update(_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", a or b or c).lower()))
        found = sorted(words & BOILERPLATE_WORDS)
        if found and name in CONTAINERS:
            return f"{name}.{found[0]}"
        if _HIDDEN.search(attributes) and name not in ("body", "html"):
            return f"{name}.hidden"
        if words & CONTENT_WORDS and name in ("div", "section", "td"):
            return f"{name}.content"
    if name == "header" and _in_article(around):
        return around
    return name if name in TELLING else None


def is_boilerplate(kind: str) -> bool:
    return kind in BOILERPLATE or kind.partition(".")[2] in BOILERPLATE_WORDS


def tokens(page: str, articles_count: bool = False):
    """Yields (tag name or None, kind of element around, raw text, starts a block) in page order. ``articles_count``: an
    article is one in boilerplate too."""
    stack: list[tuple[str, str]] = []
    opened: Counter = Counter()  # names on the stack: a closing tag of none of them costs nothing
    at, n = 0, len(page)
    around = "body"
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            yield None, around, page[at:], False
            return
        if m.start() > at:
            yield None, around, page[at : m.start()], False
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        block = name not in INLINE
        if closing:
            if opened[name]:
                while True:
                    last, _ = stack.pop()
                    opened[last] -= 1
                    if last == name:
                        break
            around = stack[-1][1] if stack else "body"
            yield name, around, "", block
            continue
        if name == "body" and opened["head"]:
            stack = [x for x in stack if x[0] != "head"]
            opened["head"] = 0
            around = stack[-1][1] if stack else "body"
        if block and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            opened["p"] -= 1
            stack.pop()
            around = stack[-1][1] if stack else "body"
        own = _kind(name, attributes, around)
        # what stands in boilerplate is boilerplate, and in an article of the article's kind
        if is_boilerplate(around) and not (articles_count and name in ("article", "main")) and name != "body" and not is_boilerplate(own or ""):
            own = around
        if own is None or (_in_article(around) and not is_boilerplate(own) and own != "article"):
            own = around
        yield name, own, "", block
        if name in RAW and not attributes.endswith("/"):
            end = _ENDS[name].search(page, at)
            at = end.start() if end else n
        elif name not in VOID and not attributes.endswith("/") and (own != around or name in ("article", "main") or (block and name != "p")):
            stack.append((name, own))
            opened[name] += 1
            around = own


def read(page: str) -> list[tuple[str | None, str, str, bool]]:
    """The page's tokens. Where most words stand in articles, or else in articles and main, other plain kinds are marked."""
    found = list(tokens(page))
    if not any(_in_article(kind) for _, kind, _, _ in found) and re.search(r"<(article|main)[\s>]", page, re.IGNORECASE):
        found = list(tokens(page, True))
    words: Counter = Counter()
    for name, kind, text, _ in found:
        if name is None and not is_boilerplate(kind):
            words[kind if _in_article(kind) else "other"] += len(text.split())
    total = sum(words.values())
    inside = next((own for own in (("article",), ("article", "main")) if 0 < total <= 2 * sum(words[k] for k in own)), None)
    if inside is None:
        return found
    return [(name, kind if kind in inside or is_boilerplate(kind) else kind + "*", text, block) for name, kind, text, block in found]


@dataclass
class Weights:
    """words: score of a word by kind (unknown kinds: ``other``); tags: score of a tag by name, below 0."""

    words: dict[str, float]
    tags: dict[str, float]
    other: float = 1.0
    beside: float = -1.0
    other_tag: float = -1.0

    def word(self, kind: str) -> float:
        if is_boilerplate(kind):
            return min(self.words.get(kind, 0.0), 0.0)
        return self.words.get(kind, self.beside if kind.endswith("*") else self.other)

    def tag(self, name: str, kind: str) -> float:
        """Within kinds that are all content, within boilerplate and where nothing is read a tag says nothing."""
        if name in RAW or is_boilerplate(kind) or self.word(kind) > 2.5:
            return 0.0
        return self.tags.get(name, self.other_tag)


# Prior counts (content, other) of words by kind and of tags by name.
_PRIOR_WORDS = {"article": (20, 1), "main": (20, 1), "body": (3, 1), "figure": (2, 1), "body*": (1, 3)}
_PRIOR_TAGS = {name: (20, 2) for name in ("p", "b", "i", "em", "strong", "br", "h1", "h2", "h3", "span", "blockquote")}
_PRIOR_TAGS |= {name: (2, 5) for name in ("a", "li", "ul", "div", "td", "tr", "img", "input")}


def labelled(found: list) -> bool:
    """Whether the page labels itself: one article, or else one main, holds most of its words."""
    opened = Counter(name for name, kind, _, _ in found if name == kind)  # the tags that open them (closing ones stand outside)
    return any(kind.endswith("*") for _, kind, _, _ in found) and (opened["article"] or opened["main"]) == 1


def label_counts(page: str) -> Counter:
    """(what, name, in content) counts of a page that labels itself; nothing of others."""
    found = read(page)
    out: Counter = Counter()
    if not labelled(found):
        return out
    for name, kind, text, _ in found:
        own = _in_article(kind)
        if name is not None:
            # what makes an element boilerplate is its kind, and tags beside the content say nothing of other pages
            if own or (is_boilerplate(kind) and kind.partition(".")[0] != name):
                out["tag", name, own] += 1
        elif n := len(text.split()):
            out["word", kind, own] += n
    return out


def learn(pages: DataFrame, sample_pages: int = 2000, page_id: str = "page_id", text: str = "html") -> Weights:
    pages = pick(pages, page_id=page_id, html=text)
    candidates = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    # only ids are sorted; the pages themselves are read again where they are
    chosen = candidates.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    sample = candidates.join(F.broadcast(chosen), "page_id", "left_semi")

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(1).to_pylist():
                total.update(label_counts(page))
        if total:
            what, name, inside = zip(*total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(what), pa.array(name), pa.array(inside), pa.array(list(total.values()), pa.int64())],
                names=["what", "name", "inside", "n"])

    counted = sample.mapInArrow(count, "what string, name string, inside boolean, n long")
    # tag names are whatever pages hold: those that stand on one page of the sample only are left to the default score
    sums = counted.groupBy("what", "name", "inside").agg(F.sum("n").alias("n")).where("what = 'word' or n > 1")
    words, tags = {k: list(v) for k, v in _PRIOR_WORDS.items()}, {k: list(v) for k, v in _PRIOR_TAGS.items()}
    for r in sums.collect():
        (words if r.what == "word" else tags).setdefault(r.name, [1, 1])[not r.inside] += r.n
    score = lambda pair: math.log(pair[0] / pair[1])
    return Weights({k: max(-4.0, min(4.0, score(v))) for k, v in words.items()},
                   {k: min(-0.1, max(-4.0, score(v))) for k, v in tags.items()})


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, stop) with the largest sum, the first of equal ones; (0, 0) if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str, weights: Weights) -> str:
    found = read(page)
    # words of boilerplate are left out wherever they stand: they cost nothing, those beside an article do
    scores = [weights.tag(name, kind) if name else 0.0 if is_boilerplate(kind) else len(text.split()) * weights.word(kind)
              for name, kind, text, _ in found]
    start, stop = best_region(scores)
    blocks, current = [], []
    for name, kind, text, block in found[start:stop]:
        if name is None:
            if weights.word(kind) > 0:
                current.append(html.unescape(text))
        elif block:
            blocks.append("".join(current))
            current = []
        elif name == "br":
            current.append(" ")
    blocks.append("".join(current))
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract(pages: DataFrame, weights: Weights, page_id: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches):
        for batch in batches:
            found = [main_text(p or "", weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pick(pages, page_id=page_id, url=url, html=text).mapInArrow(run, "page_id long, url string, text string, n_chars long")
