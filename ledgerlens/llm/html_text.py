"""Main text of HTML pages: a maximum-scoring subsequence of words and tags.

Words score positive and tags negative; a linear scan finds the contiguous region of the largest sum. The weights
come from labelled pages (``labelled_pages``): a tag's weight is its log odds between boilerplate and content, and
elements whose names or class words occur with boilerplate only are left out of the region's text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.common import table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|title|textarea|iframe|svg|math|object|select|button)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>"
    r"|<[a-zA-Z/!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\s(hidden)(?=[\s=/>]|\Z)", re.I)

#: Elements that do not end a block of text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label input".split())
#: Elements that hold others and are followed until their end; paragraphs and inline elements without a class are not.
HOLDERS = frozenset("html body div section article main nav aside header footer form ul ol dl table figure fieldset dialog center blockquote".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: Holders in which a header belongs to the article.
ARTICLES = frozenset(["article", "main"])
#: Class words that name the article itself, and those that only describe a layout (has-sidebar).
OWN_WORDS = frozenset("article main post entry story".split())
LAYOUT_WORDS = frozenset("has with no without".split())
HIDDEN = re.compile(r"display\s*:\s*none", re.I)


# ---------------------------------------------------------------- labelled pages
#: Class words by which pages mark what is not the article, and what is.
BOILERPLATE_WORDS = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar widget related recommended footer header masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "subscription signup comment comments commentlist discussion disqus responses reader share sharing social login search pagination pager "
    "copyright legal disclaimer toolbar topbar contentinfo complementary dialog skip reply replies feedback adsense adbox adslot advertorial "
    "announcement privacy paywall outbrain taboola teaser"
).split()
#: Of these, words that also name subjects: they count only where they are at least half of a class name.
WEAK_WORDS = frozenset(
    "share sharing related recommended header notice alert legal search reply replies responses reader privacy login feedback discussion dialog "
    "announcement social subscription signup banner disclaimer copyright promotion promo sponsor sponsored consent comment response skip pager".split()
)
CONTENT_WORDS = "article content main post entry story body text page container wrapper prose".split()
BOILERPLATE_TAGS = "nav aside footer form header dialog fieldset".split()


def labelled_pages() -> Iterator[list[tuple[str, tuple[str, ...], int, bool]]]:
    """Pages as labelled runs (tag, class words, words in it, is content), composed from the fixed word lists.

    Boilerplate words, tags and link lists surround an article of paragraphs; wrappers hold both kinds.
    """
    for k, word in enumerate(BOILERPLATE_WORDS):
        wrapper, tag = CONTENT_WORDS[k % len(CONTENT_WORDS)], BOILERPLATE_TAGS[k % len(BOILERPLATE_TAGS)]
        holder = ("article", "div", "main", "section")[k % 4]
        page = [("body", (), 0, True), ("div", (), 4, False), (tag, (), 6, False), (("div", "section", "ul")[k % 3], (word,), 8, False)]
        page += [(x, (), 1, False) for x in ("ul", "li", "a") * 6] + [(holder, (wrapper,), 60, True)]
        page += [(x, (), 25, True) for x in ("p", "h1", "p", "b", "p", "em", "p", "i", "p", "h2", "p", "blockquote", "p", "br", "p", "span", "p", "strong", "p", "a", "p", "table", "p", "tr", "p", "td", "ul", "li", "li", "ol", "div", "pre", "code")]
        yield page


@cache
def weights() -> tuple[dict[str, float], frozenset[str], frozenset[str]]:
    """Tag weights (negative), and the tags and class words that mark boilerplate, by smoothed log odds of words."""
    tags: tuple[Counter, Counter] = (Counter(), Counter())
    inside: tuple[Counter, Counter] = (Counter(), Counter())
    for page in labelled_pages():
        for tag, classes, words, content in page:
            tags[content][tag] += 1
            inside[content][f"<{tag}>"] += words
            for c in classes:
                inside[content][c] += words
    odds = {t: log((tags[0][t] + 1) / (tags[1][t] + 1)) for t in tags[0] | tags[1]}
    marks = {f for f in inside[0] | inside[1] if log((inside[1][f] + 0.5) / (inside[0][f] + 0.5)) < -2}
    links = {"li", "a", "ul", "nav"}
    cost = {t: -min(2.0, max(0.02, 0.3 + 0.3 * v)) if t not in links else -0.5 for t, v in odds.items()}
    return cost, frozenset(m[1:-1] for m in marks if m[0] == "<") - links - {"div", "body"} | {"nav"}, frozenset(m for m in marks if m[0] != "<")


# ---------------------------------------------------------------- extraction
def _boilerplate(name: str, attrs: str, in_article: bool) -> bool:
    _, bad_tags, bad_words = weights()
    if name in bad_tags and not (name == "header" and in_article):
        return True
    if not attrs or name in ("html", "body"):
        return False
    words: set[str] = set()
    bad: set[str] = set()
    for m in ATTR.finditer(attrs):
        if m[5]:
            return True
        for given in (m[2] or m[3] or m[4] or "").lower().split():
            parts = [x for x in re.split(r"[^a-z0-9]+", given) if x]
            words.update(parts)
            marked = [x for x in parts if x in bad_words]
            if 2 * len(marked) >= len(parts):
                bad.update(marked)
            else:
                bad.update(x for x in marked if x not in WEAK_WORDS)
    if HIDDEN.search(attrs):
        return True
    if bad and (in_article or words & OWN_WORDS):
        bad -= {"header"}  # an article's own header
    if not bad or words & LAYOUT_WORDS:
        return False
    return not (name in ARTICLES and words & OWN_WORDS)


def extract(page: str | None) -> str:
    """The page's main text: blocks in page order joined by a line feed; empty for null and for pages without text.

    White space in a block, line break elements included, becomes one space. Unclosed elements, stray end tags and
    pages cut off inside a tag, a comment or a script are read as far as they go.
    """
    if not page:
        return ""
    cost = weights()[0]
    # each block: its text, the number of elements that hold it, its score; before it: the score of the tags since the
    # block before, and the least number of open elements in between
    blocks: list[tuple[str, int, float]] = []
    gaps: list[float] = []
    dips: list[int] = []
    stack: list[tuple[str, bool]] = []
    opened: Counter = Counter()
    out_depth, articles, dip, gap, inner, buffer = 0, 0, 0, 0.0, 0.0, []

    def flush() -> None:
        nonlocal gap, inner, dip
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append((text, len(stack), text.count(" ") + 1 + inner))
                gaps.append(gap)
                dips.append(dip)
                gap, inner, dip = 0.0, 0.0, len(stack)
        gap += inner
        inner = 0.0

    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            if not out_depth:
                buffer.append(unescape(m["text"]))
            continue
        name = m["name"] or m["name2"]
        if not name:
            continue
        name, end, attrs = name.lower(), m["end"] or m["end2"], m["attrs"] or m["attrs2"] or ""
        if name == "br":
            buffer.append(" ")
            continue
        inline = name in INLINE
        if inline:
            inner += cost.get(name, -0.3)
        else:
            flush()
            gap += cost.get(name, -0.3)
        if name in VOID or attrs.endswith("/") and inline:
            continue
        if end:
            while opened[name]:
                top, bad = stack.pop()
                opened[top] -= 1
                out_depth -= bad
                articles -= top in ARTICLES
                if top == name:
                    break
            dip = min(dip, len(stack))
            continue
        while stack and not inline and (stack[-1][0] == "p" or stack[-1][0] == name == "li"):
            top, bad = stack.pop()  # a paragraph or list item that was left out and not closed
            opened[top] -= 1
            out_depth -= bad
            dip = min(dip, len(stack))
        bad = _boilerplate(name, attrs, articles > 0)
        if name in HOLDERS or bad:
            if bad:
                flush()
            stack.append((name, bad))
            opened[name] += 1
            out_depth += bad
            articles += name in ARTICLES
    flush()
    if not blocks:
        return ""
    # the contiguous run of blocks with the largest sum of words and tags between them
    best, lo, hi, total, start = float("-inf"), 0, 0, 0.0, 0
    for i, (_, _, score) in enumerate(blocks):
        if i and total + gaps[i] > 0:
            total += gaps[i] + score
        else:
            total, start = score, i
        if total > best:
            best, lo, hi = total, start, i
    # the region grows to the innermost element that holds all of it
    depth = min([blocks[lo][1], *dips[lo + 1 : hi + 1]])
    if depth > 2:
        while lo and dips[lo] >= depth:
            lo -= 1
        while hi + 1 < len(blocks) and dips[hi + 1] >= depth:
            hi += 1
    return "\n".join(t for t, _, _ in blocks[lo : hi + 1])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of pages(page_id, url, html), one to one.

    Null and empty html give an empty text. Repeated rows and null ids or urls keep their rows; other columns are
    not read; an empty table gives no rows. A page is held by one task as a whole, as its row is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(h) for h in part.column("html").to_pylist()]
                yield pa.record_batch({"page_id": part.column("page_id"), "url": part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url", "cast(html as string) html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
