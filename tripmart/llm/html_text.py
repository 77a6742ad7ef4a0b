"""Main text of web pages.

The standard library's parser streams tags and text; a line is the text of one block. The ratio of text
to tags per line, shifted by evidence (within an article: up, mostly links: down), smoothed by a Gaussian
over neighbouring lines and split in two clusters, tells which lines carry content, on every page. Lines
within navigation, notices, adverts, comments, forms and the like are set aside by the elements around
them, unless most of the content is there. Content regions are the articles that hold content, if most of
the content is theirs; otherwise the lowest element around all content lines, but for lists of links
before and after them that stand apart. All else within a region stays.

Elements are numbered in page order and know their parent; what lies within an element is summed from the
last to the first, so the time is linear in the page, however deeply it is nested.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.words import arrow_rows

# Elements and words of the HTML standard and of common page templates.
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section"
    " summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset(
    "html head body div section article main nav aside header footer form ul ol dl menu table fieldset figure"
    " details dialog noscript template svg math iframe object select button textarea canvas video audio search"
    " script style title".split()
)
NEVER_CONTENT = frozenset(
    "head nav aside footer form menu dialog noscript template svg math iframe object select button textarea"
    " canvas video audio search script style title".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that name boilerplate wherever they stand in a class, and those that do next to known words only.
COMMENT_WORDS = frozenset("comment comments commentlist commentbox commentform commenter disqus replies reply respond".split())
PLAIN_NOISE = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsored promo paywall popup newsletter navbar"
    " menubar breadcrumb breadcrumbs sidebar sidebars pagination".split()
)
NOISE_WORDS = PLAIN_NOISE | frozenset(
    "sponsor promotion banner cookie cookies consent notice notices subscribe subscription modal overlay menu nav"
    " navigation footer header masthead share sharing social related recommended widget toolbar pager login signup"
    " search".split()
)
# Parts that leave the meaning of a noise word as it is, parts that turn it, and noise words that are the
# title's or the text's own next to the last ones.
MODIFIERS = frozenset(
    "site global main top bottom left right primary secondary wrapper wrap container box bar list links link"
    " item items button buttons icons block area inner outer form user reader body thread slot unit card trail"
    " space text author x".split()
)
TURNING = frozenset("no not non without with has hide hidden free".split())
OF_CONTENT = frozenset("post posts entry article articles page section content".split())
OWN_PARTS = frozenset("header footer masthead banner notice notices search menu".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())

SHIFT = 4  # by which evidence raises or lowers a line's ratio
COMMENTS_RATIO = 20  # an element of reader comments this many times larger than all plain text is not believed

_BLANK = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CUT_OFF = re.compile(r"<!--(?!.*-->).*\Z|<[A-Za-z/!?][^>]*\Z", re.DOTALL)


def names_noise(token: str, is_class: bool = False) -> bool:
    """Whether a whole class or id names boilerplate: ``cookie-notice``, not ``no-comments`` or ``post-header``.

    In a class one plain noise word is enough; an id may be the slug of a heading, so all of it must be known.
    """
    parts = {x.lower() for x in _PART.findall(token)}
    if parts & TURNING:
        return False
    if is_class and parts & PLAIN_NOISE:
        return True
    found = parts & NOISE_WORDS
    if parts & OF_CONTENT:
        found -= OWN_PARTS
    return bool(found) and parts <= NOISE_WORDS | MODIFIERS | OF_CONTENT


class _Lines(HTMLParser):
    """Lines of a page, each with its text, tags and innermost element, and the elements with their parents.

    Elements are those that may hold blocks, numbered in page order; -1 is none. Lines within elements of
    ``named`` (set aside by their class, id or role) are there as well, those within ``NEVER_CONTENT`` not.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []  # text, tags, element
        self.links: list[bool] = []  # mostly text of links
        self.headings: list[str] = []  # h1 .. h6 or nothing
        self.kinds: list[str] = []
        self.parents: list[int] = []
        self.named: dict[int, bool] = {}  # elements set aside by name: for reader comments?
        self._link = 0
        self._link_chars = 0
        self._level = ""
        self._stack: list[tuple[str, int, bool]] = []  # tag, number, set aside
        self._open: Counter[str] = Counter()  # tags on the stack
        self._aside = 0
        self._heading = 0
        self._text: list[str] = []
        self._tags = 0

    def _pop(self) -> str:
        tag, _, noise = self._stack.pop()
        self._open[tag] -= 1
        self._aside -= noise
        return tag

    def _flush(self) -> None:
        text = _BLANK.sub(" ", "".join(self._text)).strip()
        self._text.clear()
        if text:
            self.lines.append((text, max(1, self._tags), self._stack[-1][1] if self._stack else -1))
            self.links.append(2 * self._link_chars > len(text))
            self.headings.append(self._level)
            self._tags = 0
        self._link_chars, self._level = 0, ""

    def _in_article(self) -> bool:
        return self._open["article"] > 0 or self._open["main"] > 0

    def _is_noise(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in NEVER_CONTENT:
            return True
        inside = self._in_article()
        if tag == "header":
            return not inside
        if tag in ("html", "body", "article", "main") and not (tag == "article" and inside):
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _names(self, tag: str, attrs: list[tuple[str, str | None]]) -> list[str]:
        """What sets an element aside by name; ids of headings and paragraphs are often slugs of their text."""
        if tag in ("html", "body", "main") or (tag == "article" and not self._in_article()):
            return []
        found = []
        for name, value in attrs:
            if name == "role" and value and value.lower() in NOISE_ROLES and tag != "article":
                found.append(value)
            elif name in ("class", "id") and value and tag not in HEADINGS and (name == "class" or tag in CONTAINERS):
                found += [x for x in value.split() if names_noise(x, name == "class")]
        return found

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
            # a paragraph or item left open ends with the next
            if self._stack and self._stack[-1][0] in ("p", "li", "dt", "dd") and self._stack[-1][0] in ("p", tag):
                self._pop()
        elif tag in ("br", "wbr"):
            self._text.append(" " if tag == "br" else "")
        self._tags += 1
        if tag in HEADINGS:
            self._heading += 1
        self._link += tag == "a"
        noise = tag not in VOID and (tag in BLOCKS or tag in CONTAINERS) and self._is_noise(tag, attrs)
        names = self._names(tag, attrs) if attrs and not noise and tag in BLOCKS else []
        if tag in CONTAINERS or noise or names:
            number = len(self.kinds)
            if names:
                self.named[number] = any(x.lower() in COMMENT_WORDS for n in names for x in _PART.findall(n))
            self.kinds.append(tag)
            self.parents.append(self._stack[-1][1] if self._stack else -1)
            self._stack.append((tag, number, noise))
            self._open[tag] += 1
            self._aside += noise

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in HEADINGS:
            self._level = tag
        if tag in BLOCKS:
            self._flush()
        if tag == "a":
            self._link = max(0, self._link - 1)
        self._tags += 1
        if tag in HEADINGS:
            self._heading = max(0, self._heading - 1)
        # an element left open ends with the one around it
        if self._open[tag]:
            while self._pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self._aside or (not self._heading and self._open["header"]):
            return
        self._text.append(data)
        if self._link:
            self._link_chars += len(_BLANK.sub(" ", data).strip())

    def finish(self) -> None:
        # a tag or comment that the page's end cuts off is markup, not text
        if not self.cdata_elem:
            self.rawdata = _CUT_OFF.sub("", self.rawdata)
        self.close()
        self._flush()


def smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    reach = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for k in range(len(values)):
        lo, hi = max(0, k - reach), min(len(values), k + reach + 1)
        weight = kernel[lo - k + reach : hi - k + reach]
        out.append(sum(v * w for v, w in zip(values[lo:hi], weight, strict=True)) / sum(weight))
    return out


def two_clusters(values: list[float]) -> float:
    """The threshold halfway between the means of the values below and above it."""
    cut = sum(values) / len(values)
    for _ in range(50):
        low = [v for v in values if v < cut]
        high = [v for v in values if v >= cut]
        if not low or not high:
            return min(values)
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def within(page: _Lines, chosen: Iterable[int]) -> list[bool]:
    """For every element (the last entry: for none) whether it is one of the chosen or lies in one."""
    inside = [False] * (len(page.kinds) + 1)
    for n in chosen:
        inside[n] = True
    for n, parent in enumerate(page.parents):
        inside[n] = inside[n] or inside[parent]
    return inside


def held(page: _Lines, amounts: dict[int, int]) -> list[int]:
    """For every element the sum of the lines' amounts in it."""
    total = [0] * (len(page.kinds) + 1)
    for k, amount in amounts.items():
        total[page.lines[k][2]] += amount
    for n in range(len(page.kinds) - 1, -1, -1):
        if page.parents[n] >= 0:
            total[page.parents[n]] += total[n]
    return total


def dense_lines(page: _Lines, at: list[int]) -> list[int]:
    """Those of the lines ``at`` in the upper cluster of smoothed text per tag, or that would be alone."""
    inside = within(page, [n for n, kind in enumerate(page.kinds) if kind in ("article", "main")])
    own = []
    for k in at:
        text, tags, element = page.lines[k]
        own.append(len(text) / tags * (SHIFT if inside[element] else 1) / (SHIFT if page.links[k] else 1))
    ratio = smoothed(own)
    cut = two_clusters(ratio)
    return [k for k, *pair in zip(at, own, ratio, strict=True) if max(pair) >= cut]


def not_aside(page: _Lines) -> list[int]:
    """Lines in no element set aside by name.

    One that holds most of the page's text is not set aside, unless content in an article stands outside
    all such elements (for reader comments: plain lines of a ``COMMENTS_RATIO``-th of its own text).
    """
    every = list(range(len(page.lines)))
    if not page.named:
        return every
    size = {k: len(page.lines[k][0]) for k in every}
    dense = {k: size[k] for k in dense_lines(page, every)}
    in_named = within(page, page.named)
    in_article = within(page, [n for n, kind in enumerate(page.kinds) if kind in ("article", "main")])
    plain = [k for k in every if not (in_named[page.lines[k][2]] or page.headings[k] or page.links[k])]
    article = any(k in dense and in_article[page.lines[k][2]] for k in plain)
    other, total, total_dense = sum(size[k] for k in plain), sum(size.values()), sum(dense.values())
    most, most_dense = held(page, size), held(page, dense)
    aside = [
        n for n, comments in page.named.items()
        if article or (comments and COMMENTS_RATIO * other >= most[n])
        or 2 * most[n] <= total or 2 * most_dense[n] <= total_dense
    ]
    gone = within(page, aside)
    return [k for k in every if not gone[page.lines[k][2]]]


def with_title(page: _Lines, at: list[int], kept: list[int]) -> list[int]:
    """``kept`` with the last h1 before it, should it have none."""
    if any(page.headings[k] == "h1" for k in kept):
        return kept
    return [k for k in at if k < kept[0] and page.headings[k] == "h1"][-1:] + kept


def article_lines(page: _Lines, at: list[int], dense: list[int], kind: str) -> list[int]:
    """Lines of the elements of a kind, but for those that are links without content."""
    here = [n for n, k in enumerate(page.kinds) if k == kind]
    content = held(page, dict.fromkeys(dense, 1))
    own = held(page, {k: 1 for k in at if not page.links[k]})
    inside = within(page, [n for n in here if content[n] or own[n]])
    return [k for k in at if inside[page.lines[k][2]]]


def around_content(page: _Lines, at: list[int], dense: list[int]) -> list[int]:
    """Lines from the first content line to the last, of elements with content, and next to them up to a link."""
    dense = [k for k in dense if not page.links[k]] or dense
    first, last = dense[0], dense[-1]
    content = held(page, dict.fromkeys(dense, 1))
    regions = [n for n in range(len(page.kinds)) if 0 < content[n] < len(dense)]
    # the lowest element around all content is a region, too, if content stands in it directly
    lowest = max((n for n in range(len(page.kinds)) if content[n] == len(dense)), default=-1)
    if lowest >= 0 and page.kinds[lowest] not in ("html", "body") and any(page.lines[k][2] == lowest for k in dense):
        regions.append(lowest)
    inside = within(page, regions)
    keep = {k for k in at if first <= k <= last or inside[page.lines[k][2]]}
    # short lines next to the content, up to a link; links below a heading are the text's own
    for way in ([k for k in reversed(at) if k < first], [k for k in at if k > last]):
        below = False
        for k in way:
            if k not in keep:
                if page.links[k] and not below:
                    break
                keep.add(k)
            below = k > last and (bool(page.headings[k]) or (below and page.links[k]))
    return [k for k in at if k in keep]


def main_text(html: str | None) -> str:
    """Blocks of the article, one per line; empty if there is no text."""
    page = _Lines()
    page.feed(html or "")
    page.finish()
    at = not_aside(page)
    if not at:
        return ""
    dense = dense_lines(page, at)
    size = lambda lines: sum(len(page.lines[k][0]) for k in lines)
    for kind in ("article", "main"):
        kept = article_lines(page, at, dense, kind)
        if kept and 2 * size(kept) >= size(dense):
            break
    else:
        kept = around_content(page, at, dense)
    return "\n".join(page.lines[k][0] for k in with_title(page, at, kept))


_OUT = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for page_id, url, html in arrow_rows(batches):
        text = main_text(html)
        rows.append((page_id, url, text, len(text)))
        size += len(text)
        if size > 4_000_000 or len(rows) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OUT.types, strict=True)], schema=_OUT)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _OUT.types, strict=True)], schema=_OUT)


def page_texts(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) of every row of ``pages``, from the whole html.

    Character references are decoded, white space within a block becomes one blank, blocks are joined
    by one newline in page order. Null, empty and textless pages give an empty text. Pages are
    independent: no shuffle, repeated rows give a row each, other columns are not read.
    """
    return (
        pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
        .mapInArrow(_extract, "id long, url string, text string, n_chars long")
        .withColumnsRenamed({"id": id_col, "url": url_col})
    )
