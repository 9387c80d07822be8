"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events. They fill blocks, the lines of
the page, with their text and the number of tags met. The ratio of text to tags
by line is smoothed with a Gaussian and parted into two clusters by a threshold;
regions of the page with a line above it are content. Elements and names that
page furniture has are evidence: plain ones take an element out, doubtful ones
only if its own ratio is that of furniture. An article mark is evidence, too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tokens import string_column

_SIGMA = 1.0
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
#: Elements that hold no article text, and words of class, id or role that say so.
_SKIPPED = frozenset(
    "head title script style noscript template nav aside form button select option textarea input iframe object svg "
    "canvas menu dialog audio video map".split()
)
_CHROME = frozenset(["header", "footer"])
_SKIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead header topbar footer sidebar widget cookie cookies consent gdpr notice notices "
    "notification notifications announcement announcements popup modal overlay newsletter subscribe subscription share "
    "sharing social reactions related comment comments respond disqus login signup search contentinfo complementary "
    "toolbar alert hidden".split()
)
#: Words that name nothing else, whatever element has them.
_PLAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsored navbar breadcrumb breadcrumbs masthead topbar cookie cookies gdpr "
    "newsletter signup disqus".split()
)
#: A compound that starts with a word of chrome and ends in one of these names
#: chrome (ad-box); with another end (search-engine) it is doubtful.
_BOX_WORDS = frozenset(
    "area bar block bottom box boxes button buttons card cards container content feed form frame group holder icons inner "
    "item items left link links list lists outer panel panels post posts region right row section slot stories strip top "
    "unit units wrap wrapper zone".split()
)
#: Compounds with these name the header of the page, with others that of a part.
_PAGE_WORDS = frozenset("app blog desktop fixed global main mobile page site sticky theme top web".split())
#: Compound names with one of these words, or that end in one of those, tell of
#: an element's state or layout (has-sidebar, search-results), not what it is.
_STATE_WORDS = frozenset("has no with without not overflow".split())
_STATE_ENDS = frozenset(
    "active closed collapsed disabled enabled expanded free heading headline layout main open opened page result "
    "results title visible".split()
)
#: Chrome whose own items are often marked as articles.
_LISTED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising promo promotion sponsor sponsored widget related comment comments "
    "respond disqus".split()
)
_ARTICLE = frozenset(["article", "main"])
#: Elements that lines stand in, not groups of lines.
_LINES = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup header li dt dd ul ol dl blockquote pre table thead tbody tfoot tr td th figure figcaption "
    "address hr".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Lists and tables hold lines, yet can be chrome as a whole.
_WHOLE = frozenset("ul ol dl table header".split())
# How an element is skipped: not at all, not if the page has nothing better (an
# article in an element skipped by its name), by its name, or for good.
_KEPT, _SPARE, _NAMED, _GONE = range(4)
#: Elements whose end a new one of the same kind implies.
_IMPLIED_END = frozenset("p li dt dd tr td th option".split())
_NAMES = re.compile(r"[A-Za-z]+")


#: Doubtful elements are chrome below this share of the mean ratio of content,
#: or with this share of their text in links.
_CHROME_RATIO, _CHROME_LINKS = 0.1, 0.5
#: Clusters whose means differ by less than this factor are one.
_CLUSTERS_APART = 4.0


@dataclass
class Block:
    """A line of the page."""

    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    region: int = 0
    article: int = 0
    spare: bool = False
    doubt: int = 0

    def line(self) -> str:
        return " ".join("".join(self.text).split())


class BlockParser(HTMLParser):
    """Collects the blocks of a page; text of skipped elements is left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks = [Block()]
        # Name, how it is skipped, numbers of the article, the group of lines and the doubtful element around.
        self._open: list[tuple[str, int, int, int, int]] = []
        self._count: Counter[str] = Counter()  # open elements by name
        self._articles = self._groups = self._doubts = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections that are none, such as ``<![x[``, are comments, not errors."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def _close(self, first: int, last: int | None = None) -> None:
        for name, *_ in self._open[first:last]:
            self._count[name] -= 1
        del self._open[first:last]

    def _state(self) -> tuple[int, int, int, int]:
        return self._open[-1][1:] if self._open else (_KEPT, 0, 0, 0)

    def _new_block(self) -> None:
        skipped, article, group, doubt = self._state()
        last = self.blocks[-1]
        if last.text or last.tags:
            self.blocks.append(last := Block())
        last.article, last.spare = article if skipped <= _SPARE else 0, skipped == _SPARE
        last.region, last.doubt = group, doubt

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _IMPLIED_END and self._open and self._open[-1][0] == tag:
            self._close(len(self._open) - 1)
        if tag not in _VOID:
            skipped, article, group, doubt = self._state()
            if tag in _ARTICLE and not article:
                self._articles += 1
                article = self._articles
                if skipped == _NAMED:
                    skipped = _SPARE
            own, doubtful = _evidence(tag, attrs, bool(article))
            if doubtful and not doubt:
                self._doubts += 1
                doubt = self._doubts
            if tag in _SKIPPED or tag in _CHROME and not (tag == "header" and article):
                own = _GONE
            if tag not in _INLINE and tag not in _LINES:
                self._groups += 1
                group = self._groups
            self._open.append((tag, max(skipped, own), article, group, doubt))
            self._count[tag] += 1
        if tag not in _INLINE:
            self._new_block()
        elif tag == "br":
            self.handle_data(" ")
        self.blocks[-1].tags += 1

    def handle_endtag(self, tag: str) -> None:
        self.blocks[-1].tags += 1
        if self._count[tag]:
            at = len(self._open) - 1
            while self._open[at][0] != tag:
                at -= 1
            # An inline end does not close the blocks that were opened inside it.
            if tag in _INLINE and any(name not in _INLINE for name, *_ in self._open[at + 1 :]):
                self._close(at, at + 1)
                return
            self._close(at)
        if tag not in _INLINE:
            self._new_block()

    def handle_data(self, data: str) -> None:
        if self._state()[0] <= _SPARE:
            self.blocks[-1].text.append(data)
            if self._count["a"]:
                self.blocks[-1].linked += len(data.strip())


def _chrome_words(name: str) -> tuple[frozenset[str], bool]:
    """The words by which a class, id or role names chrome, and whether it is
    plain that it does. A whole name is plain (ad, top-bar), as is the last word
    of a compound (site-footer), and the first before a word for a box (ad-slot).
    Compounds that tell of a state or a layout name nothing."""
    parts = _NAMES.findall(name)
    whole = frozenset(["".join(parts)]) & _SKIPPED_WORDS
    if whole or len(parts) < 2:
        return whole, True
    if _STATE_WORDS.intersection(parts) or parts[-1] in _STATE_ENDS:
        return frozenset(), True
    first, last = frozenset(parts[:1]) & _SKIPPED_WORDS, frozenset(parts[-1:]) & _SKIPPED_WORDS
    if parts[-1] == "header" and parts[0] not in _PAGE_WORDS or parts[0] == "header":
        first, last = first - {"header"}, last - {"header"}
    if parts[0] not in ("is", "visually"):
        first, last = first - {"hidden"}, last - {"hidden"}
    return (first | last, True) if last else (first, parts[-1] in _BOX_WORDS)


def _evidence(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> tuple[int, bool]:
    """How an element is skipped by what its attributes say, and whether that is
    in doubt. Names of lines and ids of sections, which are link targets, are
    doubtful unless they can mean nothing else; those of headings and of inline
    elements say nothing else. The header of an article belongs to it."""
    if tag in ("html", "body") or tag in _ARTICLE:
        return _KEPT, False
    plain: set[str] = set()
    doubtful = False
    for name, value in attrs:
        value = (value or "").lower()
        if name in ("class", "id", "role"):
            for one in value.split():
                words, sure = _chrome_words(one)
                if in_article:
                    words -= {"header"}
                line = tag in _LINES and tag not in _WHOLE or tag in _INLINE or name == "id" and tag == "section"
                if line and not (sure and words & _PLAIN_WORDS) or not sure:
                    doubtful |= bool(words) and tag not in _HEADINGS and tag not in _INLINE
                else:
                    plain |= words
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return _GONE, False
        if name == "style" and "display:none" in value.replace(" ", ""):
            return _GONE, False
    if tag in _HEADINGS or not plain:
        return _KEPT, doubtful
    return _GONE if _LISTED_WORDS.intersection(plain) else _NAMED, False


def smoothed(ratios: np.ndarray, sigma: float = _SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines; the ends weigh what there is."""
    radius = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    middle = slice(radius, radius + len(ratios))
    return np.convolve(ratios, kernel)[middle] / np.convolve(np.ones(len(ratios)), kernel)[middle]


def threshold(ratios: np.ndarray) -> float:
    """The border between the two clusters of ``ratios`` with the least squared
    distances to their means; the least ratio if the means are not apart."""
    ordered = np.sort(ratios)
    sums, sizes = np.cumsum(ordered), np.arange(1, len(ordered) + 1)
    below = sums[:-1] / sizes[:-1]
    above = (sums[-1] - sums[:-1]) / sizes[::-1][1:]
    # The least inner distances are the greatest between the clusters.
    between = sizes[:-1] * sizes[::-1][1:] * (above - below) ** 2
    if not len(between):
        return float(ordered[0])
    at = int(between.argmax())
    if above[at] < _CLUSTERS_APART * below[at]:
        return float(ordered[0])
    return float((below[at] + above[at]) / 2)


def _without_furniture(lines: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """Lines of doubtful elements become empty if the element's own ratio is far
    below that of the lines in no doubt, or most of its text is in links."""
    sure = [(len(line), max(block.tags, 1)) for block, line in lines if line and not block.doubt]
    usual = sum(chars / tags for chars, tags in sure) / max(len(sure), 1)
    sums: dict[int, list[int]] = {}
    for block, line in lines:
        if block.doubt:
            own = sums.setdefault(block.doubt, [0, 0, 0])
            own[0], own[1], own[2] = own[0] + len(line), own[1] + block.tags, own[2] + block.linked
    gone = {
        doubt
        for doubt, (chars, tags, linked) in sums.items()
        if chars < _CHROME_RATIO * usual * max(tags, 1) or linked >= _CHROME_LINKS * chars
    }
    return [(block, "" if block.doubt in gone else line) for block, line in lines]


def main_text(html: str | None) -> str:
    """Lines of the content regions, joined by line feeds; empty if there are none.

    A region is the lines of one parent, skipped elements between them or not
    (lines are paragraphs, headings, list items, cells and the like). Smoothed ratios of all lines, also of those that are skipped
    and have no text left, form two clusters. A region with a line in the upper
    one, ties included, is content, and is given whole, its short lines too. On
    pages that mark articles, these and nothing else are content, each whole; an
    article inside an element that only its name makes chrome counts if the rest
    of the page has no article and less text.
    """
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    lines = _without_furniture([(block, block.line()) for block in parser.blocks])
    lengths = [0, 0]
    for block, line in lines:
        lengths[block.spare] += len(line)
    if lengths[False] >= lengths[True] or any(block.article and line and not block.spare for block, line in lines):
        for block, _ in lines:
            block.article = 0 if block.spare else block.article
        lines = [(block, "" if block.spare else line) for block, line in lines]
    lines = [(block, line) for block, line in lines if line or block.tags]
    if any(block.article and line for block, line in lines):
        return "\n".join(line for block, line in lines if line and block.article)
    if not any(line for _, line in lines):
        return ""
    ratios = smoothed(np.array([len(line) / max(block.tags, 1) for block, line in lines]))
    border = threshold(ratios)
    content = {block.region for (block, line), ratio in zip(lines, ratios) if line and ratio >= border}
    return "\n".join(line for block, line in lines if line and block.region in content)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, url, text, n_chars) of every page.

    The whole html is read; a null one is empty and gives an empty text. White
    space in a block becomes one space. Repeated rows stay, null ids and urls
    are kept, other columns are left out.
    """

    def extract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(html.as_py()) for html in string_column(batch, "_html")], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), texts], names=["_id", "_url", "text"]
            )

    id_kind, url_kind = (pages.schema[name].dataType.simpleString() for name in (id_col, url_col))
    found = pages.select(
        pages[id_col].alias("_id"), pages[url_col].alias("_url"), pages[html_col].alias("_html")
    ).mapInArrow(extract_task, f"_id {id_kind}, _url {url_kind}, text string")
    return found.select(
        F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")
    )
