"""Main text of web pages: parser events become lines, whose text-to-tag ratios are smoothed and
clustered to choose the content regions."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import carried, tidy

# Elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title svg math canvas object iframe audio video map head".split())
FURNITURE = frozenset("nav footer aside button select textarea dialog menu".split())
DOUBTFUL = frozenset("form fieldset".split())
MAIN = frozenset("article main".split())
SECTIONING = frozenset("article main section div header body td table form fieldset".split()) | FURNITURE
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
LISTS = frozenset("ul ol menu".split())
CLOSES_P = BLOCKS - {"body", "html", "tbody", "tfoot", "thead", "tr"}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words of class and id names that mark what is no article text.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|nav\w*|menus?|breadcrumbs?|"
    r"sidebar|side|aside|widgets?|footer|masthead|site-?header|page-?header|topbar|toolbar|comments?|disqus|replies|respond|reader-?comments|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscri\w*|signup|login|pagination|pager|skip|copyright|legal|disclaimer)(?:$|[\s_-])",
    re.IGNORECASE,
)

# The only ones that count on an article or main element itself.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|respond|reader-?comments|ads?|advert\w*|sponsor\w*)(?:$|[\s_-])", re.IGNORECASE)

# Spread of the Gaussian, in lines, and how many of them it reaches to either side.
SIGMA, REACH = 1.0, 3
KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]

# Priors that a line's ratio is multiplied by: inside an article or main element, inside an element whose name, role or
# kind is that of a notice, advert, form and the like, and for text that is nothing but links.
INSIDE, NAMED, LINKED = 2.0, 1 / 64, 0.05

# A region beside one of content is content too if a line of it with no more inline tags than words reaches so much of the
# threshold.
BESIDE = 0.5


class Line(NamedTuple):
    """Text of one block, the tags seen in it, its region, the innermost named element around it (0: none), whether it is
    inside an article or main element, the share of its characters inside links, and its inline tags."""

    text: str
    tags: int
    region: int
    named: int
    inside: bool
    links: float
    inline: int


class Open(NamedTuple):
    """What an open element counts for."""

    tag: str
    silent: bool
    furniture: bool
    named: bool
    main: bool
    region: bool


class Lines(HTMLParser):
    """Lines of a page. Menus, footers, sidebars and controls, which are elements of their own kind, have none; elements that only
    their names make suspect are remembered. Every event costs the same, however deep the page is nested."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[Open] = []
        self.open: Counter[str] = Counter()
        self.items = [0]  # open list items, by open list
        self.parents, self.regions = [0], [0]  # parent of each region; the open ones
        self.articles = [False]  # whether a region is an article or main element
        # of named elements: the one around each, those open now, whether the first article is inside, whether it is about comments or
        # adverts, whether it is inside an article
        self.outer, self.around, self.first, self.hard, self.within = [0], [0], [False], [False], [False]
        self.silent = self.furniture = self.main = self.links = self.stories = 0
        self.held: list[str] = []
        self.tags = self.linked = self.inline = 0

    def flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text and not self.furniture:
                self.lines.append(Line(text, max(1, self.tags), self.regions[-1], self.around[-1], self.main > 0, min(1.0, self.linked / len(text)), self.inline))
            self.held = []
        self.tags = self.linked = self.inline = 0

    def suspect(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool, bool]:
        """Whether an element is hidden, whether it is suspect by kind, name or role, and whether it is one of comments."""
        hidden, named, comments = False, tag in DOUBTFUL or (tag == "header" and not self.main), False
        for name, value in attrs:
            if name in ("class", "id") and value:
                named |= bool((COMMENTS if tag in MAIN else NAMES).search(value))
                comments |= bool(COMMENTS.search(value))
            elif name == "role" and value:
                named |= value.lower() in ROLES
            hidden |= name == "hidden" or name == "aria-hidden" and value == "true"
        return hidden, named, comments

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P and self.open["p"]:
            self.shut("p")
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        self.inline += tag not in BLOCKS
        if tag in VOID:
            if tag == "br":
                self.held.append(" ")
            return
        if tag == "li" and self.items[-1]:
            self.shut("li")
        elif tag in ("td", "th"):
            self.held.append(" ")
        if tag in LISTS:
            self.items.append(0)
        self.items[-1] += tag == "li"
        silent, furniture, main, named = tag in SILENT, tag in FURNITURE, tag in MAIN, False
        if not silent and not furniture and tag not in ("html", "body"):
            hidden, named, comments = self.suspect(tag, attrs)
            furniture |= hidden
            named &= not furniture
        if furniture or named:
            self.flush()
        if named:
            self.outer.append(self.around[-1])
            self.around.append(len(self.outer) - 1)
            self.first.append(False)
            self.hard.append(comments)
            self.within.append(self.main > 0)
        if main and not self.stories and not self.furniture and not furniture:
            # the first article or main element: all around it that is open now has it inside
            self.stories += 1
            for i in self.around:
                self.first[i] = True
            if named:
                self.first[self.around[-1]] = False
        # An article or main element is one region, whatever sections and tables are inside it.
        region = main or (tag in SECTIONING and not self.main)
        if region:
            self.parents.append(self.regions[-1])
            self.articles.append(main)
            self.regions.append(len(self.parents) - 1)
        self.stack.append(Open(tag, silent, furniture, named, main, region))
        self.open[tag] += 1
        self.silent += silent
        self.furniture += furniture
        self.main += main
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        self.inline += tag not in BLOCKS
        if self.open[tag]:
            self.shut(tag)

    def shut(self, tag: str) -> None:
        while True:
            e = self.stack.pop()
            if e.furniture or e.named or e.tag in BLOCKS:
                self.flush()
            self.open[e.tag] -= 1
            self.silent -= e.silent
            self.furniture -= e.furniture
            self.main -= e.main
            self.links -= e.tag == "a"
            if e.named:
                self.around.pop()
            if e.region:
                self.regions.pop()
            if e.tag in LISTS:
                self.items.pop()
            elif e.tag == "li":
                self.items[-1] -= 1
            if e.tag == tag:
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.held.append(data)
            if self.links:
                self.linked += len("".join(data.split()))

    def doubted(self) -> list[bool]:
        """For each named element, whether its lines are doubted. They are not if the first article of the page is inside, or more
        than half of the page's text and no article is elsewhere; of comments and adverts that is asked for too, or
        four fifths of the text. What is inside a doubted element is doubted."""
        chars, total = [0] * len(self.outer), 0
        for line in self.lines:
            chars[line.named] += len(line.text)
            total += len(line.text)
        for i in range(len(chars) - 1, 0, -1):
            chars[self.outer[i]] += chars[i]
        out = [False]
        for i in range(1, len(chars)):
            most = 2 * chars[i] > total
            alone = not self.stories or self.within[i]
            if self.hard[i]:
                cleared = self.first[i] and most or alone and 5 * chars[i] > 4 * total
            else:
                cleared = self.first[i] or alone and most
            out.append(not cleared or out[self.outer[i]])
        return out


def smoothed(values: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is what lies inside."""
    out = []
    for i in range(len(values)):
        low, high = max(0, i - REACH), min(len(values), i + REACH + 1)
        weights = KERNEL[low - i + REACH : high - i + REACH]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """Half way between the means of the two clusters of the values."""
    cut = (min(values) + max(values)) / 2
    for _ in range(50):
        low, high = [v for v in values if v <= cut], [v for v in values if v > cut]
        if not high:
            return min(values)
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str | None) -> str:
    """The blocks of the content regions of a page, one a line; empty for a null or empty page.

    A line's value is its text-to-tag ratio, smoothed over its neighbours, times its priors: more than one inside an article
    or main element, less than one inside an element named for a notice, advert, form, comments and the like, and
    for links. The values' two clusters give the threshold. Regions (an article or main element; outside of these
    the innermost sectioning element) with a line that reaches it are content, and so are those beside them, inside or
    right around them with a line that reaches half of it, but for articles, which stand for themselves. A content region stays whole, a short line beside
    long ones too, but for doubted lines below the threshold.

    A name is no reason to doubt what has the page's first article or most of its text inside.
    """
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines, parents, doubted = parser.lines, parser.parents, parser.doubted()
    if not lines or all(doubted[line.named] for line in lines):
        return ""
    values = smoothed([len(line.text) / line.tags for line in lines])
    for i, line in enumerate(lines):
        prior = (INSIDE if line.inside else 1.0) * (NAMED if doubted[line.named] else 1.0)
        values[i] *= prior * max(LINKED, 1.0 - line.links)
    cut = threshold(values)
    content = {line.region for line, value in zip(lines, values, strict=True) if value >= cut}
    beside = content | {parents[r] for r in content}
    near = {line.region for line, value in zip(lines, values, strict=True) if value >= BESIDE * cut and line.inline <= line.text.count(" ") + 1}
    content |= {r for r in near if (r in beside or parents[r] in beside) and not parser.articles[r]}
    return "\n".join(line.text for line, value in zip(lines, values, strict=True) if line.region in content and (value >= cut or not doubted[line.named]))


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the html) of ``pages`` with ``text``, the main text, and ``n_chars``,
    its code points. Columns of these names in ``pages`` are replaced.

    White space in a block is one space; blocks are joined by a line feed in page order. Null, empty and
    pure-furniture pages have an empty text. Each page is parsed by itself, whole, so repeated rows give
    repeated rows and an empty table an empty one; a task holds one Arrow batch.
    """
    keep = [c for c in (keep or pages.columns) if c not in (html, "text", "n_chars")]
    read, fields = carried(pages, keep, F.col(f"`{html}`"))
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=schema.names)

    return read.mapInArrow(tidy(run), schema)
