"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard parser streams events.  Block tags cut the page into lines; inline tags do not.  A line's ratio is its
characters over its tags; the ratios are smoothed along the page, and lines at or over a threshold taken from their spread
form the content cluster.  The region is the innermost element that holds most of the cluster, an article or main element
before others.  All its lines belong to the text, short ones too, except those inside boilerplate elements.

What a class, id, item property, data attribute or short label is called, and a form, are hints only: layout wrappers have such names too.  An element under a hint is
boilerplate unless it holds a main element, the article with most clustered characters, or half of the characters of a first
cluster in which hints do not count (nearly all of them if it stands beside an article that is under no hint).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED = 1 << 16
SIGMA = 1.5
MOST = 0.7
NEARLY_ALL = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SILENT = frozenset("head title script style noscript template iframe object svg math canvas audio video select option textarea button datalist map".split())
BOILERPLATE = frozenset("nav footer aside dialog menu fieldset".split())
REGIONS = frozenset("body main article section div td blockquote center".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
CLOSES_P = REGIONS | BOILERPLATE | frozenset("form p h1 h2 h3 h4 h5 h6 ul ol dl table pre hr header figure address details".split())
#: What names of classes and ids hint at, word by word.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs"
    " sidebar aside footer header masthead topbar toolbar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup"
    " login comment comments respond replies disqus share sharing social related recommended widget pagination pager search form skip".split()
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
NAME_CHARS = 40
LABEL_WORDS = 3
HEADINGS = frozenset("h2 h3 h4 h5 h6".split())
#: A heading over reader comments: they end at the next heading of its rank or with the element around it.
COMMENT_HEADING = re.compile(r"(?i)(?:(?:reader|user|visitor)s?['\u2019]? )?comments?(?: ?\([0-9]+\)| ?: ?[0-9]+)?|[0-9]+ (?:comments?|repl(?:y|ies)|responses?)|leave a (?:comment|reply)|join the (?:conversation|discussion)")


def _named_boilerplate(attrs: dict[str, str | None]) -> bool:
    if not attrs:
        return False
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", (attrs.get("style") or "").lower()):
        return True
    return False


def _hinted(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag == "form" or (attrs.get("role") or "").lower() == "form":
        return True
    names = [attrs.get("class"), attrs.get("id"), attrs.get("itemprop"), attrs.get("itemtype")]
    names += [v for k, v in attrs.items() if k.startswith("data-") and len(v or "") <= NAME_CHARS]
    if any(w.lower() in HINTS for name in names if name for w in _WORDS.findall(name)):
        return True
    label = _WORDS.findall(attrs.get("aria-label") or "")  # prose: only a short one is a name
    return len(label) <= LABEL_WORDS and any(w.lower() in HINTS for w in label)


class _Line(NamedTuple):
    text: str
    tags: int
    region: int  # innermost region and hinted element around it, or -1
    hint: int
    dropped: bool


class _Nest:
    """Elements of one sort, numbered as they open.  Those inside number r are r .. ends[r] - 1."""

    def __init__(self):
        self.open: list[int] = []
        self.parents: list[int] = []
        self.ends: list[int] = []

    def enter(self) -> int:
        self.parents.append(self.inner)
        self.ends.append(-1)
        self.open.append(len(self.parents) - 1)
        return self.open[-1]

    def leave(self):
        self.ends[self.open.pop()] = len(self.parents)

    @property
    def inner(self) -> int:
        return self.open[-1] if self.open else -1

    def holds(self, outer: int, number: int) -> bool:
        return outer <= number < self.ends[outer]

    def totals(self, own: list[int]) -> list[int]:
        """Per element: what it and all inside it have, from what each has itself."""
        sums = [0, *accumulate(own)]
        return [sums[e] - sums[r] for r, e in enumerate(self.ends)]


class _Lines(HTMLParser):
    """Lines with the regions and the hinted elements around them; each event costs the same at any depth."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool, bool]] = []  # tag, opens boilerplate, a region, a hinted element
        self.places: dict[str, list[int]] = {}  # depths of the open elements of a tag
        self.blocks: list[int] = []  # depths of the open elements that are not inline
        self.kinds: list[str] = []
        self.regions, self.hints = _Nest(), _Nest()
        self.hint_region: list[int] = []  # region around each hinted element
        self.around: dict[int, int] = {}  # hinted element around each article and main
        self.lines: list[_Line] = []
        self.parts: list[str] = []
        self.muted: tuple[int, str] | None = None  # depth and tag of a heading over reader comments
        self.tags = 0
        self.silent = self.dropped = self.articles = 0

    def _text(self) -> str:
        return " ".join("".join(self.parts).split())

    def _end_line(self):
        text = self._text()
        if text:
            self.lines.append(_Line(text, self.tags, self.regions.inner, self.hints.inner, self.dropped > 0 or self.muted is not None))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if tag in CLOSES_P and self.places.get("p"):
            self._close("p")
        if tag in VOID:
            return
        if self.muted and tag in HEADINGS and tag <= self.muted[1]:
            self.muted = None
        named = dict(attrs)
        inner = tag not in ("html", "body", "article", "main")
        drop = tag in BOILERPLATE or (tag == "header" and not self.articles) or (inner and _named_boilerplate(named))
        hinted = inner and not drop and _hinted(tag, named)
        if tag in REGIONS:
            region = self.regions.enter()
            self.kinds.append(tag)
        if hinted:
            self.hints.enter()
            self.hint_region.append(self.regions.inner)
        if tag in ("article", "main"):
            self.around[region] = self.hints.inner
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, drop, tag in REGIONS, hinted))
        self.dropped += drop
        self.silent += tag in SILENT
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        # '<div/>' opens a div all the same; only void elements close themselves
        self.handle_starttag(tag, attrs)

    def _close(self, tag):
        while self.stack:
            t, drop, region, hinted = self.stack.pop()
            self.places[t].pop()
            if t not in INLINE:
                self.blocks.pop()
            if region:
                self.regions.leave()
            if hinted:
                self.hints.leave()
            self.dropped -= drop
            self.silent -= t in SILENT
            self.articles -= t in ("article", "main")
            if self.muted and len(self.stack) < self.muted[0]:
                self.muted = None
            if t == tag:
                return

    def handle_endtag(self, tag):
        if tag in HEADINGS and self.places.get(tag) and not self.muted and COMMENT_HEADING.fullmatch(self._text()):
            self.muted = (self.places[tag][-1], tag)
        if tag not in INLINE:
            self._end_line()
        self.tags += 1
        if self.places.get(tag):
            if tag in INLINE and self.blocks and self.blocks[-1] > self.places[tag][-1]:
                return  # a stray inline end does not close blocks
            self._close(tag)

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)

    def finish(self):
        self.close()
        self._end_line()
        for nest in (self.regions, self.hints):
            while nest.open:
                nest.leave()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weights


def content_lines(lines) -> np.ndarray:
    """Which lines are in the content cluster."""
    ratios = np.array([0.0 if x.dropped else len(x.text) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratios)
    usable = np.array([not x.dropped for x in lines])
    return usable & (smooth >= min(smooth.std(), smooth.max()))


def _settled(parser: _Lines) -> list[_Line]:
    """The lines, those in hinted elements dropped unless the cluster lies in the element."""
    regions, hints = parser.regions, parser.hints
    if not hints.parents or not parser.lines:
        return parser.lines
    in_hint, clustered, other = ([0] * len(n.parents) for n in (hints, regions, regions))
    total = 0
    for x, chosen in zip(parser.lines, content_lines(parser.lines)):
        size = len(x.text)
        if chosen:
            total += size
            if x.hint >= 0:
                in_hint[x.hint] += size
        if x.region >= 0 and not x.dropped:
            (clustered if chosen else other)[x.region] += size
    inside, clustered, other = hints.totals(in_hint), regions.totals(clustered), regions.totals(other)
    best = max(parser.around, key=lambda r: (clustered[r], other[r], -r), default=None)
    kept = {h for h, w in enumerate(inside) if 2 * w >= total}
    forced: set[int] = set()

    def force(h):
        while h >= 0 and h not in forced:
            forced.add(h)
            h = hints.parents[h]

    if best is not None and (clustered[best] or other[best]):
        if parser.around[best] < 0:
            # an article outside of all hints: what lies beside it needs nearly all of the cluster
            kept = {h for h in kept if regions.holds(best, parser.hint_region[h]) or inside[h] >= NEARLY_ALL * total}
        force(parser.around[best])
    for r, h in parser.around.items():
        if parser.kinds[r] == "main":
            force(h)
    sound: list[bool] = []  # kept, and all around it too
    for h, parent in enumerate(hints.parents):
        sound.append((h in kept or h in forced) and (parent < 0 or sound[parent]))
    return [x._replace(dropped=x.dropped or (x.hint >= 0 and not sound[x.hint])) for x in parser.lines]


def main_text(html: str | None) -> str:
    parser = _Lines()
    html = html or ""
    for at in range(0, len(html), FEED):
        parser.feed(html[at : at + FEED])
    parser.finish()
    lines = _settled(parser)
    if not lines:
        return ""
    cluster = content_lines(lines)
    own = [0] * len(parser.kinds)
    total = 0
    for x, chosen in zip(lines, cluster):
        if chosen and not x.dropped:
            total += len(x.text)
            if x.region >= 0:
                own[x.region] += len(x.text)
    region = None
    if total:
        weight = parser.regions.totals(own)
        strong = [r for r, w in enumerate(weight) if parser.kinds[r] in ("article", "main") and w >= 0.5 * total]
        wide = [r for r, w in enumerate(weight) if w >= MOST * total]
        named = [r for r in strong if parser.kinds[r] == "article"] or strong
        region = max(named) if named else max(wide) if wide else None
    else:
        articles = [r for r, k in enumerate(parser.kinds) if k in ("article", "main")]
        region = articles[0] if articles else None
    return " ".join(x.text for x in lines if not x.dropped and (region is None or parser.regions.holds(region, x.region)))


def extract(pages: DataFrame, *, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns but the html) with text, the page's main text, and n_chars, its code points.

    A null or empty page, and one without text, has an empty text; broken markup is read as far as it goes; repeated rows
    are read each for itself; columns of pages named text or n_chars are replaced; an empty table gives an empty result.
    """
    keep = [c for c in (pages.columns if keep is None else keep) if c not in (html, "text", "n_chars")]
    given = pages.select(*keep, html)
    schema = T.StructType([*pages.select(*keep).schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(html)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"]
            )

    return given.mapInArrow(run, schema)
