"""Main text of web pages by text-to-tag ratio (operator 4).

The standard library's parser streams a page's events.  Blocks (paragraphs,
headings, list items, cells: the page's lines) get their text and the number of
tags met since the block before; parts that name themselves as page furniture
(menus, page headers and footers, sidebars, notices, adverts, forms, comments,
scripts, styles) give no blocks.  The ratio of text length to tags is smoothed
along the page with a Gaussian; blocks above a threshold (the standard deviation of
the smoothed ratios, as in content extraction via tag ratios) are content.  The
content region is the articles or main elements if they hold all content blocks, or
else the smallest element that holds all of them; all blocks of the region are kept,
short ones too, but for blocks made of links that stand outside an article and whose
smoothed ratio is low.

Defined results: null and empty html give an empty text; html of any length is
parsed whole; a page without any content block gives an empty text; repeated rows
are repeated; an empty table gives no rows; other columns are kept, those named
like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillsight.llm.staging import prepare, read

SMOOTHING_RADIUS = 2
SMOOTHING_SIGMA = 1.0
#: Elements without an end tag, and those that end the block around them; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead title tr ul".split())
HOLDER = frozenset("article body div html main section td center".split())
HIDDEN = frozenset("aside button dialog footer form head iframe math menu nav noscript object script select style svg "
                   "template textarea".split())
#: Words of class and id names, and roles, of page furniture; fixed values.
FURNITURE = frozenset("ad ads adv advert adverts advertisement adsense breadcrumb breadcrumbs comment comments "
                      "consent cookie cookies disclaimer disqus footer gdpr login menu modal nav navbar "
                      "navigation newsletter notice notices notification outbrain overlay pager pagination popup promo "
                      "promotion recommended related replies reply responses search share sharing sidebar sidenav "
                      "signup skip social sponsor sponsored subscribe taboola toolbar topbar widget widgets "
                      "alert sidemenu skyscraper paywall".split())
#: These only as the first word of a name: page builders call any part of a page ``x-widget-...``; fixed values.
LAYOUT = frozenset(["widget", "widgets"])
#: These only outside an article: inside they head the article itself; fixed values.
OUTER_FURNITURE = frozenset(["banner", "header", "masthead"])
#: Class names that speak of the page's state, not of the element; fixed values.
STATE_NAME = re.compile(r"(has|no|with|without)-.*|.*-(open|closed|enabled|disabled|count|on|off)")
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                  "toolbar".split())
#: An open element of the key is ended by a start tag of these, unless a holder stands between.
#: Start tags that leave an open head as it is; any other one ends it, and so does text.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript object script style template title".split())
IMPLIED_END = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
               "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]),
               "th": frozenset(["td", "th", "tr", "tbody"]), "option": frozenset(["option"])}
_NAME = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")


class Page(HTMLParser):
    """Collects blocks as (text, tags, link characters, path of holders)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.open: list[tuple[str, bool]] = []  # name, hides its content
        self.holders: list[int] = []
        self.kinds: list[str] = []  # of each holder met
        self.hidden = self.links = self.tags = self.link_chars = 0
        self.text: list[str] = []

    def end_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((text, self.tags, self.link_chars, tuple(self.holders)))
            self.tags = 0
        self.text, self.link_chars = [], 0

    def hides(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in HIDDEN:
            return True
        inside = any(self.kinds[h] in ("article", "main") for h in self.holders)
        if tag == "header":
            return not inside
        if tag in ("html", "body", "main"):
            return False
        at = {k: (v or "").lower() for k, v in attrs}
        if "hidden" in at or at.get("aria-hidden") == "true" or at.get("role") in ROLES:
            return True
        if re.search(r"display\s*:\s*none", at.get("style", "")):
            return True
        said = f"{at.get('class', '')} {at.get('id', '')}".split()
        names = {n for s in said if not STATE_NAME.fullmatch(s) for k, n in enumerate(_NAME.findall(s))
                 if k == 0 or n not in LAYOUT}
        return bool(names & FURNITURE) or not inside and bool(names & OUTER_FURNITURE)

    def pop(self) -> None:
        tag, hides = self.open.pop()
        self.hidden -= hides
        self.links -= tag == "a"
        if tag in HOLDER:
            self.holders.pop()

    def end_head(self) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == "head":
                while len(self.open) > k:
                    self.pop()
                return
            if self.open[k][0] in IN_HEAD:  # what stands in a title or template stays there
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in IN_HEAD:
            self.end_head()
        if tag in BLOCK:
            self.end_block()
        if tag == "br":
            self.text.append("\n")
        if tag in VOID:
            return
        for k in range(len(self.open) - 1, -1, -1):
            was = self.open[k][0]
            if tag in IMPLIED_END.get(was, ()):
                while len(self.open) > k:
                    self.pop()
                break
            if was in HOLDER or was in ("table", "ul", "ol", "dl", "nav", "form", "aside", "footer", "header"):
                break
        hides = self.hides(tag, attrs)
        self.open.append((tag, hides))
        self.hidden += hides
        self.links += tag == "a"
        if tag in HOLDER:
            self.holders.append(len(self.kinds))
            self.kinds.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.end_block()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self.pop()
                return
            if self.open[k][0] in HOLDER and tag not in BLOCK and tag not in HIDDEN:
                return

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        if not self.hidden:
            self.text.append(data)
            if self.links:
                self.link_chars += len(data.strip())


def smooth(ratios: np.ndarray) -> np.ndarray:
    at = np.arange(-SMOOTHING_RADIUS, SMOOTHING_RADIUS + 1)
    kernel = np.exp(-at ** 2 / (2 * SMOOTHING_SIGMA ** 2))
    padded = np.pad(ratios, SMOOTHING_RADIUS)
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def content(blocks: list[tuple[str, int, int, tuple[int, ...]]], with_links: bool = False) -> np.ndarray:
    """Threshold clustering: which blocks have a high smoothed text-to-tag ratio (link text counts only ``with_links``)."""
    ratios = smooth(np.array([(len(t) - (0 if with_links else links)) / max(tags, 1) for t, tags, links, _ in blocks], float))
    return ratios >= min(ratios.std(), ratios.max())


def region(blocks, kinds: list[str], chosen: np.ndarray) -> set[int]:
    """Article or main elements if they hold all content, or else the smallest holder of all of it."""
    paths = [path for (text, _, links, path), use in zip(blocks, chosen) if use and 2 * links <= len(text)]
    paths = paths or [path for (_, _, _, path), use in zip(blocks, chosen) if use]
    for kind in ("article", "main"):
        if all(any(kinds[h] == kind for h in path) for path in paths):
            return {h for path in paths for h in path if kinds[h] == kind}
    common = set(paths[0]).intersection(*paths[1:])
    return {max(common, default=-1)}


def main_text(html: str | None) -> str:
    """Blocks of the content region, joined by empty lines."""
    page = Page()
    page.feed(html or "")
    page.close()
    page.end_block()
    blocks = page.blocks
    if not blocks:
        return ""
    where = region(blocks, page.kinds, content(blocks))
    named = any(page.kinds[h] in ("article", "main") for h in where if h >= 0)
    kept = [text for (text, _, links, path), use in zip(blocks, content(blocks, with_links=True))
            if (-1 in where or where.intersection(path)) and (named or use or 2 * links <= len(text))]
    return "\n\n".join(kept)


def extract(pages: DataFrame, html: str = "html", columns: list[str] | None = None) -> DataFrame:
    """``pages`` with text and n_chars of the main text."""
    made = {"text": "string", "n_chars": "long"}
    names = [n for n in (columns or pages.columns) if n not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [main_text(h) for h in part.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*names, *made])

    fields = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([*(f"`{n}` {fields[n]}" for n in names), *(f"{n} {t}" for n, t in made.items())])
    return pages.select(*dict.fromkeys([*names, html])).mapInArrow(run, schema)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    prepare(spark)
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"), columns=["page_id", "url"])
