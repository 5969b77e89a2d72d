"""HTML extraction by line-block distribution.

Markup is stripped to lines, one for each block of text.  Text lengths are summed
over a sliding window of lines; where the sum surges a region of main text begins,
where it dives to nothing the region ends, and all lines between are kept.  Markup
only says what the sums are made of: menus, notices and the like have no lines,
and outside an article they leave a gap that no window spans; text in links weighs
nothing outside an article; a page's article surges from its first character, and
text beside it only with the weight of a paragraph.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import small_batches, table

#: Lines of the sliding window; characters in it from which text surges, and from which it does beside an article.
WINDOW, SURGE, BESIDE = 3, 40, 160

#: Elements whose content is never text, those that are not main text, those that break lines.
RAW = frozenset("script style noscript template iframe object svg canvas math audio video textarea select".split())
ASIDE = frozenset("nav header footer aside form button menu dialog head".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where a new one of the listed kind begins.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    **{x: {"p"} for x in "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()},
}
#: Words in class, id or role that mark what is not main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar side aside rail footer foot header masthead topbar toolbar comment comments disqus respond reply replies discussion cookie cookies consent gdpr notice notification "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations widget pagination pager "
    "skip complementary contentinfo search dialog form feedback toc tags".split()
)
#: Words that stand beside a mark in a compound name without changing what it means.
AFFIXES = frozenset(
    "site page top bottom left right main global primary secondary upper lower list item items box links link bar wrapper wrap container block section area zone slot unit "
    "body inner outer content text title icon button group column col row panel post entry user reader mobile desktop sticky fixed inline small large".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I | re.S)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def _means_aside(name: str) -> bool:
    """Is a class, id or role a mark, or a compound of marks and affixes?"""
    parts = {x.lower() for x in _PART.findall(name)}
    return not parts.isdisjoint(MARKS) and parts <= MARKS | AFFIXES


def _marked(attributes: str) -> bool:
    """Do an element's attributes say that it is hidden or not main text?"""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id", "role") and any(map(_means_aside, value.split())):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """The page's blocks in order: text, characters of it in links, whether inside article or main.

    Outside an article a block that is not main text leaves WINDOW empty lines, so
    that no window spans it; so do an article's ends.
    """
    lines: list[tuple[str, int, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, not main text, article, link
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    off = inside = link = False

    def end_line(within: bool | None = None) -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append((text, min(linked, len(text)), inside if within is None else within))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if off or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if link:
            linked += len(text)

    def pop() -> None:
        nonlocal off, inside, link
        was, within = off, inside
        opened[stack.pop()[0]] -= 1
        _, off, inside, link = stack[-1] if stack else ("", False, False, False)
        if not inside and (within or was and not off):
            end_line(within)
            lines.extend([("", 0, False)] * WINDOW)

    at = 0
    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        if found[1] is not None:
            say(html.escape(found[1]))
        name = (found[3] or found[6] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[2] or found[5]), found[4] or found[7] or ""
        if name in BLOCK:
            end_line()
        if closing:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        for old in CLOSES.get(name, ()):
            if stack and stack[-1][0] == old:
                pop()
        main = name in ("article", "main")
        if main and not inside and not off:
            lines.extend([("", 0, False)] * WINDOW)
        aside = name in ASIDE and not (name == "header" and inside)
        stack.append((name, off or aside or (name not in ("html", "body") and _marked(attributes)), inside or main, link or name == "a"))
        opened[name] += 1
        if stack[-1][1] and not off:
            end_line()
        _, off, inside, link = stack[-1]
    end_line()
    return lines


def main_text(page: str | None) -> str:
    """The regions that surge, one block to a line; where none does, all text outside links; empty if there is none."""
    lines = lines_of(page or "")
    surge = BESIDE if any(inside for _, _, inside in lines) else SURGE
    # an article's text counts whole, and surges however short it is
    weight = [len(text) + surge if inside else len(text) - link for text, link, inside in lines]
    kept, start, total, surged = [], None, 0, False
    for k in range(len(lines) + WINDOW):
        total += (weight[k] if k < len(lines) else 0) - (weight[k - WINDOW] if k >= WINDOW else 0)
        if total and start is None:
            start, surged = k, False
        surged |= total >= surge
        if not total and start is not None:
            if surged:
                kept.append((start, min(k, len(lines))))
            start = None
    if not kept and sum(weight):
        kept = [(0, len(lines))]
    return "\n".join(lines[k][0] for a, b in kept for k in range(a, b) if lines[k][0])


def html_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (code points).

    A null or empty page has the empty text; ids and urls are passed on as they
    are, null and repeated ones too; columns named text or n_chars are replaced;
    an empty table gives an empty one.
    """
    small_batches(pages.sparkSession)
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*rest, html_col)
    schema = pages.select(*rest).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*rest, "text", "n_chars"])

    return rows.mapInArrow(run, schema)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
