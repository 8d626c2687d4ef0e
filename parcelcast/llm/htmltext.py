"""HTML extraction by line-block distribution.

Markup is stripped to lines, one per block element. Parts that by their element, role, class or id are menus, headers,
footers, sidebars, notices, adverts, forms or comments become empty lines, and so does every border between layout boxes
outside an article or main element. Class and id words count as a whole or as the head noun of a name (``site-header``, not
``has-sidebar``), and a part with most of the page's text is no noise. Headings and inline elements are never noise by such words,
nor are paragraphs inside an article or main element; there, boxes are not so by the words of TOPICS, and by an id only if it
says comments, sharing or adverts. Embedded media (svg, video, ...) and select boxes leave the line they stand in whole. The text lengths are summed over windows of ``window``
lines: the sum surges where a run of text begins and dives to zero after it ends. A run is dense if its largest window reaches
``surge`` characters; if none does, the longest run is taken.

Runs lead to regions, and all lines of a region are kept, short ones too. All text of article and main elements is kept, and
so is every dense run outside of them. On a page where those elements are missing, or hold nothing dense while something
else is, the region is the outermost boxes with dense runs, what lies between them, and the lines around them up to the next
page part (navigation, header, footer, menu, form) or menu. Parts dropped inside a region do not end it. Of unmarked parts,
two links or more without other text are a menu, if they are not dense.

Broken markup loses no more than itself: an element that is never closed, or a slash in its tag, takes nothing along, a quote that
is never closed ends with its tag; only script, style and comments without an end run to the end of the page. Tags are found in
one pass that is linear in the page, however long or broken.

Null, empty and text-free pages give the empty text. Repeated rows give equal texts, rows of equal or null ids one each;
very long pages are read whole; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import html as entities
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from parcelcast.llm.common import bound_batches, table

# Element names of HTML
RAW = frozenset("script style noscript template textarea title".split())
ENDLESS = frozenset("script style".split())  # that run to the end of the page if nothing closes them
EMBEDDED = frozenset("iframe object svg math select canvas audio video".split())
SKIPPED = frozenset("head nav header footer aside form menu dialog button fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br picture".split())
BOXES = frozenset("div section article main body center table tbody tr td th".split())
BLOCKS = BOXES | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre hr address figure details summary caption hgroup html".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS = frozenset("nav header footer menu form".split())  # parts of a page, beyond which its text does not go on
NOISE = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|"
    r"overlay|nav\w*|menus?|breadcrumbs?|sidebar|side|aside|rail|widgets?|header|masthead|topbar|footer|foot|copyright|"
    r"comments?|replies|respond|disqus|related|recommend\w*|share|sharing|social|newsletter|subscribe|signup|login|search|"
    r"pagination|pager|toc|tags|skip|hidden|legal|disclaimer")
TALK = re.compile(r"comments?|replies|respond|disqus|hidden")
TOPICS = frozenset("legal disclaimer search alert alerts".split())  # classes that an article may give to boxes of its own
INSIDE_ID = re.compile(r"ads?|advert\w*|adsense|sponsor\w*|comments?|replies|respond|disqus|share|sharing|social")
# Words at the end of a class name that leave the noun before them as its head, and words that turn it into something else
HOLDERS = frozenset("area bar block box button buttons container content group icon icons inner item items left link links list "
                    "outer panel post posts right row section slot top bottom unit wrap wrapper".split())
ABOUT = frozenset("has no not non with without show hide use enable disable overflow".split())
OWN = frozenset("article entry post story content text".split())  # whose header and footer belong to the text
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_QUOTE = re.compile(r"=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


@functools.lru_cache(maxsize=4096)
def _noise_word(token: str) -> str:
    """The word that makes a class or id noise: all of it or its head noun; empty if none does."""
    if NOISE.fullmatch(token):
        return token
    words = [w for w in re.split(r"[_-]+", token) if w]
    if not ABOUT.isdisjoint(words):
        return ""
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    if not words or not NOISE.fullmatch(words[-1]):
        return ""
    if words[-1] in ("header", "footer", "foot") and not OWN.isdisjoint(words):
        return ""
    return words[-1]


class Tag(NamedTuple):
    start: int
    end: int
    closing: bool
    name: str
    attributes: str


def _tags(page: str) -> tuple[str, list[Tag]]:
    """The page without comments, declarations and raw elements, and its tags: one pass from left to right."""
    out, tags, size, at = [], [], 0, 0
    last = {c: page.rfind(c) for c in "\"'>"}
    quotes, open_raw = True, set()

    def tag_end(i: int) -> int:
        """Place of the ``>`` that ends a tag whose name ends at ``i``; quoted values are passed over."""
        nonlocal quotes
        first = page.find(">", i)
        if not quotes:
            return first
        while True:
            end = page.find(">", i)
            if end < 0:
                quotes = False  # a quote swallowed all ends: from here on quotes do not count
                return first
            quoted = _QUOTE.search(page, i, end)
            if not quoted or last[quoted[1]] < quoted.end():
                return end
            i = page.find(quoted[1], quoted.end()) + 1

    def keep(a: int, b: int) -> None:
        nonlocal size
        out.append(page[a:b])
        size += b - a

    start = 0
    while (found := _OPEN.search(page, at)) and (found[1] or found.start() < last[">"]):
        if found[1]:
            end = page.find("-->", found.end())
            end = len(page) if end < 0 else end + 3
            drop = True
        elif found[2]:
            end, drop = page.find(">", found.end()) + 1, True
        else:
            end, name = tag_end(found.end()) + 1, found[4].lower()
            drop = name in RAW
            if drop and not found[3] and name not in open_raw:
                close = re.compile(rf"</{name}\s*>", re.I).search(page, end)
                if close:
                    end = close.end()
                elif name in ENDLESS:
                    end = len(page)
                else:
                    open_raw.add(name)  # nothing closes it any more
        if drop:
            keep(start, found.start())
            out.append(" ")
            size += 1
            start = end
        else:
            keep(start, found.start())
            tags.append(Tag(size, size + end - found.start(), bool(found[3]), name, page[found.end(): end - 1]))
            keep(found.start(), end)
            start = end
        at = end
    keep(start, len(page))
    return "".join(out), tags


def _noise(name: str, attributes: str, inside: bool) -> str:
    """Why an element is noise: ``element`` by what it is, ``name`` by its class or id, empty if it is none."""
    if name == "header" and inside:
        return ""
    if name in SKIPPED:
        return "name" if name in ("form", "fieldset") else "element"
    if not attributes or name in CONTENT or name == "body" or name == "html":
        return ""
    found: dict[str, str] = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), value.strip("\"'").lower())
    if "hidden" in found or not NOISE_ROLES.isdisjoint(found.get("role", "").split()):
        return "element"
    if re.search(r"display\s*:\s*none", found.get("style", "")):
        return "element"
    if name in INLINE or name in HEADINGS or inside and name == "p":
        return ""
    words = [w for key in ("class", "id") for token in found.get(key, "").split() if (w := _noise_word(token))
             and (not inside or (w not in TOPICS if key == "class" else INSIDE_ID.fullmatch(w)))]
    return "" if not words else "element" if any(TALK.fullmatch(w) for w in words) else "name"


def _partners(tags: list[Tag]) -> dict[int, int]:
    """For the opening tags that are closed, the number of the closing tag."""
    open_by_name: dict[str, list[int]] = {}
    closed = {}
    for i, tag in enumerate(tags):
        name = tag.name
        if tag.closing:
            if stack := open_by_name.get(name):
                closed[stack.pop()] = i
        elif name not in VOID and not (name in EMBEDDED and tag.attributes.endswith("/")):
            open_by_name.setdefault(name, []).append(i)
    return closed


class Line(NamedTuple):
    text: str  # empty: a dropped part or a border
    inside: bool = False  # of an article or main element
    top: int = -1  # number of the outermost box below the body
    links: int = 0
    linked: int = 0  # characters in links
    heading: bool = False
    ends: bool = False  # a dropped part that ends the text of the page


def _parse(page: str, tags: list[Tag], closed: dict[int, int], opened: set[int], window: int):
    """Lines, the dropped elements (tag, why, inside), and whether an article or main element stands outside of those."""
    lines: list[Line] = []
    dropped: list[tuple[int, str, bool]] = []
    held: list[str] = []
    gap = [Line("")] * window
    inside = anchor = links = linked = 0  # depth of article and main elements, of links; of the line held
    heading, content, top, top_end = False, False, -1, -1

    def flush() -> None:
        nonlocal links, linked, heading
        if line := " ".join(entities.unescape("".join(held)).split()):
            lines.append(Line(line, inside > 0, top, links, linked, heading))
        held.clear()
        links = linked = 0
        heading = False

    def border() -> None:
        flush()
        if not inside:
            lines.extend(gap)

    at, i = 0, 0
    while i < len(tags):
        tag = tags[i]
        text = page[at: tag.start]
        held.append(text)
        if anchor:
            linked += len(text.strip())
        at, name = tag.end, tag.name
        why = "" if tag.closing or i not in closed or i in opened else _noise(name, tag.attributes, inside > 0)
        if not tag.closing and i in closed and (name in EMBEDDED or why and name in INLINE):
            i = closed[i]  # leaves its line whole
            at = tags[i].end
            held.append(" ")
        elif why:
            flush()
            if not inside:
                lines.extend(gap)
                lines.append(Line("", top=top, ends=name in ENDS))
            dropped.append((i, why, inside > 0))
            i = closed[i]
            at = tags[i].end
        elif name in CONTENT:
            if tag.closing:
                flush()
                inside = max(0, inside - 1)
                border()
            elif i in closed:
                border()
                inside += 1
                content = True
        elif name in BOXES:
            border()
            if not tag.closing and i > top_end and i in closed and name not in ("body", "center"):
                top, top_end = i, closed[i]
            elif i == top_end:
                top = -1
        elif name in BLOCKS:
            flush()
            heading = not tag.closing and len(name) == 2 and name in HEADINGS
        elif name == "br":
            held.append(" ")
        elif name == "a":
            anchor = int(not tag.closing)
            links += anchor
        i += 1
    held.append(page[at:])
    flush()
    return lines, dropped, content


def _runs(lines: list[Line], window: int) -> list[tuple[int, int, int]]:
    """(first line, line after the last, largest window) between the surges and dives of the summed text lengths."""
    sizes = [len(line.text) for line in lines]
    runs, start = [], None
    total, best = 0, 0
    for i in range(len(sizes) + window):
        total += (sizes[i] if i < len(sizes) else 0) - (sizes[i - window] if i >= window else 0)
        if total and start is None:
            start, best = i, 0
        if start is not None:
            best = max(best, total)
            if not total:
                runs.append((start, min(i, len(sizes)), best))
                start = None
    if start is not None:
        runs.append((start, len(sizes), best))
    return runs


def page_lines(page: str, window: int = 3, surge: int = 80) -> list[Line]:
    """Lines of text of a page in order; empty lines stand for dropped parts and for borders.

    A part that looks like noise but holds most of the page's text is opened: by name, if no article or main element is
    outside of it; as an element of its kind (or comments), if moreover nothing dense is.
    """
    page, tags = _tags(page)
    closed = _partners(tags)
    opened: set[int] = set()
    sums: list[int] = []  # characters of text, and of text in links, up to each tag
    link_sums: list[int] = []
    while True:
        lines, dropped, content = _parse(page, tags, closed, opened, window)
        if not dropped:
            return lines
        kept = sum(len(line.text) for line in lines)
        if not sums:
            at = total = link_total = anchor = 0
            for tag in tags:
                n = len("".join(page[at: tag.start].split()))
                total, link_total, at = total + n, link_total + n * anchor, tag.end
                if tag.name == "a":
                    anchor = int(not tag.closing)
                sums.append(total)
                link_sums.append(link_total)
            total += len("".join(page[at:].split()))
        dense = kept >= surge and any(r[2] >= surge for r in _runs(lines, window))
        more = set()
        for i, why, inside in dropped:
            size, in_links = sums[closed[i]] - sums[i], link_sums[closed[i]] - link_sums[i]
            if 2 * size > total and 2 * in_links <= size and (inside or not content) and (why == "name" or not dense):
                more.add(i)
        if not more:
            return lines
        opened |= more


def _menus(lines: list[Line]) -> set[int]:
    """Lines outside article and main that are links only, two links or more one after another."""
    menus: set[int] = set()
    group: list[int] = []
    for i, line in enumerate([*lines, Line("end")]):
        if not line.text:
            continue
        if line.links and not line.heading and not line.inside and line.linked >= 0.8 * len(line.text):
            group.append(i)
            continue
        if sum(lines[k].links for k in group) > 1:
            menus.update(group)
        group = []
    return menus


def dense_lines(lines: list[Line], window: int = 3, surge: int = 80) -> list[str]:
    """The lines of the regions between the surge and dive points of the summed text lengths."""
    runs = _runs(lines, window)
    article = {i for i, line in enumerate(lines) if line.inside}
    dense = [r for r in runs if r[2] >= surge]
    outer = [r for r in dense if not any(i in article for i in range(r[0], r[1]))]
    kept = {i for a, b, _ in dense for i in range(a, b)} | article
    if outer and len(outer) == len(dense) or not article:
        menus = _menus(lines)
        if not dense and runs:
            # the longest run leads to the region, and a menu does so only if there is nothing else
            size = lambda r: (sum(len(lines[i].text) for i in range(r[0], r[1]) if i not in menus),
                              sum(len(lines[i].text) for i in range(r[0], r[1])))
            a, b, _ = max(runs, key=lambda r: (size(r), -r[0]))
            outer, kept = [(a, b, 0)], kept | set(range(a, b))
        own = {i for a, b, _ in outer for i in range(a, b) if lines[i].text}
        tops = {lines[i].top for i in own} - {-1}
        core = own | {i for i, line in enumerate(lines) if line.text and line.top in tops}
        if core:
            first, last = min(core), max(core)
            while first and not lines[first - 1].ends and first - 1 not in menus:
                first -= 1
            while last + 1 < len(lines) and not lines[last + 1].ends and last + 1 not in menus:
                last += 1
            kept |= {i for i in range(first, last + 1) if i not in menus}
    return [line.text for i, line in enumerate(lines) if i in kept and line.text]


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    if not page:
        return ""
    return "\n".join(dense_lines(page_lines(page, window, surge), window, surge))


def extract(pages: DataFrame, window: int = 3, surge: int = 80) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = bound_batches(pages).select("page_id", "url", "html")

    def run(batches):
        for batch in batches:
            texts = [main_text(page, window, surge) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
