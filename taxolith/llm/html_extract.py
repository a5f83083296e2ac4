"""Operator 3: main text of HTML pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names and words that name page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
#: Blocks that hold text; the other ones are containers, and each container tag is a blank line.
TEXT_BLOCKS = frozenset("address blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary td th tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = ("script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "textarea", "select", "button", "head", "title")
#: Those whose content is no markup: unclosed, they take the rest of the page.
RAW_TEXT = ("script", "style", "textarea", "iframe", "noscript", "template")
FURNITURE = frozenset("nav footer aside form dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
#: Words that name what is set between the text: their elements weigh little, and the distribution decides.
ADVERT = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe signup notice notices alert alerts disclaimer".split()
)
#: Words that name furniture.
STRONG = frozenset(
    "login comment comments respond reply replies disqus sidebar widget widgets menu menubar nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager toc footer masthead topbar toolbar share sharing social related recommended recommendations".split()
)
#: Words that name furniture outside an article.
WEAK = frozenset("header discussion side foot popular trending tags search skip copyright legal".split())
#: Words that go with those; a name with any other word names something else.
NEUTRAL = frozenset(
    "site page main global top bottom left right box list area section wrap wrapper container block bar item items link links inner outer row slot unit "
    "button buttons icons form count post posts user widget thread content primary secondary".split()
)
#: Words that say what a page has, not what an element is, and words that name the element around it.
SAYING = frozenset("has have with no without is not show hide hidden toggle".split())
AROUND = frozenset("layout page template grid theme enabled disabled free".split())

TAG = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = {"<!--": "-->", "<![CDATA[": "]]>", "<!": ">", "<?": ">"}
QUOTE_OR_END = re.compile(r"[>\"']")
#: Any attribute, so that what stands inside a value is not taken for one.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")


def named_furniture(name: str, in_article: bool) -> int:
    """1 if one class token or id names page furniture, 3 if it names an advert or notice, else 0.

    It is read as words between hyphens, underscores and capitals, all of which must belong:
    ``share-buttons`` is furniture, ``share-price`` is not.
    """
    parts = [p.lower() for p in WORD.split(name) if p]
    if not parts or SAYING & set(parts) or parts[-1] in AROUND:
        return False
    if not all(p in STRONG or p in WEAK or p in NEUTRAL or p in ADVERT or p.isdigit() for p in parts):
        return 0
    if any(p in ADVERT for p in parts):
        return 3
    return int(any(p in STRONG for p in parts) or not in_article and any(p in WEAK for p in parts))


def furniture(name: str, attributes: str, in_article: bool) -> int:
    """2 if an element is page furniture by its name, role or being hidden, 1 if a class or id says so, 3 if these say advert or notice, else 0."""
    if name in FURNITURE or name == "header" and not in_article:
        return 2
    if name in ("html", "body", "article", "main"):
        return 0
    named = 0
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), next((v for v in m.groups()[1:] if v is not None), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in ROLES:
            return 2
        if key in ("class", "id"):
            named = max([named, *(named_furniture(t, in_article) for t in value.split())], key=(0, 3, 1).index)
    return named


class Tags:
    """Reads the tags of a page from left to right, in time that grows with its length alone."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in ">\"'"}
        self.never: set[str] = set()  # what is known not to come any more

    def find(self, what: str, at: int) -> int:
        """Where ``what`` comes next, or -1; the rest of the page is searched in vain only once."""
        if what in self.never or self.last.get(what, len(self.page)) < at:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.never.add(what)
        return found

    def end(self, at: int) -> int:
        """Where a tag ends whose name ends at ``at``: at the next > outside quotes, -1 if there is none."""
        while self.last[">"] >= at:
            m = QUOTE_OR_END.search(self.page, at)
            if m[0] == ">":
                return m.start()
            closing = self.find(m[0], m.end())
            if closing < 0 or self.last[">"] < closing:  # a stray quote
                return self.find(">", m.end())
            at = closing + 1
        return -1

    def after(self, name: str, at: int) -> int:
        """Where the page goes on after the closing tag of a raw element, -1 if it is never closed."""
        if name in self.never:
            return -1
        m = re.compile(rf"</{name}(?=[\s/>])", re.I).search(self.page, at)
        stop = self.find(">", m.end()) if m else -1
        if stop < 0:
            self.never.add(name)
        return stop + 1 if stop >= 0 else -1


class Line:
    """A line of text: ``gap`` blank lines before it, unlinked characters, and what it lies in.

    ``place`` is its innermost container, ``soft`` the number of the advert or notice around it (0: none), ``title`` marks a first
    heading in a page header.
    """

    __slots__ = ("text", "gap", "plain", "mark", "article", "heading", "bad", "soft", "place", "title")

    def __init__(self, text: str, gap: int, plain: int, mark: int, article: bool, heading: bool, bad: bool, soft: int, place: int, title: bool):
        self.text, self.gap, self.plain, self.mark, self.article, self.heading, self.bad = text, gap, plain, mark, article, heading, bad
        self.soft, self.place, self.title = soft, place, title


def lines_of(page: str) -> tuple[list[Line], list[tuple[int, str]]]:
    """Strip the markup: a line for each block of text, a blank line for each container tag between; and the containers, as (outer one, name).

    A line is ``bad`` in an element that is furniture by its name or role, or by a class or
    id unless that element holds the article: an ``article`` or ``main``, or else a first
    heading and over half of all unlinked text. Text of furniture inside a line is left out.
    """
    out: list[Line] = []
    open_: list[tuple[str, int, int, int, int, int]] = []  # element, 1 if furniture by its name, its mark or -1, 1 if its text is left out, 1 if a container, the soft number outside
    named: Counter = Counter()
    marks: list[list[int]] = []  # of elements named as furniture: outer mark, article within, first heading within, characters
    places: list[tuple[int, str]] = []
    parts: list[str] = []
    linked = bad = muted = links = articles = gap = soft = softs = headers = 0
    mark, place, heading, first = -1, -1, False, False
    tags, at, end = Tags(page), 0, len(page)

    def flush() -> None:
        nonlocal parts, linked, gap
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                title = first and bad > 0 and bad == headers
                out.append(Line(text, gap, 0 if linked > len(text) / 2 else len(text), mark, articles > 0, heading, bad > 0, soft, place, title))
                gap = 0
            parts = []
        linked = 0

    def close(to: int) -> None:
        nonlocal bad, muted, links, articles, mark, heading, first, place, soft, headers
        for name, hard, own, inline, container, outside in reversed(open_[to:]):
            named[name] -= 1
            bad -= hard
            headers -= hard and name == "header"
            muted -= inline
            links -= name == "a"
            articles -= name in ("article", "main")
            heading = heading and name not in HEADINGS
            first = first and name != "h1"
            if container:
                place = places[place][0]
            soft = outside
            if own >= 0:
                mark = marks[own][0]
        del open_[to:]

    while at < end:
        m = TAG.search(page, at)
        text, stop, name = page[at : m.start() if m else end], end, ""
        if m and m[0] in SPECIAL:
            close_mark = SPECIAL[m[0]]
            found = tags.find(close_mark, m.end())
            stop = found + len(close_mark) if found >= 0 else end  # one that is never closed takes the rest
        elif m:
            found = tags.end(m.end())
            if found < 0:  # no tag at all
                text, stop = page[at : m.end()], m.end()
            else:
                name, stop = m[2].lower(), found + 1
        if text and not muted:
            parts.append(text)
            if links:
                linked += len(text.strip())
        at = stop
        if not name:
            continue
        if name in BLOCKS:
            flush()
            gap += name not in TEXT_BLOCKS
        elif name in ("br", "img", "input"):
            parts.append(" ")
        if m[1]:
            if named[name]:
                k = len(open_) - 1
                while open_[k][0] != name:
                    k -= 1
                close(k)
            continue
        attributes = page[m.end() : found]
        if name in RAW and not attributes.endswith("/"):
            go_on = tags.after(name, at)
            if go_on >= 0 or name in RAW_TEXT:
                at = go_on if go_on >= 0 else end
        elif name not in VOID and not attributes.endswith("/"):
            if name in ("p", "li") and open_ and open_[-1][0] == name:
                close(len(open_) - 1)
            kind, own = furniture(name, attributes, articles > 0), -1
            inline, container, outside = bool(kind) and name not in BLOCKS, name in BLOCKS and name not in TEXT_BLOCKS, soft
            if kind == 1 and not inline:
                own = len(marks)
                marks.append([mark, 0, 0, 0])
                mark = own
            if kind == 3 and not inline and not soft:
                softs += 1
                soft = softs
            if container:
                places.append((place, name))
                place = len(places) - 1
            open_.append((name, int(kind == 2), own, int(inline), int(container), outside))
            named[name] += 1
            bad += kind == 2
            headers += kind == 2 and name == "header"
            muted += inline
            links += name == "a"
            articles += name in ("article", "main")
            if mark >= 0 and kind < 2:
                marks[mark][1] += name in ("article", "main")
                marks[mark][2] += name == "h1"
            heading = heading or name in HEADINGS
            first = first or name == "h1"
    flush()
    for line in out:
        if line.mark >= 0 and not line.bad:
            marks[line.mark][3] += line.plain
    for outer, *held in reversed(marks):  # an element's own come after it
        if outer >= 0:
            for k, x in enumerate(held, 1):
                marks[outer][k] += x
    total = sum(line.plain for line in out if not line.bad)
    marked: list[bool] = []
    for outer, article, top, size in marks:
        marked.append(outer >= 0 and marked[outer] or not article and not (top and 2 * size > total))
    for line in out:
        line.bad = line.bad or line.mark >= 0 and marked[line.mark]
    # the headline of a page that has no other first heading may stand in its header
    titles = [line for line in out if line.title]
    if len(titles) == 1 and not any(line.heading and not line.bad for line in out):
        titles[0].bad = False
    return out, places


def weights(lines: list[Line], places: list[tuple[int, str]]) -> tuple[list[float], set[int], bool]:
    """What each line's text counts for in the distribution, the containers of the core, and whether that is an article.

    A line counts for its unlinked characters: twice in an ``article`` or ``main``, a tenth in what is
    named an advert or notice, not at all in furniture. The core is the innermost container that
    holds six tenths of all that. If it is or lies in an article, lines outside it count for a quarter.
    """
    own = [0.0 if line.bad else line.plain * (2.0 if line.article else 1.0) * (0.1 if line.soft else 1.0) for line in lines]
    sums, total = [0.0] * len(places), sum(own)
    for line, w in zip(lines, own):
        if line.place >= 0:
            sums[line.place] += w
    for k in range(len(places) - 1, -1, -1):  # an element's own come after it
        if places[k][0] >= 0:
            sums[places[k][0]] += sums[k]
    core = max((k for k in range(len(places)) if sums[k] >= 0.6 * total > 0), default=-1)
    # of containers one inside the other the last one opened is the innermost; a bare page is no core
    while core >= 0 and places[core][1] in ("html", "body"):
        core = -1
    inside: set[int] = set()
    up = -1
    if core >= 0:
        inside.add(core)
        for k in range(core + 1, len(places)):
            if places[k][0] in inside:
                inside.add(k)
        up = core
        while up >= 0 and places[up][1] not in ("article", "main"):
            up = places[up][0]
        if up >= 0:  # the articles as a whole, not the longest section
            inside = set()
            for k, (outer, name) in enumerate(places):
                if outer in inside or name in ("article", "main"):
                    inside.add(k)
            own = [w if line.place in inside else w / 4 for line, w in zip(lines, own)]
    # lines of links do not part the core
    own = [max(w, 1.0) if line.place in inside and not line.bad else w for line, w in zip(lines, own)]
    return own, inside, up >= 0


def surges(weight: list[float], window: int, surge: int) -> list[tuple[int, int]]:
    """Half-open stretches between surge and dive points of the sums over ``window`` lines.

    A surge is the first block whose sum reaches ``surge`` (or half of the highest sum, if
    that is less), a dive the next block without text. A block begins at its line.
    """
    n = len(weight)
    sums = [sum(weight[k : k + window]) for k in range(n)]
    least = min(surge, max(sums, default=0) / 2)
    out, k = [], 0
    while k < n:
        if sums[k] and sums[k] >= least:
            start = k
            while k < n and sums[k]:
                k += 1
            out.append((start, k))
        else:
            k += 1
    return out


def main_text(page: str | None, window: int = 3, surge: int = 80) -> str:
    """The text between the surge and dive points of the line-block distribution.

    The page is lines of text with blank lines between them where containers begin or end,
    other than inside the core (``weights``), whose lines follow one another. Sums of the lines' weights over
    ``window`` lines surge where they reach ``surge`` and dive where they fall to nothing;
    what lies between is kept but for furniture, and so are headings right before it. An
    advert or notice, and beside an article a run of lines outside it, is kept only if it reaches ``surge`` by itself. Lines whose sums never surge
    are left out: lone notices, adverts and lists of links.
    """
    lines, places = lines_of(page or "")
    own, core, article = weights(lines, places)
    weight, where, run = [], [], []
    for k, line in enumerate(lines):
        within = bool(k) and line.place in core and lines[k - 1].place in core
        gap = 0 if within else min(line.gap, window)
        weight += [0.0] * gap
        where.append(len(weight))
        weight.append(own[k])
        # runs of lines that no blank line and no edge of an advert or of the core parts
        same = bool(k) and not gap and line.soft == lines[k - 1].soft and (line.place in core) == (lines[k - 1].place in core)
        run.append(run[-1] if same else k)
    mass: Counter = Counter()
    for k, w in enumerate(own):
        mass[run[k]] += w
    alone = [bool(line.soft or article and line.place not in core) and mass[run[k]] < surge for k, line in enumerate(lines)]
    kept, k = [], 0
    for start, end in surges(weight, window, surge):
        while k < len(lines) and where[k] < start:
            k += 1
        first = k
        while k < len(lines) and where[k] < end:
            k += 1
        # the core begins with its first line, however short
        while 0 < first < len(lines) and lines[first].place in core and lines[first - 1].place in core and (not kept or kept[-1] < first - 1):
            first -= 1
        chosen = [j for j in range(first, k) if not lines[j].bad and not alone[j]]
        while chosen and not own[chosen[-1]] and lines[chosen[-1]].place not in core:  # links after the last text
            chosen.pop()
        while chosen and not own[chosen[0]] and lines[chosen[0]].place not in core:  # and before the first
            chosen.pop(0)
        # headings go with the text that follows them
        head = chosen[0] if chosen else 0
        while head and lines[head - 1].heading and own[head - 1] and not lines[head - 1].soft and where[head] - where[head - 1] <= window and (not kept or kept[-1] < head - 1):
            head -= 1
        kept += [*range(head, chosen[0]), *chosen] if chosen else []
    return "\n".join(lines[j].text for j in kept)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", window: int = 3, surge: int = 80) -> DataFrame:
    """Main text of HTML pages: ``page_id, url, text``, text empty if there is none.

    Every page is worked on alone and whole, next to the scan, in time and memory that grow
    with its length, whatever its markup. Null and empty pages give
    the empty string; null ids and urls stay null; repeated rows keep a row each; broken
    markup (unclosed or stray tags, cut-off entities) is read as far as it goes; an empty
    table gives no rows; other columns are left out, whatever their names.
    """

    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()

    def compute(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = pa.array([main_text(v.as_py(), window, surge) for v in part.column(2)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["page_id", "url", "text"])

    return source.mapInArrow(compute, f"page_id {kind}, url string, text string")
