"""Main text of web pages by wrappers inferred from the pages of each host.

A page becomes a stream of block tags and text slots. The streams of a host are aligned one
after another into a wrapper, a regular expression without unions: tags, text slots,
optional groups ``( )?`` and repeated groups ``( )+``. Where streams differ in a text, the
text becomes a slot; where they differ in tags, the differing run becomes optional; where the
same run follows itself, it becomes a repeated group. Every page takes part: tasks infer
partial wrappers, which align with each other in the same way.

The wrapper is marked once: which of its elements hold the article, and which are menus,
adverts and the like. Each page is then aligned with its host's wrapper and gives the text of
its slots in marked elements.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from reelgrove.llm.common import kept, slices, text_values
from reelgrove.operators.joins import lookup_join

# Fixed values of HTML: elements that break a block, that hold no text to read, that have no
# content, and that end an open element of the same kind.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
UNREAD = set(
    "applet audio button canvas datalist embed iframe input map math meter noframes noscript object "
    "output picture progress select svg template textarea title video".split()
)
RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "noframes", "xmp", "noembed")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
CONTAINERS = set("div section td center body html".split())
HOLDS = {  # what an implied end does not reach beyond
    "li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
    "tbody": {"table"}, "tfoot": {"table"},
}

# What an element is for, by its tag, or by words of its class, id or role.
ASIDE_TAGS = set("aside dialog fieldset footer form head header menu nav search".split())
MAIN_TAGS = {"article", "main"}
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense alert banner banners breadcrumb breadcrumbs "
    "byline-share comment comments complementary contentinfo cookie cookies consent disqus footer gdpr header "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices notification paywall popup promo "
    "promoted promotion recommended related respond reply replies search share sharing sidebar sidebars signup "
    "skip social sponsor sponsored subscribe subscription teaser toc toolbar topbar widget widgets".split()
)
MAIN_WORDS = set("article articlebody content entry main maincontent post story text".split())
ASIDE, PLAIN, MAIN = "-", "", "+"

DEEPEST = 64
LONGEST = 48
PERIODS = 6
LARGEST = 4096
HELD_HOSTS = 2048
TRIM_EVERY = 64
FAN_IN = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_ROLE = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+(?=[A-Z])|[A-Z]?[a-z]+|[A-Z]+")


def _purpose(name: str, more: str) -> str:
    if name in ASIDE_TAGS:
        return ASIDE
    if more:
        if "hidden" in more or "display" in more:
            if _HIDDEN.search(more):
                return ASIDE
        words = set()
        for value in _ROLE.findall(more):
            words.update(w.lower() for w in _WORD.findall(value))
        if words & ASIDE_WORDS and not (name in MAIN_TAGS and not words & {"comment", "comments", "ad", "ads"}):
            return ASIDE
        if words & MAIN_WORDS:
            return MAIN
    return MAIN if name in MAIN_TAGS else PLAIN


class Element:
    """A block element of a page or of a wrapper.

    ``label`` is the tag with its purpose, ``#`` a text slot, ``( )`` a group of elements.
    ``must`` and ``many`` tell optional and repeated elements. A slot's ``held`` is a hash of
    its text while all pages agree on it, and ``chars`` the characters that it held.
    """

    __slots__ = ("label", "parts", "must", "many", "held", "chars", "texts", "marked")

    def __init__(self, label, parts=None, must=True, many=False, held=None, chars=0, texts=None):
        self.label = label
        self.parts = [] if parts is None else parts
        self.must = must
        self.many = many
        self.held = held
        self.chars = chars
        self.texts = texts
        self.marked = False


def stream(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of every token; kind is ``text``, ``open``, ``close`` or ``skip``."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        name = m["name"]
        if name:
            yield "close" if m["end"] else "open", name.lower(), m["more"]
        elif m["raw"]:
            yield "skip", m["raw"].lower(), ""
    if at < len(page):
        yield "text", "", page[at:]


def parsed(page: str) -> Element:
    """The block elements of a page, with the ends that HTML leaves out put in.

    Inline elements have no token of their own: their text runs on. An end without its start
    is passed over, an element still open at the end of the page ends there. Below the 64th
    level only elements with a purpose are told apart; others' texts belong to that level.
    """
    root = Element("")
    open_ = [("", root, 0)]  # name, element and level
    count: dict[str, int] = {}  # open elements by name
    unread = 0  # depth inside an element that is not read
    text: list[str] = []

    def flush():
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            if words:
                open_[-1][1].parts.append(
                    Element("#", held=xxhash.xxh64_intdigest(words), chars=len(words), texts=words)
                )

    def close(names, holders=()):
        """End the innermost open element of these names, if no holder comes before it."""
        if not any(count.get(n) for n in names):
            return False
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] in names:
                flush()
                for n, *_ in open_[i:]:
                    count[n] -= 1
                del open_[i:]
                return True
            if open_[i][0] in holders:
                return False
        return False

    for kind, name, rest in stream(page):
        if kind == "text":
            if not unread:
                text.append(entities.unescape(rest))
            continue
        if kind == "skip":
            continue
        if name in UNREAD:
            if name not in VOID and not rest.endswith("/"):
                unread = unread + 1 if kind == "open" else max(0, unread - 1)
            continue
        if name not in BLOCKS:
            if name == "br" and not unread:
                text.append(" ")
            continue
        unread = 0  # a block ends what was never closed
        if kind == "close":
            close((name,))
            continue
        flush()
        if name in ENDS:
            while close(ENDS[name], HOLDS[name]):
                pass
        if open_[-1][0] == "p":  # no paragraph holds another block
            close(("p",))
        if name in VOID:
            continue
        element = Element(name + _purpose(name, rest))
        _, inside, level = open_[-1]
        if level < DEEPEST or level < 2 * DEEPEST and element.label != name and not inside.label.endswith(ASIDE):
            inside.parts.append(element)
            open_.append((name, element, level + 1))
        else:
            open_.append((name, inside, level))
        count[name] = count.get(name, 0) + 1
    flush()
    return root


# ---- union-free expressions -------------------------------------------------------------

def merged(a: Element, b: Element) -> Element:
    """One element for two of the same label, of the same or of different pages."""
    return Element(
        a.label,
        aligned(a.parts, b.parts) if a.parts or b.parts else [],
        a.must and b.must,
        a.many or b.many,
        a.held if a.held == b.held else None,
        a.chars + b.chars,
    )


def general(element: Element) -> Element:
    """A page's element as a wrapper: runs that follow themselves become repeated."""
    return Element(
        element.label,
        collapsed([general(p) for p in element.parts]) if element.parts else [],
        held=element.held,
        chars=element.chars,
    )


def _flat(parts: Iterable[Element]) -> Iterator[Element]:
    """Groups opened; their parts need not be there."""
    for p in parts:
        if p.label == "( )":
            for q in _flat(p.parts):
                yield Element(q.label, q.parts, q.must and p.must, q.many, q.held, q.chars)
        else:
            yield p


def collapsed(parts: list[Element]) -> list[Element]:
    """Put runs of elements that follow themselves together, the shortest runs first."""
    for period in range(1, PERIODS + 1):
        if len(parts) < 2 * period:
            break
        out: list[Element] = []
        i = 0
        while i < len(parts):
            run = parts[i : i + period]
            labels = [p.label for p in run]
            end = i + period
            while len(run) == period and _follows(run, labels, parts[end : end + period]):
                run = [merged(a, b) for a, b in zip(run, parts[end : end + period])]
                end += period
            if end == i + period:
                out.append(parts[i])
                i += 1
                continue
            if period == 1:
                run[0].many = True
                out.append(run[0])
            else:
                out.append(Element("( )", run, all(p.must for p in run), True))
            i = end
        parts = out
    return parts if len(parts) <= LONGEST else [_any_order(parts)]


def _follows(run: list[Element], labels: list[str], after: list[Element]) -> bool:
    """Whether elements repeat those before them."""
    return [p.label for p in after] == labels and all(_alike(a, b) for a, b in zip(run, after))


def _alike(a: Element, b: Element) -> bool:
    """Whether two neighbours of one label are one repeated element: containers have to have
    parts of mostly the same labels."""
    return _bare(a) not in CONTAINERS or _likeness(a, b) >= 1.25


def _runs(parts: list[Element]) -> list[tuple[list[int], Element]]:
    """Places of the elements of a page that count as one repeated element, and that element."""
    out: list[tuple[list[int], Element]] = []
    for i, p in enumerate(parts):
        if out and out[-1][1].label == p.label and _alike(out[-1][1], p):
            places, first = out[-1]
            places.append(i)
            if _bare(p) in CONTAINERS:
                known = {q.label for q in first.parts}
                new = [q for q in p.parts if q.label not in known]
                if new:
                    out[-1] = (places, Element(p.label, [*first.parts, *new]))
        else:
            out.append(([i], p))
    return out


def _any_order(parts: list[Element]) -> Element:
    """A repeated group of one optional element per label, which any order of them matches."""
    known: dict[str, Element] = {}
    for p in _flat(parts):
        known[p.label] = merged(known[p.label], p) if p.label in known else p
    for p in known.values():
        p.must = False
    return Element("( )", list(known.values()), False, True)


def _pairs(a: list[Element], b: list[Element]) -> list[tuple[int | None, int | None]]:
    """A longest common run of labels: pairs of places, one of them None where unmatched."""
    if [p.label for p in a] == [p.label for p in b]:
        return [(i, i) for i in range(len(a))]
    score = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = score[i], score[i + 1]
        for j in range(len(b) - 1, -1, -1):
            best = max(below[j], row[j + 1])
            if a[i].label == b[j].label:
                best = max(best, below[j + 1] + _likeness(a[i], b[j]))
            row[j] = best
    pairs: list[tuple[int | None, int | None]] = []
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label and score[i][j] == score[i + 1][j + 1] + _likeness(a[i], b[j]):
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif score[i][j] == score[i + 1][j]:
            pairs.append((i, None))
            i += 1
        else:
            pairs.append((None, j))
            j += 1
    pairs += [(k, None) for k in range(i, len(a))]
    pairs += [(None, k) for k in range(j, len(b))]
    return pairs


def _likeness(a: Element, b: Element) -> float:
    """How well two elements of one label fit: parts of the same labels, and equal texts."""
    if a.label == "#":
        return 1.5 if a.held is not None and a.held == b.held else 1.0
    if not a.parts and not b.parts:
        return 1.5
    x, y = {p.label for p in a.parts}, {p.label for p in b.parts}
    return 1.0 + 0.5 * len(x & y) / len(x | y)


def aligned(a: list[Element], b: list[Element]) -> list[Element]:
    """The expression that matches what either of two matches; unmatched elements are optional."""
    if any(p.label == "( )" for p in a) or any(p.label == "( )" for p in b):
        if [p.label for p in a] != [p.label for p in b] or [[q.label for q in p.parts] for p in a if p.label == "( )"] != [
            [q.label for q in p.parts] for p in b if p.label == "( )"
        ]:
            return [_any_order([*a, *b])]
    out = []
    for i, j in _pairs(a, b):
        if i is None or j is None:
            one = b[j] if i is None else a[i]
            out.append(Element(one.label, one.parts, False, one.many, one.held, one.chars))
        else:
            out.append(merged(a[i], b[j]))
    return collapsed(out)


def expression(wrapper: Element) -> str:
    """The wrapper as text, for people and for comparing wrappers."""
    if wrapper.label == "#":
        inner = "#"
    else:
        inside = " ".join(expression(p) for p in wrapper.parts)
        name = wrapper.label.rstrip(ASIDE + MAIN)
        inner = inside if not name or wrapper.label == "( )" else f"<{name}> {inside} </{name}>"
        inner = " ".join(inner.split())
    if wrapper.many or not wrapper.must:
        return f"( {inner} ){'+' if wrapper.many and wrapper.must else '*' if wrapper.many else '?'}"
    return inner


def trimmed(wrapper: Element) -> Element:
    """The wrapper without its deepest levels, if it has more than ``LARGEST`` elements.

    What a page has there belongs to the level above.
    """

    def sizes(e: Element, level: int, count: list[int]) -> list[int]:
        if level == len(count):
            count.append(0)
        count[level] += 1
        for p in e.parts:
            sizes(p, level + 1, count)
        return count

    def cut(e: Element, levels: int) -> None:
        if levels == 0:
            e.parts = []
        for p in e.parts:
            cut(p, levels - 1)

    counts = sizes(wrapper, 0, [])
    if sum(counts) > LARGEST:
        levels = len(counts)
        while levels > 1 and sum(counts[:levels]) > LARGEST:
            levels -= 1
        cut(wrapper, levels - 1)
    return wrapper


def packed(e: Element) -> list:
    return [e.label, int(e.must), int(e.many), e.held, e.chars, [packed(p) for p in e.parts]]


def unpacked(row: list) -> Element:
    label, must, many, held, chars, parts = row
    return Element(label, [unpacked(p) for p in parts], bool(must), bool(many), held, chars)


# ---- marking and reading ------------------------------------------------------------------

def _all(e: Element) -> Iterator[Element]:
    yield e
    for p in e.parts:
        yield from _all(p)


def _bare(e: Element) -> str:
    return e.label.rstrip(ASIDE + MAIN)


def _is_aside(e: Element, inside_main: bool) -> bool:
    """A heading block inside the article belongs to it."""
    return e.label.endswith(ASIDE) and not (inside_main and e.label == "header" + ASIDE)


def _slots(e: Element, inside_main: bool = False) -> Iterator[Element]:
    """Slots outside of menus, adverts and the like."""
    if e.label == "#":
        yield e
        return
    for p in e.parts:
        if not _is_aside(p, inside_main):
            yield from _slots(p, inside_main)


def mark(wrapper: Element) -> Element:
    """Mark the slots of the main text.

    Those are the slots of ``article`` elements; without any, of ``main`` elements or of those
    named as content; without any, of the smallest element that has most of the text.
    Menus, adverts and the like inside it stay out. In the last case so do texts that are the
    same on all pages, if others differ.
    """

    def named(e: Element, wanted: Callable[[Element], bool], found: list[Element]) -> list[Element]:
        for p in e.parts:
            if p.label.endswith(ASIDE):
                continue
            if wanted(p) and any(s.chars for s in _slots(p, True)):
                found.append(p)
            else:
                named(p, wanted, found)
        return found

    def take(e: Element, free: bool = False) -> None:
        """Mark an element with all inside it; only slots that differ, if ``free``."""
        e.marked = e.label != "#" or not free or e.held is None
        for p in e.parts:
            if not _is_aside(p, True):
                take(p, free)

    for wanted in (
        lambda e: _bare(e) == "article",
        lambda e: _bare(e) == "main",
        lambda e: e.label.endswith(MAIN),
    ):
        found = named(wrapper, wanted, [])
        if found:
            for e in found:
                take(e)
            return wrapper

    def text_of(e: Element) -> int:
        slots = list(_slots(e))
        free = [s for s in slots if s.held is None]
        return sum(s.chars for s in free or slots)

    total = text_of(wrapper)
    best = wrapper
    while True:
        inner = [p for p in _flat(best.parts) if p.label != "#" and not p.label.endswith(ASIDE)]
        inner = [p for p in inner if _bare(p) in CONTAINERS or _bare(p) in ("table", "tbody", "tr")]
        most = max(inner, key=text_of, default=None)
        if most is None or 2 * text_of(most) <= total:
            break
        best = most
    take(best, any(s.held is None for s in _slots(best)))
    return wrapper


def has_article(e: Element) -> bool:
    return any(_bare(p) == "article" or has_article(p) for p in e.parts if not p.label.endswith(ASIDE))


def _matches(parts: list[Element], wrapper: list[Element]) -> list[Element | None]:
    """The wrapper's element for each of a page's, by aligning the two."""
    out: list[Element | None] = [None] * len(parts)
    flat: list[Element] = []

    def opened(items: list[Element]) -> None:
        for w in items:
            if w.label == "( )":
                opened(w.parts)
            else:
                flat.append(w)

    opened(wrapper)
    by_label: dict[str, list[Element]] = {}
    for w in flat:
        by_label.setdefault(w.label, []).append(w)
    unsure = any(len(v) > 1 for v in by_label.values())
    if unsure:
        runs = _runs(parts)
        if len(runs) <= LONGEST:
            for a, b in _pairs([e for _, e in runs], flat):
                if a is not None and b is not None:
                    for i in runs[a][0]:
                        out[i] = flat[b]
    for i, p in enumerate(parts):
        if out[i] is None and p.label in by_label:
            known = by_label[p.label]
            out[i] = next((w for w in known if any(s.marked for s in _all(w))), known[0])
    return out


def read(page: Element, wrapper: Element) -> list[str]:
    """The page's texts in marked slots of the wrapper, in page order."""
    found: list[str] = []

    def visit(p: Element, w: Element) -> None:
        for part, at in zip(p.parts, _matches(p.parts, w.parts)):
            if at is None:  # below the levels of a trimmed wrapper
                if w.marked and not _is_aside(part, True):
                    found.extend(s.texts for s in _slots(part, True))
            elif part.label != "#":
                visit(part, at)
            elif at.marked:
                found.append(part.texts)

    visit(page, wrapper)
    return found


# ---- on tables ------------------------------------------------------------------------------

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame, url_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col(f"`{url_col}`"), _HOST, 1))
    return pages.withColumn("__host", F.when(host != "", host))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's wrapper of each host; given away whenever it holds many hosts."""
    known: dict[str, Element] = {}
    task, given, seen = TaskContext.get().partitionId(), 0, 0

    def out():
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(known), pa.string()),
                pa.array([(task << 24) + given] * len(known), pa.int64()),
                pa.array([json.dumps(packed(trimmed(w))) for w in known.values()], pa.string()),
            ],
            ["__host", "part", "wrapper"],
        )

    for batch in batches:
        for part in slices(batch, "__html"):
            for host, page in zip(part.column("__host").to_pylist(), text_values(part.column("__html"))):
                one = general(parsed(page))
                known[host] = merged(known[host], one) if host in known else one
                seen += 1
                if seen % TRIM_EVERY == 0:
                    trimmed(known[host])
                if len(known) >= HELD_HOSTS:
                    yield out()
                    known.clear()
                    given += 1
    if known:
        yield out()


def infer(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """A wrapper of each host (``__host``), inferred from all of its pages.

    Partial wrappers of the tasks are aligned in rounds of about ``FAN_IN`` per group, so
    a host with most of the pages costs no task more than a small number of small rows.
    """
    hosted = with_host(pages, url_col).select("__host", F.col(f"`{html_col}`").alias("__html"))
    partial = kept(
        hosted.where("__host IS NOT NULL").mapInArrow(_partial, "__host string, part bigint, wrapper string"),
        "partial_wrappers",
    )
    most = partial.groupBy("__host").count().agg(F.max("count")).first()[0] or 0

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        wrapper = None
        for text in rows["wrapper"]:
            one = unpacked(json.loads(text))
            wrapper = one if wrapper is None else trimmed(merged(wrapper, one))
        return pd.DataFrame(
            {"__host": [rows["__host"].iloc[0]], "part": [int(rows["part"].iloc[0])], "wrapper": [json.dumps(packed(wrapper))]}
        )

    fan = 0
    while most > 1:
        groups, fan = -(-most // FAN_IN), fan + 1
        dealt = partial.withColumn("group", F.pmod(F.xxhash64("part", F.lit(fan)), F.lit(groups)))
        partial = dealt.groupBy("__host", "group").applyInPandas(
            lambda rows: together(rows), "__host string, part bigint, wrapper string"
        )
        most = groups
    return partial.select("__host", "wrapper")


def extract(
    pages: DataFrame, html_col: str = "html", url_col: str = "url", output: str = "main_text"
) -> DataFrame:
    """All columns of ``pages`` and the main text of every page.

    Blocks are joined by an empty line; character references are decoded and white space
    inside a block is one space. A page without an article has the text of the element that
    holds most of it. NULL or empty html, and pages without text, give an empty text. Pages
    without a host (NULL or odd url) are read by a wrapper of their own, as is a page whose
    host's wrapper finds nothing in it. Repeated rows are kept; an empty table gives an empty
    result. A column named like the output is replaced.
    """
    rest = pages.select([F.col(f"`{c}`") for c in pages.columns if c != output])
    wrapped = lookup_join(
        with_host(rest, url_col),
        kept(infer(rest, html_col, url_col), "wrappers").withColumnRenamed("wrapper", "__wrapper"),
        "__host",
    )
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Element] = {}
        for batch in batches:
            for part in slices(batch, html_col):
                out = []
                for text, page in zip(part.column("__wrapper").to_pylist(), text_values(part.column(html_col))):
                    one = parsed(page)
                    found: list[str] = []
                    if text is not None:
                        if text not in known:
                            if len(known) >= HELD_HOSTS:
                                known.clear()
                            known[text] = mark(unpacked(json.loads(text)))
                        found = read(one, known[text])
                    if not found and (text is None or not has_article(one)):
                        found = read(one, mark(general(one)))
                    out.append("\n\n".join(found))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(out, pa.string())], [*names, output]
                )

    return wrapped.select(*[F.col(f"`{n}`") for n in names], "__wrapper").mapInArrow(
        run, T.StructType([*rest.schema.fields, T.StructField(output, T.StringType())])
    )
