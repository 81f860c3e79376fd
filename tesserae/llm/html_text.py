"""HTML extraction: the maximum-scoring subsequence of a page, words for and tags against it.

A page is one sequence of runs of words and tags. A word scores by where it stands (paragraph, heading, list item, link;
beside the element that the page names as its content, it counts against), a tag by its name; the weights are log odds
learned from labelled pages, those whose markup names its article. One linear scan finds the best contiguous region. The
region, grown to whole blocks, is the text; only what its markup says isn't content (menus, asides, forms, scripts,
adverts, reader comments) is left out of it, and such an element costs the scan one tag, however long it is.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import map_texts

#: Pages that weights are learned from, at most (those first by a hash of their id).
SAMPLE = 500

# Fixed lists of HTML: elements without content, with raw content, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe object canvas math xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Of those with raw content, the ones whose content is markup all the same.
MARKED_UP = frozenset("template svg object canvas math".split())
RAW_END = {n: re.compile(rf"</{n}(?=[\t\n\f\r />])", re.IGNORECASE | re.ASCII) for n in RAW}
SPACED = frozenset("br td th".split())
#: Names of tags whose weight is learned; others share one weight.
KNOWN = VOID | RAW | BLOCK | SPACED | frozenset("a abbr audio b bdi bdo big button cite code data datalist del dfn em font i ins kbd label map mark meter output picture progress q ruby s samp select small span strike strong sub sup time tt u var video head".split())
#: Elements that aren't content; roles that say the same; elements and roles that name content.
AWAY = frozenset("head nav footer aside form script style noscript template svg iframe button select textarea menu dialog input object canvas title datalist".split())
AWAY_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
CONTENT = frozenset("article main".split())
MAIN_ROLE = re.compile(r"(?:^|\s)role\s*=\s*[\"']?main(?:[\"'\s/]|$)", re.IGNORECASE)

# Whole class and id names that aren't content. A name of several parts means what its last part does (reader-comments,
# site-footer), or its first where the others only say what kind of box it is (share-buttons, ad-slot-2).
NOTHING_ELSE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie cookies cookiebar consent gdpr notice notices notification notifications "
    "newsletter sidebar sidebars menu menus nav navbar topnav subnav navigation breadcrumb breadcrumbs footer copyright masthead topbar comments commentlist disqus respond replies "
    "widget widgets popup popups modal overlay lightbox pagination pager toolbar skiplink login signin signup adbox adslot adunit sharing".split()
)
FIRST_PART = NOTHING_ELSE | frozenset("share social related recommended search subscribe comment reply skip".split())
BOX_PART = frozenset(
    "area author bar block body box button buttons cards container content form group header heading holder icon icons item items link links list media meta module panel posts articles stories reads row section slot title unit "
    "wrap wrapper inner outer left right top bottom main notice message text to 0 1 2 3 4 5 6 7 8 9".split()
)
WHOLE_NAMES = frozenset("ad comment reply share social related search subscribe teaser teasers siteheader pageheader site-header page-header sr-only screen-reader-text visually-hidden skip-to-content".split())
#: Of these, the ones that say so even of an element that names content.
OF_CONTENT = frozenset("comment comments commentlist reply replies related teaser teasers promo promos ad ads".split())
#: Classes and ids that say how a page is laid out, whatever names they hold.
LAYOUT_NAME = re.compile(r"(?:has|no|not|with|without|is|hide|show)[_-].*|.*[_-](?:open|opened|closed|enabled|disabled|on|off)", re.IGNORECASE)
#: What a form around a whole page holds, and one to fill in doesn't.
PAGE_PART = re.compile(r"<(?:(?:article|main|nav|header|footer|h1)(?=[\s/>])|[a-z]+\s[^<>]*?\brole\s*=\s*[\"']?main\b)", re.IGNORECASE)
FORM_END = re.compile(r"</form(?=[\s/>])", re.IGNORECASE)
#: How surely an element isn't content: a layout word or a form, a word that articles are called by too, an element or role.
SOFT, NAMED, HARD = 1, 2, 3

#: A comment, a declaration, or a tag; a quote opens a value only behind =, and one that never closes takes the rest.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=(?!\s*[\"'])|[^>=])*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")


@dataclass(slots=True)
class Element:
    name: str
    how: int
    content: bool
    up: Element | None
    wraps: bool = False  # holds the page's main element
    away: int = 0  # how surely it isn't content, by itself and by what holds it
    place: str = "body"  # where its words stand
    para: Element | None = None  # the paragraph that a new one ends
    inside: bool = False  # in an element that names content, and not away

    def __post_init__(self) -> None:
        if self.up is None:
            return
        if self.name in BLOCK:
            self.place = self.name if self.name in ("p", "li") else "heading" if re.fullmatch("h[1-6]", self.name) else "body"
            self.para = self if self.name == "p" else None
        else:
            self.place, self.para = "link" if self.name == "a" else self.up.place, self.up.para

    def settle(self) -> None:
        """Set away once that of `up` is: an article undoes SOFT around it, a main element all but HARD."""
        own = 0 if self.wraps and self.how < HARD else self.how
        above = self.up.away if self.up else 0
        self.away = max(own, 0 if not own and self.name in CONTENT and above == SOFT else above)
        self.inside = self.content and not self.away


@dataclass(slots=True)
class Run:
    """A tag (words = 0) or text between tags; block: number of the block that text belongs to."""

    kind: str
    words: int = 0
    text: str = ""
    block: int = -1
    within: Element | None = field(default=None, repr=False)


def _parts(name: str) -> list[str]:
    return [p for p in re.split(r"[_-]+", name.lower()) if p]


def says_away(name: str) -> bool:
    """Whether a whole class or id name says that its element isn't content."""
    parts = _parts(name)
    if not parts:
        return False
    return name.lower() in WHOLE_NAMES or parts[-1] in NOTHING_ELSE or (len(parts) > 1 and parts[0] in FIRST_PART and all(p in BOX_PART or p in FIRST_PART for p in parts[1:]))


def says_no_content(name: str) -> bool:
    """Whether it says so even of an element that names content."""
    return says_away(name) and not OF_CONTENT.isdisjoint((_parts(name)[0], _parts(name)[-1]))


def _how_away(name: str, attributes: str, inside_content: bool) -> int:
    if (name in AWAY and name != "form") or (name == "header" and not inside_content):
        return HARD
    own = SOFT if name == "form" else 0
    if not attributes.strip():
        return own
    found = {(m[1] or m[5]).lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in AWAY_ROLE or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return HARD
    if name in ("html", "body"):
        return own
    names = [n for a in ("class", "id") for n in found.get(a, "").split() if not LAYOUT_NAME.fullmatch(n)]
    if any(map(says_no_content, names)):
        return HARD if name in CONTENT else NAMED
    return SOFT if name not in CONTENT and any(map(says_away, names)) else own


class Forms:
    """Whether a form is around a page rather than in it: it holds a part of a page. Ends and parts are looked up once."""

    def __init__(self, page: str):
        self.page, self.ends, self.parts = page, None, None

    def around(self, at: int) -> bool:
        if self.ends is None:
            self.ends = [m.start() for m in FORM_END.finditer(self.page)]
            self.parts = [m.start() for m in PAGE_PART.finditer(self.page)]
        e, p = bisect_left(self.ends, at), bisect_left(self.parts, at)
        return p < len(self.parts) and self.parts[p] < (self.ends[e] if e < len(self.ends) else len(self.page))


def raw_end(page: str, at: int, name: str) -> int:
    """Start of the closing tag of a raw element whose content starts at `at`; the page's end if there is none."""
    if name not in MARKED_UP:
        m = RAW_END[name].search(page, at)
        return m.start() if m else len(page)
    while m := TOKEN.search(page, at):
        at, inner = m.end(), (m[2] or "").lower()
        if m[1] and inner == name:
            return m.start()
        if not m[1] and inner in RAW and inner not in MARKED_UP and not m[3].endswith("/") and (end := RAW_END[inner].search(page, at)):
            at = end.start()
    return len(page)


def runs(page: str) -> list[Run]:
    """The page's tags and texts in order, in time in proportion to its length however deep elements are nested."""
    out: list[Run] = []
    top = Element("", 0, False, None)
    now, at, block = top, 0, 0
    every, forms = [top], Forms(page)
    open_now: Counter = Counter()

    def say(text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        if text:
            out.append(Run(now.place, len(text.split()), text, block, now))

    while m := TOKEN.search(page, at):
        closing, name = m[1] == "/", (m[2] or "").lower()
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not name:
            continue
        if name in BLOCK:
            block += 1
        elif name in SPACED:
            out.append(Run("space", 0, " ", block, now))
        tag = name if name in KNOWN else "other"
        if closing:
            if open_now[name]:
                while now.name != name:
                    open_now[now.name] -= 1
                    now = now.up
                open_now[name] -= 1
                now = now.up
            out.append(Run(f"</{tag}>", 0, "", -1, now))
            continue
        if name not in VOID:
            if name == "p" and now.para is not None:  # a new paragraph ends one that is open
                end = now.para.up
                while now is not end:
                    open_now[now.name] -= 1
                    now = now.up
            how = _how_away(name, m[3], now.content)
            if how == SOFT and name == "form" and forms.around(at):
                how = 0
            if not m[3].endswith("/") or name not in ("svg", "script", "iframe"):
                main = name == "main" or bool(MAIN_ROLE.search(m[3]))
                how = 0 if main and how == SOFT else how
                now = Element(name, how, now.content or name in CONTENT or main, now)
                every.append(now)
                open_now[name] += 1
                if main and not how:
                    e = now.up
                    while e is not None and not e.wraps:
                        e.wraps, e = True, e.up
                if name in RAW:
                    at = raw_end(page, at, name)
        out.append(Run(f"<{tag}>", 0, "", -1, now))
    if at < len(page):
        say(page[at:])
    for e in every:  # what wraps the main element is known only now
        e.settle()
    return out


def scored_kinds(seq: list[Run]) -> list[str | None]:
    """What each run scores by; "": nothing; None: it lies in an element that isn't content, whose first tag alone counts ("<away>").

    On a page that names its content, what stands beside that counts by itself ("p beside"), and so do adverts and the
    like there; in the content, and on other pages, they are elements that aren't content.
    """
    named = any(r.words and r.within.inside for r in seq)
    out: list[str | None] = []
    entered = False
    for r in seq:
        e = r.within
        left_out = e.away >= HARD or (e.away and (e.content or not named))
        if left_out:
            out.append(None if entered else "<away>")
            entered = True
            continue
        entered = False
        if r.kind.startswith("<"):
            out.append(r.kind)
        else:
            out.append("" if not r.words else f"{r.kind} beside" if named and not e.inside else r.kind)
    return out


def weight_counts(page: str) -> Counter:
    """(kind, inside) -> words or tags of a labelled page, one whose markup names its article; empty for others."""
    seq = runs(page)
    if not any(r.words and r.within.inside for r in seq):
        return Counter()
    out: Counter = Counter()
    for r, kind in zip(seq, scored_kinds(seq), strict=True):
        if kind:
            out[kind, bool(r.within.inside)] += r.words or 1
    return out


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Smoothed log odds of standing inside content: from 0.2 for words in it, up to -0.2 for tags and -0.5 for words beside it."""
    own: dict[str, float] = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1))
        own[kind] = min(-0.2, max(-4.0, odds)) if kind.startswith("<") else min(-0.5, max(-1.0, odds)) if kind.endswith(" beside") else max(0.2, min(4.0, odds))
    # words of a page without any markup to go by still count for the region
    return {"p": 1.0, "heading": 1.0, "body": 0.5, "li": 0.4, "link": 0.2} | own


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous stretch with the largest sum, (0, 0) if none is positive; the first of equals."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, bounds = total, (start, i + 1)
    return bounds


def scores_of(seq: list[Run], kinds: list[str | None], weights: dict[str, float]) -> list[float]:
    def one(r: Run, kind: str | None) -> float:
        if not kind:
            return 0.0
        if kind.startswith("<"):
            return weights.get(kind, -0.2)
        return r.words * weights.get(kind, -0.5 if kind.endswith(" beside") else 0.2)

    return [one(r, k) for r, k in zip(seq, kinds, strict=True)]


def main_text(page: str, weights: dict[str, float]) -> str:
    """The best region, grown to whole blocks."""
    seq = runs(page)
    kinds = scored_kinds(seq)
    start, end = best_region(scores_of(seq, kinds, weights))
    said = [bool(r.text) and k is not None and k != "<away>" for r, k in zip(seq, kinds, strict=True)]
    blocks = {r.block for r, s in zip(seq[start:end], said[start:end], strict=True) if s and r.words}
    parts: dict[int, list[str]] = {}
    for r, s in zip(seq, said, strict=True):
        if s and r.block in blocks:
            parts.setdefault(r.block, []).append(r.text)
    texts = (" ".join("".join(p).split()) for p in parts.values())
    return "\n\n".join(t for t in texts if t)


def learn_weights(pages: DataFrame, key: str = "page_id", page: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most `sample` pages; only sums per kind, of which KNOWN bounds the number, reach the driver. Unlabelled pages add nothing."""

    def run(batches):
        for b in batches:
            total: Counter = Counter()
            for p in b.column(0).to_pylist():
                total += weight_counts(p or "")
            rows = sorted(total.items())
            yield pa.RecordBatch.from_arrays([pa.array([k for (k, _), _ in rows], pa.string()), pa.array([i for (_, i), _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())], names=["kind", "inside", "n"])

    chosen = pages.select(key).orderBy(F.xxhash64(key), key).limit(sample).withColumnRenamed(key, "_key").distinct()
    rows = pages.select(key, page).join(F.broadcast(chosen), F.col(key) == F.col("_key")).select(page)
    got = map_texts(rows, run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    return weights_of({(r["kind"], r["inside"]): r["n"] for r in got.collect() if r["kind"]})


def extracted(pages: DataFrame, weights: dict[str, float], page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keep, text and n_chars (code points) of every page, whole pages; a narrow map, no shuffle.

    A null or empty page, and one without content, has an empty text. Repeated rows each get a row; an empty table gives
    none. Blocks are joined by two line feeds, white space within one is one space, character references are decoded.
    Markup that is cut off or not closed ends with the page. Other columns are not read.
    """

    def run(batches):
        for b in batches:
            texts = [main_text(p or "", weights) for p in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return map_texts(pages.select(*keep, page), run, f"{schema}, text string, n_chars long")
