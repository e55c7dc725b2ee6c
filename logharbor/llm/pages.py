"""Main text of web pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm.common import arrow_column, read_table, session, whole_text
from logharbor.llm.folds import first_by_hash, one_text_per_id
from logharbor.llm.mincut import label

#: Largest number of pages that the block classifier is fitted on.
TRAINING_PAGES = 500
#: Smoothness of blocks that follow each other, that share a parent, and that share a grandparent.
FOLLOW, SIBLING, COUSIN = 0.4, 0.8, 0.3
#: Capacities are whole numbers of this part of a unit.
UNIT = 1000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea iframe".split())
#: Elements that a browser does not show as text of the page: their text is a block of its own, marked `never`.
UNSEEN = frozenset("svg template noembed noframes".split())
#: Elements in which a tag that ends in a slash has no content.
FOREIGN = frozenset(["svg", "math"])
#: Start tags that an open foreign element ends at, unless one of POINTS lies between.
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var article section main".split()
)
POINTS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: Elements without content when their own start tag ends in a slash.
CLOSABLE = UNSEEN | FOREIGN | {"object"}
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center col colgroup dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul video".split()
)
#: Elements that an open element of these kinds ends at, when a start tag of the key comes.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol menu dl table select body html article section div nav aside main footer header form td th object math".split()) | UNSEEN
KEEPS_P_OPEN = frozenset("button canvas col colgroup head legend noscript option optgroup caption tbody td tfoot th thead tr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset(["p", "blockquote", "pre"])
LISTED = frozenset(["li", "td", "dd"])
MAIN = frozenset(["article", "main"])
ASIDE = frozenset("nav footer aside form menu dialog button select fieldset noscript search head".split())
#: Words that name boilerplate in class, id and role attributes.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs footer comment comments reply replies disqus "
    "respond related recommended share sharing social subscribe subscription newsletter login signup pagination pager copyright "
    "alert toolbar complementary contentinfo".split()
)
#: Words that name boilerplate unless the main element lies inside.
SELDOM = frozenset("sidebar header masthead widget widgets aside rail search topbar".split())
#: Words that go with these without a meaning of their own: a name of both kinds only, like "share-buttons", names
#: boilerplate, and one with other words, like "share-price", is but a hint of it.
PLAIN = frozenset(
    "area article bar block body bottom box button buttons container content entry foot form group head inner item items left link "
    "links list main message module news outer page panel post posts primary right row secondary section site slot small stories "
    "story text title top unit wrap wrapper".split()
)
#: Words that make a class name tell of a state of the page rather than of the element.
STATE = frozenset("has is no with without open closed opened enabled disabled active allowed type status".split())
HINT = frozenset("article content entry post story text body main".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*>",
    re.S,
)
TAIL = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
STOP = re.compile(r"[.!?…。](?=\s|$)")

FEATURES = ("one", "length", "stops", "links", "heading", "paragraph", "item", "near", "main", "aside", "never", "named", "seldom", "hint", "beside")
#: The features from here on come from semantic tags and names.
TOLD = FEATURES.index("main")
#: Weights of a block being content that hold without training pages; fitted weights are drawn towards them.
PRIOR = np.array([-2.5, 0.6, 1.5, -5.0, 1.0, 1.5, -1.0, -1.0, 6.0, -15.0, -15.0, -3.0, -6.0, 1.0, -7.0])
#: Blocks before and after one whose share of links is its feature `near`.
NEAR = 2


@dataclass(slots=True)
class Element:
    """An open element; what its ancestors say of it is handed down when it is opened."""

    name: str
    parent: Element | None
    main: bool = False
    aside: bool = False
    never: bool = False
    named: bool = False
    hint: bool = False
    unseen: bool = False
    foreign: bool = False
    heading: bool = False
    paragraph: bool = False
    item: bool = False
    #: The innermost element from here upwards that is boilerplate unless the main element lies inside.
    seldom: Element | None = None
    #: Set when the main element turns out to lie inside; then it lies inside all ancestors too.
    holds_main: bool = False
    #: The block-level element that a text in here lies in.
    block: Element | None = None


@dataclass(slots=True)
class Run:
    """Text since the last block-level tag, the element of its first word, and how much of it is linked."""

    pieces: list[str] = field(default_factory=list)
    home: Element | None = None
    linked: int = 0


@dataclass(slots=True)
class Block:
    text: str
    element: Element
    linked: int
    row: list[float] = field(default_factory=list)


def _said(part: str, name: str) -> tuple[bool, bool, bool, bool]:
    """What a class, id or role says: boilerplate, a hint of it, boilerplate around the main element, a hint of content."""
    own, whole = {w.lower() for w in WORD.findall(part)}, {part.lower()}
    if name in MAIN:
        own = whole  # a main element is named by whole names only: "comment", but not "comment-list"
    elif own & STATE:
        return False, False, False, False
    bad, doubtful = not own.isdisjoint(NEVER), not own.isdisjoint(SELDOM)
    clear = own <= NEVER | SELDOM | PLAIN or not whole.isdisjoint(NEVER | SELDOM)
    return bad and clear, bad and not clear, doubtful and clear, not own.isdisjoint(HINT)


def _opened(name: str, attributes: str, parent: Element | None) -> Element:
    up = parent or Element("", None)
    e = Element(name, parent, up.main or name in MAIN, up.aside or name in ASIDE, up.never or name in UNSEEN, up.named, up.hint)
    e.unseen, e.foreign = up.unseen or name in UNSEEN, name in FOREIGN or (up.foreign and up.name not in POINTS)
    e.heading, e.paragraph, e.item = up.heading or name in HEADING, up.paragraph or name in PROSE, up.item or name in LISTED
    e.block = e if name in BLOCK or parent is None else up.block
    seldom = False
    if "=" in attributes or "hidden" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "style":
                e.never |= bool(HIDDEN.search(value))
            elif key == "hidden" or key == "aria-hidden":
                e.never |= key == "hidden" or value.lower() == "true"
            elif name not in ("html", "body"):
                for part in value.split():
                    never, named, around, hint = _said(part, name)
                    e.never |= never
                    e.named |= named
                    e.hint |= hint
                    seldom |= around
                    e.main |= key == "role" and part.lower() == "main"
    e.seldom = e if seldom or (name == "header" and not e.main) else up.seldom
    if e.main and not up.main and not e.never and not e.aside:
        while up is not None and up.name and not up.holds_main:
            up.holds_main = True
            up = up.parent
    return e


class Stack:
    """The open elements, and where those of each name and those that bound a scope stand."""

    def __init__(self) -> None:
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, e: Element) -> None:
        at = len(self.open)
        self.open.append(e)
        self.places.setdefault(e.name, []).append(at)
        if e.name in BLOCK:
            self.blocks.append(at)
        if e.name in SCOPE:
            self.scopes.append(at)

    def last(self, name: str) -> int:
        """Where the innermost element of the name stands, 0 if there is none but perhaps the root."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def close(self, upto: int) -> None:
        while len(self.open) > upto:
            at, e = len(self.open) - 1, self.open.pop()
            self.places[e.name].pop()
            for kept in (self.blocks, self.scopes):
                if kept and kept[-1] == at:
                    kept.pop()

    def end(self, name: str) -> None:
        """What an end tag closes; one that is not block-level closes nothing beyond a block-level element."""
        at = self.last(name)
        if at and (name in BLOCK or name == "a" or not self.blocks or at > self.blocks[-1]):
            self.close(at)

    def end_paragraph(self) -> None:
        at = self.last("p")
        if at and (not self.scopes or at > self.scopes[-1]):
            self.close(at)

    def end_siblings(self, name: str) -> None:
        """A list item, cell or row ends the open ones before it, as far as its list or table reaches."""
        ends = ENDS[name]
        while True:
            k = len(self.scopes)
            while k and self.open[self.scopes[k - 1]].name in ends:
                k -= 1
            at = max(self.last(other) for other in ends)
            if not at or (k and at <= self.scopes[k - 1]):
                return
            self.close(at)
            if name != "tr":
                return


def blocks(page: str) -> list[Block]:
    """Runs of text between block-level tags, in page order, with the element that each lies in.

    Text of UNSEEN elements is a run of its own and does not part the one around it. An element that is
    not closed ends with the one that contains it; an UNSEEN one that no end tag follows is passed over.
    """
    out: list[Block] = []
    stack = Stack()
    stack.push(_opened("html", "", None))
    opened = stack.open
    shown, unseen = Run(), Run()
    ends: dict[str, int] = {}
    last_tag = page.rfind(">") + 1

    def flush() -> None:
        for run in (shown, unseen):
            if run.pieces:
                text = " ".join(html.unescape("".join(run.pieces)).split())
                if text:
                    out.append(Block(text, run.home or opened[-1], run.linked))
                run.pieces.clear()
            run.linked, run.home = 0, None

    def ended(name: str) -> bool:
        """Whether an end tag of the name comes later; each is looked for once."""
        if ends.get(name, 0) < at:
            found = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            ends[name] = found.start() if found else len(page)
        return ends[name] < len(page)

    at = 0
    while at < len(page):
        # where no ">" follows there is no tag either, and looking for one would read the rest each time
        found = (TAG if at < last_tag else TAIL).search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            run = unseen if opened[-1].unseen else shown
            if run.home is None and not text.isspace():
                run.home = opened[-1]
            run.pieces.append(text)
            if stack.places.get("a"):
                run.linked += len(text)
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower() if found.re is TAG else ""
        if not name:
            continue
        if found[1] or found[4]:
            if name in BLOCK:
                flush()
            if name == "br":
                (unseen if opened[-1].unseen else shown).pieces.append(" ")
            stack.end(name)
            continue
        attributes = found[3] or ""
        if opened[-1].foreign and opened[-1].name not in POINTS and name in BREAKS_OUT:
            while opened[-1].foreign and opened[-1].name not in POINTS:
                stack.close(len(opened) - 1)
        if name in BLOCK:
            flush()
            if name not in KEEPS_P_OPEN:
                stack.end_paragraph()
            if name in ENDS:
                stack.end_siblings(name)
        if name == "br":
            (unseen if opened[-1].unseen else shown).pieces.append(" ")
        elif attributes.endswith("/") and (name in CLOSABLE or opened[-1].foreign):
            continue
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name in UNSEEN and not ended(name):
            continue
        elif name not in VOID:
            stack.push(_opened(name, attributes, opened[-1]))
    flush()
    return out


def rated(found: list[Block]) -> list[Block]:
    """The blocks with their FEATURES filled in."""
    any_main = _any_main(found)
    sizes, linked = (np.cumsum([0] + [x for b in found for x in [pick(b)]]) for pick in (lambda b: len(b.text), lambda b: min(b.linked, len(b.text))))
    for k, b in enumerate(found):
        e, n = b.element, len(b.text)
        low, high = max(k - NEAR, 0), min(k + NEAR + 1, len(found))
        others = sizes[high] - sizes[low] - n
        b.row = [
            1.0,
            log1p(n),
            min(len(STOP.findall(b.text)), 3) / 3,
            min(b.linked / n, 1.0),
            float(e.heading),
            float(e.paragraph),
            float(e.item),
            float((linked[high] - linked[low] - min(b.linked, n)) / others) if others else 0.0,
            float(e.main),
            float(e.aside),
            float(e.never),
            float(e.named),
            float(e.seldom is not None and not e.seldom.holds_main),
            float(e.hint),
            float(any_main and not e.main),
        ]
    return found


def _any_main(found: list[Block]) -> bool:
    return any(b.element.main and not (b.element.aside or b.element.never) for b in found)


def content(page: str, weights: np.ndarray) -> list[str]:
    """Texts of the blocks on the content side of the minimum cut.

    `weights` has two rows, for pages with a main element and for those without; one row holds for both.
    """
    found = rated(blocks(page))
    if not found:
        return []
    row = np.atleast_2d(weights)[0 if _any_main(found) else -1]
    scores = np.rint(np.array([b.row for b in found]) @ row * UNIT).astype(np.int64).tolist()
    edges, last_in, last_below = [], {}, {}
    for k, b in enumerate(found):
        inner = b.element.block
        outer = inner.parent or inner
        if k:
            edges.append((k - 1, k, int(FOLLOW * UNIT)))
        # a block is tied to the one before it in the same element, and below the same parent
        for kept, key, weight in ((last_in, id(outer), SIBLING), (last_below, id(outer.parent or outer), COUSIN)):
            if key in kept:
                edges.append((kept[key], k, int(weight * UNIT)))
            kept[key] = k
    return [b.text for b, keep in zip(found, label(scores, edges)) if keep]


def _teacher(row: list[float]) -> int:
    """What the semantic tags say of a block: 1 content, 0 boilerplate, -1 nothing."""
    main, aside, never = (row[FEATURES.index(name)] for name in ("main", "aside", "never"))
    return 0 if aside or never else 1 if main else -1


def _fitted(x: np.ndarray, y: np.ndarray, pull: float) -> np.ndarray:
    """Logistic weights that are drawn to PRIOR by `pull`; both kinds of blocks weigh the same."""
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    weights = PRIOR.copy()
    for _ in range(20):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (share * (p - y)) + pull * (weights - PRIOR)
        weights = weights - np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(PRIOR)), slope)
    return weights


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", bound: int = TRAINING_PAGES) -> np.ndarray:
    """Weights of the block classifier, from the blocks that semantic tags tell apart on at most `bound` pages.

    Two rows: one for pages with a main element, and one for pages without, which is fitted on the same
    blocks with their tags and names hidden. Logistic fits that are drawn to PRIOR; without such blocks it
    is PRIOR itself. Ids are sampled, each once however often it is repeated; of pages that share an id the
    one with the least digest stands for all, and pages without an id are named by their digest.
    """
    page = whole_text(html_col)
    named = pages.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.sha2(page, 256)).alias("name"), page.alias("page"))
    sample = one_text_per_id(named, first_by_hash(named.select("name"), bound, "name"), "name", "page")

    def work(texts: pa.Array) -> pa.Array:
        return pa.array([[b.row for b in rated(blocks(t))] for t in texts.to_pylist()], pa.list_(pa.list_(pa.float64())))

    listed = sample.select(arrow_column(work, "array<array<double>>")(F.col("page")).alias("rows")).toArrow()
    rows = [row for page in listed.column("rows").to_pylist() for row in page]
    known = np.array([_teacher(row) for row in rows])
    if not len(rows) or not (known == 0).any() or not (known == 1).any():
        return np.stack([PRIOR, PRIOR])
    x, y = np.array(rows)[known >= 0], known[known >= 0]
    hidden = x.copy()
    hidden[:, TOLD:] = 0
    return np.stack([_fitted(x, y, 0.01), _fitted(hidden, y, 0.001)])


def main_text(
    pages: DataFrame, html_col: str = "html", out: str = "text", weights: np.ndarray | None = None, id_col: str = "page_id"
) -> DataFrame:
    """The table with the main text of each page in a new column.

    Blocks on the content side of the cut are joined by one space in page order; character references
    are decoded and white space in a block is one space. Null and empty pages, and pages without
    content, have an empty text. Markup-free elements (RAW) have no text; fallbacks of objects and formulas
    are text like any other, that of UNSEEN elements counts as boilerplate. Pages are labelled one by one, so repeated rows and ties do not matter.
    Other columns are passed on; one that is named `out` is replaced. An empty table stays empty.
    """
    weights = train(pages, html_col, id_col) if weights is None else weights

    def work(texts: pa.Array) -> pa.Array:
        return pa.array([" ".join(content(t, weights)) for t in texts.to_pylist()], pa.string())

    return pages.withColumn(out, arrow_column(work, "string")(whole_text(html_col)))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(session(spark), sf_dir, "pages")
    return main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
