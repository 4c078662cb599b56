"""The main text of web pages: the best contiguous stretch of words and tags."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh

# Labelled pages, about, that the weights are learned from.
SAMPLE_PAGES = 5000

# Names and marks of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea title select object".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog button head".split()) | RAW
CONTAINERS = frozenset("html body main article section div table thead tbody tfoot tr td th ul ol dl blockquote header "
                       "figure details center".split())
BOILERPLATE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu "
                              "menubar toolbar".split())
BOILERPLATE_MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo "
                              "promotion sidebar widget widgets comment comments reply replies respond disqus cookie "
                              "cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
                              "subscribe subscription signup share sharing social related recommended breadcrumb "
                              "breadcrumbs menu nav navbar navigation footer header masthead login search pagination "
                              "pager toolbar hidden bio more".split())
# Words that may stand beside a mark in one class or id: "advert-box", "left-sidebar".
BESIDE_MARKS = frozenset("box container wrapper wrap block area section panel list items item bar links link buttons button "
                         "icons inner outer top bottom left right primary secondary main site global slot unit google author read "
                         "post posts entry story stories article articles content policy trail thread".split())
# The article's own head and foot: "post-header".
OWN = frozenset("post entry story article content".split())
OWN_PARTS = frozenset("header footer".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Tags with other names share one weight.
OTHER = "other"

# A word's weight in an element whose reason no labelled page shows, and the outside words each reason is given beforehand.
UNSEEN, PRIOR_WORDS = -1.0, 1.0
# A marked element holds the page, and stays, if unmarked words elsewhere are fewer than its words by this factor.
WRAPPER = 10

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


@dataclass(slots=True)
class Piece:
    """A tag (``name``) or a stretch of text between tags, and the container it lies in."""

    name: str
    text: str
    node: int
    excluded: bool
    reason: str = ""  # of a tag that opens an element with one


@dataclass
class Page:
    pieces: list[Piece]
    names: list[str]     # of the containers, by number
    parents: list[int]
    inside: list[bool]   # container within an article
    reasons: list[str]   # why it may be boilerplate: a name "<nav>", an attribute "[role]" or a mark "ad"

    def above(self, node: int) -> list[int]:
        found = []
        while node >= 0:
            found.append(node)
            node = self.parents[node]
        return found[::-1]


def _parts(token: str) -> list[str]:
    """The words of a class or id: "leftSidebar", "ad-slot", and "commentlist" as a mark and a word beside it."""
    parts = []
    for found in _MARK.findall(token):
        part = found.lower()
        cut = next((i for i in range(2, len(part)) if part[:i] in BOILERPLATE_MARKS and part[i:] in BESIDE_MARKS), 0)
        parts += [part[:cut], part[cut:]] if cut and part not in BOILERPLATE_MARKS else [part]
    return parts


def _mark(value: str) -> str:
    """The first mark of a class or id, "" if none: one of its tokens is made of marks and words beside them alone."""
    for token in value.split():
        parts = _parts(token)
        marks = [m for m in parts if m in BOILERPLATE_MARKS]
        if not marks or not all(m in BOILERPLATE_MARKS or m in BESIDE_MARKS or m.isdigit() for m in parts):
            continue
        if set(marks) <= OWN_PARTS and OWN.intersection(parts):
            continue
        return marks[0]
    return ""


def _reason(name: str, attributes: str, in_article: bool) -> str:
    """Why an element may be boilerplate ("" if nothing says so)."""
    if name in BOILERPLATE or name == "header" and not in_article:
        return f"<{name}>"
    if not attributes or name in ("html", "body", "main"):
        return ""
    mark = ""
    for found in _ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), (found[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "[role]" if key == "role" else "[hidden]"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "[role]" if key == "role" else "[hidden]"
        if key == "role" and value.lower() in BOILERPLATE_ROLES:
            return "[role]" if key == "role" else "[hidden]"
        if key == "class" or key == "id" and name not in HEADINGS:
            mark = mark or _mark(value)
    return mark


def _kept(page: Page) -> set[int]:
    """Containers that no reason takes out: they hold the page's article or main, or else nearly all that is left.

    Without an article, a marked element or form stays if it has most of the words, and words elsewhere that
    nothing marks, or that lie in such elements around it, are fewer than a ``WRAPPER``-th of its own.
    """
    names, reasons = page.names, page.reasons
    words = [0] * len(names)
    for piece in page.pieces:
        if not piece.name:
            words[piece.node] += len(piece.text.split())
    nearest = [0] * len(names)  # the element with a reason that a container lies in, itself included
    own = [0] * len(names)      # words that such an element, or the page, has outside others
    for node in range(len(names)):
        nearest[node] = node if reasons[node] or not node else nearest[page.parents[node]]
        own[nearest[node]] += words[node]
    for node in range(len(names) - 1, 0, -1):  # what menus and the like have is not counted further up
        if not reasons[node].startswith(("<", "[")) or names[node] == "form":
            words[page.parents[node]] += words[node]
    articles = [n for n, name in enumerate(names) if name == "article" and not reasons[n]]
    kept = {a for n, name in enumerate(names) if name == "main" for a in page.above(n)}
    if articles:
        return kept.union(page.above(max(articles, key=lambda n: words[n])))
    kept.update(n for n, name in enumerate(names) if name == "article" and not page.inside[page.parents[n]])
    elsewhere = {0: own[0]}  # by kept element: unmarked words of the page outside and inside it
    for n in range(1, len(names)):
        around = nearest[page.parents[n]]
        if not reasons[n] or around not in elsewhere:
            continue
        if n in kept or ((not reasons[n].startswith("<") or names[n] == "form") and 2 * words[n] > words[0]
                         and WRAPPER * elsewhere[around] < words[n]):
            kept.add(n)
            elsewhere[n] = elsewhere[around] + own[n]
    return kept


def parse(page: str, weights: Weights | None = None) -> Page:
    """Tags and texts in order; scripts and the like are excluded, and with ``weights`` elements that score negative.

    All words of an element with a reason, such as a menu, an advert or reader comments, weigh what the weights
    say of that reason, so its own score has that sign. None is taken out that holds the page's article or main,
    or, without an unmarked article, nearly all of the page.
    """
    pieces: list[Piece] = []
    names, parents, inside, reasons = ["root"], [-1], [False], [""]
    open_: list[tuple[str, int]] = [("root", 0)]  # name, node
    at = 0
    while True:
        found = _PIECE.search(page, at)
        text = page[at:found.start() if found else len(page)]
        node = open_[-1][1]
        if text:
            pieces.append(Piece("", text, node, False))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        name, closing = found[2].lower(), bool(found[1])
        if closing:
            if any(o[0] == name for o in open_[1:]):
                while open_.pop()[0] != name:
                    pass
            pieces.append(Piece(f"/{name}", "", open_[-1][1], False))
            continue
        if name in RAW and not found[3].endswith("/"):
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            pieces.append(Piece(name, "", node, True))
            continue
        if name == "body":  # a head left open ends here
            while len(open_) > 1 and open_[-1][0] != "html":
                open_.pop()
            node = open_[-1][1]
        reason = _reason(name, found[3], inside[node])
        if name not in VOID and not found[3].endswith("/") and (name in CONTAINERS or reason):
            names.append(name)
            parents.append(node)
            inside.append(inside[node] or name == "article")
            reasons.append(reason)
            node = len(names) - 1
            open_.append((name, node))
            pieces.append(Piece(name, "", node, False, reason))
        else:
            pieces.append(Piece(name, "", node, False))
    parsed = Page(pieces, names, parents, inside, reasons)
    if weights is None or not any(reasons):
        return parsed
    kept, excluded = _kept(parsed), [False]
    for n in range(1, len(names)):
        excluded.append(excluded[parents[n]] or bool(reasons[n]) and n not in kept and weights.inside(reasons[n]) < 0)
    for piece in pieces:
        piece.excluded = piece.excluded or excluded[piece.node]
    return parsed


@dataclass
class Weights:
    word: float
    tags: dict[str, float]
    marks: dict[str, float] = field(default_factory=dict)  # a word's, by the reason of the element it is in

    def inside(self, reason: str) -> float:
        return self.marks.get(reason, UNSEEN)

    def of(self, piece: Piece) -> float:
        """An element that is taken out counts once, by its tag and reason, so that it parts no article."""
        if not piece.name:
            return 0.0 if piece.excluded else self.word * len(piece.text.split())
        score = self.tags.get(piece.name, self.tags[OTHER])
        return score + self.inside(piece.reason) if piece.reason and piece.excluded else score


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """First and past-the-last index of the contiguous stretch with the largest sum (empty: 0, 0); the first of equals."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def _story(parsed: Page, scores: list[float], first: int, past: int) -> tuple[int, int, set[int]]:
    """The stretch less articles beside the story: the part to stay, and articles to leave out.

    If one outermost article has at least half of what the stretch scores, the stretch is cut to it; if what lies
    outside all of them has, and there are several, they are teasers and left out; else all stay, as on a page of items.
    """
    pieces = parsed.pieces
    outer = [-1] * len(parsed.names)
    for node in range(1, len(outer)):
        above = outer[parsed.parents[node]]
        outer[node] = above if above >= 0 else node if parsed.names[node] == "article" else -1
    sums: dict[int, float] = {}
    for i in range(first, past):
        at = outer[pieces[i].node]
        sums[at] = sums.get(at, 0.0) + scores[i]
    if len(sums) < 2:
        return first, past, set()
    best, total = max(sums, key=sums.get), sum(s for s in sums.values() if s > 0)
    if 2 * sums[best] < total:
        return first, past, set()
    if best < 0:
        beside = {a for a in sums if a >= 0}
        return first, past, beside if len(beside) > 1 else set()
    own = [i for i in range(first, past) if outer[pieces[i].node] == best]
    return own[0], own[-1] + 1, set()


def _with_headings(pieces: list[Piece], first: int) -> int:
    """Where the stretch begins with the headings right before it."""
    while True:
        at = first - 1
        while at >= 0 and not pieces[at].name and not pieces[at].text.strip():
            at -= 1
        if at < 0 or pieces[at].excluded or pieces[at].name[:1] != "/" or pieces[at].name[1:] not in HEADINGS:
            return first
        opens = pieces[at].name[1:]
        while at >= 0 and pieces[at].name != opens:
            at -= 1
        if at < 0:
            return first
        first = at


def main_text(page: str, weights: Weights) -> str:
    """The text of the best stretch and the rest of the article, main or innermost container that holds it.

    Right below html or body it is the stretch alone, with the headings before it.
    """
    parsed = parse(page, weights)
    pieces = parsed.pieces
    scores = [weights.of(p) for p in pieces]
    first, past, beside = _story(parsed, scores, *best_stretch(scores))
    left_out = [False] * len(parsed.names)
    for node in range(1, len(left_out)):
        left_out[node] = node in beside or left_out[parsed.parents[node]]
    texts = [p for p in pieces[first:past] if not p.name and not p.excluded and not left_out[p.node] and p.text.strip()]
    if not texts:
        return ""
    common = []
    for a, b in zip(parsed.above(texts[0].node), parsed.above(texts[-1].node)):
        if a != b:
            break
        common.append(a)
    whole = next((n for n in common if parsed.names[n] == "article"),
                 next((n for n in common if parsed.names[n] == "main"), common[-1]))
    if parsed.names[whole] in ("root", "html", "body"):
        while first and not (pieces[first].name and pieces[first].name.lstrip("/") not in INLINE):
            first -= 1
        first = _with_headings(pieces, first)
        while past < len(pieces) and not (pieces[past].name and pieces[past].name.lstrip("/") not in INLINE):
            past += 1
        chosen = [p for p in pieces[first:past] if not left_out[p.node]]
    else:
        within = [False] * len(parsed.names)
        for node in range(whole, len(parsed.names)):
            within[node] = not left_out[node] and (node == whole or within[parsed.parents[node]])
        chosen = [p for p in pieces if within[p.node]]
    blocks, current = [], []
    for piece in chosen:
        if not piece.name:
            if not piece.excluded:
                current.append(entities.unescape(piece.text))
        elif piece.name == "br":
            current.append(" ")
        elif piece.name.lstrip("/") not in INLINE and piece.name not in RAW:
            blocks.append(current)
            current = []
    blocks.append(current)
    return "\n".join(filter(None, (" ".join("".join(b).split()) for b in blocks)))


def learn_weights(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample_pages`` labelled pages: those that mark their main text as ``article``.

    How much likelier a word or tag is inside the article than outside, as a logarithm: words are kept
    positive and tags negative. Words in an element with a reason to be boilerplate (its name, an attribute, a mark in
    its class or id) are counted for that reason instead: a mark is positive where the pages have its words within
    their articles, names and attributes stay negative. Reasons no page shows weigh ``UNSEEN``. Without labelled
    pages a word is 1 and a tag -2.
    """
    labelled = pages.select(F.col(f"`{html}`").alias("html")).where(F.col("html").rlike(r"(?i)<article[\s>]"))
    count = labelled.count()
    chance = min(1.0, sample_pages / count) if count else 1.0
    sample = labelled.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < chance * (1 << 30))
    listed = INLINE | VOID | BOILERPLATE | CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr caption".split())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                parsed = parse(page)
                for p in parsed.pieces:
                    name = p.name if p.name.lstrip("/") in listed or not p.name else OTHER
                    if p.name:
                        counts[name, parsed.inside[p.node] and not p.excluded] += 1
                        continue
                    n = len(p.text.split())
                    found = {parsed.reasons[a] for a in parsed.above(p.node)} - {""}
                    for reason in found or {""}:
                        counts[f"in {reason}" if reason else "", parsed.inside[p.node]] += n
        yield pa.record_batch([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.bool_()),
                               pa.array(list(counts.values()), pa.int64())], ["name", "inside", "n"])

    rows = (sample.mapInArrow(tally, "name string, inside boolean, n bigint")
            .groupBy("name", "inside").agg(F.sum("n").alias("n")).collect())
    n = {(r["name"], r["inside"]): r["n"] for r in rows}
    totals = {side: sum(v for k, v in n.items() if k[1] is side) for side in (True, False)}

    def likelier(name: str, prior: float = 0.5) -> float:
        return float(np.log((n.get((name, True), 0) + 0.5) / (totals[True] + 1))
                     - np.log((n.get((name, False), 0) + prior) / (totals[False] + 1)))

    if not totals[True] or not totals[False]:
        return Weights(1.0, {OTHER: -2.0})
    seen = {k[0] for k in n}
    tags = {name: min(-0.1, likelier(name)) for name in seen if name and not name.startswith("in ")}
    marks = {name[3:]: likelier(name, PRIOR_WORDS) for name in seen if name.startswith("in ")}
    marks = {reason: min(-0.1, w) if reason[0] in "<[" else w for reason, w in marks.items()}
    return Weights(max(0.1, likelier("")), {OTHER: -1.0} | tags, marks)


def extracted(html: str, weights: Weights) -> Column:
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page or "", weights) for page in batch.to_pylist()], pa.string())

    return run.asNondeterministic()(F.coalesce(F.col(f"`{html}`"), F.lit("")))


def extract(pages: DataFrame, html: str = "html", labelled: DataFrame | None = None,
            sample_pages: int = SAMPLE_PAGES) -> tuple[DataFrame, str]:
    """The rows as they are with one more column, and its name: the main text of the page.

    Words score positive and tags negative; a linear scan finds the contiguous stretch with the largest
    sum. It is cut to one article, or teaser articles are left out, where that has half of its score, and the text is
    that of the article, main or container element around it. Elements in it go whose own score is negative: menus,
    headers, footers, sidebars, notices, adverts, forms and reader comments, by the weight of their name, role or
    marks (whole tokens of a class or id). An element around the article or main, or on pages without an unmarked
    article around nearly all words, stays. Scripts and styles are no text. Character references are decoded, white
    space inside a block becomes one space, blocks are lines. Null and empty pages and pages without any such text
    give an empty text; repeated rows get equal texts; an empty table gives no rows. Rows do not move; the weights
    are one number for each tag name and reason.
    """
    corpus_session(pages.sparkSession)
    weights = learn_weights(pages if labelled is None else labelled, html, sample_pages)
    name, = fresh(pages, "main_text")
    return pages.withColumn(name, extracted(html, weights)), name
