"""Operator 7, main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative, and one linear scan finds the
contiguous region of the greatest sum: the main text begins and ends with it. All scores are learned from labelled pages, those
that mark their article by an ``article`` (or ``main``) element:

- a word scores by the elements around it: where labelled pages have the words of such an element inside their article
  it scores up to 1, where they have them outside down to -1. Elements no page tells about leave a word at what encloses it.
- a tag costs little where labelled pages have it inside their article, up to ``MOST`` where they have it outside.
  Tags are known with the section they stand in, so the list items of a menu cost and those of an article do not.

Within the region the elements that lie wholly in it and whose words score negative (an advert between two paragraphs)
are left out; nothing is left out because of its place in the page outside the scan. ``RESERVED`` names what HTML and common
usage reserve for other than main text; it counts as ``PRIOR`` words seen outside, which labelled pages outweigh.

Only a page's own tags and words are used, so pages are independent. Null or empty html gives an empty text. Unclosed
and stray tags are tolerated; a ``<`` that begins no tag is text. Pages of any length and nesting are read whole in linear time.
Of regions that tie the first is taken. Repeated rows give repeated rows; extra columns, whatever their names, are ignored; an
empty table gives no rows. Without a labelled page only the priors score.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, table

#: The least and greatest cost of a tag, and that of one nothing is known about.
LEAST, MOST, UNKNOWN = 0.005, 8.0, 3.25
#: The greatest log-odds of being inside that counts, and the words or tags a prior counts as.
CAP, PRIOR = 4.0, 20
#: Kinds of elements and tags that get a weight, the most frequent ones.
KINDS = 4096

# Element names by their part in a page, and what is reserved for other than main text.
ARTICLE = frozenset(["article", "main"])
STRUCTURE = frozenset("div ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption details summary blockquote section p h1 h2 h3 h4 h5 h6 pre address hgroup center".split())
SECTIONS = frozenset("html head body nav header footer aside form button menu dialog fieldset label search article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas audio video textarea select title".split())
ENDS = {"head": (STRUCTURE | SECTIONS | INLINE) - {"html", "head"}, "p": STRUCTURE | SECTIONS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split()) | INLINE - {"a", "label", "button"} | {"br", "img", "hr"}
FORMS = frozenset(["form", "fieldset"])  # may hold a whole page, its article too
RESERVED_NAMES = frozenset("head nav header footer aside form button menu dialog fieldset label search".split())
RESERVED = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu nav navbar navigation newsletter notice notices promo promoted replies sidebar signup sponsor sponsored subscribe contentinfo complementary".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Za-z]+")
_RAW_END = {name: re.compile(f"</{name}(?![a-zA-Z])", re.IGNORECASE) for name in RAW}


def marks_of(rest: str) -> tuple[str, ...]:
    """The words of an element's class, id and role."""
    if "=" not in rest:
        return ()
    return tuple(sorted({w.lower() for m in NAMED.finditer(rest) for w in _PART.findall(m[1] or m[2] or m[3] or "")}))


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", run, ""), ("open", name, attributes), ("close", name, ""); what raw elements and comments hold is left out."""
    at, n, find = 0, len(page), page.find
    closed = True  # whether any ">" is left
    while at < n:
        i = find("<", at)
        if i < 0:
            yield "text", page[at:], ""
            return
        if i > at:
            yield "text", page[at:i], ""
        after = page[i + 1 : i + 2]
        if after in ("!", "?"):
            comment = page.startswith("<!--", i)
            end = find("-->", i + 4) if comment else find(">", i) if closed else -1
            if end < 0 and not comment:
                closed = False
                yield "text", "<", ""
                at = i + 1
            else:
                at = n if end < 0 else end + (3 if comment else 1)
            continue
        m = TAG.match(page, i) if after == "/" or after.isalpha() else None
        if not m:
            yield "text", "<", ""
            at = i + 1
            continue
        name, at = m[2].lower(), m.end()
        yield ("close" if m[1] else "open"), name, m[3]
        if name in RAW and not m[1] and not m[3].endswith("/"):
            end = _RAW_END[name].search(page, at)
            if not end:
                return
            at = find(">", end.end()) + 1 or n


class Open:
    """An open element: its kind, the section it stands in, whether a labelled article holds it (``within``), with nothing reserved between (``inside``), and whether something reserved holds it."""

    __slots__ = ("barred", "begin", "holder", "inside", "kind", "least", "marks", "name", "seen", "weight", "within")

    def __init__(self, name: str, kind: str, holder: str, marks: tuple[str, ...], around: Open | None = None) -> None:
        self.name, self.kind, self.holder, self.marks = name, kind, holder, marks
        self.barred = around is not None and (around.barred or (reserved(name, marks) and name not in FORMS))
        labels = name in ARTICLE and not self.barred
        self.within = labels or (around is not None and around.within)
        self.inside = labels or (around is not None and around.inside and not reserved(name, marks))
        self.begin, self.seen, self.weight, self.least = 0, (0, 0), None, CAP


def reserved(name: str, marks: tuple[str, ...]) -> bool:
    return name in RESERVED_NAMES or (not RESERVED.isdisjoint(marks) and name not in ("html", "body"))


class Reader:
    """Walks a page's tokens with the stack of open elements; ``tag``, ``text``, ``opened`` and ``shut`` are told of them."""

    def __init__(self) -> None:
        self.stack = [Open("", "", "", ())]
        self.count: Counter[str] = Counter()

    def text(self, run: str) -> None: ...

    def tag(self, name: str, kind: str, opens: bool) -> None: ...

    def opened(self, e: Open) -> None: ...

    def shut(self, e: Open, whole: bool) -> None: ...

    def _pop(self, whole: bool = True) -> None:
        e = self.stack.pop()
        self.count[e.name] -= 1
        self.shut(e, whole)

    def read(self, page: str) -> None:
        stack, count = self.stack, self.count
        for what, x, rest in tokens(page):
            if what == "text":
                self.text(x)
                continue
            top = stack[-1]
            if what == "close":
                kind = ""
                if count[x]:
                    while stack[-1].name != x:
                        self._pop()
                    kind = stack[-1].kind
                    self._pop()
                self.tag(x, kind or f"{stack[-1].holder}>{x}", False)
                continue
            while top.name in ENDS and x in ENDS[top.name]:
                self._pop()
                top = stack[-1]
            marks = marks_of(rest)
            own = ".".join([x, *marks[:4]])
            kind = own if x in SECTIONS or marks else f"{top.holder}>{x}"
            self.tag(x, kind, True)
            if x in VOID or x in RAW or rest.endswith("/") or (x in INLINE and not reserved(x, marks)):
                continue
            e = Open(x, kind, own if x in SECTIONS or (marks and x in STRUCTURE) else top.holder, marks, top)
            stack.append(e)
            count[x] += 1
            self.opened(e)
        while len(stack) > 1:
            self._pop(False)


class _Tally(Reader):
    """Counts (what, key, inside): words under each kind of element and each mark, and tags by kind and by name."""

    def __init__(self) -> None:
        super().__init__()
        self.seen: Counter[tuple[str, str, bool]] = Counter()
        self.words = [0, 0]
        self.labelled = False

    def text(self, run: str) -> None:
        self.words[self.stack[-1].inside] += len(run.split())

    def tag(self, name: str, kind: str, opens: bool) -> None:
        self.seen["tag", kind, self.stack[-1].inside] += 1
        self.seen["name", name, self.stack[-1].inside] += 1

    def opened(self, e: Open) -> None:
        e.seen = tuple(self.words)
        self.labelled |= e.inside

    def shut(self, e: Open, whole: bool) -> None:
        for inside in (False, True):
            if n := self.words[inside] - e.seen[inside]:
                self.seen["word", e.kind, inside] += n
                for mark in e.marks:
                    self.seen["mark", mark, inside] += n


def tallies(page: str) -> Counter:
    """(what, key, inside) counts of a labelled page; none of others."""
    t = _Tally()
    t.read(page)
    return t.seen if t.labelled else Counter()


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for raw in raw_texts(batch.column(0)):
            total.update(tallies(raw.decode()))
        keys = list(total)
        yield pa.record_batch([pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))] + [pa.array([total[k] for k in keys], pa.int64())], ["what", "kind", "inside", "n"])


Weights = dict[str, dict[str, float]]


def fitted(pages: DataFrame, html_col: str = "html") -> Weights:
    """Log-odds of being inside an article, of words by kind of element and by mark and of tags by kind and by name: the most frequent ``KINDS``."""
    found = pages.select(F.col(html_col).cast("string").alias("html")).mapInArrow(_tally, "what string, kind string, inside boolean, n long")
    sums = found.groupBy("what", "kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n"))
    return weights_of([tuple(r) for r in sums.orderBy(F.desc("n"), "what", "kind").limit(KINDS).collect()])


def weights_of(rows: list[tuple[str, str, int, int]]) -> Weights:
    out: Weights = {"tag": {}, "name": {}, "word": {}, "mark": {}}
    for what, kind, inside, n in rows:
        name, *marks = kind.rpartition(">")[2].split(".") if what != "mark" else ("", kind)
        out_prior = PRIOR if what != "name" and reserved(name, tuple(marks)) else 0
        in_prior = PRIOR if not out_prior and not marks and name in PLAIN else 0
        out[what][kind] = max(-CAP, min(CAP, math.log((inside + in_prior + 0.5) / (n - inside + out_prior + 0.5))))
    return out


class _Scan(Reader):
    """Scores a page's words and tags in turn and keeps the best region so far."""

    def __init__(self, weights: Weights) -> None:
        super().__init__()
        self.word, self.mark, self.tags, self.names = weights["word"], weights["mark"], weights["tag"], weights["name"]
        self.pieces: list[str] = []
        self.total, self.begin, self.best = 0.0, 0, (0.0, 0, 0)
        self.left: list[tuple[int, int]] = []

    def odds(self, e: Open) -> float | None:
        """The log-odds of an element's words, or None where nothing tells."""
        known = self.word.get(e.kind)
        if known is not None:
            return known
        told = [self.mark[m] if m in self.mark else -CAP for m in e.marks if m in self.mark or (m in RESERVED and e.name not in ("html", "body"))]
        if e.name in RESERVED_NAMES:
            told.append(-CAP)
        return min(told) if told else CAP if e.name in ARTICLE else None

    def cost(self, name: str, kind: str) -> float:
        top = self.stack[-1]
        if top.within:  # the labelled article goes on after what is reserved, or unknown, in it
            known = self.tags.get(f"{top.holder}>{name}", CAP) if top.least > 0 else CAP
        else:
            known = self.tags.get(kind, self.names.get(name, CAP if name in PLAIN else None))
        return UNKNOWN if known is None else max(LEAST, min(MOST, -known * MOST / CAP))

    def score(self) -> float:
        """What a word scores here."""
        top = self.stack[-1]
        return -LEAST if top.least < 0 and top.within else math.tanh(top.least / 2)

    def text(self, run: str) -> None:
        n = len(run.split())
        if n:
            score = self.score()
            if score > 0 and self.total <= 0:
                self.total, self.begin = 0.0, len(self.pieces)
            self.total += score * n
            if score > 0 and self.total > self.best[0]:
                self.best = (self.total, self.begin, len(self.pieces) + 1)
        self.pieces.append(html.unescape(run) if "&" in run else run)

    def tag(self, name: str, kind: str, opens: bool) -> None:
        self.total -= self.cost(name, kind)
        self.pieces.append("" if name in INLINE else " ")

    def opened(self, e: Open) -> None:
        around = self.stack[-2]
        e.weight, e.begin = self.odds(e), len(self.pieces)
        if e.name in ARTICLE and not e.barred:
            e.least = CAP if e.weight is None else e.weight
        else:
            e.least = around.least if e.weight is None else min(around.least, e.weight)

    def shut(self, e: Open, whole: bool) -> None:
        if whole and e.weight is not None and e.weight < 0:
            self.left.append((e.begin, len(self.pieces)))

    def region(self, scan: bool = True) -> str:
        """The text of the best region, without the elements in it that are left out; of the whole page if not ``scan``."""
        begin, end = self.best[1:]
        if not scan:
            held = [i for i, x in enumerate(self.pieces) if x and not x.isspace()]
            begin, end = (held[0], held[-1] + 1) if held else (0, 0)
        skip = bytearray(end - begin)
        for a, b in self.left:
            if begin < a and b < end:
                skip[a - begin : b - begin] = b"\1" * (b - a)
        return " ".join("".join(" " if s else x for x, s in zip(self.pieces[begin:end], skip, strict=True)).split())


def extract(page: str, weights: Weights, scan: bool = True) -> str:
    """The main text of one page; without ``scan`` what is left of the whole page, to tell what the scan does."""
    s = _Scan(weights)
    s.read(page)
    return s.region(scan)


def _extractor(held) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = held.value
        for batch in batches:
            texts = [extract(raw.decode(), weights) for raw in raw_texts(batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, weights: Weights, page_id: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    held = pages.sparkSession.sparkContext.broadcast(weights)  # at most KINDS numbers
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extractor(held), "page_id long, url string, text string, n_chars long")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fitted(pages))
