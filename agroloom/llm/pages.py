"""Main text of web pages by consensus of their host.

Every page scores its containers by the text of the blocks inside. Spark adds up, per host, the votes for generalised
tag-class paths; each page is then extracted again from all containers on its host's winning path, with the text beside them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow, slices, texts_of
from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE = re.compile(r"""=\s*(["'])|>""")
READS = 8  # times a page's length that may be spent on quoted attributes
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[a-z]+")

# Elements whose content is no text of the page.
_DROPPED = frozenset(
    "script style template noscript iframe object embed svg math canvas audio video form button select option textarea input "
    "nav header footer aside menu dialog head title".split()
)
_RAW = frozenset("script style textarea title noscript iframe template svg math".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_CONTAINERS = frozenset("article main section div td body".split())
# Parts of class and id names that mark side matter.
_SIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs footer header masthead sidebar aside notice alert cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended widget pagination pager toolbar skip".split()
)
_READERS = frozenset("comment comments commentlist reply replies disqus respond discussion".split())
_WRAPPER = re.compile(r"\b(?:with|has|no|without)[-_]\w+")  # says what lies beside, not what it is
_SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# Elements of lists and tables: a start tag closes the nearest open one of its kind, unless a list or table begins between.
_KINDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_KIND_OF = {tag: kind for kind, (same, _) in _KINDS.items() for tag in same}
_SCOPES = {tag: [k for k, (same, stop) in _KINDS.items() if tag in same or tag in stop] for tag in {t for x in _KINDS.values() for ts in x for t in ts}}


class Scanner:
    """Markup of a page from left to right, in time linear in its length.

    ``next`` gives the next tag, comment or declaration at or after ``at`` and moves ``at`` behind it; the caller may move it
    further, as behind a script. A ``<`` that begins no markup is text.
    """

    def __init__(self, source: str):
        self.source, self.at = source, 0
        self.last = source.rfind(">")
        self.spent = 0

    def next(self) -> tuple[int, str, str, str] | None:
        """Where it begins, its kind (``start``, ``end``, ``data`` or ``skip``), tag in lower case (or the data) and attributes."""
        source, at = self.source, self.at
        while (begin := source.find("<", at)) >= 0:
            if source.startswith("<!--", begin):
                return self._until(begin, "-->", 4, "skip")
            if source.startswith("<![CDATA[", begin):
                return self._until(begin, "]]>", 9, "data")
            if begin > self.last:  # nothing is closed any more
                return None
            if source.startswith(("<!", "<?"), begin):
                self.at = source.find(">", begin) + 1
                return begin, "skip", "", ""
            closing = source.startswith("/", begin + 1)
            name = _NAME.match(source, begin + 1 + closing)
            if name:
                end = self._close(name.end())
                self.at = end + 1
                return begin, "end" if closing else "start", name[0].lower(), source[name.end() : end]
            at = begin + 1
        return None

    def _until(self, begin: int, mark: str, skip: int, kind: str) -> tuple[int, str, str, str]:
        end = self.source.find(mark, begin + skip)
        self.at = len(self.source) if end < 0 else end + len(mark)
        return begin, kind, self.source[begin + skip : len(self.source) if end < 0 else end], ""

    def _close(self, at: int) -> int:
        """The ``>`` that ends a tag: the first one outside quoted values, or the first of all where a quote stays open.

        Broken quotes may lead to the end of the page again and again, so they are followed only until that has cost
        ``READS`` times the length of the page.
        """
        first = self.source.find(">", at)
        while self.spent < READS * len(self.source):
            m = _QUOTE.search(self.source, at)
            if m is None:
                break
            if m[1] is None:
                return m.start()
            end = self.source.find(m[1], m.end())
            self.spent += (len(self.source) if end < 0 else end) - at
            if end < 0:
                break
            at = end + 1
        return first


class Element:
    __slots__ = ("tag", "step", "path", "parent", "around", "scopes", "side", "holds", "within", "score")

    def __init__(self, tag: str, step: str, path: int, parent: Element | None, side: int):
        self.tag, self.step, self.path, self.parent, self.side = tag, step, path, parent, side
        # the nearest container around it
        self.around = parent if parent is None or parent.tag in _CONTAINERS else parent.around
        self.scopes: dict[str, Element] = {} if parent is None else parent.scopes
        if tag in _SCOPES:
            self.scopes = self.scopes | dict.fromkeys(_SCOPES[tag], self)
        self.holds = False  # an article or main element lies inside
        self.within = tag in ("article", "main") or parent is not None and parent.within  # it is one or lies in one
        self.score = 0.0


def _attributes(text: str) -> dict[str, str]:
    if not text or "=" not in text and "hidden" not in text:
        return {}
    return {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(text)}


def _step(tag: str, marks: dict[str, str]) -> str:
    """Tag with its classes in order, digits generalised."""
    names = sorted(set(_DIGITS.sub("#", marks.get("class", "").lower().replace(">", " ")).split()))
    return ".".join([tag, *names])


def _side_kind(tag: str, marks: dict[str, str], in_article: bool) -> int:
    """2: never text; 1: side matter by its names, unless it holds the article; 0: none. An article's own header is part of it."""
    if tag in _DROPPED and not (in_article and tag == "header"):
        return 2
    if not marks:
        return 0
    style = marks.get("style", "").replace(" ", "").lower()
    if "hidden" in marks or "display:none" in style or marks.get("aria-hidden") == "true":
        return 2
    if tag in ("body", "html", "article", "main"):
        return 0
    parts = _PARTS.findall(_WRAPPER.sub("", f"{marks.get('class', '')} {marks.get('id', '')}".lower()))
    side = (_SIDE | _READERS).intersection(parts) - ({"header"} if in_article else set())
    return int(bool(side) or marks.get("role", "").lower() in _SIDE_ROLES)


class Page:
    """The blocks of a page, each with its element and the share of link text, and the page's containers.

    Everything takes time linear in the page, also where tags are broken or nested without end.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[Element, str, int]] = []
        self.containers: list[Element] = []
        self.kept: list[tuple[Element, str, int]] | None = None
        self.paths: dict[tuple[int, str], int] = {}  # (path of the parent, step) -> path
        self._read(source)

    def _read(self, source: str) -> None:
        here = Element("", "", 0, None, 0)
        open_: dict[str, int] = {}
        parts: list[str] = []
        linked, in_link, scan, at = 0, 0, Scanner(source), 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
                if text:
                    self.blocks.append((here, text, linked))
                parts.clear()
            linked = 0

        def add(text: str) -> None:
            nonlocal linked
            if text:
                parts.append(text)
                if in_link:
                    linked += len(text)

        def close(top: Element) -> None:
            """End ``top`` and all elements open inside it."""
            nonlocal here
            while True:
                e, here = here, here.parent
                open_[e.tag] -= 1
                if e is top:
                    return

        while (found := scan.next()) is not None:
            begin, kind, tag, given = found
            add(source[at:begin])
            at = scan.at
            if kind == "skip":
                continue
            if kind == "data":
                add(html.escape(tag, quote=False))
                continue
            if kind == "end":
                if tag == "a":
                    in_link = 0
                if tag in _INLINE:
                    continue
                flush()
                if open_.get(tag):
                    up = here
                    while up.tag != tag:
                        up = up.parent
                    close(up)
                continue
            if tag == "a":
                in_link = 1
            if tag == "br":
                parts.append(" ")
            if tag in _INLINE:
                continue
            flush()
            if here.tag == "p":
                close(here)
            same = here.scopes.get(_KIND_OF.get(tag, ""))
            if same is not None and same.tag in _KINDS[_KIND_OF[tag]][0]:
                close(same)
            if tag in _VOID:
                continue
            marks = _attributes(given)
            step = _step(tag, marks)
            path = self.paths.setdefault((here.path, step), len(self.paths) + 1)
            here = Element(tag, step, path, here, 2 if here.side == 2 else _side_kind(tag, marks, here.within))
            open_[tag] = open_.get(tag, 0) + 1
            if tag in ("article", "main"):
                up = here.parent
                while up is not None and not up.holds:
                    up.holds = True
                    up = up.parent
            if tag in _CONTAINERS:
                self.containers.append(here)
            if tag in _RAW:  # nothing inside is markup
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = scan.at = end.start() if end else len(source)
        add(source[at:])
        flush()

    def text_blocks(self) -> list[tuple[Element, str, int]]:
        """Blocks outside side matter, whatever its size; all text of a page that is side matter as a whole by its names."""
        if self.kept is None:
            text = [b for b in self.blocks if b[0].side != 2]
            aside = self._lying(lambda e: e.side != 0 and not e.holds)
            self.kept = [b for b in text if not aside(b[0])] or text
        return self.kept

    @staticmethod
    def _lying(test: Callable[[Element], bool]) -> Callable[[Element], Element | None]:
        """The nearest element around (or itself) that passes a test; what was found is kept for all elements between."""
        known: dict[Element, Element | None] = {}

        def look(e: Element | None) -> Element | None:
            passed, found = [], None
            while e is not None and e not in known:
                passed.append(e)
                if test(e):
                    found = e
                    break
                e = e.parent
            else:
                found = known[e] if e is not None else None
            known.update(dict.fromkeys(passed, found))
            return found

        return look

    def best(self) -> Element | None:
        """The container with the highest score: block text without links, whole for the nearest, then halved."""
        for e in self.containers:
            e.score = 0.0
        for e, text, linked in self.text_blocks():
            weight, worth = 1.0, max(len(text) - 2 * linked, 0)
            up = e if e.tag in _CONTAINERS else e.around
            while up is not None and weight > 0.1:
                up.score += worth * weight
                weight /= 2
                up = up.around
        scored = [e for e in self.containers if e.score > 0]
        return max(scored, key=lambda e: e.score) if scored else None

    @staticmethod
    def path_of(e: Element) -> str:
        steps = []
        while e.parent is not None:
            steps.append(e.step)
            e = e.parent
        return "".join(f">{x}" for x in reversed(steps))

    def on(self, path: str | None) -> list[Element]:
        """The containers on the path that hold text besides links."""
        wanted = 0
        for step in (path or "").split(">")[1:]:
            wanted = self.paths.get((wanted, step), -1)
        if wanted <= 0:
            return []
        there = self._lying(lambda e: e.path == wanted)
        found = {there(e): None for e, text, linked in self.text_blocks() if len(text) > 2 * linked}
        return [e for e in found if e is not None and e.tag in _CONTAINERS]

    def whole(self, chosen: list[Element]) -> list[Element]:
        """For each the outermost container around it that is an article or main, has text of its own beside it, or holds
        several sections of which it is one; else itself."""
        own: set[Element] = set()
        seen: set[Element] = set()
        sections: dict[Element | None, int] = {}
        for e, text, linked in self.text_blocks():
            if len(text) > 2 * linked:
                up = e if e.tag in _CONTAINERS else e.around
                if up is not None:
                    own.add(up)
                while up is not None and up not in seen:
                    seen.add(up)
                    if up.tag == "section":
                        sections[up.around] = sections.get(up.around, 0) + 1
                    up = up.around
        tops: dict[Element, Element | None] = {}  # the outermost such container around an element
        for e in chosen:
            passed = []
            while e is not None and e not in tops:
                passed.append(e)
                e = e.around
            top = tops[e] if e is not None else None
            for x in reversed(passed):
                up = x.around
                if top is None and up is not None:
                    if up.tag in ("article", "main") or up in own or x.tag == "section" and sections.get(up, 0) > 1:
                        top = up
                tops[x] = top
        return [tops[e] or e for e in chosen]

    def text_of(self, chosen: list[Element]) -> str:
        """Blocks inside the containers in page order (of the whole page without any)."""
        some = set(chosen)
        inside = self._lying(lambda e: e in some)
        return "\n\n".join(text for e, text, _ in self.text_blocks() if not some or inside(e))


def host_of(url: str):
    """Host in lower case, without user and port; null without one."""
    found = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", F.lower(found))


def path_votes(df: DataFrame, page: str = "html") -> DataFrame:
    """host, path, votes: on how many of a host's pages the best container has the path; summed before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes: dict[tuple[str | None, str], int] = {}
        for batch in batches:
            for part in slices(batch, page):
                for host, source in zip(part.column("host").to_pylist(), texts_of(part, page).to_pylist()):
                    found = Page(source)
                    best = found.best()
                    if best is not None:
                        path = found.path_of(best)
                        votes[host, path] = votes.get((host, path), 0) + 1
                if len(votes) > 50_000:
                    yield _votes(votes)
                    votes = {}
        yield _votes(votes)

    return map_arrow(df.select("host", page), run, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def _votes(votes: dict) -> pa.RecordBatch:
    keys = list(votes)
    columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)] + [pa.array(list(votes.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["host", "path", "votes"])


def winning_paths(votes: DataFrame) -> DataFrame:
    """host, path with the most votes; the longer, then the smaller path breaks ties."""
    best = F.max(F.struct("votes", F.length("path").alias("n"), "path")).alias("best")
    return votes.groupBy("host").agg(best).select("host", F.col("best.path").alias("winning_path"))


BROADCAST_BYTES = 32 << 20  # winning paths up to this size go to every task
SALTS = 64  # copies of a host's path in the join beyond it


def with_winners(df: DataFrame, winners: DataFrame, spread: str) -> DataFrame:
    """Each page with its host's path. Pages only move where the paths are too many to broadcast, and then salted, so that
    a host with a large share of the pages is dealt to many tasks by the column ``spread``."""
    winners = checkpointed(winners)
    size = winners.agg(F.sum(F.octet_length("winning_path") + F.coalesce(F.octet_length("host"), F.lit(0)) + 32).alias("n")).first()["n"] or 0
    if size <= BROADCAST_BYTES:
        return null_safe_join(df, F.broadcast(winners), ["host"])
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = winners.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return null_safe_join(salted, copies, ["host", "__salt"]).drop("__salt")


def main_text(source: str, path: str | None) -> str:
    """Text of all containers on the path, else of the page's own best one, each with the text beside it (``Page.whole``)."""
    page = Page(source)
    own = page.best()
    there = page.on(path) or ([own] if own is not None else [])
    return page.text_of(page.whole(there))


def extract_pages(df: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """All columns of ``df`` but the page, with ``text``: the main text, empty if there is none.

    Null and empty pages give "". Pages without a host vote among themselves. Repeated rows vote each and give
    equal texts. A column called ``text`` is replaced.
    """
    df = df.drop("text", "winning_path", "host").withColumn("host", host_of(url))
    winners = winning_paths(path_votes(df, page))
    rows = with_winners(df, winners, url).drop("host")
    fields = [f for f in rows.schema.fields if f.name not in (page, "winning_path")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, page):
                texts = map(main_text, texts_of(part, page).to_pylist(), part.column("winning_path").to_pylist())
                names = [n for n in part.schema.names if n not in (page, "winning_path")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(list(texts), pa.string())], [*names, "text"])

    schema = rows.select(*[F.col(f"`{f.name}`") for f in fields], F.lit("").alias("text")).schema
    return map_arrow(rows, run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    out = extract_pages(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
