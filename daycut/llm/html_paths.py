"""Main-text extraction by consensus host paths.

Pass 1 scores the containers of every page (text length, link share, depth)
and reports the best ones as generalised tag-class paths (digits in classes
become ``0``; positions are dropped).  Spark adds up the votes per host and
path.  Pass 2 extracts each page anew with the winning paths of its host, the
first one that the page has; a page that has none of them uses its own best
container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .textkit import blocks

#: Elements whose content is never main text, elements without
#: content, elements that begin a block, and words of class, id and role that
#: mark boilerplate.
DROP = frozenset("script style noscript template button select textarea input iframe object embed svg canvas video "
                 "audio head title dialog menu map".split())
#: Elements that go unless they hold the page's ``main``; a form stays like a
#: labelled element (some sites wrap whole pages in one).
FRAME = frozenset("nav header footer aside form".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
_NOISE = (r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|alert|popup|modal|"
          r"newsletter|subscribe|nav\w*|menu|breadcrumbs?|sidebar|side|aside|widget|footer|header|masthead|"
          r"topbar|toolbar|comments?|replies|disqus|respond|share|sharing|social|related|"
          r"recommend\w*|pagination|pager|login|signup|search|skip|copyright|legal|gdpr|toc)")
#: Words beside them that say only where or how.
_PLACE = (r"(?:site|main|global|left|right|top|bottom|primary|secondary|container|wrap|wrapper|inner|outer|box|bar|block|"
          r"list|links?|items?|buttons?|icons?|area|region|group|panel|col|column|row|unit|slot|zone|form|title|posts?|"
          r"articles|\d+(?:x\d+)?)")
_SEP = "[_-]+"
#: A whole class or id that marks boilerplate.
NOISE = re.compile(rf"(?:(?:post|entry|article|story|page){_SEP}(?!header))?(?:{_PLACE}{_SEP})*{_NOISE}"
                   rf"(?:{_SEP}(?:{_NOISE}|{_PLACE}))*", re.I)
#: Elements whose id is a label; those of others are often made from a heading.
LABELLED = frozenset("div ul ol table td".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
CONTAINER = frozenset("article main section div td body".split())
#: An opening tag of the first kind ends an open element of the second.
ENDS = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
        "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Paths a page votes for, and paths a host keeps.
VOTES = 3
KEPT = 3
#: Bytes of all hosts' winners up to which they are sent to every task, measured
#: before; beyond it each host's pages are dealt over ``SALTS`` parts.
SENT_BYTES = 16 << 20
SALTS = 32

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*)>?"
                    r"|<[!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def attributes(text: str) -> dict[str, str]:
    """Attributes of an opening tag by name; of a repeated name the first."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


def noisy(tag: str, attrs: dict[str, str]) -> bool:
    """Whether class, id, role or a hiding attribute say that the element is
    boilerplate."""
    if tag in ("html", "body", "article", "main"):
        return False
    if attrs.get("role", "").lower() in NOISE_ROLE or attrs.get("aria-hidden", "").lower() == "true" or "hidden" in attrs:
        return True
    names = attrs.get("class", "").split()
    ids = attrs.get("id", "").split() if tag in LABELLED and "section" not in names else []
    return any(NOISE.fullmatch(x) for x in names + ids)


class _Mark:
    """An element that may be boilerplate, and what it holds: signs of text
    that is not in links, ``main`` and ``article`` elements."""

    __slots__ = ("parent", "strict", "text", "main", "articles", "gone")

    def __init__(self, parent: "_Mark | None", strict: bool = False) -> None:
        self.parent, self.strict, self.text, self.main, self.articles, self.gone = parent, strict, 0, 0, 0, False


class _Node:
    """A container.  Its path is that of its parent and its own name; paths are
    numbered, so a deep page needs no long strings."""

    __slots__ = ("tag", "depth", "path", "parent", "mark", "own", "links", "first", "last")

    def __init__(self, tag: str, path: int, parent: "_Node | None", first: int, mark: _Mark | None) -> None:
        self.tag, self.path, self.parent, self.first, self.last, self.mark = tag, path, parent, first, first, mark
        self.depth = parent.depth + 1 if parent else 1
        self.own = self.links = 0      # signs of text, and those in links


class _Paths:
    """Numbers of the container paths of one page."""

    def __init__(self) -> None:
        self._ids: dict[tuple[int, str], int] = {}
        self._names: list[tuple[int, str, int]] = [(-1, "", 0)]     # parent, name, length

    def of(self, parent: int, name: str) -> int:
        got = self._ids.setdefault((parent, name), len(self._names))
        if got == len(self._names):
            self._names.append((parent, name, self._names[parent][2] + len(name) + 1))
        return got

    def text(self, path: int) -> str:
        parts = []
        while path > 0:
            path, name, _ = self._names[path]
            parts.append(name)
        return "".join(f"/{x}" for x in reversed(parts))

    def find(self, text: str) -> int | None:
        """The number of a path text, if the page has it."""
        for path, (_, name, size) in enumerate(self._names):
            if path and size == len(text) and text.endswith(name) and self.text(path) == text:
                return path
        return None


def _raw_end(text: str, tag: str, at: int) -> int:
    found = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(text, at)
    return found.end() if found else len(text)


def parse(page: str) -> tuple[list[str], list[_Node], _Paths]:
    """Blocks of a page in order, without boilerplate, its containers, paths.

    A container knows the range of blocks it covers.  Unclosed elements end
    with the element around them; a stray closing tag is ignored.  A frame
    element (``FRAME``) and one labelled as boilerplate go at the end, unless
    they turned out to hold the page's ``main`` or (forms and labelled elements
    alone) its only ``article`` or, with none of these outside it, most of the
    text that is not in links.  Time and memory grow with the page, however
    deep its elements nest.
    """
    raw: list[tuple[list, _Node | None]] = []
    pending: list[tuple[str, _Mark | None, bool]] = []   # text, mark around it, in a link
    nodes: list[_Node] = []
    stack: list[tuple[str, _Node | None, bool, _Mark | None]] = []     # tag, container, dropped, mark around it
    open_tags: dict[str, int] = {}
    open_blocks: list[int] = []    # their places on the stack
    whole = _Mark(None)            # the page
    marks: list[_Mark] = []
    paths = _Paths()
    here: _Node | None = None
    mark: _Mark | None = None
    skip = links = 0               # open dropped elements, open links

    def flush() -> None:
        if pending:
            raw.append((pending.copy(), here))
            pending.clear()

    def close() -> None:
        nonlocal here, skip, links, mark
        tag, node, dropped, around = stack.pop()
        open_tags[tag] -= 1
        if tag in BLOCK:
            open_blocks.pop()
            flush()
        if node is not None:
            node.last = len(raw)
            here = node.parent
        mark = around
        skip -= dropped
        links -= tag == "a"

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[2] is None:
            if not skip and (m[0][0] != "<" or m[0] == "<"):
                pending.append((m[0], mark, links > 0))
                if not links:
                    (mark or whole).text += len(" ".join(m[0].split()))
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags.get(tag):
                while stack[-1][0] != tag:
                    close()
                close()
            continue
        while stack and tag in ENDS.get(stack[-1][0], ()):
            close()
        if (tag == "p" or tag in BLOCK and tag != "br") and open_blocks and stack[open_blocks[-1]][0] == "p":
            # inline elements left open inside a paragraph end with it
            depth = open_blocks[-1]
            while len(stack) > depth:
                close()
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        attrs = attributes(m[3])
        dropped = tag in DROP
        if tag in ("script", "style", "noscript", "template", "textarea", "title", "iframe"):
            at = _raw_end(page, tag, at)
            continue
        if m[0].endswith("/>") and tag in ("svg", "path", "use"):
            continue
        node, around = None, mark
        if not skip and not dropped:
            if tag == "main":
                (mark or whole).main += 1
            elif tag == "article":
                (mark or whole).articles += 1
            labelled = noisy(tag, attrs)
            if labelled or tag in FRAME:
                mark = _Mark(mark or whole, not labelled and tag != "form")
                marks.append(mark)
            if tag in CONTAINER:
                name = re.sub(r"\d+", "0", ".".join([tag, *sorted(attrs.get("class", "").lower().split())]))
                node = _Node(tag, paths.of(here.path if here else 0, name), here, len(raw), mark)
                nodes.append(node)
                here = node
        skip += dropped
        links += tag == "a"
        if tag in BLOCK:
            open_blocks.append(len(stack))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        stack.append((tag, node, dropped, around))
    while stack:
        close()
    flush()
    for x in reversed(marks):      # inner before outer
        x.parent.text += x.text
        x.parent.main += x.main
        x.parent.articles += x.articles
    for x in marks:                # outer before inner
        other = whole.main or whole.articles > x.articles       # the page says that its text is elsewhere
        holds = x.main or not x.strict and not other and (x.articles == 1 or 2 * x.text > whole.text)
        x.gone = not holds or x.parent.gone
    done: list[str] = []
    place = [0]
    for parts, node in raw:
        parts = [(t, a) for t, x, a in parts if x is None or not x.gone]
        line = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if line:
            done.append(line)
            if node is not None:
                node.own += len(line)
                node.links += min(sum(len(t) for t, a in parts if a), len(line))
        place.append(len(done))
    for node in reversed(nodes):   # inner before outer
        if node.parent is not None:
            node.parent.own += node.own
            node.parent.links += node.links
    nodes = [n for n in nodes if n.mark is None or not n.mark.gone]
    for node in nodes:
        node.first, node.last = place[node.first], max(place[node.last], place[node.first])
    return done, nodes, paths


def score(node: _Node) -> float:
    """Text that is not in links, with a bonus for the elements that say so
    and, among nested containers, for the inner one."""
    weight = {"article": 3.0, "main": 2.0, "section": 1.1, "div": 1.05, "td": 1.0, "body": 0.8}[node.tag]
    return weight * max(node.own - 2 * node.links, 0) * (1 + 0.01 * node.depth)


def best_paths(page: str, votes: int = VOTES) -> list[tuple[str, float]]:
    """The page's best container paths with their share of its score."""
    _, nodes, paths = parse(page)
    by: dict[int, float] = {}
    for node in nodes:
        by[node.path] = by.get(node.path, 0.0) + score(node)
    least = sorted((v for v in by.values() if v > 0), reverse=True)[:votes][-1:]
    top = sorted(((v, paths.text(p)) for p, v in by.items() if least and v >= least[0]), key=lambda x: (-x[0], x[1]))[:votes]
    total = sum(v for v, _ in top)
    return [(p, v / total) for v, p in top]


def extract(page: str, wanted: list[str]) -> tuple[str, str]:
    """Text of the first of the ``wanted`` paths the page has text at, and that
    path.

    All containers of the path count, in page order; nested ones once.
    """
    lines, nodes, paths = parse(page)
    for text in wanted:
        path = paths.find(text)
        ranges = sorted((n.first, n.last) for n in nodes if n.path == path and n.own) if path else []
        if ranges:
            out, upto = [], 0
            for lo, hi in ranges:
                out += lines[max(lo, upto):hi]
                upto = max(upto, hi)
            return "\n".join(out), text
    best = max(nodes, key=lambda n: (score(n), -n.first), default=None)
    if best is not None and best.own:
        return "\n".join(lines[best.first:best.last]), paths.text(best.path)
    return "\n".join(lines), ""


def host(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url_col: str, html_col: str, kept: int = KEPT) -> DataFrame:
    """Votes per host: ``host``, ``paths`` (winners first, at most ``kept``).

    Votes are summed before they move, so a host of very many pages is a few
    rows a task.  Ties go to the path that sorts first.
    """
    rows = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            out = [(h, p, s) for h, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())
                   for p, s in best_paths(page or "")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                 pa.array([round(x[2] * 1000) for x in out], pa.int64())], ["host", "path", "votes"])

    votes = rows.mapInArrow(vote, "host string, path string, votes long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"))
    rank = Window.partitionBy("host").orderBy(F.col("votes").desc(), "path")
    return (votes.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= kept)
            .groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rank", "path"))).alias("top"))
            .select("host", F.col("top.path").alias("paths")))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page by its host's winning paths.

    Returns a row per page: ``id``, ``url``, ``text``, ``path`` (where the text
    was found, empty if no container has any).  Null or empty html gives an
    empty text; a null url belongs to the host of empty name.  Repeated rows
    get equal results each; an empty table gives no rows; other columns are
    ignored.
    """
    winners = checkpointed(host_paths(pages, url_col, html_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host(F.col(url_col)).alias("host"))
    size = winners.agg(F.sum(F.length("host") + F.length(F.array_join("paths", "")) + 64)).first()[0] or 0
    if size <= SENT_BYTES:                                  # pages stay where they are
        rows = rows.join(F.broadcast(winners), "host", "left")
    else:
        parts = winners.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS))).join(parts, ["host", "salt"], "left")
    rows = rows.select("id", "url", "html", "paths")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            got = [extract(page or "", paths or []) for page, paths in
                   zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.string())], ["id", "url", "text", "path"])

    return rows.mapInArrow(run, f"id {kind}, url string, text string, path string")
