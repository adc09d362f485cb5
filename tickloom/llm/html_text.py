"""Main text of web pages: subtrees that recur across a host's pages are removed.

A page is read into a tree of elements. Every block element gets a hash of its
tag, class and text; Spark counts on how many different pages of a host each
hash occurs (pages with the same main text count once, so copies of an article
do not make it a template). A subtree found on at least LEAST_PAGES pages, and on as many as the cube root of
the host's pages, belongs to a template of the site or of one of its sections
and is deleted. A paragraph or heading inside an article or main element counts
only where it recurs at the same place, for passages that articles share stay.
A page is joined with its own recurring hashes, never with those of its host.

What a page says about itself is used too: elements and class names for menus,
headers, footers, adverts, forms and comments are left out, and a page whose
article and main elements hold a third of its remaining text or more is read only there.

Reading takes time in proportion to the page: tags are found by their first
characters and closed by a scanner that looks for a missing end once.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import extended, sliced, texts, travels, unused, with_fields, written

travels(__name__)

LEAST_PAGES = 5

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements left out with all they hold: CODE has no elements in it, EMBEDDED may hold more of its own kind.
CODE = "script|style|textarea|title|iframe"
EMBEDDED = "template|noscript|svg|math|select|object|canvas|video|audio"
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
PASSAGES = frozenset("p h1 h2 h3 h4 h5 h6".split())
LEFT_OUT = frozenset("head nav footer aside form button menu dialog fieldset input label".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
HOLDS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
         "tr": frozenset(["table"]), "td": frozenset(["table"]), "th": frozenset(["table"])}
# Classes, ids and roles that name such parts, as a whole.
NAMES = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising banner promo "
    "sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login "
    "comment comments disqus replies reply respond share sharing social breadcrumb breadcrumbs pagination pager related "
    "recommended widget toolbar copyright masthead contentinfo complementary search".split()
)
# Those that also count as the first part of a longer name, before - or _.
FIRST_PARTS = frozenset(
    "nav navbar menu footer sidebar ad ads advert cookie cookies newsletter breadcrumb breadcrumbs pagination comments "
    "disqus".split()
)
# The start of a tag, and all of it where it holds no other < or >; a scanner reads the others.
_START = re.compile(r"""<(?:(!--)|([!?])|(/?)([a-zA-Z][\w:-]*)(?:((?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+)>)?)""")
_RAW = frozenset(f"{CODE}|{EMBEDDED}".split("|"))
_CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in CODE.split("|")}
_PAIRED = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])", re.I) for tag in EMBEDDED.split("|")}
_OPTIONS = re.compile(r"(?:\s*</?opt(?:ion|group)\b[^>]*>[^<]*)*", re.I)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


@dataclass
class Element:
    tag: str
    name: str = ""
    left_out: bool = False
    parts: list = field(default_factory=list)  # texts and elements in page order
    hash: int = 0
    place: int | None = None  # of a passage inside an article
    said: str = ""


def _named(attributes: str) -> tuple[str, bool]:
    found = " ".join(a or b or c for a, b, c in _NAME.findall(attributes))
    names = found.lower().split()
    out = any(n in NAMES or n.replace("_", "-").partition("-")[0] in FIRST_PARTS for n in names)
    return found, out or bool(_HIDDEN.search(attributes))


class _Tags:
    """Finds where tags end. A quote that never closes is searched for once; tags from there on end at the next >."""

    def __init__(self, page: str):
        self.page, self.last, self.plain_from = page, page.rfind(">"), len(page)

    def end(self, at: int) -> int:
        """The place of the > of the tag whose attributes begin at ``at``, or -1."""
        if at > self.last:
            return -1
        page, i = self.page, at
        while i <= self.last and at < self.plain_from:
            close = page.find(">", i)
            if close < 0:
                break
            quotes = [q for q in (page.find('"', i, close), page.find("'", i, close)) if q >= 0]
            if not quotes:
                return close
            ends = page.find(page[min(quotes)], min(quotes) + 1)
            if ends < 0:
                break
            i = ends + 1
        self.plain_from = min(self.plain_from, at)
        return page.find(">", at)


def _pairs(tags: _Tags, tag: str) -> dict[int, int]:
    """Start of each element with a closing tag of its own, and its end."""
    found, opened, at = {}, [], 0
    while m := _PAIRED[tag].search(tags.page, at):
        close = tags.end(m.end())
        if close < 0:
            break
        at = close + 1
        if not m[1]:
            if not (tag in ("svg", "math") and tags.page[close - 1] == "/"):
                opened.append(m.start())
        elif opened:
            found[opened.pop()] = at
    return found


def _end(tags: _Tags, tag: str, start: int, after: int, pairs: dict[str, dict[int, int]]) -> int:
    """Where an element that is left out ends; its start tag is from ``start`` to ``after``.

    Without a closing tag it is its start tag alone (and a select its options),
    only a script or style takes the rest of the page.
    """
    page = tags.page
    if tag in _CLOSING:
        closing = None if tag in pairs else _CLOSING[tag].search(page, after)
        if closing:
            return closing.end()
        pairs[tag] = {}
        return len(page) if tag in ("script", "style") else after
    if tag not in pairs:
        pairs[tag] = _pairs(tags, tag)
    end = pairs[tag].get(start, after)
    return _OPTIONS.match(page, end).end() if tag == "select" and end == after else end


class _Open:
    """The open elements, with a count by tag, so that a search for one that is not open costs nothing."""

    def __init__(self, root: Element):
        self.stack, self.count = [root], Counter()

    def push(self, e: Element) -> None:
        self.stack.append(e)
        self.count[e.tag] += 1

    def close(self, i: int) -> None:
        for e in self.stack[i:]:
            self.count[e.tag] -= 1
        del self.stack[i:]

    def any(self, tags: frozenset[str]) -> bool:
        return any(self.count[t] > 0 for t in tags)

    def ended_by(self, tag: str) -> None:
        """A closing tag ends the innermost element of its kind and all within."""
        if self.count[tag] > 0:
            i = len(self.stack) - 1
            while self.stack[i].tag != tag:
                i -= 1
            self.close(i)

    def before(self, tag: str) -> None:
        """End what an opening tag ends: a paragraph before a block, an item before the next one."""
        if tag in BLOCKS and self.count["p"] > 0:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == "p":
                    self.close(i)
                    break
                if self.stack[i].tag in BLOCKS:
                    break
        if tag in CLOSED_BY and self.any(CLOSED_BY[tag]):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in HOLDS.get(tag, ()):
                    break
                if self.stack[i].tag in CLOSED_BY[tag]:
                    self.close(i)
                    break


def parsed(page: str) -> Element:
    """The element tree; unclosed and stray tags are mended as browsers commonly do.

    A tag that never closes is text, but for one that the page breaks off in.
    """
    root = Element("html")
    opened, tags = _Open(root), _Tags(page)
    at = done = 0  # searched and taken up to here
    pairs: dict[str, dict[int, int]] = {}
    while m := _START.search(page, at):
        tag, attributes, close = (m[4] or "").lower(), "", -1
        if m[1]:
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        elif m[2]:
            end = page.find(">", m.end()) + 1 or len(page)
        elif m[5] is not None:
            end, attributes = m.end(), m[5]
            close = end - 1
        else:
            close = tags.end(m.end())
            if close < 0:
                at = page.find("<", m.end())
                if at >= 0:
                    continue
                at = end = len(page)
            else:
                end, attributes = close + 1, page[m.end() : close]
        if m.start() > done:
            opened.stack[-1].parts.append(html.unescape(page[done : m.start()]))
        at = done = end
        if close < 0:
            continue
        if m[3]:
            opened.ended_by(tag)
            continue
        if tag in _RAW:
            opened.stack[-1].parts.append(" ")
            at = done = _end(tags, tag, m.start(), end, pairs)
            continue
        opened.before(tag)
        name, out = _named(attributes) if attributes.strip() else ("", False)
        element = Element(tag, name, tag in LEFT_OUT or (out and tag not in ("html", "body", "main")))
        opened.stack[-1].parts.append(element)
        if tag not in VOID and not attributes.endswith("/"):
            opened.push(element)
    if done < len(page):
        opened.stack[-1].parts.append(html.unescape(page[done:]))
    return root


def _walk(root: Element) -> list[Element]:
    found, todo = [], [root]
    while todo:
        e = todo.pop()
        found.append(e)
        todo += [p for p in e.parts if isinstance(p, Element)]
    return found


def _placed(root: Element) -> None:
    """Mark passages of articles with their place: on the way down, which child each element is, from the nearer end."""
    todo = [(root, 0, False)]
    while todo:
        e, place, inside = todo.pop()
        if inside and e.tag in PASSAGES:
            e.place = place
        inside = inside or e.tag in ("article", "main")
        children = [p for p in e.parts if isinstance(p, Element)]
        for i, child in enumerate(children):
            nearer = i if 2 * i < len(children) else i - len(children)
            todo.append((child, (place * 1_000_003 + nearer) % (1 << 61) if inside else 0, inside))


def hashed(root: Element) -> list[Element]:
    """The block elements with text, each with its hash: tag, names and text of its subtree, a passage's place."""
    out = []
    _placed(root)
    for e in reversed(_walk(root)):  # children come before their parents
        said = "".join(p if isinstance(p, str) else p.said for p in e.parts)
        for p in e.parts:
            if not isinstance(p, str):
                p.said = ""  # now part of its parent's
        e.said = said
        if e.tag in BLOCKS and (text := " ".join(said.split())):
            place = "" if e.place is None else f"\0{e.place}"
            content = f"{e.tag}\0{e.name}\0{text}{place}"
            e.hash = xxhash.xxh3_64_intdigest(content.encode("utf-8", "surrogatepass")) - (1 << 63)
            out.append(e)
    return out


def _is_header(e: Element) -> bool:
    """A header is left out unless it holds the article's heading."""
    return e.tag == "header" and not any(x.tag == "h1" for x in _walk(e))


def main_text(root: Element, templates: frozenset[int] = frozenset()) -> str:
    """Blocks of the main part in page order, joined by line feeds.

    The main part is what article and main elements hold, if that is at least
    a third of all text that is not left out, else the whole page.
    """
    blocks, inside = _blocks(root, templates)
    marked = [b for b, i in zip(blocks, inside) if i]
    if 3 * sum(map(len, marked)) >= sum(map(len, blocks)):
        blocks = marked or blocks
    return "\n".join(blocks)


def _blocks(root: Element, templates: frozenset[int]) -> tuple[list[str], list[bool]]:
    """The blocks that are not left out, and whether an article or main element holds them."""
    blocks: list[str] = []
    inside: list[bool] = []
    current: list[str] = []
    depth = 0  # of open article and main elements

    def flush() -> None:
        text = " ".join("".join(current).split())
        if text:
            blocks.append(text)
            inside.append(depth > 0)
        current.clear()

    todo: list = [root]
    while todo:
        e = todo.pop()
        if isinstance(e, int):  # the end of a block
            flush()
            depth -= e
        elif isinstance(e, str):
            current.append(e)
        elif e.tag == "br":
            current.append(" ")
        elif e is not root and _dropped(e, templates):
            if e.tag in BLOCKS:
                flush()
        else:
            if e.tag in BLOCKS:
                flush()
                scope = int(e.tag in ("article", "main"))
                depth += scope
                todo.append(scope)
            todo += reversed(e.parts)
    flush()
    return blocks, inside


def _dropped(e: Element, templates: frozenset[int]) -> bool:
    return e.left_out or _is_header(e) or (e.hash in templates and e.tag not in ("html", "body"))


def host(url: Column) -> Column:
    """The host in lower case; a null url, or one without a host, is the host ''."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        hashes, pages = [], []
        for page in texts(batch, "_html"):
            root = parsed(page or "")
            hashes.append(list({e.hash for e in hashed(root) if not e.left_out}))
            pages.append(xxhash.xxh3_64_intdigest(main_text(root).encode("utf-8", "surrogatepass")) - (1 << 63))
        host, doc = (batch.column(batch.schema.get_field_index(c)) for c in ("_host", "_doc"))
        yield pa.RecordBatch.from_arrays(
            [doc, host, pa.array(pages, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))],
            names=["doc", "host", "page", "hashes"],
        )


def _doc(url: Column, page: Column) -> Column:
    return F.xxhash64(host(url), page)


def subtrees(pages: DataFrame) -> DataFrame:
    """(doc, host, page, hashes) of every row, written: doc stands for host and html, page for the main text."""
    url, page = F.col("url"), F.col("html")
    rows = pages.select(_doc(url, page).alias("_doc"), host(url).alias("_host"), page.alias("_html"))
    return written(rows.mapInArrow(_subtrees, "doc long, host string, page long, hashes array<long>"), "subtrees")


def templates(found: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, hash) of the subtrees that recur on enough pages of their host, written."""
    seen = found.select("host", "page", F.explode("hashes").alias("hash")).distinct()
    many = seen.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    sizes = found.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    kept = many.join(sizes, "host").where(F.col("n") >= F.cbrt("pages"))
    return written(kept.select("host", "hash"), "templates")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Every row of ``pages`` with ``text`` and ``n_chars``; columns so named are replaced.

    A null or empty html, and a page without main text, give the empty text.
    Copies of a page and repeated rows are extracted alike. Pages without a
    host form one host. An empty table gives an empty result.
    """
    found = subtrees(pages)
    own = found.select("doc", "host", F.explode("hashes").alias("hash"))
    doc, hashes = unused(pages, "doc", "hashes")
    # A page has at most as many of them as it has subtrees.
    own = own.join(templates(found, least_pages), ["host", "hash"]).groupBy(F.col("doc").alias(doc)).agg(
        F.collect_set("hash").alias(hashes)
    )
    marked = pages.withColumn(doc, _doc(F.col("url"), F.col("html")))
    rows = marked.join(own, doc, "left").select(*[f"`{c}`" for c in pages.columns], hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for page, recurring in zip(texts(batch, "html"), texts(batch, hashes)):
                root = parsed(page or "")
                if recurring:
                    hashed(root)
                out.append(main_text(root, frozenset(recurring or ())))
            new = {"text": pa.array(out, pa.string()), "n_chars": pa.array(map(len, out), pa.int64())}
            yield extended(batch.select([n for n in batch.schema.names if n != hashes]), new)

    return rows.mapInArrow(run, with_fields(pages.schema, text="string", n_chars="long"))
