"""Main text of web pages by deducing each host's template from token equivalence classes.

A page is read as tokens: block elements named by their path (tags with their id and class), and the texts of blocks. For
each (host, token) Spark adds up the pages it occurs in and a fingerprint of its occurrence vector (how often on which
page), partially before the shuffle, so a host with a third of all pages is summed everywhere. Tokens of one host with
equal vectors are one equivalence class. Classes that occur once on at least half of the host's pages are valid; their
elements nest by path into the host's template. Between template elements lie the slots. The main slot is the template's
article element, else its deepest container, that holds more than half of the host's text outside of page furniture.

On each page the main slot's blocks are the text, without furniture inside it (navigation, forms, comments and the like,
by element, role, id and class) and without block texts that are template themselves. Pages whose host has no usable
template (a single page, or none that the template fits) fall back to their own ``article`` or ``main`` element, else to
the whole body without furniture.

What is furniture is decided by structure. Class words never make html, body, main or article furniture, and an element that they,
or a form, do mark is a wrapper instead if it holds the page's heading and other blocks; navigation, asides, headers and footers by
element or role never are. Only where nothing at all would be left, forms, then elements around other furniture, then all that is
not hidden count as text.

Pages are read in linear time and memory: a ``<`` that nothing closes costs one search, a page whose quotes do not close is read
without them, elements are numbered nodes, and as in browsers nesting counts up to a depth (deeper elements belong to the one above).

Defined cases: null html gives an empty text; a null or odd url counts as host ''; repeated rows are pages of their own;
unclosed and misnested elements close with their ancestors; a ``<`` that begins no tag is text; ``br`` is white space; long pages are
read whole; columns of the input under the names that are added are replaced, all but html stay; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.common import LONG, STRING, without
from remitlens.storage import stored

_OPEN = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)")
_ATTRIBUTES = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([A-Za-z][\w:-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
_SPACE = re.compile(r"\s+")
#: Elements whose content is not text of the page: those that HTML reads up to their end tag, and those that hold elements.
_RAW = frozenset(("script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"))
_SKIPPED = frozenset(("noscript", "template", "svg", "object", "select", "canvas", "audio", "video"))
#: Elements that end skipped ones which were left open.
_OUTSIDE = frozenset(("body", "main", "article", "h1"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul hr".split()
)
#: Blocks that end when one of the named ones begins beside them.
_ENDS = {
    "p": _BLOCK - {"html", "head", "body"},
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "head": frozenset(("body",)),
}
_FURNITURE = frozenset("nav aside footer header form button dialog menu search fieldset label input".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer "
    "masthead cookie cookies consent gdpr notice notices disclaimer comment comments reply replies respond discussion disqus share sharing social newsletter subscribe "
    "signup login related recommended recommendations popup modal overlay widget toolbar pager pagination skip copyright topbar".split()
)
_COMMENT_WORDS = frozenset("comment comments reply replies respond discussion disqus".split())
#: Furniture elements that may be wrappers around everything.
_FORMS = frozenset(("form", "fieldset", "label", "dialog"))
LEAST_SHARE = 0.5
#: Elements that class words never make furniture.
_NEVER_FURNITURE = frozenset(("html", "body", "main", "article"))
#: Blocks that a wrapper holds at least, the heading included.
WRAPPED = 3
#: Nesting that paths spell out, and characters of ids and classes that they show before they are shortened to a digest.
MOST_DEEP, MOST_NAMED = 512, 64
#: Block texts count as template if so many of the pages with the main slot have them, and enough of the slot varies.
FIXED_SHARE = 0.9
#: Main slots are elements that hold blocks, not blocks of text; ones around the innermost may hold this much of its text.
_CONTAINER = r"(?:^|>)(?:html|body|main|article|section|div|table|tbody|tr|td|center|fieldset)(?:[.#][^>]*)?$"
_ARTICLE, _PAGE = r"(?:^|>)(?:article|main)(?:[.#][^>]*)?$", r"(?:^|>)(?:html|body)(?:[.#][^>]*)?$"
MORE = 1.15


#: Kinds of furniture marks.
_NONE, _STRONG, _FORM, _WORD, _COMMENT = range(5)


def _words(attributes: str) -> tuple[str, int, bool]:
    """Suffix of the element's name for paths, what kind of furniture id, class or role call it, and whether it is hidden."""
    suffix, kind, hidden = "", _NONE, False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            parts = value.split()
            # Names with digits tend to be numbered; they do not tell elements of a template apart.
            suffix += "".join(("." if name == "class" else "#") + p for p in parts if not any(c.isdigit() for c in p))
            words = {w for p in parts for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", p).lower())}
            if kind != _STRONG and words & _FURNITURE_WORDS:
                kind = _COMMENT if kind == _COMMENT or words & _COMMENT_WORDS else _WORD
        elif name == "role" and value.strip().lower() in _FURNITURE_ROLES:
            kind = _STRONG
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
    suffix = suffix.replace(">", "")
    return (suffix if len(suffix) <= MOST_NAMED else f".{_digest(suffix):x}"), kind, hidden


class _Scanner:
    """Finds tags and comments in order, in time linear in the page."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes = page, page.rfind(">"), True

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(begin, end, element or '', whether it is an end tag, attributes) of the next one; the element is '' for comments."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), "", False, ""
            if at > self.last:  # nothing ends a tag any more
                at = page.find("<!--", at)
                if at < 0:
                    return None
                continue
            if m := _OPEN.match(page, at):
                rest = _ATTRIBUTES.match(page, m.end()) if self.quotes else None
                if rest is None:  # quotes that do not close; they are not searched for again
                    self.quotes = False
                end = rest.end() if rest else page.find(">", m.end()) + 1
                return at, end, m[2].lower(), bool(m[1]), page[m.end() : end - 1]
            if page[at + 1 : at + 2] in ("!", "?"):
                return at, page.find(">", at) + 1, "", False, ""
            at += 1
        return None


class Nodes:
    """Block elements of a page by path: node 0 is the page itself, parents come before their children."""

    def __init__(self) -> None:
        self.paths, self.parents, self.elements, self.depths, self.counts = [""], [0], [""], [0], [0]
        self.known: dict[tuple[int, str], int] = {}

    def child(self, parent: int, element: str, suffix: str) -> int:
        if self.depths[parent] >= MOST_DEEP:
            return parent
        name = element + suffix
        node = self.known.get((parent, name))
        if node is None:
            node = self.known[parent, name] = len(self.paths)
            self.paths.append(f"{self.paths[parent]}>{name}" if parent else name)
            self.parents.append(parent)
            self.elements.append(element)
            self.depths.append(self.depths[parent] + 1)
            self.counts.append(0)
        self.counts[node] += 1
        return node

    def inherited(self, holds: Callable[[int], bool]) -> list[bool]:
        """Of each node, whether it or one around it ``holds``."""
        out = [False] * len(self.paths)
        for node in range(1, len(out)):
            out[node] = out[self.parents[node]] or holds(node)
        return out


_HIDDEN = -1


class _Marks:
    """Furniture elements of a page. Mark 0 is none; a mark knows the one around it."""

    def __init__(self) -> None:
        self.kinds, self.around = [_NONE], [0]
        self.heading, self.by_article = -1, False
        self.headings: list[int] = []

    def new(self, around: int, kind: int) -> int:
        self.kinds.append(kind)
        self.around.append(around)
        return len(self.kinds) - 1

    def begins(self, element: str, mark: int) -> None:
        """Take note of headings: the page's is its first h1, else its first article."""
        if mark == _HIDDEN:
            return
        if element == "h1" and (self.heading < 0 or self.by_article):
            self.heading, self.by_article = mark, False
        elif element in ("main", "article") and self.heading < 0:
            self.heading, self.by_article = mark, True
        if element in ("h1", "h2", "h3"):
            self.headings.append(mark)

    def closed(self, texts: list[int]) -> list[bool]:
        """Of each mark, whether texts inside are furniture; ``texts`` are the innermost marks of the page's texts."""
        n = len(self.kinds)
        blocks, holds, titled, nests = [0] * n, [False] * n, [False] * n, [False] * n
        for mark in texts:
            if mark != _HIDDEN:
                blocks[mark] += 1
        if self.heading > 0:
            holds[self.heading] = True
        for mark in self.headings:
            titled[mark] = True
        for mark in range(n - 1, 0, -1):
            up, kind = self.around[mark], self.kinds[mark]
            nests[up] = True
            if kind != _STRONG:
                blocks[up] += blocks[mark]
                titled[up] |= titled[mark]
                holds[up] |= holds[mark] and not (kind == _COMMENT and self.by_article)

        def wrapper(mark: int) -> bool:
            kind = self.kinds[mark]
            if kind == _STRONG or blocks[mark] < WRAPPED:
                return False
            if kind == _FORM:
                return holds[mark] or titled[mark]
            return holds[mark] and not (kind == _COMMENT and self.by_article)

        open_marks = [not mark or wrapper(mark) for mark in range(n)]

        def inside() -> list[bool]:
            out = [False] * n
            for mark in range(1, n):
                out[mark] = out[self.around[mark]] or not open_marks[mark]
            return out

        found = inside()
        for also in (lambda m: self.kinds[m] == _FORM, lambda m: self.kinds[m] in (_WORD, _COMMENT) and nests[m], lambda m: True):
            if any(mark != _HIDDEN and not found[mark] for mark in texts):
                break
            open_marks = [now or also(mark) for mark, now in enumerate(open_marks)]
            found = inside()
        return found


def blocks(page: str) -> tuple[list[tuple[int, bool, str]], Nodes]:
    """Texts of a page as (node, furniture, text), and its block elements."""
    scanner, nodes, marks = _Scanner(page), Nodes(), _Marks()
    # Open elements: name, node, innermost mark, whether it is skipped; and where on the stack each name is.
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
    places: dict[str, list[int]] = defaultdict(list)
    marked: list[tuple[int, int, str]] = []
    parts: list[str] = []
    last_end: dict[str, int] = {}
    lower = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), page)
    at = 0

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                marked.append((stack[-1][1], stack[-1][2], text))

    def push(name: str, node: int, mark: int, skipped: bool) -> None:
        places[name].append(len(stack))
        stack.append((name, node, mark, skipped))

    def pop() -> None:
        places[stack.pop()[0]].pop()

    def close(name: str) -> None:
        if places[name]:
            depth = places[name][-1]
            while len(stack) > depth:
                pop()

    while found := scanner.next(at):
        begin, end, name, closing, attributes = found
        if begin > at and not stack[-1][3]:
            parts.append(page[at:begin])
        at = end
        if name in _RAW:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{name}\b", re.I).search(page, at)
                at = page.find(">", stop.end()) + 1 if stop else 0
                at = at or len(page)
        elif name == "br":
            parts.append("\n")
        elif name in _SKIPPED:
            if closing:
                if stack[-1][3]:
                    close(name)
            elif not attributes.endswith("/"):
                if name not in last_end:
                    last_end[name] = lower.rfind(f"</{name}")
                if at <= last_end[name]:  # one without an end tag further on holds nothing
                    push(name, stack[-1][1], stack[-1][2], True)
        elif name in _BLOCK:
            if stack[-1][3]:
                if closing:
                    if not places[name]:
                        continue
                    if stack[places[name][-1]][3]:
                        close(name)
                        continue
                elif name not in _OUTSIDE:
                    if name not in _VOID:
                        push(name, stack[-1][1], stack[-1][2], True)
                    continue
                while not closing and stack[-1][3]:
                    pop()
            flush()
            if closing:
                close(name)
            else:
                while name in _ENDS.get(stack[-1][0], ()):
                    pop()
                suffix, kind, hidden = _words(attributes)
                node = nodes.child(stack[-1][1], name, suffix)
                if name not in _VOID:
                    # The header of an article is its own, a page's is furniture.
                    own = name == "header" and (places["article"] or places["main"])
                    mark = stack[-1][2]
                    if name == "head" or (hidden and name not in ("html", "body")):
                        mark = _HIDDEN
                    elif mark != _HIDDEN:
                        if name in _FURNITURE and not own:
                            kind = _FORM if name in _FORMS and kind == _NONE else kind if name in _FORMS else _STRONG
                        elif name in _NEVER_FURNITURE and kind != _STRONG:
                            kind = _NONE
                        mark = marks.new(mark, kind) if kind else mark
                    marks.begins(name, mark)
                    push(name, node, mark, False)
    if at < len(page) and not stack[-1][3]:
        parts.append(page[at:])
    flush()
    closed = marks.closed([mark for _, mark, _ in marked])
    return [(node, mark == _HIDDEN or closed[mark], text) for node, mark, text in marked], nodes


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


_TOKENS = "host string, path string, text long, n_pages long, total long, vector long, chars long"


def tokens(pages: DataFrame) -> DataFrame:
    """Sums over the pages of a batch: (host, path, text, n_pages, total, vector, chars).

    ``text`` is null for elements and a digest for the texts of blocks. ``vector`` is the wrapping sum of a digest of
    each page with its count, so repeated rows do not cancel each other; ``chars`` is the text below an element outside of furniture, of a text its length on each page. Path '' counts the pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0, 0])

            def add(key: tuple, page: int, count: int, chars: int = 0) -> None:
                entry = sums[key]
                entry[0] += 1
                entry[1] += count
                entry[2] = (entry[2] + _digest(f"{page}:{count}") + (1 << 63)) % (1 << 64) - (1 << 63)
                entry[3] += chars

            for name, url, page in zip(*(batch.column(c).to_pylist() for c in ("host", "url", "html")), strict=True):
                number = _digest(f"{url}\n{page}")
                texts, nodes = blocks(page or "")
                times: dict[tuple[int, str], int] = defaultdict(int)
                clean: set[tuple[int, str]] = set()
                below = [0] * len(nodes.paths)
                for node, furniture, text in texts:
                    times[node, text] += 1
                    if not furniture:
                        clean.add((node, text))
                        below[node] += len(text)
                for node in range(len(below) - 1, 0, -1):
                    below[nodes.parents[node]] += below[node]
                add((name, "", None), number, 1, below[0])
                for node in range(1, len(below)):
                    add((name, nodes.paths[node], None), number, nodes.counts[node], below[node])
                for (node, text), count in times.items():
                    add((name, nodes.paths[node], _digest(text)), number, count, len(text) if (node, text) in clean else 0)
            columns = [[k[0] for k in sums], [k[1] for k in sums], [k[2] for k in sums], *([v[i] for v in sums.values()] for i in range(4))]
            kinds = (pa.string(), pa.string(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "path", "text", "n_pages", "total", "vector", "chars"])

    return pages.select(_host().alias("host"), "url", "html").mapInArrow(run, _TOKENS)


def _main_slot(chain: Column) -> Column:
    """The main slot; ``chain`` are the containers of most of the text, which nest, from the inside.

    An article or main element is the slot. Otherwise it is the innermost container, or one around it (not the body)
    that adds little, such as the heading.
    """
    own = F.filter(chain, lambda c: c["path"].rlike(_ARTICLE))
    start = F.get(F.when(F.size(own) > 0, own).otherwise(chain), F.lit(0))

    def outwards(now: Column, c: Column) -> Column:
        fits = (c["depth"] < now["depth"]) & ~now["path"].rlike(_ARTICLE) & ~c["path"].rlike(_PAGE) & (c["chars"] <= MORE * now["chars"])
        return F.when(fits, c).otherwise(now)

    return F.aggregate(chain, start, outwards)


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, fixed): the main slot's path, null where the host has none, and digests of template texts below it."""
    sums = tokens(pages).groupBy("host", "path", "text").agg(*[F.sum(c).alias(c) for c in ("n_pages", "total", "chars")], F.sum(F.col("vector").cast("decimal(20,0)")).alias("vector"))
    sums = stored(sums, "page-tokens")
    hosts = sums.where("path = ''").groupBy("host").agg(F.sum("n_pages").alias("pages"), F.sum("chars").alias("host_chars"))
    # Most tokens occur on one page only; they go before a host's tokens meet.
    own = sums.where("path <> '' AND n_pages >= 2").join(hosts, "host").where(F.col("n_pages") >= LEAST_SHARE * F.col("pages"))
    # An equivalence class is named by its vector; its members all occur on the same pages, equally often.
    classes = own.groupBy("host", "vector", "n_pages").agg(F.min(F.col("total") == F.col("n_pages")).alias("once"), F.collect_list(F.struct("path", "text", "chars")).alias("members"), F.first("host_chars").alias("host_chars"), F.first("pages").alias("pages"))
    members = classes.where("once").select("host", "host_chars", "pages", "n_pages", F.explode("members").alias("m")).select("host", "host_chars", "pages", "n_pages", "m.path", "m.text", "m.chars")
    holders = members.where(F.col("text").isNull() & (2 * F.col("chars") > F.col("host_chars")) & F.col("path").rlike(_CONTAINER))
    chain = F.reverse(F.sort_array(F.collect_list(F.struct(F.size(F.split("path", ">")).alias("depth"), "chars", "path", "n_pages"))))
    main = holders.groupBy("host").agg(chain.alias("chain")).select("host", _main_slot(F.col("chain")).alias("slot")).select("host", F.col("slot.path").alias("main"), F.col("slot.n_pages").alias("slots"))
    main = stored(main, "main-slots")
    inside = (F.col("path") == F.col("main")) | F.col("path").startswith(F.concat("main", F.lit(">")))
    length = F.col("chars") / F.col("n_pages")
    # What differs between pages, each text once, so that copies of an article do not count as pages that vary.
    slot_chars = sums.where("text IS NOT NULL").join(main, "host").where(inside).groupBy("host").agg(F.sum(length).alias("slot_chars"))
    texts = members.where("text IS NOT NULL").join(main, "host").where(inside & (F.col("n_pages") >= FIXED_SHARE * F.col("slots")))
    alike = texts.groupBy("host").agg(F.sum(length).alias("alike"), F.collect_set("text").alias("near"), F.collect_set(F.when(F.col("n_pages") == F.col("slots"), F.col("text"))).alias("all"), F.first("slots").alias("slots"))
    varies = F.col("slot_chars") - F.col("alike")
    # Texts that some pages lack could be those of copies beside few other pages; for them each page has to vary.
    chosen = F.when(2 * varies >= F.col("alike") * F.col("slots"), F.col("near")).when(varies >= F.col("alike"), F.col("all"))
    fixed = alike.join(slot_chars, "host").select("host", chosen.alias("fixed")).where("fixed IS NOT NULL")
    return main.drop("slots").join(fixed, "host", "left")


def main_text(page: str | None, main: str | None, fixed: frozenset[int]) -> str:
    texts, nodes = blocks(page or "")
    clean = [(node, text) for node, furniture, text in texts if not furniture]
    if main is not None:
        slot = nodes.inherited(lambda node: nodes.paths[node] == main)
        if inside := [t for node, t in clean if slot[node]]:
            return "\n".join(t for t in inside if not fixed or _digest(t) not in fixed)
    article = nodes.inherited(lambda node: nodes.elements[node] in ("article", "main"))
    return "\n".join([t for node, t in clean if article[node]] or [t for _, t in clean])


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with text and n_chars (columns of these names are replaced)."""
    found = stored(templates(pages), "templates")
    source = without(pages, "text", "n_chars", "_host", "_main", "_fixed")
    named = source.withColumn("_host", _host())
    joined = named.join(found.select(F.col("host").alias("_host"), F.col("main").alias("_main"), F.col("fixed").alias("_fixed")), "_host", "left").drop("_host")
    rest = [f for f in joined.schema if f.name not in ("html", "_main", "_fixed")]
    schema = T.StructType([*rest, T.StructField("text", STRING), T.StructField("n_chars", LONG)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("html", "_main", "_fixed")), strict=True)
            texts = [main_text(page, main, frozenset(fixed or ())) for page, main, fixed in rows]
            arrays = [*(batch.column(f.name) for f in rest), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(run, schema)
