"""HTML as an array of nodes, and selections on that array as Spark expressions.

One Arrow function turns a page into its nodes in document order; everything after
that (finding elements, cutting blocks, reading text and attributes) is Spark SQL.

A node is (pos, stop, up, tag, cls, attrs, text). `pos` counts nodes of the page,
descendants are the nodes with pos < p < stop, `up` is the parent's pos. Text sits in
nodes of its own with the tag '#text', script and style content in '#raw'.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip

NODE_TYPE = T.ArrayType(
    T.StructType()
    .add("pos", T.IntegerType())
    .add("stop", T.IntegerType())
    .add("up", T.IntegerType())
    .add("tag", T.StringType())
    .add("cls", T.ArrayType(T.StringType()))
    .add("attrs", T.MapType(T.StringType(), T.StringType()))
    .add("text", T.StringType())
)
_NODE = pa.struct(
    [
        ("pos", pa.int32()),
        ("stop", pa.int32()),
        ("up", pa.int32()),
        ("tag", pa.string()),
        ("cls", pa.list_(pa.string())),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
    ]
)
# elements without content, and elements a following sibling closes (HTML standard)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {
    "li": {"li"}, "p": {"p"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
}
_SCOPE = frozenset("ul ol table tbody dl select div section article body".split())


# a quote opens a value only behind =; elsewhere it is a character like others, as it is if it never closes
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]*|))*+)>""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|["']?([^\s>]+)))?""")
_RAW_END = {"script": re.compile("</script", re.I), "style": re.compile("</style", re.I)}


class _Nodes:
    """Nodes of a batch of pages, column by column; tolerates unclosed and stray tags."""

    def __init__(self):
        self.offsets = [0]
        self.missing = []
        self.pos, self.stop, self.up, self.tag, self.cls, self.attrs, self.text = ([] for _ in range(7))

    def add_page(self, html: str | None) -> None:
        self.missing.append(html is None)
        if html:
            self._read(html)
        self.offsets.append(len(self.pos))

    def _read(self, html: str) -> None:
        base = len(self.pos)
        open_nodes: list[tuple[int, str]] = []
        at, last = 0, html.rfind(">")
        while at < len(html):
            # nothing ends behind the last > but an open comment
            token = _TOKEN.search(html, at) if at <= last or html.find("<!--", at) >= 0 else None
            end = token.start() if token else len(html)
            if end > at:
                self._add(base, open_nodes, "#text", None, unescape(html[at:end]))
            if not token:
                break
            at = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                self._close(base, open_nodes, self._nearest(open_nodes, (name,), ()))
                continue
            if name in _CLOSED_BY:
                self._close(base, open_nodes, self._nearest(open_nodes, _CLOSED_BY[name], _SCOPE))
            place = self._add(base, open_nodes, name, token[3], None)
            if name in _RAW_END:
                close = _RAW_END[name].search(html, at)
                stop = close.start() if close else len(html)
                open_nodes.append((place, name))
                if stop > at:
                    self._add(base, open_nodes, "#raw", None, html[at:stop])
                at = stop
            elif name not in _VOID and not token[3].endswith("/"):
                open_nodes.append((place, name))
        self._close(base, open_nodes, 0)

    @staticmethod
    def _nearest(open_nodes, names, barriers) -> int:
        """Depth of the innermost open node with one of the names, not looking past a barrier."""
        for depth in range(len(open_nodes) - 1, -1, -1):
            if open_nodes[depth][1] in names:
                return depth
            if open_nodes[depth][1] in barriers:
                break
        return len(open_nodes)

    def _close(self, base, open_nodes, depth) -> None:
        here = len(self.pos) - base
        for place, _ in open_nodes[depth:]:
            self.stop[place] = here
        del open_nodes[depth:]

    def _add(self, base, open_nodes, tag, attributes, text) -> int:
        place = len(self.pos)
        names = {}
        if attributes and not attributes.isspace():
            for key, double, single, bare in _ATTRIBUTE.findall(attributes):
                value = double or single or bare
                names.setdefault(key.lower(), unescape(value) if "&" in value else value)
        self.pos.append(place - base)
        self.stop.append(place - base + 1)
        self.up.append(open_nodes[-1][0] - base if open_nodes else -1)
        self.tag.append(tag)
        self.cls.append(names["class"].split() if "class" in names else [])
        self.attrs.append(list(names.items()))
        self.text.append(text)
        return place

    def to_arrow(self) -> pa.Array:
        columns = [self.pos, self.stop, self.up, self.tag, self.cls, self.attrs, self.text]
        nodes = pa.StructArray.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _NODE)], fields=list(_NODE)
        )
        return pa.ListArray.from_arrays(pa.array(self.offsets, type=pa.int32()), nodes, mask=pa.array(self.missing, pa.bool_()))


# nodes that are held as Python objects at a time, about 1 KB each; a page is never cut
MOST_NODES = 20_000


def nodes_of_pages(pages: pa.Array, most: int = MOST_NODES) -> pa.Array:
    """Nodes of each page; they become Arrow arrays as soon as `most` of them are there."""
    done, found = [], _Nodes()
    for page in pages:
        found.add_page(page.as_py())
        if len(found.pos) >= most:
            done.append(found.to_arrow())
            found = _Nodes()
    return pa.concat_arrays([*done, found.to_arrow()])


@F.arrow_udf(NODE_TYPE)
def html_nodes(pages: pa.Array) -> pa.Array:
    """Nodes of each page, in Arrow batches; `session.SETTINGS` bound the bytes of a batch."""
    return nodes_of_pages(pages)


Match = Callable[[Column], Column]


def element(tag: str | None = None, cls: str | None = None, cls_like: str | None = None, attr: str | None = None, any_case: bool = False) -> Match:
    """Test for a node: tag, one class, part of the class attribute (in any case on request), presence of an attribute."""

    def test(node: Column) -> Column:
        out = node["tag"] == tag if tag else ~node["tag"].startswith("#")
        if cls:
            out = out & F.array_contains(node["cls"], cls)
        if cls_like:
            value = F.coalesce(F.try_element_at(node["attrs"], F.lit("class")), F.lit(""))
            out = out & F.contains(F.lower(value) if any_case else value, F.lit(cls_like))
        if attr:
            out = out & F.map_contains_key(node["attrs"], attr)
        return out

    return test


def every(nodes: Column, match: Match) -> Column:
    return F.filter(nodes, match)


def first(nodes: Column, match: Match) -> Column:
    return F.get(F.filter(nodes, match), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def under(nodes: Column, node: Column) -> Column:
    """Descendants of a node. `nodes` may be a page or a block cut out of one."""
    start = F.get(nodes, F.lit(0))["pos"]
    return let(node, lambda n: F.slice(nodes, n["pos"] - start + 2, F.greatest(n["stop"] - n["pos"] - 1, F.lit(0))))


def block(nodes: Column, node: Column) -> Column:
    """A node together with its descendants, in the same form as a page."""
    start = F.get(nodes, F.lit(0))["pos"]
    return let(node, lambda n: F.slice(nodes, n["pos"] - start + 1, F.greatest(n["stop"] - n["pos"], F.lit(0))))


def children(nodes: Column, node: Column, tag: str | None = None) -> Column:
    """Direct children of a node, of one tag on request."""

    def pick(n: Column) -> Column:
        return F.filter(under(nodes, n), lambda c: (c["up"] == n["pos"]) & ((c["tag"] == tag) if tag else F.lit(True)))

    return let(node, pick)


def child(nodes: Column, node: Column, tag: str, nth: int) -> Column:
    """The nth direct child with that tag, as in a positional path step tag[n]."""
    return F.get(children(nodes, node, tag), F.lit(nth - 1))


def walk(nodes: Column, node: Column, *steps: tuple[str, int]) -> Column:
    for tag, nth in steps:
        node = child(nodes, node, tag, nth)
    return node


def attribute(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def _joined(nodes: Column, node: Column, shown: Match) -> Column:
    def join(n: Column) -> Column:
        texts = F.filter(under(nodes, n), lambda t: t["tag"] == "#text")
        return F.when(n.isNotNull(), F.array_join(F.transform(texts, shown), ""))

    return let(node, join)


def text_of(nodes: Column, node: Column) -> Column:
    """Text of a node: its text nodes joined, then outer blanks removed."""
    return strip(_joined(nodes, node, lambda t: t["text"]))


def tight_text_of(nodes: Column, node: Column) -> Column:
    """Text of a node with every text node stripped before joining."""
    return _joined(nodes, node, lambda t: strip(t["text"]))


def with_nodes(pages: DataFrame, html: str = "html", out: str = "nodes") -> DataFrame:
    return pages.withColumn(out, html_nodes(F.col(html))).drop(html)


def explode_blocks(df: DataFrame, found: Column, nodes: str = "nodes", position: str = "position", out: str = "block") -> DataFrame:
    """One row per found node, holding only that node's part of the page."""
    picked = df.select(
        *[c for c in df.columns if c != nodes],
        F.posexplode(F.transform(found, lambda n: block(F.col(nodes), n))).alias(position, out),
    )
    return picked.withColumn(position, F.col(position) + 1)


def extract_rows(df: DataFrame, selectors: list[Match], nodes: str = "nodes", position: str = "position", out: str = "block") -> DataFrame:
    """Blocks of the first selector that finds anything on the page."""
    return explode_blocks(df, first_non_empty([every(F.col(nodes), s) for s in selectors]), nodes, position, out)


def first_non_empty(candidates: list[Column]) -> Column:
    found = candidates[-1]
    for candidate in reversed(candidates[:-1]):
        found = F.when(F.size(candidate) > 0, candidate).otherwise(found)
    return found
