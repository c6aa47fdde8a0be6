"""Main text of web pages by removing what recurs across the pages of a site.

Element subtrees are hashed, inside the main element too; Spark counts on how many
different pages of its host each one occurs, and subtrees that recur on many of them are
deleted before the main text is chosen from what is left.  Elements whose tag, role or
class says that they are not part of an article go as well, wherever they occur once only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkhunt.names import c
from sparkhunt.operators.lookup import lookup_join
from sparkhunt.session import cut_lineage, scratch_path

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never part of an article.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input iframe object embed svg canvas audio video dialog menu map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
#: Words of class and id that mark menus, notices, adverts, comments and the like.
MARKS = frozenset(
    "ad ads adsense adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent "
    "disclaimer disqus footer header masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend "
    "li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Tags that an opening tag ends when they are open in the same container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"}}
CONTAINERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
LINKED = frozenset(("a", "button", "label"))
PARAGRAPHS = frozenset(("p", "pre", "blockquote"))
#: Blocks of an article's own text, which articles may quote from each other.
FLOW = frozenset("address blockquote center details dir dl figure h1 h2 h3 h4 h5 h6 hgroup ol p pre table ul".split())
#: Items and cells, which mean something only within their list or table.
PARTS = frozenset("caption dd dt figcaption hr legend li summary tbody td tfoot th thead tr".split())
#: Characters from which text outside a paragraph counts as running text.
PROSE = 25
#: How a candidate is counted: wherever it stands, or by its place from the start or from
#: the end; flow blocks between others need a number of siblings that changes.
ANYWHERE, START, START_FLOW, END, END_FLOW = range(5)
#: Place of what is counted wherever it stands.
NOWHERE = 1 << 30
_SPACE = re.compile(r"\s+")
_MARK = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


class TreeBuilder(HTMLParser):
    """A forgiving tree of a page: unclosed and stray tags do no harm."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", {})
        self._open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end({"p"}, {"table", "td", "th", "li", "div", "article", "main", "section", "button"})
        if tag in ENDS:
            self._end(ENDS[tag], CONTAINERS[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        self._open[-1].kids.append(node)
        if tag not in VOID:
            self._open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _end(self, tags: set[str], until: set[str]) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag in tags:
                del self._open[i:]
                return
            if self._open[i].tag in until:
                return

    def handle_endtag(self, tag):
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag == tag:
                del self._open[i:]
                return

    def handle_data(self, data):
        self._open[-1].kids.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _walk(root: Node) -> list[tuple[Node, Node | None]]:
    """All nodes with their parents, parents first."""
    out, wait = [], [(root, None)]
    while wait:
        node, parent = wait.pop()
        out.append((node, parent))
        wait.extend((x, node) for x in reversed(node.kids) if isinstance(x, Node))
    return out


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attrs.get("role", "").lower() in ("main", "article")


def _marked(node: Node) -> bool:
    """Whether tag, role or class say that the element is not part of an article."""
    attrs = node.attrs
    if node.tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if attrs.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return True
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    return node.tag not in ("html", "body", "article", "main") and any(x.lower() in MARKS for x in _MARK.split(names)) or (
        node.tag == "article" and any(x.lower() in ("comment", "comments", "promo", "related", "advert") for x in _MARK.split(names))
    )


def _prune(root: Node) -> None:
    """Takes out what is marked as no part of an article, and page headers."""
    wait = [(root, False)]
    while wait:
        node, inside = wait.pop()
        inside = inside or _is_main(node)
        node.kids = [x for x in node.kids if not isinstance(x, Node) or not (_marked(x) or x.tag == "header" and not inside)]
        wait.extend((x, inside) for x in node.kids if isinstance(x, Node))


def _main_marks(nodes: list[tuple[Node, Node | None]]) -> tuple[dict[int, Node], set[int]]:
    """The outermost main element around each node inside one, and the nodes that hold one."""
    inside, above = {}, set()
    for node, parent in nodes:
        top = inside.get(id(parent)) or (parent if parent is not None and _is_main(parent) else None)
        if top is not None:
            inside[id(node)] = top
    for node, parent in reversed(nodes):
        if parent is not None and (_is_main(node) or id(node) in above):
            above.add(id(parent))
    return inside, above


def _digest(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def candidates(nodes: list[tuple[Node, Node | None]], page: int) -> tuple[dict[int, dict], dict[int, list[int]], dict[int, int]]:
    """What is counted: (candidates by unit, numbers of the candidates by node, number of each outermost main element).

    A candidate is a subtree at a place; its number in the page is even where the place
    does not matter.

    A unit is the page, or the content of an outermost main element; equal units count
    once.  Outside the main elements, every element that holds text counts wherever it
    stands, if it holds no main element; so do link blocks inside one.  The other blocks
    inside a main element count by their place among their siblings, from the start and
    from the end, so that a passage that articles quote here and there stays; so do items
    and cells outside of one, which mean something only within their list or table (inside
    one they are no candidates).  Words within a line of text are no candidates; a link
    that ends it, or any element outside a main element, is one at that place.
    """
    inside, above = _main_marks(nodes)
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}
    digest: dict[int, int] = {}
    for node, _ in reversed(nodes):
        n = m = 0
        parts = [f"<{node.tag} {node.attrs.get('class', '')}>"]
        for kid in node.kids:
            if isinstance(kid, Node):
                n, m = n + chars[id(kid)], m + linked[id(kid)]
                parts.append(f"#{digest[id(kid)]}")
            else:
                n += len(kid.strip())
                parts.append(_SPACE.sub(" ", kid).strip())
        chars[id(node)], linked[id(node)] = n, n if node.tag in LINKED else m
        digest[id(node)] = _digest(*parts)
    units: dict[int, dict] = {}
    found: dict[int, list[int]] = {}
    tops: dict[int, int] = {}
    numbers: dict[tuple[int, int], int] = {}

    def add(node: Node, kinds: list[tuple[int, int]], siblings: int = 0) -> None:
        top = inside.get(id(node))
        own = digest[id(node)] if top is None else _digest("in", str(digest[id(node)]))
        unit = units.setdefault(page if top is None else digest[id(top)], {})
        found[id(node)] = []
        for kind, place in kinds:
            at = numbers.setdefault((own, place), 2 * len(numbers) + (kind != ANYWHERE))
            # a unit may hold a candidate several times
            one = unit.setdefault(at, {"at": at, "own": own, "place": place, "kind": kind, "low": siblings, "high": siblings})
            one["kind"], one["low"], one["high"] = min(one["kind"], kind), min(one["low"], siblings), max(one["high"], siblings)
            found[id(node)].append(at)

    for node, _ in nodes:
        line, spoken, lines = 0, set(), []
        for kid in node.kids:
            breaks = isinstance(kid, Node) and (kid.tag in BLOCKS or kid.tag == "br")
            line += breaks
            if kid_chars := chars[id(kid)] if isinstance(kid, Node) else len(kid.strip()):
                lines.append((kid, kid_chars, line))
            if isinstance(kid, str) and any(map(str.isalnum, kid)):
                spoken.add(line)
            line += breaks
        beside = any(isinstance(x, Node) and x.tag in BLOCKS for x, _, _ in lines)
        for i, (kid, kid_chars, at) in enumerate(lines):
            if isinstance(kid, str) or id(kid) in above and id(kid) not in inside and not _is_main(kid) or kid.tag in ("html", "body"):
                continue
            if (outside := id(kid) not in inside) and _is_main(kid):
                add(kid, [(ANYWHERE, NOWHERE)])
                tops[id(kid)] = found.pop(id(kid))[0]
                continue
            links, last = 2 * linked[id(kid)] >= kid_chars, i == len(lines) - 1
            if kid.tag not in BLOCKS and at in spoken:
                if links or outside:  # the first of these is only counted, since its siblings never change
                    add(kid, [(START_FLOW, i), (END, -1)] if last else [(START_FLOW, i)])
            elif links or outside and kid.tag not in PARTS:
                add(kid, [(ANYWHERE, NOWHERE)])
            elif outside or kid.tag not in PARTS and (kid.tag in BLOCKS or beside):
                flow = kid.tag in FLOW
                add(kid, [(START_FLOW if flow and i else START, i), (END_FLOW if flow and not last else END, i - len(lines))], len(lines))
    return units, found, tops


def read_page(html: str) -> tuple[list[dict], list[dict]]:
    """(units with their candidates, blocks of text) of a page.

    Elements that are marked as something else than an article are left out.  A block has
    the number of the outermost main element it lies in (``top``, or None), whether it is a
    paragraph (``para``), and pieces with the numbers of the candidates each lies ``under``.
    """
    root = parse(html)
    _prune(root)
    units, found, tops = candidates(_walk(root), _digest(html))
    return [{"unit": k, "found": list(v.values())} for k, v in units.items()], _text_blocks(root, found, tops)


def _text_blocks(root: Node, found: dict[int, list[int]], tops: dict[int, int]) -> list[dict]:
    blocks: list[dict] = []
    held: list[dict] = []

    def flush(top, para):
        if any(not x["text"].isspace() for x in held):
            blocks.append({"top": top, "para": para, "pieces": held.copy()})
        held.clear()

    wait: list = [(root, (), None, False)]
    while wait:
        item, under, top, para = wait.pop()
        if item is None:
            flush(top, para)
        elif isinstance(item, str):
            held.append({"text": item, "under": under})
        else:
            if item.tag in BLOCKS or id(item) in tops:
                flush(top, para)
                wait.append((None, (), tops.get(id(item), top), para or item.tag in PARAGRAPHS))
            inner_top, inner_para = tops.get(id(item), top), para or item.tag in PARAGRAPHS
            under = (*under, *found.get(id(item), ()))
            if item.tag == "br":
                held.append({"text": " ", "under": under})
            wait.extend((x, under, inner_top, inner_para) for x in reversed(item.kids))
    flush(None, False)
    return blocks


def _left(block: dict, templates: set[int] | frozenset[int]) -> str:
    pieces = [x["text"] for x in block["pieces"] if not templates or templates.isdisjoint(x["under"])]
    return _SPACE.sub(" ", "".join(pieces)).strip()


def join_blocks(blocks: list[dict], templates: set[int] | frozenset[int] = frozenset()) -> str:
    """The main text: what lies under no template, blocks with an empty line between.

    Of what is left of the page, the main elements are taken unless more running text
    (paragraphs, and other blocks of ``PROSE`` characters) stands outside of them; then
    all of it is.  Where templates at places would leave less than a quarter of the
    blocks and of the text of a main element, it is a changed copy of other articles
    rather than a story with notices, and they stay.
    """
    anywhere = frozenset(x for x in templates if not x & 1)
    texts: list[str] = []
    of_top: dict[int | None, list[int]] = {}
    for i, block in enumerate(blocks):
        texts.append(_left(block, templates))
        of_top.setdefault(block["top"], []).append(i)
    for top, mine in of_top.items():
        if top is not None and len(anywhere) < len(templates):
            whole = {i: _left(blocks[i], anywhere) for i in mine}
            n, size = sum(map(bool, whole.values())), sum(map(len, whole.values()))
            if 4 * sum(bool(texts[i]) for i in mine) < n and 4 * sum(len(texts[i]) for i in mine) < size:
                for i in mine:
                    texts[i] = whole[i]
    inner = outer = 0
    for block, text in zip(blocks, texts, strict=True):
        weight = len(text) if block["para"] or len(text) >= PROSE else 0
        inner, outer = (inner, outer + weight) if block["top"] is None else (inner + weight, outer)
    if outer > inner:
        out = [t for b, t in zip(blocks, texts, strict=True) if t and b["top"] not in templates]
    else:
        mains = any(t and b["top"] is not None for b, t in zip(blocks, texts, strict=True))
        out = [t for b, t in zip(blocks, texts, strict=True) if t and (b["top"] is not None or not mains)]
    # a lone surrogate, which a character reference may give, is not text
    return "\n\n".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def main_text(html: str, templates: set[int] | frozenset[int] = frozenset()) -> str:
    return join_blocks(read_page(html)[1], templates)


def _rows(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(k, v) for k, v in fields.items()]))


_LONG, _INT = T.LongType(), T.IntegerType()
_BLOCKS = _rows(top=_INT, para=T.BooleanType(), pieces=_rows(text=T.StringType(), under=T.ArrayType(_INT)))
_UNITS = _rows(unit=_LONG, found=_rows(at=_INT, own=_LONG, place=_INT, kind=_INT, low=_INT, high=_INT))


def read_pages(pages: DataFrame) -> DataFrame:
    """Replaces ``html`` by ``units`` and ``blocks``; parses once."""
    kept = [x for x in pages.schema.fields if x.name != "html"]
    schema = T.StructType([*kept, T.StructField("units", _UNITS), T.StructField("blocks", _BLOCKS)])
    arrow = to_arrow_schema(schema)
    ready = pages.select(*[x.name for x in kept], "html")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [read_page(x) for x in part.column("html").to_pylist()]
            for x in (x for _, blocks in found for block in blocks for x in block["pieces"]):
                x["text"] = x["text"].encode("utf-8", "replace").decode() if not x["text"].isascii() else x["text"]
            made = [pa.array([x[i] for x in found], arrow.field(name).type) for i, name in enumerate(("units", "blocks"))]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], schema.names)

    return ready.mapInArrow(run, schema)


def _group() -> Column:
    return F.xxhash64("host", "x.own")


def site_templates(read: DataFrame, least_pages: int = 5) -> DataFrame:
    """(group, place): the subtrees that recur on a host; a group is a subtree of a host.

    ``read`` has ``host`` and ``units``.  A candidate is a template where it occurs in at
    least ``least_pages`` different units, however many pages the host has.  One that
    counts by its place must also stand there in more than half of the units that hold it;
    and a flow block between others is one only if the number of its siblings changes,
    since the place says nothing otherwise.
    """
    units = read.select("host", F.explode("units").alias("u")).select("host", "u.*").dropDuplicates(["host", "unit"])
    rows = units.select("host", F.explode("found").alias("x")).select(_group().alias("group"), "x.place", "x.kind", "x.low", "x.high")
    by_place = rows.groupBy("group", "place").agg(F.count(F.lit(1)).alias("n"), F.min("kind").alias("kind"), F.min("low").alias("low"), F.max("high").alias("high"))
    # a group has one row here for each place it was seen at
    first = F.when(F.col("kind").isin(START, START_FLOW), F.col("n")).otherwise(0)
    counted = by_place.withColumn("all", F.sum(first).over(Window.partitionBy("group"))).where(F.col("n") >= least_pages)
    fixed = F.col("kind").isin(START, END) | (F.col("low") < F.col("high"))
    return counted.where((F.col("kind") == ANYWHERE) | (2 * F.col("n") > F.col("all")) & fixed).select("group", "place")


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_pages: int = 5) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    A null page is an empty one and gives an empty text; rows without a host form a site
    of their own; repeated rows are repeated; broken markup is read as far as it makes
    sense; an empty table gives no row; other columns are not read.  Pages are parsed
    once; their blocks are kept, and the pieces under templates left out of the text.
    """
    host = F.lower(F.coalesce(F.try_parse_url(c(url), F.lit("HOST")), F.lit("")))
    rows = pages.select(c(key).alias("key"), c(url).alias("url"), host.alias("host"), F.coalesce(c(html), F.lit("")).alias("html"))
    path = scratch_path(pages.sparkSession, "pages")
    read = read_pages(rows).withColumn("row", F.monotonically_increasing_id())
    read.write.option("compression", "zstd").parquet(path)
    read = pages.sparkSession.read.schema(read.schema).parquet(path)
    templates = cut_lineage(site_templates(read, least_pages))
    # a host may have any number of templates: each row gets those it holds, no host a list
    own = read.select("row", "host", F.explode(F.flatten("units.found")).alias("x")).select("row", _group().alias("group"), "x.place", "x.at")
    held = lookup_join(own, templates, ["group", "place"], "inner")
    lists = cut_lineage(held.groupBy("row").agg(F.collect_set("at").alias("templates")))
    joined = lookup_join(read.select("row", "key", "url", "blocks"), lists, "row").select("key", "url", "blocks", "templates")
    schema = T.StructType([T.StructField(key, pages.schema[key].dataType), T.StructField(url, pages.schema[url].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names

    def texts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [join_blocks(b, frozenset(t or ())) for b, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names)

    return joined.mapInArrow(texts, schema)
