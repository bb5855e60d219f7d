"""HTML as a table of elements, its components, and the CSS rules that match them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize, spread, table

#: Elements without content, and those that end where the next of their kind (or their parent) does.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IMPLIED_END = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
BLOCKS = frozenset("address article aside blockquote div dl footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

#: Elements whose content is text without tags, entities decoded.
DECODED = ("textarea", "title")

ELEMENTS = (
    "page_id long, node_id int, parent_id int, last_id int, depth int, levels int, tag string, attrs map<string,string>, classes array<string>, start int, size int, text_start int, text_size int, text string, "
    "line int, last_line int, at int, head int, bytes int, inner int, closed boolean, text_at int, text_bytes int, label_at int, label_bytes int"
)
NAMES = [f.split()[0] for f in ELEMENTS.split(", ")]
#: What a row with a negative node_id is: the page's text, its text with each piece stripped, and a line of its layout.
TEXT, LABELS, LINE = -1, -2, -3
#: Characters of markup after which a task sends on the rows it holds.
HELD = 4_000_000
#: Runs of what counts as space in a text.
TEXT_SPACE = r"(?U)[\s\x1c-\x1f]+"


class Tree(HTMLParser):
    """Elements of a document in order; open ones are closed where HTML implies it.

    An element knows where its markup starts and ends, where the document's text and labels (the text, each piece stripped)
    are in it, the number of its last descendant, and the first and last of its lines: a line is a tag, a piece of text, a
    comment or a declaration. So what a tree holds grows with the document alone.
    """

    CDATA_CONTENT_ELEMENTS = (*HTMLParser.CDATA_CONTENT_ELEMENTS, *DECODED)

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.source, self.nodes, self.open, self.open_tags = html, [], [], Counter()
        self.pieces: list[str] = []
        self.labels: list[str] = []
        self.told: list[tuple] = []  # lines that aren't tags: line, parent, depth, kind, text
        self.chars = self.text_bytes = self.label_bytes = self.lines = 0
        self.starts = [0, *accumulate(len(line) + 1 for line in html.split("\n"))]
        self.feed(html)
        self.close()
        while self.open:
            self.end(len(html))

    def place(self) -> int:
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def end(self, at: int, printed: bool = True) -> None:
        node = self.open.pop()
        self.open_tags[node["tag"]] -= 1
        node.update(end=at, text_size=self.chars - node["text_start"], text_bytes=self.text_bytes - node["text_at"], label_bytes=self.label_bytes - node["label_at"], last=len(self.nodes) - 1)
        if printed:
            node["last_line"] = self.lines
            self.lines += 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        closes = IMPLIED_END.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        while self.open and self.open[-1]["tag"] in closes:
            self.end(self.place())
        n, start = len(self.nodes), self.place()
        source = self.get_starttag_text() or ""
        head = start + len(source)
        node = {"id": n, "last": n, "parent": self.open[-1]["id"] if self.open else None, "depth": len(self.open), "tag": tag, "attrs": {k: v or "" for k, v in attrs}, "start": start, "head": head, "end": head, "closed": source.endswith("/>"), "line": self.lines, "last_line": self.lines}
        node |= {"text_start": self.chars, "text_size": 0, "text_at": self.text_bytes, "text_bytes": 0, "label_at": self.label_bytes, "label_bytes": 0}
        self.lines += 1
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if self.open and self.open[-1] is self.nodes[-1]:
            self.end(self.nodes[-1]["end"], printed=False)

    def handle_endtag(self, tag: str) -> None:
        if not self.open_tags[tag]:
            return
        after = self.source.find(">", self.place()) + 1 or len(self.source)
        while self.open:
            last = self.open[-1]["tag"] == tag
            self.end(after if last else self.place())
            if last:
                return

    def handle_data(self, data: str) -> None:
        kind = self.open[-1]["tag"] if self.open else ""
        data = unescape(data) if kind in DECODED else data
        self.pieces.append(data)
        self.chars += len(data)
        self.text_bytes += len(data.encode())
        if label := data.strip():
            self.labels.append(label)
            self.label_bytes += len(label.encode())
            self.tell("#raw" if kind in HTMLParser.CDATA_CONTENT_ELEMENTS else "#text", label, len(self.open))

    def tell(self, kind: str, text: str, depth: int) -> None:
        self.told.append((self.lines, self.open[-1]["id"] if self.open else None, depth, kind, text))
        self.lines += 1

    def handle_comment(self, data: str) -> None:
        self.tell("#comment", f"<!--{data}-->", len(self.open))

    def handle_decl(self, decl: str) -> None:
        self.tell("#decl", f"<!{decl}>", 0)


def byte_places(text: str) -> np.ndarray | None:
    """Where each character of a text begins in its UTF-8 bytes, and the end; None where that is the character's own number."""
    if text.isascii():
        return None
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.r_[0, np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))]


def rows_of(page: int, html: str) -> Iterator[tuple]:
    """A page's rows, as `parsed` describes them."""
    tree, places = Tree(html), byte_places(html)
    levels = len(tree.nodes).bit_length()
    byte = (lambda i: i) if places is None else lambda i: int(places[i])
    for n in tree.nodes:
        at, head, end, inner = byte(n["start"]), byte(n["head"]), byte(n["end"]), None
        if n["tag"] in HTMLParser.CDATA_CONTENT_ELEMENTS:
            close = html.rfind("</", n["head"], n["end"])
            inner = byte(close if close >= 0 else n["end"]) - head
        yield (
            page, n["id"], n["parent"], n["last"], n["depth"], levels, n["tag"], list(n["attrs"].items()), n["attrs"].get("class", "").split(), n["start"], n["end"] - n["start"], n["text_start"], n["text_size"], None,
            n["line"], n["last_line"], at, head - at, end - at, inner, n["closed"], n["text_at"], n["text_bytes"], n["label_at"], n["label_bytes"],
        )
    none = (None,) * 11
    yield page, TEXT, *(None,) * 11, "".join(tree.pieces), *none
    yield page, LABELS, *(None,) * 11, "".join(tree.labels), *none
    for line, parent, depth, kind, text in tree.told:
        yield page, LINE, parent, None, depth, None, kind, *(None,) * 6, text, line, line, *(None,) * 9


def parsed(pages: DataFrame) -> DataFrame:
    """A row per element; rows with a negative node_id hold the page's text, its labels and its lines. Null and empty html has none.

    start and size say which characters of the page are an element's markup, text_start and text_size which of the
    page's text are its own and its descendants'; last_id is the last descendant's node_id (or its own), levels how
    many binary digits the number of the page's elements has. at, bytes, text_at, text_bytes, label_at and label_bytes say
    the same in UTF-8 bytes, which can be cut without counting characters; head is the size of the start tag, inner that of a
    script's or style's content, closed whether the start tag ends itself. line and last_line are those of the start tag and
    of the end tag. Neither markup nor text is repeated at each depth.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ints = [pa.int32()] * 5
        types = [pa.int64(), *ints, pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), *ints[:4], pa.string(), *ints, pa.int32(), pa.bool_(), *ints[:4]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=NAMES)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for page, html in zip(*(c.to_pylist() for c in batch.columns)):
                if not html:
                    continue
                rows += rows_of(page, html)
                held += len(html)
                if held >= HELD:
                    yield batch_of(rows)
                    rows, held = [], 0
        yield batch_of(rows)

    return pages.select("page_id", "html").mapInArrow(parse, ELEMENTS)


class Elements:
    """The element table of pages: parsed once, written, and read by all who need a part of it.

    nodes: a row per element, as `parsed` describes. page_id tells pages apart. A page's markup, text or labels meet its
    elements once, as an array, and are cut by bytes: nothing is carried along with each element.
    """

    def __init__(self, pages: DataFrame):
        self.pages = pages.select("page_id", "html")
        stored = materialize(parsed(spread(self.pages)))
        self.nodes = stored.where("node_id >= 0").drop("text")
        self.texts = stored.where(f"node_id = {TEXT}").select("page_id", F.col("text").cast("binary").alias("whole"))
        self.labels = stored.where(f"node_id = {LABELS}").select("page_id", F.col("text").cast("binary").alias("whole"))
        self.told = stored.where(f"node_id = {LINE}").select("page_id", "line", "depth", F.col("parent_id"), F.col("tag").alias("kind"), "text")

    def cut(self, found: DataFrame, whole: DataFrame, name: str, at: str, size: str) -> DataFrame:
        """found with the bytes at..at+size of its page's whole (page_id, whole) as text, in a column called name."""
        columns = [c for c in found.columns if c != name]
        grouped = found.groupBy("page_id").agg(F.collect_list(F.struct(*(c for c in columns if c != "page_id"))).alias("_rows"))
        piece = lambda r: F.substring(F.col("whole"), r[at] + 1, r[size]).cast("string")
        met = grouped.join(whole, "page_id").select("page_id", F.explode(F.transform("_rows", lambda r: F.struct(r.alias("r"), piece(r).alias("t")))).alias("_cut"))
        return met.select(*(F.col(c) if c == "page_id" else F.col("_cut.r").getField(c).alias(c) for c in columns), F.col("_cut.t").alias(name))

    def with_text(self, found: DataFrame) -> DataFrame:
        """Elements with their text, each run of space as one."""
        return self.cut(found, self.texts, "text", "text_at", "text_bytes").withColumn("text", F.trim(F.regexp_replace("text", TEXT_SPACE, " ")))

    def with_label(self, found: DataFrame) -> DataFrame:
        """Elements with the pieces of their text, each stripped, joined."""
        return self.cut(found, self.labels, "label", "label_at", "label_bytes")

    def with_markup(self, found: DataFrame, name: str = "outer_html", at: str = "at", size: str = "bytes") -> DataFrame:
        """Elements with their markup, or another part of the page."""
        return self.cut(found, self.pages.select("page_id", F.col("html").cast("binary").alias("whole")), name, at, size)

    def lines(self, tags: DataFrame | None = None, raw: Callable[[Column], Column] | None = None, drop: str | None = None) -> DataFrame:
        """page_id, lines: each page's lines in order (line, depth, text): a tag, a piece of text, a comment or a declaration.

        tags (page_id, node_id, new) have other start tags for some elements; raw rewrites what stands in styles; comments
        that match drop have no text.
        """
        starts = self.with_markup(self.nodes.select("page_id", "node_id", "line", "last_line", "depth", "at", "head"), "old", "at", "head")
        if tags is not None:
            starts = starts.join(tags.select("page_id", "node_id", "new"), ["page_id", "node_id"], "left")
        shown = F.coalesce("new", "old") if tags is not None else F.col("old")
        name = F.regexp_extract("old", r"^<([^\s/>]+)", 1)
        both = F.array(F.struct("line", "depth", shown.alias("text")), F.when(F.col("last_line") > F.col("line"), F.struct(F.col("last_line").alias("line"), "depth", F.concat(F.lit("</"), name, F.lit(">")).alias("text"))))
        of_tags = starts.select("page_id", F.explode(F.array_compact(both)).alias("l"))
        told = self.told
        if raw is not None:
            styles = self.nodes.where("tag = 'style'").select("page_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("_style"))
            told = told.join(styles, ["page_id", "parent_id"], "left").withColumn("text", F.when(F.col("_style"), raw(F.col("text"))).otherwise(F.col("text")))
        text = F.when(F.col("kind") == "#text", F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))).otherwise(F.col("text"))
        if drop:
            text = F.when((F.col("kind") == "#comment") & F.col("text").rlike(drop), F.lit("")).otherwise(text)
        of_texts = told.select("page_id", F.struct("line", "depth", text.alias("text")).alias("l"))
        return of_tags.unionByName(of_texts).groupBy("page_id").agg(F.array_sort(F.collect_list("l")).alias("lines"))


def laid_out(lines: Column, margin: Column | None = None) -> Column:
    """Lines as text, a space deeper for each open element (beyond margin); a run of blank lines is one, those without text go."""
    shown = F.transform(F.filter(lines, lambda l: l["text"] != ""), lambda l: F.concat(F.repeat(F.lit(" "), l["depth"] - margin if margin is not None else l["depth"]), l["text"]))
    return F.regexp_replace(F.array_join(shown, "\n"), r"\n\s*\n", "\n\n")


# fixed values: type: which elements, and the lengths of their laid-out markup that count
COMPONENTS = {
    "headers": ("tag = 'header' or (tag = 'div' and exists(classes, c -> lower(c) rlike 'header|nav'))", "length(outer_html) > 100"),
    "footers": ("tag = 'footer' or (tag = 'div' and exists(classes, c -> lower(c) rlike 'footer'))", "length(outer_html) > 100"),
    "sections": ("tag = 'section'", "length(outer_html) > 200"),
    "hero": ("tag in ('div', 'section') and exists(classes, c -> lower(c) rlike 'hero|banner|mv|main-visual')", "length(outer_html) > 200"),
    "buttons": ("tag in ('button', 'a') and exists(classes, c -> lower(c) rlike 'btn|button')", "length(outer_html) > 50"),
    "navigation": ("tag = 'nav'", "length(outer_html) > 100"),
    "cards": ("tag in ('div', 'article') and exists(classes, c -> lower(c) rlike 'card|item|product|post')", "length(outer_html) > 200 and length(outer_html) < 2000"),
    "forms": ("tag = 'form'", "length(outer_html) > 100"),
    "typography": ("tag rlike '^h[1-6]$'", "length(outer_html) > 50"),
}
#: Buttons and headings stand within their parent, if its markup is shorter than this.
SHORT_PARENT = 500


def components(elements: Elements, layout: bool = False) -> DataFrame:
    """page_id, type, ord, node_id, root_id, root_last, html: the first of each markup within a page and type, in document order.

    root_id is the element whose markup stands in html (the parent, where that is shown), root_last its last
    descendant. With layout, markup is laid out before sizes and repetitions count; header elements stay as written.
    """
    nodes = elements.nodes
    place = ("node_id", "last_id", "at", "bytes", "depth", "line", "last_line")
    kinds = F.array_compact(F.array(*(F.when(F.expr(test), F.lit(name)) for name, (test, _) in COMPONENTS.items())))
    typed = nodes.select("page_id", "parent_id", "tag", "size", *place, F.explode(kinds).alias("type"))
    parents = nodes.where(F.col("size") < SHORT_PARENT).select("page_id", F.col("node_id").alias("parent_id"), F.struct(*place).alias("parent"))
    found = typed.join(parents, ["page_id", "parent_id"], "left")
    root = F.when(F.col("type").isin("buttons", "typography") & F.col("parent").isNotNull(), F.col("parent")).otherwise(F.struct(*place))
    found = found.withColumn("root", root).select("page_id", "type", "node_id", "tag", F.col("root.node_id").alias("root_id"), F.col("root.last_id").alias("root_last"), "root.at", "root.bytes", "root.depth", "root.line", "root.last_line")
    found = elements.with_markup(found)
    if layout:
        packed = found.groupBy("page_id").agg(F.collect_list(F.struct(*(c for c in found.columns if c != "page_id"))).alias("_rows")).join(elements.lines(), "page_id")
        own = lambda r: F.slice(F.col("lines"), r["line"] + 1, r["last_line"] - r["line"] + 1)
        shown = lambda r: F.when(r["tag"] == "header", r["outer_html"]).otherwise(laid_out(own(r), r["depth"]))
        found = packed.select("page_id", F.explode(F.transform("_rows", lambda r: F.struct(r.alias("r"), shown(r).alias("outer_html")))).alias("_c"))
        found = found.select("page_id", *(F.col("_c.r").getField(c).alias(c) for c in ("type", "node_id", "root_id", "root_last")), F.col("_c.outer_html").alias("outer_html"))
    fits = F.coalesce(*(F.when(F.col("type") == name, F.expr(size)) for name, (_, size) in COMPONENTS.items()))
    first = F.row_number().over(Window.partitionBy("page_id", "type", "md5").orderBy("node_id"))
    kept = found.where(fits).withColumn("md5", F.md5("outer_html")).withColumn("first", first).where("first = 1")
    ordinal = F.row_number().over(Window.partitionBy("page_id", "type").orderBy("node_id"))
    return kept.select("page_id", "type", ordinal.alias("ord"), "node_id", "root_id", "root_last", F.col("outer_html").alias("html"))


CSS_RULES = "page_id long, rule_ord int, selector string, media string, body string"


def rules_of(css: str) -> list[tuple[str, str, str]]:
    """selector, enclosing at-rule and body of each rule, brackets balanced, comments gone."""
    text, out = [], []
    rest = css
    while "/*" in rest:
        before, _, after = rest.partition("/*")
        text.append(before)
        rest = after.partition("*/")[2]
    text = "".join(text) + rest
    at, media = 0, []
    while at < len(text):
        brace, close = text.find("{", at), text.find("}", at)
        if close >= 0 and (brace < 0 or close < brace):
            at = close + 1
            if media:
                media.pop()
            continue
        if brace < 0:
            break
        selector = text[at:brace].rpartition(";")[2].strip()
        if selector.startswith("@") and not selector.startswith(("@font-face", "@page")):
            media.append(selector)
            at = brace + 1
            continue
        depth, end = 1, brace + 1
        while end < len(text) and depth:
            depth += (text[end] == "{") - (text[end] == "}")
            end += 1
        out.append((selector, " ".join(media), text[brace + 1 : end - 1 if not depth else end].strip()))
        at = end
    return out


def css_rules(sheets: DataFrame) -> DataFrame:
    """page_id, rule_ord, selector, media, body of each rule of sheets (page_id, css)."""

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            for page, css in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(page, i, *rule) for i, rule in enumerate(rules_of(css or ""))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["page_id", "rule_ord", "selector", "media", "body"])

    return sheets.select("page_id", "css").mapInArrow(parse, CSS_RULES)


def below(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Each root's row (page_id, root_id, root_last and more) beside the elements in its subtree, itself included.

    A subtree is a run of node_ids. It falls into at most two blocks of each power of two; an element is in one block
    of each. So both meet by equality, however deep or wide a page is, and each pair once.
    """
    dealt = nodes.withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("levels")))).withColumn("_block", F.expr("shiftright(node_id, _level)"))
    wide = roots.withColumn("_level", F.explode(F.expr("sequence(0, cast(log2(root_last - root_id + 1) as int))")))
    wide = wide.withColumn("_lo", F.expr("shiftright(root_id + shiftleft(1, _level) - 1, _level)")).withColumn("_hi", F.expr("shiftright(root_last + 1, _level)"))
    blocks = F.expr("explode(array_compact(array(if(_lo & 1 = 1, _lo, null), if(_hi & 1 = 1, _hi - 1, null))))")
    return dealt.join(wide.where("_lo < _hi").withColumn("_block", blocks).drop("_lo", "_hi"), ["page_id", "_level", "_block"]).drop("_level", "_block")


def component_css(nodes: DataFrame, parts: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, type, ord, rule_ord of the rules that match a component, by equality of a class, id or tag.

    The elements of a component are those below its root: an equi-join. Their tokens and the selectors'
    meet in another. Rules of :root that define a variable which a matched rule uses come too.
    """
    tokens = F.array_union(F.array_union(F.transform("classes", lambda c: F.concat(F.lit("."), c)), F.array(F.col("tag"))), F.array_compact(F.array(F.concat(F.lit("#"), F.col("attrs")["id"]))))
    inside = below(nodes.select("page_id", "node_id", "levels", tokens.alias("tokens")), parts.select("page_id", "type", "ord", "root_id", "root_last")).select("page_id", "type", "ord", F.explode("tokens").alias("token")).distinct()
    names = F.expr(r"regexp_extract_all(selector, '(^|[\\s>+~,(])([a-z][a-z0-9]*)|([.#][A-Za-z_][A-Za-z0-9_-]*)', 0)")
    named = rules.withColumn("token", F.explode(F.transform(names, lambda x: F.regexp_replace(x, r"^[\s>+~,(]+", ""))))
    matched = inside.join(named, ["page_id", "token"]).select("page_id", "type", "ord", "rule_ord", "body").distinct()
    used = matched.select("page_id", "type", "ord", F.explode(F.expr(r"regexp_extract_all(body, 'var\\((--[A-Za-z0-9_-]+)', 1)")).alias("name"))
    defined = rules.where("contains(selector, ':root')").select("page_id", "rule_ord", F.explode(F.expr(r"regexp_extract_all(body, '(--[A-Za-z0-9_-]+)\\s*:', 1)")).alias("name"))
    roots = used.join(defined, ["page_id", "name"]).select("page_id", "type", "ord", "rule_ord")
    return matched.select("page_id", "type", "ord", "rule_ord").unionByName(roots).distinct()


def html_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all elements: of their markup in the page, and of their text in the page's text."""
    return parsed(spread(table(spark, sf_dir, "pages"))).where("node_id >= 0").select("page_id", "node_id", "parent_id", "last_id", "depth", "tag", "classes", "start", "size", "text_start", "text_size")


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spread(table(spark, sf_dir, "pages"))).where("node_id >= 0").groupBy("tag").agg(F.count("*").alias("n"), F.max("depth").alias("deepest"))


def page_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, n_elements, first_tags: how many elements a page has, and the names of the first ten."""
    nodes = parsed(spread(table(spark, sf_dir, "pages"))).where("node_id >= 0")
    early = F.collect_list(F.when(F.col("node_id") < 10, F.struct("node_id", "tag")))
    return nodes.groupBy("page_id").agg(F.count("*").alias("n_elements"), F.array_join(F.array_sort(early)["tag"], " ").alias("first_tags"))


QUERIES = {"html_elements": html_elements, "tag_counts": tag_counts, "page_outline": page_outline}
