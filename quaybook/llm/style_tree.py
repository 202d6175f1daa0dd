"""Main text of web pages by a site style tree.

Pages of one host are merged into a style tree. A node is an element path
with its presentation (tag, class and id); on each page it has a style (the
sequence of its children) and, near the leaves, content.

* A node's presentation importance is the entropy of its styles over the
  host's different pages, its content importance that of its texts, both
  relative to the number of pages that have it: templates repeat themselves, articles
  don't. Nodes that too few pages have (``MIN_PAGES``) are important.
* A branch whose own node has low importance both ways is noise and removed
  from every page of the host.
* What no repetition can show (a menu that differs from page to page) is told
  by its presentation: elements that HTML or common class names reserve for
  navigation, headers, footers, asides, forms, adverts, notices and comments
  are removed. A name counts as a whole; it removes neither the only article
  of a page nor most of its text, and inside an article only names that can't
  belong to one count, and a header stays. And the article element is never noise.

The tree is built by aggregation over the different pages of a host: rows with
the same nodes and text are copies and count as one page, so a group of copies
is no template. Each task sends the nodes of its different pages with digests
of their styles and texts, and counts per digest are summed before entropies.
Nothing about a host is gathered in one task but its list of noise paths.

Each page is parsed once: its text parts are written with the path of their
node, and when the noise paths of its host are known (a join that Spark
broadcasts if its size allows), the parts below them are left out and the
others joined. Blocks of text are separated by an empty line.

Null and empty html gives an empty text; null urls belong to one host of their
own. Repeated rows are extracted one by one. An empty input gives an empty
result.
"""

from __future__ import annotations

import functools
import html as entities
import itertools
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quaybook.llm.common import pick, prepare
from quaybook.plans.stages import write_stage

MIN_PAGES = 8
LEAST_IMPORTANCE = 0.3  # of 1: relative entropy below which a node repeats itself
MARKED, DROP = 1, 2  # what makes a node noise by presentation: its names, its tag

# What HTML and common practice reserve for parts outside the article.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
DROPPED = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "option", "head", "menu", "dialog",
                     "svg", "canvas", "object", "audio", "video", "label", "fieldset")) | RAW
BLOCKS = frozenset(("address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "figcaption",
                    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li", "main", "ol", "p", "pre", "section",
                    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption")) | DROPPED
ENDS_P = BLOCKS - {"body", "html"}
# A class or id marks noise only if all its hyphenated parts do, or qualify
# those that do: "site-nav" does, "with-sidebar" and "search-results" don't.
NOISE_WORDS = frozenset((
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget widgets ad ads banner cookie cookies "
    "consent popup modal overlay newsletter subscribe signup share sharing social pagination pager toolbar skip "
    "comment comments reply replies respond disqus").split())
#: These can also name a part of an article, so they mark nothing inside one.
OUTSIDE_WORDS = frozenset("header notice alert login search discussion related recommended copyright legal disclaimer".split())
REPLY_WORDS = frozenset("comment comments reply replies respond disqus discussion".split())
NOISE_START = re.compile(r"(?:advert|sponsor|promo)\w*")
QUALIFIERS = frozenset("site main top bottom left right primary secondary global area list links link item items slot unit bar box".split())
MOST, MOST_REPLIES = 0.5, 0.9  # of a page's text: a part above it is no noise by its name
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
NAMES = re.compile(r"""[\s"'](class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I | re.S)
SPACE = re.compile(r"\s+")
HOST = re.compile(r"\A[^:]*://([^/?#]*)", re.S)


class Mark:
    """A node that its names mark as noise."""
    __slots__ = ("at", "replies", "inside", "free", "size", "articles")

    def __init__(self, at: int, replies: bool, inside: bool, free: int, size: int, articles: int):
        self.at, self.replies, self.inside, self.free = at, replies, inside, free
        self.size, self.articles = -size, -articles  # of the page so far; the node's own once it is closed

    def void(self, total: int, free: int) -> bool:
        """Whether the node is the page's article after all: no article lies
        elsewhere, and it holds one or most of the text."""
        return free <= self.free and (self.articles and not self.inside
                                      or self.size > total * (MOST_REPLIES if self.replies else MOST))


class Node:
    __slots__ = ("tag", "path", "noise", "kept", "holds", "children", "parts", "mark", "article", "free")

    def __init__(self, tag: str, path: str, noise: int, kept: bool, mark: Mark | None = None, article: bool = False, free: int = 0):
        self.tag, self.path, self.noise, self.kept = tag, path, noise, kept
        self.holds = False  # an article
        self.children: list[str] = []
        self.parts: list[str] = []
        # Its own mark; whether it lies in an article element, and in how many unmarked articles.
        self.mark, self.article, self.free = mark, article, free


@functools.lru_cache(1 << 14)
def noise_by_names(names: str, article: bool) -> int:
    """0: not noise, 1: noise, 2: replies."""
    for token in names.lower().split():
        parts = [p for p in re.split(r"[-_]+", token) if p]
        words = [p for p in parts if p not in QUALIFIERS and not p.isdigit()]
        if words and all(p in NOISE_WORDS or NOISE_START.fullmatch(p) or not article and p in OUTSIDE_WORDS for p in words):
            return 2 if any(p in REPLY_WORDS for p in words) else 1
    return 0


def _presentation(tag: str, attributes: str, article: bool = False) -> tuple[str, bool, int]:
    """(tag with class and id, whether tag or attributes drop it, whether its
    names mark noise). ``article``: it lies in one."""
    dropped = tag in DROPPED and not (article and tag == "header")
    if not attributes or attributes == "/":
        return tag, dropped, 0
    found = {k.lower(): v.strip("\"'") for k, v in NAMES.findall(attributes)}
    names = " ".join(filter(None, (found.get("class"), found.get("id"), found.get("role"))))
    dropped = dropped or "hidden" in found or found.get("aria-hidden") == "true"
    marked = noise_by_names(names, article) if names and tag not in ("body", "html", "main") else 0
    return f"{tag}.{found.get('class', '')}#{re.sub(r'[0-9]+', '0', found.get('id', ''))}", dropped, marked


Part = tuple[str | None, str]  # the path of its node, None inside an article; the text


def parse(page: str) -> tuple[list[list[Part]], list[tuple[str, int, int, bool]]]:
    """(the parts of every text block outside noise by presentation, (path,
    style digest, text digest, whether it holds an article) of every node
    that isn't such noise). A page whose names mark its own article is walked
    again without them."""
    blocks, nodes, void = _walk(page, frozenset())
    return _walk(page, void)[:2] if void else (blocks, nodes)


def below(path: str | None, noise_paths: frozenset) -> bool:
    """Whether a node on the path to the text is noise."""
    at = 0 if path else -1
    while at >= 0:
        at = path.find("/", at + 1)
        if path[:at if at >= 0 else None] in noise_paths:
            return True
    return False


def block_texts(blocks: list[list[Part]], noise_paths: frozenset = frozenset()) -> list[str]:
    """The blocks' texts without the parts below noise paths; none is empty."""
    out = []
    for parts in blocks:
        plain = len(parts) == 1
        if noise_paths:
            parts = [p for p in parts if not below(p[0], noise_paths)]
        text = "".join([p[1] for p in parts])
        text = (text if plain else SPACE.sub(" ", text)).strip()
        if text:
            out.append(text)
    return out


def walk(page: str, noise_paths: frozenset = frozenset()) -> tuple[list[str], list[tuple[str, int, int, bool]]]:
    """(text blocks of the article, nodes as ``parse`` gives them)."""
    blocks, nodes = parse(page)
    return block_texts(blocks, noise_paths), nodes


def _walk(page: str, unmarked: frozenset) -> tuple[list, list, frozenset]:
    """``parse`` with the names of the nodes that begin at ``unmarked`` marking
    nothing, and where marks are void."""
    stack = [Node("", "", 0, False)]
    nodes: list[tuple[str, int, int, bool]] = []
    blocks: list[list[Part]] = []
    line: list[str] = []
    where: list[str | None] = []
    marks: list[Mark] = []
    at = total = free = articles = 0

    def flush() -> None:
        if not line:
            return
        # White space inside a part is made plain at once, that between parts when they are joined.
        if where.count(where[0]) == len(where):
            text = SPACE.sub(" ", "".join(line))
            if text != " ":
                blocks.append([(where[0], text)])
        else:
            blocks.append(list(zip(where, line, strict=True)))
        line.clear()
        where.clear()

    def text_of(raw: str) -> None:
        nonlocal total
        top = stack[-1]
        if raw and top.noise <= MARKED:
            total += len("".join(raw.split()))
        if raw and not top.noise:
            value = entities.unescape(raw)
            line.append(value)
            where.append(None if top.kept else top.path)
            top.parts.append(value)

    def close() -> None:
        node = stack.pop()
        if node.mark:
            node.mark.size += total
            node.mark.articles += articles
        if node.tag in BLOCKS:
            flush()
        if not node.noise:
            content = SPACE.sub(" ", "".join(node.parts)).strip()
            if not node.kept:
                nodes.append((node.path, zlib.crc32(" ".join(node.children).encode()), zlib.crc32(content.encode()), node.holds))
            stack[-1].parts.append(content)
            stack[-1].holds |= node.holds or node.kept

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        text_of(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text_of(entities.escape(m[0][9:].removesuffix("]]>")))
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            while depth and len(stack) > depth:
                close()
            if not depth and tag in BLOCKS:
                flush()
            continue
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ENDS_P or tag == "p":
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in ENDS_P), 0)
            if depth and (stack[depth].tag == "p" or tag == stack[depth].tag in ("li", "tr", "td", "th", "dt", "dd", "option")):
                while len(stack) > depth:
                    close()
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            line.append(" ")
            where.append(where[-1] if where else None)
        top = stack[-1]
        if tag in VOID:
            top.children.append(tag)
            continue
        name, drop, marked = _presentation(tag, m[3], top.article)
        main = tag in ("article", "main")
        kept = top.kept or main
        if main and not top.kept:
            drop, marked = False, 0
        if m.start() in unmarked:
            marked = 0
        # Inside an article only presentation removes a node; its own parts differ from page to page.
        path = top.path + "/" + name if not top.kept else top.path
        noise = max(top.noise, DROP if drop else MARKED if marked else 0)
        here, mark = top.free, None
        if main and noise <= MARKED:
            articles += 1
            if noise < MARKED:
                free += 1
                here += 1
        if marked and noise == MARKED:
            mark = Mark(m.start(), marked == 2, top.article, top.free, total, articles)
            marks.append(mark)
        top.children.append(name)
        stack.append(Node(tag, path, noise, kept, mark, top.article or tag == "article", here))
    text_of(page[at:] if at < len(page) else "")
    while len(stack) > 1:
        close()
    flush()
    return blocks, nodes, frozenset(mark.at for mark in marks if mark.void(total, free))


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


NODES = pa.struct([("path", pa.string()), ("kind", pa.int32()), ("digest", pa.int64())])
PARTS = pa.struct([("block", pa.int32()), ("path", pa.string()), ("text", pa.string())])


def _lists(rows: list[list[tuple]], kind: pa.StructType) -> pa.Array:
    flat = list(zip(*(x for row in rows for x in row), strict=True)) or [()] * kind.num_fields
    structs = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, kind, strict=True)], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array([0, *itertools.accumulate(map(len, rows))], pa.int32()), structs)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page, nodes, parts) of every row: its nodes, a
    digest of them and of its text by which copies are known, and the parts of
    its text blocks."""
    id_type = pages.schema["page_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, all_nodes, all_parts = [], [], [], []
            for url, page in zip(batch.column(1), batch.column(2), strict=True):
                blocks, nodes = parse(page.as_py() or "")
                nodes = sorted({(n[0], kind, digest) for n in nodes
                                for kind, digest in ((0, n[1]), (1, n[2]), (2, 0), (3, 0))[:3 + n[3]]})
                hosts.append(host_of(url.as_py()))
                keys.append(blake2b(repr((block_texts(blocks), nodes)).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                all_nodes.append(nodes)
                all_parts.append([(i, *part) for i, parts in enumerate(blocks) for part in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_id), batch.column(1), pa.array(hosts, pa.string()), pa.array(keys, pa.binary()),
                 _lists(all_nodes, NODES), _lists(all_parts, PARTS)], names=["page_id", "url", "host", "page", "nodes", "parts"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {id_type.simpleString()}, url string, host string, page binary, "
             "nodes array<struct<path: string, kind: int, digest: long>>, parts array<struct<block: int, path: string, text: string>>")


def style_nodes(parsed: DataFrame) -> DataFrame:
    """(host, path, kind, digest, n): how many different pages of a host have
    the node with this style (kind 0) or this text (kind 1), have it at all
    (kind 2), or with an article in it (kind 3). Copies weigh once."""
    different = parsed.groupBy("host", "page").agg(F.first("nodes").alias("nodes"))
    return (different.select("host", F.explode("nodes").alias("node")).groupBy("host", "node.path", "node.kind", "node.digest")
            .agg(F.count("*").alias("n")))


def importances(parsed: DataFrame) -> DataFrame:
    """(host, path, pages, presentation, content, holds): relative entropies in
    0..1, and whether an article lies in the node on any page."""
    counts = style_nodes(parsed)
    # entropy = ln(N) - sum(n ln n) / N, relative to ln(N)
    per = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    relative = F.when(F.col("total") > 1, 1 - F.col("nlogn") / (F.col("total") * F.log(F.col("total")))).otherwise(1.0)
    return (per.withColumn("e", relative).groupBy("host", "path")
            .agg(F.max(F.when(F.col("kind") == 2, F.col("total"))).alias("pages"), F.max(F.when(F.col("kind") == 0, F.col("e"))).alias("presentation"),
                 F.max(F.when(F.col("kind") == 1, F.col("e"))).alias("content"),
                 F.max(F.col("kind") == 3).alias("holds")))


def noise_table(parsed: DataFrame, least: float = LEAST_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, paths): the branches of each host whose importance is low and
    that hold no article."""
    low = importances(parsed).where((F.col("pages") >= min_pages) & (F.greatest("presentation", "content") < least) & ~F.col("holds"))
    return low.groupBy("host").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    prepare(pages.sparkSession)
    parsed = write_stage(parsed_pages(pick(pages, page_id=id_col, url=url_col, html=html_col)), "parsed")
    noise = write_stage(noise_table(parsed).withColumnRenamed("host", "noise_host"), "noise")
    joined = parsed.join(noise, F.col("host") == F.col("noise_host"), "left").select("page_id", "url", "parts", "paths")
    id_type = parsed.schema["page_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_pylist()
            block, path, text = (c.to_pylist() for c in lists.flatten().flatten())
            texts = []
            for row, paths in enumerate(batch.column(3)):
                at = range(offsets[row] - offsets[0], offsets[row + 1] - offsets[0])
                blocks = [[(path[i], text[i]) for i in some] for _, some in itertools.groupby(at, block.__getitem__)]
                texts.append("\n\n".join(block_texts(blocks, frozenset(paths.as_py() or ()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {id_type.simpleString()}, url string, text string, n_chars long")
