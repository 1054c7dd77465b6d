"""Main text of web pages by wrapper induction.

The pages of a host are made by one template. One page of each host is the reference; every other page's tree is aligned with it by simple tree
matching (the largest set of node pairs that keeps parents and order). Each reference node is a slot; what the reference lacks has a slot by its path. Spark counts per slot how many of the
host's pages have which text there: a text that SHARE of all pages with the slot have, whose articles are different ones, is template, and so is a slot that holds little else; what varies is content. Pages
that are copies of one article (the same longest text) prove nothing, and what a cut-off page has open at its end doesn't vote. Hosts of all sizes are judged by the same rule.

Varying nodes may still be menus or adverts, so elements that say so (tag, role, class or id) never are content, nor is anything outside
the article where the page marks one. Siblings of equal name are one node for the alignment, so trees stay small; their texts are counted one by one.

Every page is parsed into a compact tree where it lies, and only trees meet references. Pages whose host has no template for its articles pass straight through; the others are joined with it.

Null html counts as empty, a null url as a host of its own name. A cut-off page yields what is there; an unclosed tag at its end is dropped. Pages with equal ids are
pages of their own. An empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import html
import re
import sys
from array import array
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.bitmaps import looked_up
from meterlake.llm.common import full_text, kept, slices, table, written

SHARE = 0.9  # of a slot's pages have a template text
ARTICLES = 5  # different articles it is seen with, at least

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*(?:>|\Z)", re.S)
_CUT = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")

# Elements of HTML by kind.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea noscript iframe".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strong sub sup time tt u var wbr del ins label br img".split())
_NEVER = frozenset("head title script style noscript template nav footer aside form button select option textarea input iframe svg dialog menu object".split())
_SELF_CLOSING = {"p": frozenset("p"), "li": frozenset(["li"]), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(["option"])}
_SCOPE = frozenset("ul ol dl table div article section main body td th blockquote aside nav form".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_BOILER = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice popup modal newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus replies share social related widget".split())
_BOILER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())


class Node:
    __slots__ = ("tag", "name", "marks", "parent", "children", "kind")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        self.marks = set(_NAME.findall(f"{found.get('class', '')} {found.get('id', '')}".lower()))
        self.kind = found.get("role", "").lower() or ("main" if "articlebody" in found.get("itemprop", "").lower() else "")
        self.name = (tag, (found.get("class") or "").strip().lower())


def parse(page: str) -> Node:
    """The element tree; character references are decoded, raw-text elements keep no text."""
    page = _CUT.sub("", page)
    root = at = Node("#root")
    end = 0
    skip_to = None
    for m in _TOKEN.finditer(page):
        if m.start() < end or skip_to and (m[2] or "").lower() != skip_to:
            continue
        if not skip_to and m.start() > end:
            at.children.append(html.unescape(page[end : m.start()]))
        end = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if skip_to:
                skip_to = None
                continue
            node = at
            while node.parent and node.tag != tag:
                node = node.parent
            if node.parent:
                at = node.parent
            continue
        if skip_to:
            continue
        closing = _SELF_CLOSING.get(tag) or (frozenset("p") if tag in _CLOSES_P else None)
        if tag in _CLOSES_P:
            closing = (closing or frozenset()) | {"p"}
        if closing:
            node = at
            while node.parent and node.tag not in closing and node.tag not in _SCOPE:
                node = node.parent
            if node.tag in closing:
                at = node.parent
        node = Node(tag, m[3], at)
        at.children.append(node)
        if tag in _RAW:
            skip_to = tag
        elif tag not in _VOID and not m[3].endswith("/"):
            at = node
    if not skip_to and end < len(page):
        at.children.append(html.unescape(page[end:]))
    return root


def _inside(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node:
        if node.tag in tags or node.kind == "main":
            return True
        node = node.parent
    return False


def is_boilerplate(node: Node) -> bool:
    """By its tag, role, class or id."""
    if node.tag in _NEVER or node.kind in _BOILER_ROLE or node.marks & _BOILER:
        return node.tag not in ("html", "body", "article", "main")
    return node.tag == "header" and not _inside(node.parent, ("article", "main"))


def landmarks(root: Node) -> list[Node]:
    """Outermost articles or main elements that are no boilerplate; the root where there is none."""
    for wanted in (("article",), ("main",)):
        found: list[Node] = []
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag in wanted or node.kind == "main":
                found.append(node)
            elif not is_boilerplate(node):
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]
        if found:
            return found
    return [root]


class Slot:
    """A run of equal siblings as one node: the digests of their own texts and the slots below."""

    __slots__ = ("name", "texts", "children", "number", "nodes", "path")

    def __init__(self, name: int, texts: list[int], nodes: list[Node] | None = None):
        self.name, self.texts, self.nodes, self.number, self.path = name, texts, nodes or [], -1, 0
        self.children: list[Slot] = []


def own_text(node: Node) -> str:
    return _SPACE.sub(" ", " ".join(c for c in node.children if isinstance(c, str))).strip()


def _open_at_end(root: Node) -> set[int]:
    """Nodes that are not closed where the page ends: the last one and those above it."""
    found, node = set(), root
    while node is not None:
        found.add(id(node))
        node = next((c for c in reversed(node.children) if isinstance(c, Node)), None)
    return found


def slots(root: Node, cut: bool = False) -> Slot:
    """The tree of slots that can hold content: landmarks, what stands above them and what is in them.

    Below one slot, element children of equal name (tag and class) are one slot again, in order of first appearance. Texts of a cut-off page's open nodes are left out.
    """
    marks = landmarks(root)
    ids, above = {id(m) for m in marks}, set()
    for m in marks:
        node = m.parent
        while node is not None and id(node) not in above:
            above.add(id(node))
            node = node.parent
    hidden = _open_at_end(root) if cut else set()
    top = Slot(_digest(root.tag), [], [root])
    stack = [(top, id(root) in ids)]
    while stack:
        slot, inside = stack.pop()
        merged: dict[tuple, tuple[list[Node], bool]] = {}
        for node in slot.nodes:
            for child in node.children:
                if isinstance(child, Node):
                    within = inside or id(child) in ids
                    if id(child) in above or within and not (inside and is_boilerplate(child)):
                        merged.setdefault((*child.name, within), ([], within))[0].append(child)
        for (tag, marked, _), (run, within) in merged.items():
            texts = [_digest(t) for n in run if id(n) not in hidden and (t := own_text(n))] if within else []
            child = Slot(_digest(f"{tag}.{marked}"), texts, run)
            slot.children.append(child)
            stack.append((child, within))
    return top


def packed(root: Slot) -> bytes:
    """The tree in depth-first order, in 32-bit numbers: name, depth, number of texts, texts."""
    out, stack = array("I"), [(root, 0)]
    while stack:
        slot, depth = stack.pop()
        out.extend((slot.name, depth, len(slot.texts), *slot.texts))
        stack += [(c, depth + 1) for c in reversed(slot.children)]
    return out.tobytes()


def unpacked(data: bytes) -> Slot:
    words = array("I")
    words.frombytes(data)
    at, above, root = 0, [], None
    while at < len(words):
        name, depth, n = words[at], words[at + 1], words[at + 2]
        slot = Slot(name, list(words[at + 3 : at + 3 + n]))
        at += 3 + n
        del above[depth:]
        if above:
            above[-1].children.append(slot)
        else:
            root = slot
        above.append(slot)
    return root


def numbered(root: Slot) -> Slot:
    """Slot numbers of a reference, from the top."""
    stack, k = [root], 0
    while stack:
        slot = stack.pop()
        slot.number, k = k, k + 1
        stack += reversed(slot.children)
    return root


def match(a: Slot, b: Slot) -> int:
    """Simple tree matching: size of the largest alignment of two trees whose roots are equal; 0 if they are not."""
    return _align(a, b)[0]


sys.setrecursionlimit(max(sys.getrecursionlimit(), 200_000))  # _align goes as deep as a page nests its elements


def _align(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    if a.name != b.name:
        return 0, []
    n, m = len(a.children), len(b.children)
    own = {}
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            if x.name == y.name:
                own[i, j] = _align(x, y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + own[i, j][0] if (i, j) in own else 0)
    pairs, i, j = [(a, b)], n, m
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += own[i, j][1]
    return best[n][m] + 1, pairs


def _with_paths(root: Slot) -> list[Slot]:
    """All slots; each gets a number for its path, below zero."""
    out, stack = [], [(root, 0)]
    while stack:
        slot, above = stack.pop()
        slot.path = -1 - _digest(f"{above}/{slot.name}")
        out.append(slot)
        stack += [(c, slot.path) for c in slot.children]
    return out


def aligned(page: Slot, reference: Slot) -> list[tuple[int, Slot]]:
    """(slot number, slot of the page) of all its slots: the reference's number where they are matched, else that of the path."""
    number = {id(p): r.number for r, p in _align(reference, page)[1]}
    return [(number.get(id(slot), slot.path), slot) for slot in _with_paths(page)]


def blocks(root: Node, constant: set[int]) -> list[str]:
    """Texts of the blocks under ``root`` in page order; ``constant`` has the ids of nodes whose own text is template."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            out.append(text)
        line.clear()

    stack: list[tuple[Node | str | None, Node | None]] = [(root, None)]
    while stack:
        node, parent = stack.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            if id(parent) not in constant:
                line.append(node)
        elif node.tag == "br":
            line.append(" ")
        elif node is root or not is_boilerplate(node):
            block = node.tag not in _INLINE
            if block:
                flush()
                stack.append((None, None))
            stack += [(c, node) for c in reversed(node.children)]
    flush()
    return out


Template = dict[int, set[int] | None]  # slot -> its constant texts; None: all of it


def main_text(page: str, reference: Slot | None = None, template: Template | None = None) -> str:
    """The article's blocks joined by an empty line, without what the template holds."""
    root = parse(page)
    constant: set[int] = set()
    if reference and template:
        for k, slot in aligned(slots(root), reference):
            if k in template:
                known = template[k]
                constant |= {id(n) for n in slot.nodes if known is None or _digest(own_text(n)) in known}
    return "\n\n".join(b for mark in landmarks(root) for b in blocks(mark, constant))


def _digest(text: str) -> int:
    return crc32(text.encode("utf-8", "surrogatepass"))


def longest(tree: Slot) -> tuple[int, int]:
    """Digests of the longest and the next longest of a page's texts, which tell its article from others even where it is edited a little."""
    texts = sorted({own_text(n) for slot in _with_paths(tree) if slot.texts for n in slot.nodes}, key=lambda t: (-len(t), t))[:2]
    return _digest(texts[0] if texts else ""), _digest(texts[1] if len(texts) > 1 else "")


def trees(pages: DataFrame) -> DataFrame:
    """(host, page_id, cut, article, other, tree) of every page, stored: its compact tree, and digests of its longest and its next longest text."""
    schema = pa.schema([("host", pa.string()), ("page_id", pa.int64()), ("cut", pa.bool_()), ("article", pa.int64()), ("other", pa.int64()), ("tree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for piece in slices([part], "html"):
                rows: dict[str, list] = {"cut": [], "article": [], "other": [], "tree": []}
                for page in piece.column("html").to_pylist():
                    root = parse(page)
                    cut = not page.rstrip().endswith("</html>")
                    tree = slots(root, cut)
                    for c, v in zip(rows, (cut, *longest(tree), packed(tree)), strict=True):
                        rows[c].append(v)
                yield pa.RecordBatch.from_pydict({"host": piece.column("host"), "page_id": piece.column("page_id"), **rows}, schema=schema)

    return written(pages.select("host", "page_id", "html").mapInArrow(run, "host string, page_id long, cut boolean, article long, other long, tree binary"), "page_trees")


def references(stored: DataFrame) -> DataFrame:
    """(host, reference): the tree of the page with the smallest id of each host, of a cut-off one only if all are."""
    return kept(stored.groupBy("host").agg(F.min_by("tree", F.struct("cut", "page_id", "tree")).alias("reference")))


_AT_ONCE = 50_000  # counts a task holds


def templates(stored: DataFrame, refs: DataFrame, share: float = SHARE, articles: int = ARTICLES) -> DataFrame:
    """(host, slots, texts): the constant texts of each host's slots, hosts without any left out; text -1 stands for all of a slot.

    Tasks add up their own pages, Spark the tasks, so a host with very many pages is no heavier than others. Texts of fewer pages than articles are needed go first, which leaves few rows to be compared with their slot's pages.
    Different articles are counted as bits of a 64-bit mark, which never says more than there are.
    """
    schema = pa.schema([("host", pa.string()), ("slot", pa.int64()), ("text", pa.int64()), ("pages", pa.int64()), ("members", pa.int64()), ("seen", pa.int64())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, list[int]] = {}
        known: tuple[str, Slot] | None = None

        def flush() -> pa.RecordBatch:
            rows = [(*key, *value) for key, value in counts.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for part in batches:
            for host, tree, article, other, reference in zip(*(part.column(c).to_pylist() for c in ("host", "tree", "article", "other", "reference"))):
                if known is None or known[0] != host:
                    known = host, numbered(unpacked(reference))
                for k, slot in aligned(unpacked(tree), known[1]):
                    if slot.texts:
                        found = Counter(slot.texts)
                        found[-1] = len(slot.texts)  # the slot itself
                        for text, members in found.items():
                            at = counts.setdefault((host, k, text), [0, 0, 0])
                            at[0], at[1], at[2] = at[0] + 1, at[1] + members, at[2] | 1 << (other if text == article else article) % 63
                if len(counts) > _AT_ONCE:
                    yield flush()
        if counts:
            yield flush()

    votes = stored.join(refs, "host").select("host", "tree", "article", "other", "reference").mapInArrow(vote, "host string, slot long, text long, pages long, members long, seen long")
    counted = kept(votes.groupBy("host", "slot", "text").agg(F.sum("pages").alias("pages"), F.sum("members").alias("members"), F.bit_or("seen").alias("seen")).where((F.col("pages") >= articles) | (F.col("text") == -1)))
    of_slot = counted.where("text = -1").select("host", "slot", F.col("pages").alias("all_pages"), F.col("members").alias("all_members"))
    constant = counted.where((F.col("text") != -1) & (F.bit_count("seen") >= articles)).join(of_slot, ["host", "slot"]).where(F.col("pages") >= share * F.col("all_pages"))
    whole = F.sum("members") >= share * F.max("all_members")  # at most 1 / share times as many texts as a slot has members
    told = constant.groupBy("host", "slot").agg(F.collect_list("text").alias("texts"), whole.alias("whole")).select("host", "slot", F.explode(F.when(F.col("whole"), F.array(F.lit(-1).cast("long"))).otherwise(F.col("texts"))).alias("text"))
    return kept(told.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "text"))).alias("template")))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = SHARE, articles: int = ARTICLES) -> DataFrame:
    """page_id, url and the main text of every row."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), full_text(html_col).alias("html"), host.alias("host"))
    stored = trees(rows)
    refs = references(stored)
    wrappers = kept(refs.join(templates(stored, refs, share, articles), "host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[str, Slot, Template] | None = None
        for part in batches:
            for piece in slices([part], "html"):
                texts = []
                for host, page, reference, entries in zip(*(piece.column(c).to_pylist() for c in ("host", "html", "reference", "template"))):
                    if not entries:
                        texts.append(main_text(page))
                        continue
                    if known is None or known[0] != host:
                        template: Template = {}
                        for e in entries:
                            template[e["slot"]] = None if e["text"] == -1 else (template.get(e["slot"]) or set()) | {e["text"]}
                        known = host, numbered(unpacked(reference)), template
                    texts.append(main_text(page, known[1], known[2]))
                yield pa.RecordBatch.from_pydict({"page_id": piece.column("page_id"), "url": piece.column("url"), "text": pa.array(texts, pa.string())})

    return looked_up(rows, "host", wrappers).mapInArrow(run, "page_id long, url string, text string")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
