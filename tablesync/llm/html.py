"""Main text of web pages: site templates and page furniture removed.

A page is read into a tree of elements. Every subtree gets a hash of its tags, classes and
text; Spark counts, per host, the different pages in which a hash occurs, and subtrees that
recur across many pages of their host are deleted, with page furniture known by its element,
role or class (menus, headers, footers, sidebars, notices, adverts, forms, comments). What is
left of the article, or of the page if it marks none, is its text: blocks joined by an empty line.

Many pages are PAGE_SHARE of the host's, or MANY_PAGES where that is fewer, and MIN_PAGES at least.
A subtree with a class or id that changes from page to page (a block that shows one of a few
things) counts by its place: if elements of that name under the same ancestors are on so many pages, each of their
texts on MIN_PAGES is one. Inside an article only the share counts.

Copies of a page count once, so a page that was stored many times does not make its own
article a template. Paragraphs, headings, list items and the like inside an article are its
text even if they recur, and no subtree is deleted that holds an article. A page learns which of
its own subtrees are templates, so what it is joined with is no longer than itself.

Tags are read from left to right, quotes only where a value begins, as browsers do; elements
deeper than MAX_DEPTH are not nested further. Reading takes time in proportion to the page.

Defined results: null and empty pages give an empty text; a null url has a host of its own;
unclosed and misnested elements are closed as browsers do, roughly; pages alike in all columns
give a row each; pages of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import carried, packed, saved, small_batches, table

#: A subtree is a template from this many different pages of a host, and this share or number of them.
MIN_PAGES = 5
PAGE_SHARE = 0.2
MANY_PAGES = 100
#: Rows up to which the templates of all hosts are sent to every task: under 10 MB.
BROADCAST_ROWS = 200_000
#: Elements that are open at once.
MAX_DEPTH = 512
#: Names of classes that a task remembers the meaning of.
REMEMBERED = 1 << 16

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd td th figcaption caption".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div main body td th".split())
# Page furniture by element, role and word of a class or id.
FURNITURE = frozenset(
    "head nav footer aside form button select fieldset dialog menu script style textarea title noscript "
    "iframe template svg math object input canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets ad ads "
    "advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion popup modal "
    "overlay cookie cookies consent gdpr notice notices newsletter subscribe subscription signup share sharing "
    "social related recommended recommendations comment comments disqus reply replies respond pagination pager "
    "login search toolbar skip".split())
#: Words that name furniture whatever else the element is named for.
PLAIN = frozenset(
    "nav navbar navigation breadcrumb breadcrumbs ad ads advert adverts advertisement advertisements sponsored cookie "
    "cookies consent gdpr newsletter share sharing related recommended recommendations comment comments disqus "
    "pagination pager".split())
#: Words that go with those of furniture in a name, and those that do so with PLAIN ones only.
WITH = frozenset(
    "site page main top bottom left right primary secondary global sub mobile desktop sticky fixed block box bar bars "
    "list lists link links item items container wrapper wrap inner outer section area slot unit panel column col "
    "button buttons btn icon icons form field input text toggle message policy posts articles stories news thread "
    "us me now this media and content widget the".split())
OWNERS = frozenset("post article entry story blog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Furniture that some sites put around the whole page.
WRAPPERS = frozenset("form fieldset dialog".split())

TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
SPACE = re.compile(r"[\s/]*")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

carried(__name__)


class Node:
    """An element; ``parts`` are its texts and elements in order."""

    __slots__ = ("tag", "attrs", "parts", "holds", "key", "size", "prose", "most")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.parts = tag, attrs, []
        self.holds = False  # an article or main element below it
        self.key = 0
        # characters of text, those in paragraphs and the like, and whether they are most of the page's
        self.size, self.prose, self.most = 0, 0, False


def read_tag(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """The attributes from a place after the name of a tag, whether it closes itself, and where it ends."""
    attrs: dict[str, str] = {}
    while True:
        space = SPACE.match(page, at)
        if page.startswith(">", space.end()):
            return attrs, space[0].endswith("/"), space.end() + 1
        found = ATTRIBUTE.match(page, at)
        if found is None:
            return attrs, False, len(page)  # the page ends inside the tag
        at = found.end()
        value = found[2] or found[3] or found[4] or ""
        attrs.setdefault(found[1].lower(), html.unescape(value) if "&" in value else value)


def parse(page: str) -> Node:
    """The tree of a page."""
    root = Node("#root", {})
    stack, at = [root], 0
    while True:
        start = page.find("<", at)
        if start < 0:
            _text(stack[-1], page[at:])
            return root
        mark = page[start + 1:start + 2]
        if mark in ("!", "?"):
            _text(stack[-1], page[at:start])
            comment = page.startswith("<!--", start)
            end = page.find("-->", start + 4) if comment else page.find(">", start)
            at = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        named = TAG.match(page, start)
        if named is None:
            _text(stack[-1], page[at:start + 1])
            at = start + 1
            continue
        _text(stack[-1], page[at:start])
        tag = named[1].lower()
        attrs, closed, at = read_tag(page, named.end())
        if mark == "/":
            _close(stack, tag)
            continue
        node = Node(tag, attrs)
        if tag not in INLINE and tag != "br":
            _close_implied(stack, tag)
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = read_tag(page, end.end())[2] if end else len(page)
        elif tag not in VOID and not closed and len(stack) < MAX_DEPTH:
            stack.append(node)


def _text(node: Node, text: str) -> None:
    if text:
        node.parts.append(html.unescape(text))


def _close(stack: list[Node], tag: str) -> None:
    for place in range(len(stack) - 1, 0, -1):
        if stack[place].tag == tag:
            del stack[place:]
            return
        if tag in INLINE and stack[place].tag not in INLINE:
            return  # an inline element does not end the block around it


def _close_implied(stack: list[Node], tag: str) -> None:
    same = SIBLINGS.get(tag, ())
    for place in range(len(stack) - 1, 0, -1):
        name = stack[place].tag
        if name in CLOSED_BY_BLOCK or name in same:
            del stack[place:]
            return
        if name in SCOPES:
            return


def furniture(node: Node) -> bool:
    """Whether an element is page furniture by its kind, role or name."""
    if node.tag in FURNITURE:
        return not (node.tag in WRAPPERS and node.most and 2 * node.prose > node.size)
    attrs = node.attrs
    if not attrs or node.tag in ("html", "body", "#root"):
        return False
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if node.tag in HEADINGS:
        return False
    plainly = node.most or node.tag in TEXT_BLOCKS
    if node.most and node.tag in TEXT_BLOCKS:
        return False
    return any(_names_furniture(name, plainly) for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split())


_KNOWN: dict[tuple[str, bool], bool] = {}


def _names_furniture(name: str, plainly: bool) -> bool:
    """``_by_words``, which is asked about the same names again and again."""
    found = _KNOWN.get((name, plainly))
    if found is None:
        if len(_KNOWN) >= REMEMBERED:
            _KNOWN.clear()
        found = _KNOWN[name, plainly] = _by_words(name, plainly)
    return found


def _by_words(name: str, plainly: bool) -> bool:
    """Whether a class or id names furniture as a whole, and if need be by a plain word."""
    words = [w for w in map(str.lower, NAME_WORD.findall(name)) if not w.isdigit()]
    plain = any(w in PLAIN for w in words)
    if not plain and (plainly or not any(w in WORDS for w in words)):
        return False
    return all(w in WORDS or w in WITH or plain and w in OWNERS for w in words)


def _named(node: Node) -> str:
    return f"{node.tag} {node.attrs.get('class', '')} {node.attrs.get('id', '')}"


def _hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def mark(node: Node) -> None:
    """Find the elements that hold an article or most of the text, and hash every subtree; children come first."""
    order, todo = [], [node]
    while todo:
        top = todo.pop()
        order.append(top)
        todo += [p for p in top.parts if isinstance(p, Node)]
    for top in reversed(order):
        inner = [p for p in top.parts if isinstance(p, Node)]
        top.holds = any(p.holds or p.tag in ("article", "main") for p in inner)
        said = [_named(top)]
        said += [f"<{p.key}>" if isinstance(p, Node) else " ".join(p.split()) for p in top.parts]
        top.size = sum(p.size if isinstance(p, Node) else len(p.strip()) for p in top.parts)
        top.prose = top.size if top.tag in TEXT_BLOCKS else sum(p.prose for p in inner)
        top.key = _hashed("\x1f".join(said))
    for top in order:
        top.most = 2 * top.size > node.size


#: Tells the key of a subtree inside an article from the same one outside.
WITHIN = 0x5851F42D4C957F2D


def key_of(node: Node, inside: bool) -> int:
    return node.key ^ WITHIN if inside else node.key


def candidates(root: Node) -> dict[int, tuple[bool, int | None]]:
    """Keys of the subtrees that may be deleted as a template: whether inside an article, and the place if named."""
    found, todo = {}, [(root, False, "")]
    while todo:
        node, inside, above = todo.pop()
        inside = inside or node.tag in ("article", "main")
        for part in node.parts:
            if isinstance(part, Node) and part.tag not in RAW:
                place = f"{_hashed(above)} {_named(part)}"
                if deletable(part, inside):
                    named = not inside and part.tag not in TEXT_BLOCKS and ("class" in part.attrs or "id" in part.attrs)
                    found[key_of(part, inside)] = inside, _hashed(place) if named else None
                if part.tag not in TEXT_BLOCKS or not inside:
                    todo.append((part, inside, place))
    return found


def deletable(node: Node, inside: bool) -> bool:
    if node.holds or node.tag in ("#root", "html", "body", "article", "main", "br") or node.tag in INLINE:
        return False
    return not (inside and node.tag in TEXT_BLOCKS) and bool(node.parts)


def blocks(root: Node, templates: frozenset[int]) -> list[str]:
    """The texts of the blocks of the article, or of the page if no article is left.

    A main element with text besides its articles is read as a whole.
    """
    outermost = _tops(root, templates, ("article", "main"))
    mains = [top for top in outermost if top.tag == "main"]
    if mains and _texts(mains, templates, ("article",)):
        return _texts(outermost, templates)
    return _texts(_tops(root, templates, ("article",)) or mains or [root], templates)


def _texts(tops: list[Node], templates: frozenset[int], without: tuple[str, ...] = ()) -> list[str]:
    """The texts of the blocks of elements, but for elements of some kinds."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    for top in tops:
        # (element, next part, whether it is a block)
        todo = [(top, iter(top.parts), True)]
        while todo:
            node, rest, is_block = todo[-1]
            for part in rest:
                if not isinstance(part, Node):
                    line.append(part)
                elif part.tag == "br":
                    line.append(" ")
                elif part.tag not in without and not _gone(part, templates, top.tag != "#root"):
                    inner_block = part.tag not in INLINE
                    if inner_block:
                        end()
                    todo.append((part, iter(part.parts), inner_block))
                    break
            else:
                todo.pop()
                if is_block:
                    end()
    return out


def _gone(node: Node, templates: frozenset[int], inside: bool) -> bool:
    if node.holds:
        return False
    if node.tag == "header":
        return not inside
    return furniture(node) or deletable(node, inside) and key_of(node, inside) in templates


def _tops(root: Node, templates: frozenset[int], tags: tuple[str, ...]) -> list[Node]:
    """The outermost elements of some kinds that are not in page furniture."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag in tags:
            found.append(node)
            continue
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not (
            furniture(p) and not p.holds or p.key in templates and deletable(p, False))]
    return found


def _hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, name, page in zip(batch["host"], batch["name"], batch["html"]):
            if page:
                tree = parse(page)
                mark(tree)
                rows += [(host, name, tree.key, key, inside, place) for key, (inside, place) in candidates(tree).items()]
        if rows:
            made = pd.DataFrame(rows, columns=["host", "name", "page", "key", "inside", "place"])
            yield made.astype({"place": "Int64"})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, templates in zip(batch.column("html").to_pylist(), batch.column("_templates").to_pylist()):
            if not page:
                texts.append("")
                continue
            tree = parse(page)
            mark(tree)
            texts.append("\n\n".join(blocks(tree, frozenset(templates or ()))))
        others = batch.drop_columns(["html", "_templates"])
        yield pa.RecordBatch.from_arrays([*others.columns, pa.array(texts, pa.string())],
                                         names=[*others.schema.names, "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


SUBTREES = "host string, name binary, page long, key long, inside boolean, place long"


def subtrees(pages: DataFrame) -> DataFrame:
    """The subtrees of ``pages`` (host, name, html) that may be templates; a page alike in html has one name."""
    return pages.mapInPandas(_hash, SUBTREES)


def templates(found: DataFrame, pages: DataFrame, min_pages: int = MIN_PAGES, share: float = PAGE_SHARE,
              many: int = MANY_PAGES) -> DataFrame:
    """Rows (host, key) of the ``subtrees`` that recur on their host, of whose ``pages`` the different ones count."""
    seen = found.groupBy("host", "key", "page").agg(F.first("inside").alias("inside"), F.min("place").alias("place"))
    counts = saved(seen.groupBy("host", "key").agg(
        F.count("*").alias("n"), F.first("inside").alias("inside"), F.min("place").alias("place")).where(
        F.col("n") >= min_pages), "recurring")
    size = pages.select("host", "name").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    of_share = F.greatest(F.lit(min_pages), F.ceil(F.lit(share) * F.col("pages")))
    enough = F.when(F.col("inside"), of_share).otherwise(F.least(of_share, F.lit(max(many, min_pages))))
    placed = found.where("place IS NOT NULL").select("host", "place", "page").distinct().groupBy("host", "place").agg(
        F.count("*").alias("at_place"))
    known = counts.join(size, "host").join(placed, ["host", "place"], "left")
    return known.where((F.col("n") >= enough) | (F.col("at_place") >= enough)).select("host", "key")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = PAGE_SHARE, many: int = MANY_PAGES) -> DataFrame:
    """``pages`` (url, html and others, without the html) with the main ``text``."""
    small_batches(pages.sparkSession)
    named = pages.select(host_of(F.col("url")).alias("host"), F.unhex(F.md5("html")).alias("name"), "html")
    found = saved(subtrees(named), "subtrees")
    known = saved(templates(found, named, min_pages, share, many), "templates")
    few = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    of_page = found.join(few, ["host", "key"]).groupBy("host", "name").agg(F.collect_set("key").alias("_templates"))
    marked = pages.select(packed(pages).alias("row"), host_of(F.col("url")).alias("host"), F.unhex(F.md5("html")).alias("name"))
    joined = marked.join(of_page, ["host", "name"], "left").select(
        F.col("row.html").alias("html"), "_templates", F.col("row"))
    others = [c for c in pages.columns if c != "html"]
    rows = joined.select("html", "_templates", F.struct(*[F.col(f"row.`{c}`").alias(c) for c in others]).alias("row"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("text", T.StringType())])
    texts = rows.mapInArrow(_extract, schema)
    return texts.select("row.*", "text")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
