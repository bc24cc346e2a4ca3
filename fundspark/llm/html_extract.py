"""Main text of web pages by site style trees.

Pages of one host are merged into a style tree: element nodes that agree in their path of tags,
classes and ids are one node of the tree. A node's presentation importance is the entropy of the
child sequences it shows. Its content importance is the mean over the text blocks it holds, on all
pages, of 1 less the entropy of the pages a block is on: a block that many pages of the site show
has little to do with any of them. Entropies are in units of the logarithm of the number of pages
that have the node, so 1 is most. A branch of a page is as important as the most important content
in it, and branches of low importance are removed.

Hosts with few pages tell little, so importance is drawn towards 1 there; elements whose tag stands
for furniture of a page are removed in any case, as are scripts, styles, text fields, titles,
choices of a form, and closed iframes, templates, drawings (svg) and annotations of formulas. A
class, id or role that names furniture is evidence only: it lowers the importance of its branch. It
does not remove the article, nor most of the text. Where pages of a host are near copies of each
other their articles look unimportant: if the tree would leave less than a quarter of a page's text,
it has no say on that page; nor has it inside an article or main element.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise

# Branches below LOW go.
LOW = 0.84
# Share of content in the importance of a node that holds text; the rest is presentation.
CONTENT = 0.9
# What a name of furniture leaves of a branch's importance.
NAMED = 0.3
# As many pages without anything in common are added to every node.
PRIOR_PAGES = 1.0
SALTS = 16

# Elements of HTML by their role.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr td th "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split()
)
SPACED = {"br", "td", "th", "mtd"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Their text goes up to the end tag, or else up to the end of the page.
RAW = set("script style textarea title".split())
# Shown by other means or not at all: they go with what is inside if they are closed; of an open one
# only the tag goes.
CLOSED = set("iframe template svg annotation annotation-xml".split())
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "option": {"option"}, "optgroup": {"option", "optgroup"},
    "tbody": {"tbody", "thead", "tr"}, "tfoot": {"tbody", "thead", "tr"},
}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}}
# Their end tags are often left out; what comes after is not part of them.
CHOICES = {"select", "option", "optgroup"}
CLOSES_CHOICES = CLOSES_P - {"hr"}
FURNITURE_TAGS = set("nav footer aside form button dialog menu head object".split()) | CHOICES
FURNITURE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "menu navbar navigation nav breadcrumb breadcrumbs pagination pager footer masthead sidebar "
    "aside widget related recommended comment comments reply replies respond disqus discussion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social toolbar skip copyright".split()
)
LANDMARKS = {"article", "main"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S,
)
_NAMED = re.compile(r"(?:\s|^)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:\s|^)hidden(?:[\s=/]|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_PAIRED = {
    name: re.compile(
        r"<!--.*?(?:-->|\Z)|<(script|style|textarea)\b[^>]*>.*?(?:</\1\b|\Z)"
        rf"|<(?P<end>/?)(?P<name>{name})(?=[\s/>])(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
        re.I | re.S,
    )
    for name in CLOSED
}


@dataclass
class Node:
    tag: str
    label: str
    path: int
    parent: int
    names: frozenset[str]
    hidden: bool
    children: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)


def _names(rest: str) -> tuple[str, frozenset[str]]:
    """Label part and words of class, id and role; digits, as in numbered ids, do not count."""
    label, words = [], set()
    for key, *values in _NAMED.findall(rest):
        found = _WORD.findall(next((v for v in values if v), ""))
        lowered = sorted({w.lower() for w in found})
        label.append(f"{key.lower()}={'.'.join(lowered)}")
        words.update(lowered)
    return ";".join(label), frozenset(words)


def _closed(page: str, name: str) -> dict[int, int]:
    """Start of every element of that name that has its end tag -> where it ends."""
    ends, waiting = {}, []
    for found in _PAIRED[name].finditer(page):
        if not found["name"]:
            continue
        if not found["end"]:
            if not found["rest"].endswith("/"):
                waiting.append(found.start())
        elif waiting:
            ends[waiting.pop()] = found.end()
    return ends


def parse_page(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements as nodes, the root first, and the text blocks in page order.

    Tags may be left open or closed out of order; a block ends wherever a block element begins or
    ends. Inline elements only carry text.
    """
    nodes = [Node("", "", 0, -1, frozenset(), False)]
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("", 0)]
    open_text: list[str] = []
    closed: dict[str, dict[int, int]] = {}

    def close_block() -> None:
        if open_text:
            text = " ".join(entities.unescape("".join(open_text)).split())
            open_text.clear()
            if text:
                node = stack[-1][1]
                nodes[node].texts.append(text)
                blocks.append((node, text))

    def close_to(depth: int) -> None:
        if any(tag not in INLINE for tag, _ in stack[depth:]):
            close_block()
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if not found:
            open_text.append(page[at:])
            break
        if found.start() > at:
            open_text.append(page[at : found.start()])
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        name = name.lower()
        if found["end"] or found["end2"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if name in INLINE:
                if name in SPACED and name not in VOID:
                    open_text.append(" ")
                if depth and all(tag in INLINE for tag, _ in stack[depth:]):
                    del stack[depth:]
                elif depth:
                    del stack[depth]
            elif depth:
                close_to(depth)
            else:
                close_block()
            continue
        rest = found["rest"] if found["name"] else found["rest2"]
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else size
            continue
        if name in CLOSED:
            if name not in closed:
                closed[name] = _closed(page, name)
            at = closed[name].get(found.start(), at)
            continue
        if name in INLINE:
            if name in SPACED:
                open_text.append(" ")
            if name not in VOID and not (name == "math" and rest.endswith("/")):
                stack.append((name, stack[-1][1]))
            continue
        close_block()
        if name in CLOSES_CHOICES or name == "select":
            depth = next((i for i, (tag, _) in enumerate(stack) if tag in CHOICES), 0)
            if depth:
                close_to(depth)
        if name in CLOSES_P or name in CLOSES_LIKE:
            like = CLOSES_LIKE.get(name, {"p"})
            stop = SCOPES.get(name, {"table"}) | {"article", "main", "body"} | ({"div", "section"} if like == {"p"} else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in like:
                    close_to(i)
                    break
                if stack[i][0] in stop:
                    break
        if name in VOID:
            continue
        parent = stack[-1][1]
        label, words = _names(rest) if "=" in rest else ("", frozenset())
        label = f"{name}[{label}]" if label else name
        path = xxhash.xxh3_64_intdigest(f"{nodes[parent].path}/{label}") >> 1
        nodes[parent].children.append(len(nodes))
        stack.append((name, len(nodes)))
        nodes.append(Node(name, label, path, parent, words, bool(_HIDDEN.search(rest))))
    close_block()
    return nodes, blocks


def _digest(parts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) >> 1


def block_feature(text: str) -> int:
    """Blocks that differ in case alone are one feature."""
    return xxhash.xxh3_64_intdigest(text.lower()) >> 1


def page_styles(page: str) -> Iterator[tuple[int, int, dict[int, int]]]:
    """``(path, style, blocks)`` of every path of a page: what its nodes show, and the blocks they
    hold with their numbers."""
    nodes, _ = parse_page(page)
    styles: dict[int, tuple[list[str], Counter]] = {}
    for node in nodes[1:]:
        shown, held = styles.setdefault(node.path, ([], Counter()))
        # Runs of like children count as one, as paragraphs and list items do.
        labels = [nodes[c].label for c in node.children]
        shown += [x for i, x in enumerate(labels) if not i or labels[i - 1] != x] + ["|"]
        held.update(map(block_feature, node.texts))
    for path, (shown, held) in styles.items():
        yield path, _digest(list(dict.fromkeys(shown))), dict(sorted(held.items()))


def _is_cut(node: Node, inside_article: bool) -> bool:
    """Whether the tag alone says that a branch is no content."""
    return node.tag in FURNITURE_TAGS or node.hidden or (node.tag == "header" and not inside_article)


@dataclass
class Rules:
    """Which evidence beside the tree counts."""

    tags: bool = True
    names: bool = True
    landmarks: bool = True


def main_text(page: str, importance: dict[int, tuple[float, float]], rules: Rules = Rules()) -> str:
    """The blocks that are left when furniture and branches of low importance are removed.

    ``importance`` maps a path to its presentation and content importance; an unknown path has 1.
    If the page has an article or main element that is not furniture, only these count.
    """
    nodes, blocks = parse_page(page)
    held = [0] * len(nodes)
    for node, text in blocks:
        held[node] += len(text)
    within = list(held)
    composite = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        node = nodes[i]
        shown, content = importance.get(node.path, (1.0, 1.0))
        own = CONTENT * content + (1 - CONTENT) * shown if node.texts else 0.0
        composite[i] = max([own, *(composite[c] for c in node.children)])
        within[node.parent] += within[i]

    # What tags cut off, and which landmark is the page's article: the one with most text that does
    # not lie in a branch named as furniture, if there is one.
    cut, landmark, named = [False] * len(nodes), [False] * len(nodes), [False] * len(nodes)
    main, main_rank = 0, (False, 0)
    for i in range(1, len(nodes)):
        node, up = nodes[i], nodes[i].parent
        own_name = rules.names and node.tag not in ("html", "body") and bool(node.names & FURNITURE_NAMES)
        is_landmark = rules.landmarks and node.tag in LANDMARKS
        cut[i] = cut[up] or (rules.tags and _is_cut(node, landmark[up]))
        if is_landmark and not landmark[up] and (not named[up], within[i]) > main_rank:
            main, main_rank = i, (not named[up], within[i])
        landmark[i] = landmark[up] or is_landmark
        named[i] = named[up] or own_name
    total = sum(held[i] for i in range(len(nodes)) if not cut[i])
    holds_main = [False] * len(nodes)
    at = main
    while at > 0:
        holds_main[at] = True
        at = nodes[at].parent

    def keeps(tree: bool) -> list[bool]:
        """Nodes that stay, with the tree's say or without."""
        dropped, inside = [False] * len(nodes), [False] * len(nodes)
        has_landmark = False
        for i in range(1, len(nodes)):
            node, up = nodes[i], nodes[i].parent
            is_landmark = rules.landmarks and node.tag in LANDMARKS
            furniture = rules.tags and _is_cut(node, inside[up])
            worth = composite[i] if tree and within[i] else 1.0
            # What the article holds, the same on all pages or not, is part of it.
            least = 0.0 if inside[up] or is_landmark else LOW
            if rules.names and node.tag not in ("html", "body") and node.names & FURNITURE_NAMES:
                most = not main and 2 * within[i] > total
                if not (holds_main[i] or most):
                    worth, least = worth * NAMED, LOW
            # An article after an unclosed menu or advert is not part of it.
            freed = is_landmark and not furniture and not has_landmark
            dropped[i] = (dropped[up] and not freed) or furniture or (worth < least and not holds_main[i])
            inside[i] = inside[up] or (is_landmark and not dropped[i])
            has_landmark |= inside[i]
        return [not dropped[i] and (inside[i] or not has_landmark) for i in range(len(nodes))]

    kept = keeps(tree=True)
    plain = keeps(tree=False)
    left, whole = (sum(size for size, stays in zip(held, nodes_kept, strict=True) if stays) for nodes_kept in (kept, plain))
    if 4 * left < whole:
        kept = plain
    return "\n".join(text for node, text in blocks if kept[node])


def _styles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, host, page in zip(batch["key"], batch["host"], batch["html"], strict=True):
            for path, style, blocks in page_styles(page):
                rows.append((key, host, path, style, list(blocks), list(blocks.values())))
        yield pd.DataFrame(rows, columns=["key", "host", "path", "style", "blocks", "times"])


def style_tree(styles: DataFrame) -> DataFrame:
    """``host, path, shown, held``: importance of every node of the hosts' style trees.

    Pages are counted per style and per block before entropies are summed, and the mean entropy of a
    node's blocks needs two sums only, so a host may have any share of all pages. ``styles`` has a
    row per page and path.
    """
    node = ["host", "path"]
    n, times_log = F.col("n"), F.sum(F.col("n") * F.log("n"))
    looks = styles.groupBy(*node, "style").agg(F.count(F.lit(1)).cast("double").alias("n"))
    looks = looks.groupBy(*node).agg(F.sum("n").alias("pages"), times_log.alias("nlogn"))
    pairs = F.explode(F.arrays_zip("blocks", "times")).alias("b")
    blocks = styles.select(*node, pairs).select(
        *node, F.col("b.blocks").alias("block"), F.col("b.times").cast("double").alias("n")
    )
    blocks = blocks.groupBy(*node, "block").agg(F.sum("n").alias("n"), times_log.alias("nlogn"))
    # n times the entropy of a block, in natural units, is n log n less the sum over its pages.
    content = blocks.groupBy(*node).agg(
        F.sum("n").alias("held_blocks"), F.sum(n * F.log(n) - F.col("nlogn")).alias("spread")
    )
    joined = looks.join(content, node, "left")
    pages, several = F.col("pages"), F.col("pages") > 1

    def drawn(importance):
        bounded = F.greatest(F.least(importance, F.lit(1.0)), F.lit(0.0))
        return (bounded * pages + PRIOR_PAGES) / (pages + PRIOR_PAGES)

    shown = F.when(several, (F.log(pages) - F.col("nlogn") / pages) / F.log(pages)).otherwise(1.0)
    held = F.when(several, 1 - F.col("spread") / F.col("held_blocks") / F.log(pages)).otherwise(1.0)
    return joined.select(
        *node, drawn(shown).alias("shown"), drawn(F.coalesce(held, F.lit(1.0))).alias("held")
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as Zstandard frames: what is shuffled is mostly html."""
    packer = zstandard.ZstdCompressor()
    for batch in batches:
        at = batch.schema.get_field_index("html")
        frames = [packer.compress(page) for page in batch.column(at).cast(pa.binary()).to_pylist()]
        yield batch.set_column(at, "html", pa.array(frames, pa.binary()))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = []
        for frame, tree in zip(batch["html"], batch["tree"], strict=True):
            known = {} if tree is None else {t["path"]: (t["shown"], t["held"]) for t in tree}
            texts.append(main_text(unpacker.decompress(frame).decode(), known))
        out = pd.DataFrame({"page_id": batch["id"], "url": batch["url"], "text": texts})
        out["n_chars"] = out["text"].str.len().astype("int64")
        # Ids travel as text: a missing one would turn whole numbers into floats.
        out["page_id"] = out["page_id"].map(lambda x: None if x is None else int(x)).astype("Int64")
        yield out


def extract_pages(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of pages.

    White space inside a block becomes one space; blocks are joined by line feeds. A NULL or empty
    html gives an empty text. A page without a host has no style tree, only furniture is removed.
    Rows of one host with equal html are extracted alike and count once in the tree, whatever their
    ids and urls. Other columns are not read.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.col(url_col), r"//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    base = pages.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.when(host != "", host).alias("host"),
    ).withColumn("key", F.xxhash64("host", "html"))
    schema = "key long, host string, path long, style long, blocks array<long>, times array<int>"
    styles = base.where("host is not null").select("key", "host", "html").mapInPandas(_styles, schema)
    styles = materialise(styles.distinct(), "html-styles")
    salt = F.pmod("key", F.lit(SALTS)).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    tree = style_tree(styles).withColumn("salt", spread)
    placed = styles.select("key", "host", "path", salt.alias("salt")).join(tree, ["host", "path", "salt"])
    of_page = placed.groupBy("key").agg(F.collect_list(F.struct("path", "shown", "held")).alias("tree"))
    packed = base.select("key", "id", "url", "html").mapInArrow(
        _packed, "key long, id string, url string, html binary"
    )
    joined = packed.join(of_page, "key", "left").select("id", "url", "html", "tree")
    return joined.mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
