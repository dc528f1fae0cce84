"""Operator 9: main text of HTML pages by tag-path ratios.

A page is read once into blocks of text, each with its root-to-leaf path of tags (and of the
container each stands in).  Per path the lengths of all its texts, their punctuation and the share
inside links are added up.  Two ratios, text per node and punctuation per node, are smoothed over the
page order of the blocks, fused by their product, and cut at a threshold relative to their spread:
blocks of the paths above it are content nodes.  Their text and their scores choose the article:
an ``article`` or ``main`` element that holds half of their text, else the element around the headline
whose paths score above all content outside it, else the one that holds nearly all.  Its other blocks
(titles, short paragraphs, list items, whose own ratios are low) belong to it unless their path runs
through an element that is never article text, by its tag or by a word of its class, id or role.
Where no ``article`` or ``main`` element bounds the article, runs of links before its first and after
its last prose are lists beside it and left out; all other linked text, headlines and lists of
references included, is the article's.  Words of class, id and role are evidence only: names are
split at hyphens and capitals; an element they reject by a part of a name (``has-sidebar``) keeps its
text if most of the page's prose is in it; a paragraph, headline or item is rejected only by a name
that says notice or advert and nothing else; and where words would leave a page without prose they
are not used.

Defined cases: null and empty pages and pages without text give the empty text; unclosed and
stray end tags are tolerated (paragraphs, list items, cells and options close each other);
comments (closed by ``-->`` or ``--!>``, at once in ``<!-->``), scripts, styles, drawings and unfinished
tags are markup, and so is a tag up to its first ``>`` if a quote in it stays open; text of formulas
and of objects, films and canvases is text.  Time and memory grow in proportion to the page, however
deep or unclosed its elements are.  Pages are independent rows, so ties and repeated rows do not
matter; further columns are carried through.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm.names import quoted
from lapse.llm.words import slices

#: elements without content
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is no text
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes svg annotation annotation-xml".split())
#: elements that never hold article text
NEVER = frozenset("nav aside footer form button select option label input dialog menu fieldset datalist head".split())
#: elements inside a line of text
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big br canvas cite code data del dfn em font i img ins kbd mark math object q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var video wbr".split())
#: elements that are a text and not a container: a word of BOILER says how they look, only words of NOTICE reject them
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figure figcaption caption tr tbody".split()) | INLINE
#: all words in the name of a text that is a notice or an advert
NOTICE = frozenset(
    "ad ads advert advertisement adsense banner promo sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal newsletter "
    "subscribe box bar text label message msg".split())
#: words of a class, id or role that say the same as NEVER
BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|comments?|commentlist|replies|respond|disqus|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|sidebar|side-?bar|widget\w*|related|"
    r"recommend\w*|share|sharing|social|newsletter|subscribe|signup|login|search|footer|masthead|site-?header|toolbar|tags?|toc|skip|"
    r"contentinfo|complementary|dialog|form)(?:$|[\s_-])")
#: an open element of the first kind is closed by a start tag of the second
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"]),
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p "
        "pre section table ul".split()),
}
#: a start tag does not close elements beyond these
WALL = frozenset("table ul ol dl td th article section div body html blockquote button object".split())
#: the other way round: the open elements that a start tag closes
CLOSES = {name: [t for t in CLOSED_BY if name in CLOSED_BY[t]] for name in frozenset().union(*CLOSED_BY.values())}
#: a quote opens a value only after "=", and only if white space or the tag's end follows its closing quote
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|$))|<[!?][^>]*(?:>|$)|"
    r"</?[a-zA-Z](?>=\s*(?:\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>]))|[^>])*+(?:>|$)|[^<]+|<", re.S)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*?)(/?)>?$", re.S)
MARK = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S | re.I)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in RAW}
SPACE = re.compile(r"\s+")
LONG = 120  # a text of so many characters is prose without punctuation too
PUNCT = re.compile(r"[.,;:!?…、。，！？]")


@dataclass
class Node:
    tag: str
    path: int  # number of the tag path from the root
    never: bool
    number: int
    parent: "Node | None"
    depth: int
    #: what its class, id and role say: 0 nothing, 1 a word of BOILER as a part of a name, 2 a whole one
    marked: int = 0
    inline: bool = False
    home: bool = False  # an article or main element, or inside one
    block: "Node | None" = None  # the nearest element around it, itself included, that is not inline
    link: "Node | None" = None  # the nearest link


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked_parts: list[str] = field(default_factory=list)
    link_numbers: set[int] = field(default_factory=set)
    linked: int = 0
    text: str = ""


def mark(name: str, rest: str, up: Node) -> int:
    """What class, id and role of a start tag say (``Node.marked``)."""
    if name in ("html", "body", "main") or name == "article" and not up.home:
        return 0
    names = " ".join(CAMEL.sub("-", x) for g in MARK.findall(rest) for x in g[1:] if x).lower()
    if name in TEXT:
        parts = (re.split("[_-]+", x) for x in names.split())
        return 2 if any(NOTICE.issuperset(x) and BOILER.search(" ".join(x)) for x in parts) else 0
    if not BOILER.search(names):
        return 0
    return 2 if any(BOILER.fullmatch(x) for x in names.split()) else 1


def blocks_of(page: str) -> tuple[list[Block], list[Node]]:
    """Blocks of text in page order, and all elements, each after its parent."""
    root = Node("", 0, False, 0, None, 0)
    root.block = root
    stack, nodes = [root], [root]
    paths: dict[tuple[int, str], int] = {}
    places: dict[str, list[int]] = defaultdict(list)  # where on the stack the open elements of a tag are
    walls = [0]
    out: list[Block] = []
    open_block: Block | None = None
    pos = 0

    def close(n: int) -> None:
        nonlocal open_block
        while len(stack) > n:
            x = stack.pop()
            places[x.tag].pop()
            if x.tag in WALL:
                walls.pop()
            if not x.inline:
                open_block = None

    while pos < len(page):
        m = TOKEN.match(page, pos)
        tok, pos = m.group(), m.end()
        if tok[0] != "<" or tok == "<":
            if open_block is None:
                if not tok.strip():
                    continue
                open_block = Block(stack[-1].block)
                out.append(open_block)
            open_block.parts.append(tok)
            link = stack[-1].link
            if link is not None:
                open_block.linked_parts.append(tok)
                open_block.link_numbers.add(link.number)
            continue
        t = TAG.match(tok)
        if tok.startswith(("<!", "<?")) or not t:
            continue
        end, name, rest, empty = t.group(1), t.group(2).lower(), t.group(3), t.group(4)
        up = stack[-1]
        formula = up.inline and bool(places["math"])
        inline = name in INLINE or formula
        if end:
            if places[name]:
                close(places[name][-1])
            elif not inline:
                open_block = None
            continue
        if name in RAW:
            if not empty:
                # the content is not read as markup: a "<" in it starts no tag
                close_tag = RAW_END[name].search(page, pos)
                pos = close_tag.start() if close_tag else len(page)
            continue
        if name == "br":
            if open_block is not None:
                open_block.parts.append(" ")
            continue
        nearest = max((places[x][-1] for x in CLOSES.get(name, ()) if places[x]), default=0)
        if nearest and nearest >= walls[-1]:
            close(nearest)
            up = stack[-1]
        if not inline:
            open_block = None
        if name in VOID or empty and (formula or not inline):
            continue
        if name == "a" and open_block is not None:
            open_block.linked_parts.append(" ")
        x = Node(name, paths.setdefault((up.path, name), len(paths) + 1), up.never or name in NEVER or name == "header" and not up.home,
                 len(nodes), up, up.depth + 1, mark(name, rest, up) if "=" in rest else 0, inline, up.home or name in ("article", "main"))
        x.block = up.block if inline else x
        x.link = x if name == "a" else up.link
        places[name].append(len(stack))
        if name in WALL:
            walls.append(len(stack))
        stack.append(x)
        nodes.append(x)
    for b in out:
        b.text = decoded(b.parts)
        if b.linked_parts:
            b.linked = min(len(decoded(b.linked_parts)), len(b.text))
    out = [b for b in out if b.text]
    reject(out, nodes)
    return out, nodes


def totals(nodes: list[Node], own: dict[int, int]) -> list[int]:
    """Per element the sum of ``own`` over it and all elements inside it."""
    out = [own.get(x.number, 0) for x in nodes]
    for x in reversed(nodes[1:]):
        out[x.parent.number] += out[x.number]
    return out


def decoded(parts: list[str]) -> str:
    return SPACE.sub(" ", html.unescape("".join(parts))).strip()


def reject(blocks: list[Block], nodes: list[Node]) -> None:
    """Settle which elements their class, id and role reject, with all inside them."""
    if any(x.marked for x in nodes):
        own: dict[int, int] = defaultdict(int)
        for b in blocks:
            if not b.node.never and 2 * b.linked <= len(b.text) and (len(b.text) >= LONG or PUNCT.search(b.text)):
                own[b.node.number] += len(b.text)
        inside = totals(nodes, own)
        # the nearest element with a mark, itself included, and the prose that stands directly under each
        near: list[int] = []
        direct: dict[int, int] = defaultdict(int)
        for x in nodes:
            near.append(x.number if x.marked else near[x.parent.number] if x.parent else -1)
            direct[near[-1]] += own.get(x.number, 0)
        beside, free = direct[-1], {-1}
        # wrappers first: an element holds no more than those around it
        for x in sorted((x for x in nodes if x.marked == 1 and 2 * inside[x.number] >= inside[0]), key=lambda x: (-inside[x.number], x.number)):
            if inside[x.number] and inside[x.number] >= 4 * beside:
                x.marked = 0
                if near[x.parent.number] in free:
                    free.add(x.number)
                    beside += direct[x.number]
        for kind in (1, 2):
            if beside or not inside[0]:
                break
            clear = [True]
            for x in nodes[1:]:
                x.marked = 0 if x.marked == kind else x.marked
                clear.append(clear[x.parent.number] and not x.marked)
                beside += own.get(x.number, 0) if clear[-1] else 0
    for x in nodes[1:]:
        x.never = x.never or x.marked > 0 or x.parent.never


def smooth(x: list[float]) -> list[float]:
    """Weighted mean with the two neighbours on either side."""
    weights = (0.1, 0.2, 0.4, 0.2, 0.1)
    out = []
    for i in range(len(x)):
        pairs = [(w, x[i + d]) for d, w in zip(range(-2, 3), weights) if 0 <= i + d < len(x)]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    return out


def content_nodes(blocks: list[Block]) -> tuple[list[bool], list[float]]:
    """Whether each block's path is above the threshold of the fused ratios, and the path's score."""
    length: dict[tuple, int] = defaultdict(int)
    marks: dict[tuple, int] = defaultdict(int)
    linked: dict[tuple, int] = defaultdict(int)
    nodes: dict[tuple, int] = defaultdict(int)
    key = lambda b: (b.node.never, b.node.path)
    for b in blocks:
        k = key(b)
        length[k] += len(b.text)
        marks[k] += len(PUNCT.findall(b.text))
        linked[k] += b.linked
        nodes[k] += 1
    text = smooth([max(0, length[key(b)] - 2 * linked[key(b)]) / nodes[key(b)] for b in blocks])
    punct = smooth([marks[key(b)] / nodes[key(b)] for b in blocks])
    fused = [math.sqrt(t * (p + 0.1)) for t, p in zip(text, punct)]
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    top: dict[tuple, list[float]] = defaultdict(list)
    for b, x in zip(blocks, fused):
        top[key(b)].append(x)
    score = {k: sum(v) / len(v) for k, v in top.items()}
    cut = min(max(mean - 0.8 * spread, 0.0), max(score.values(), default=0.0))
    return [score[key(b)] >= cut and not b.node.never for b in blocks], [score[key(b)] for b in blocks]


def article(blocks: list[Block], chosen: list[bool], scores: list[float], nodes: list[Node]) -> Node | None:
    """The element that is the article: the deepest ``article`` or ``main`` that holds half of the text of the content
    nodes; else the deepest one around the headline that ``headed`` finds, or that holds nearly all of that text."""
    own: dict[int, int] = defaultdict(int)
    for b, c in zip(blocks, chosen):
        if c:
            own[b.node.number] += len(b.text)
    inside = totals(nodes, own)
    if not inside[0]:
        return None
    named = [x for x in nodes if x.tag in ("article", "main") and 2 * inside[x.number] >= inside[0]]
    if named:
        return max(named, key=lambda x: x.depth)
    most = max((x for x in nodes if 10 * inside[x.number] >= 9 * inside[0]), key=lambda x: x.depth)
    return max(most, headed(blocks, chosen, scores, nodes) or most, key=lambda x: x.depth)


def headed(blocks: list[Block], chosen: list[bool], scores: list[float], nodes: list[Node]) -> Node | None:
    """The deepest element around the first headline that holds half of the content text, all whose other content
    lies on paths that score less than its own do on average."""
    at = next((b.node for b in blocks if b.node.tag == "h1" and not b.node.never), None)
    chain: list[Node] = []
    while at is not None:
        chain.append(at)
        at = at.parent
    if not chain:
        return None
    # where each element meets the chain: the deepest link of the chain that holds it
    place = {x.number: k for k, x in enumerate(chain)}
    met: list[int] = []
    for x in nodes:
        met.append(place[x.number] if x.number in place else met[x.parent.number])
    text, weighted, best = [0.0] * len(chain), [0.0] * len(chain), [0.0] * len(chain)
    for b, c, score in zip(blocks, chosen, scores):
        if c:
            k = met[b.node.number]
            text[k] += len(b.text)
            weighted[k] += len(b.text) * score
            best[k] = max(best[k], score)
    for k in range(len(chain) - 2, -1, -1):
        best[k] = max(best[k], best[k + 1])
    total, held, mass = sum(text), 0.0, 0.0
    for k, x in enumerate(chain):
        held, mass = held + text[k], mass + weighted[k]
        if held and 2 * held >= total and (k + 1 == len(chain) or best[k + 1] * held < mass):
            return x
    return None


def extract(page: str | None) -> str:
    """Main text of a page: blocks joined by newlines."""
    blocks, nodes = blocks_of(page) if page else ([], [])
    if not blocks:
        return ""
    chosen, scores = content_nodes(blocks)
    home = article(blocks, chosen, scores, nodes)
    if home is None:
        return ""
    # a container that is itself a block (one long paragraph, say) stands for its parent's blocks
    if home.tag not in ("article", "main", "body", "div", "section", "td") and home.parent is not None:
        home = home.parent
    within: list[bool] = []
    for x in nodes:
        within.append(x is home or x.parent is not None and within[x.parent.number])
    mine = [(b, c) for b, c in zip(blocks, chosen) if within[b.node.number] and not b.node.never]
    beside = set() if home.tag in ("article", "main") else link_lists([b for b, _ in mine], [c for _, c in mine], home)
    return "\n".join(b.text for n, (b, _) in enumerate(mine) if n not in beside)


def link_lists(blocks: list[Block], content: list[bool], home: Node) -> set[int]:
    """Blocks of runs of two or more links before the first or after the last prose of ``home``; a list that
    follows the prose as its sibling is the article's, unless ``home`` is the whole page."""
    linked = [2 * b.linked > len(b.text) for b in blocks]
    prose = [n for n, (b, c) in enumerate(zip(blocks, content)) if c and not linked[n]]
    out: set[int] = set()
    if not prose:
        return out
    whole = home.tag in ("", "html", "body")
    run: list[int] = []
    for n in range(len(blocks) + 1):
        if n < len(blocks) and linked[n] and not re.fullmatch("h[1-6]", blocks[n].node.tag) and not prose[0] < n < prose[-1]:
            if n < prose[0] or whole or not sibling(blocks[n].node, home):
                run.append(n)
                continue
        if sum(len(blocks[k].link_numbers) for k in run) > 1:
            out.update(run)
        run = []
    return out


def sibling(node: Node, home: Node) -> bool:
    """Whether a block's element, or the list it is an item of, stands in ``home`` itself."""
    while node.tag in ("li", "dt", "dd") and node.parent is not None:
        node = node.parent
    return node.parent is home and node.tag in ("ul", "ol", "dl", "p")


def main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text instead of the html."""
    rest = [f for f in pages.schema.fields if f.name not in (html_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [extract(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    row_type = T.StructType([T.StructField("_", T.IntegerType()), *rest])
    src = pages.select(F.struct(F.lit(0).alias("_"), *[quoted(f.name) for f in rest]).alias("row"), quoted(html_col).cast("string").alias("html"))
    out = src.mapInArrow(run, T.StructType([T.StructField("row", row_type), T.StructField("text", T.StringType())]))
    return out.select(*[F.col("row")[f.name].alias(f.name) for f in rest], F.col("text").alias(out_col))
