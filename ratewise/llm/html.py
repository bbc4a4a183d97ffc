"""Main-text extraction from HTML by composite text density.

A page is parsed into a light DOM (own scanner: unclosed, misnested and
truncated markup is accepted). Subtrees that are never main text by their tag
(scripts, styles, forms, navigation, page headers and footers, asides) or
hidden are left out. Names (class, id, role) of a menu, advert, notice, comment
list and the like put an element in doubt:

* strong doubt: a whole name of such words and of words of layout
  (``comment-list``, ``ad``), or any such role. The subtree goes, unless it is
  a wrapper: it holds over half of the page's text outside links, with an
  article, main or h1 element (or, if it does not name comments, paragraphs).
* weak doubt: such a word beside others (``related-work``), or an ambiguous
  one as the id of a section or paragraph (``discussion``). The subtree goes
  only where links or density say so too: at least a third of its text is
  links, or it has fewer characters a tag than the page.

Names of headings and of text-level tags in weak doubt decide nothing. Then,
for every node,

    density = C/T * log(C/LC' * T/LT') / log(ln(C*LC/(C-LC) + LCb*C/Cb + e))

with C characters, T tags, LC link characters, LT link tags, and the body's LCb
and Cb (x' is at least 1). The density sum of a node adds the densities of its
children. The container with the largest sum is the centre of the content (an
article or main element around it is kept, but for containers in it that are
mostly links and below the threshold; so are headings beside the path to it),
and the smallest density on the path from it up to body is the threshold: in every
subtree whose density reaches it, the node of the largest sum is kept whole.

Blocks are what block-level tags and cells delimit; ``<br>`` is white space.
Character references are decoded, white space in a block becomes one space,
and blocks are joined by an empty line. Pages are independent rows.

Defined results: a null or empty page, or one without text, gives an empty
text; page text outside any tag counts as part of body; repeated rows give
repeated results; nothing is shortened.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import ship_package, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Tags whose subtree is never main text.
CUT = frozenset("script style noscript template iframe textarea title head nav header footer aside form button select "
                "option input label fieldset svg canvas object embed menu dialog audio video map".split())
BLOCK = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
                  "hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: A tag that opens closes an open tag of the same group (down to the barrier).
CLOSES = {
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol dl div table section article blockquote pre figure main hr address details".split(), frozenset({"p"})),
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}
BARRIER = frozenset("table ul ol dl div article section main body html td th blockquote figure details button object".split())
#: Words of class, id and role names that put an element in doubt.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu menus nav navbar "
    "navigation breadcrumb breadcrumbs sidebar sidebars aside header masthead footer foot comment comments discussion reply "
    "replies disqus cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations widget widgets toolbar pagination pager search "
    "complementary contentinfo copyright legal disclaimer skip hidden".split())
#: Words of names that say where or how, not what.
LAYOUT = frozenset(
    "area article articles bar block body bottom box btn button buttons center col column container content count desktop "
    "element entry feed field form global group holder icon icons id inner item items js layout left link links list main "
    "mini mobile module outer page pages panel post posts primary reader readers region right row secondary section site slot "
    "sticky stories story strip tab tabs text thread title toggle top unit user users view wrap wrapper zone".split())
#: Words that are as likely the name of a part of an article.
AMBIGUOUS = frozenset(
    "alert banner cookie cookies copyright discussion disclaimer header legal menu menus notice notices promotion "
    "recommendations recommended related replies reply search share sharing social subscription".split())
COMMENTS = frozenset("comment comments discussion reply replies disqus".split())
TEXT_LEVEL = frozenset("p b i em strong span code cite q small sub sup u mark abbr dfn a li dt dd td th".split())
LINK_SHARE = 1 / 3
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only after an equals sign; elsewhere it is a character like any other.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))|(?=[\s/]|$))", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Tags that can be the centre of the content; paragraphs and inline tags cannot.
CONTAINER = frozenset("article blockquote body center dd div details figure li main ol pre section table tbody td tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_BODY = ("body", "html", "article", "main")


class Node:
    __slots__ = ("tag", "kids", "doubt", "comments", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag: str, doubt: int = 0, comments: bool = False):
        self.tag = tag
        self.doubt, self.comments = doubt, comments
        self.kids: list[Node | str] = []


def _named(tag: str, attrs: str) -> tuple[bool, int, bool]:
    """Whether an element is never main text, how its names put it in doubt
    (0 none, 1 weak, 2 strong), and whether they name comments."""
    if tag in CUT:
        return True, 0, False
    if not attrs or attrs.isspace() or tag in _BODY:
        return False, 0, False
    doubt, comments = 0, False
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = a or b or c, name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True, 0, False
        if name not in ("class", "id", "role"):
            continue
        for part in value.split():
            words = [w.lower() for w in _WORD.findall(part)]
            noise = [w for w in words if w in NOISE]
            if not noise:
                continue
            whole = all(w in NOISE or w in LAYOUT for w in words)
            anchor = name == "id" and (tag == "section" or tag in TEXT_LEVEL) and all(w in AMBIGUOUS for w in noise)
            sure = name == "role" or whole and not anchor
            comments = comments or any(w in COMMENTS for w in noise)
            doubt = max(doubt, 2 if sure else 1)
    if tag in HEADING or doubt == 1 and tag in TEXT_LEVEL:
        return False, 0, False
    return False, doubt, comments


def parse(html: str) -> Node:
    """Light DOM under a body node, without what is never main text by tag."""
    body = Node("body")
    stack = [body]
    cut: list[str] = []  # open tags inside a subtree that is cut
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            if not cut:
                stack[-1].kids.append(html[at:])
            break
        if m.start() > at and not cut:
            stack[-1].kids.append(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if cut:
                if tag in cut:
                    while cut.pop() != tag:
                        pass
                elif tag in ("body", "html") or any(x.tag == tag for x in stack[1:]) and tag in BARRIER:
                    cut = []  # the cut element was never closed
            if not cut:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
                    if stack[i].tag in BARRIER and tag not in BARRIER:
                        break
            continue
        empty = tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW
        if tag in RAW and not empty:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
            if end is None and tag in ("title", "noscript", "textarea"):
                continue
            at = end.start() if end else n
            gt = html.find(">", at)
            at = n if end is None or gt < 0 else gt + 1
            continue
        if cut:
            if not empty:
                cut.append(tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES[tag]:
                    del stack[i:]
                elif stack[i].tag in BARRIER:
                    break
        never, doubt, comments = _named(tag, m[3])
        if never:
            if not empty:
                cut.append(tag)
            continue
        node = Node(tag, doubt, comments)
        stack[-1].kids.append(node)
        if not empty:
            stack.append(node)
    return body


def _walk(body: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, at = [body], 0
    while at < len(out):
        out.extend(k for k in out[at].kids if not isinstance(k, str))
        at += 1
    return out


def _count(order: list[Node]) -> None:
    """Fill the counts of every subtree."""
    for x in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for k in x.kids:
            if isinstance(k, str):
                chars += len("".join(k.split()))
            else:
                chars += k.chars
                tags += k.tags + 1
                link_chars += k.link_chars
                link_tags += k.link_tags + (k.tag == "a")
        if x.tag == "a":
            link_chars = chars
        x.chars, x.tags, x.link_chars, x.link_tags = chars, tags, link_chars, link_tags


def prune(body: Node) -> None:
    """Cut the subtrees whose names, and where needed links or density, say they are not main text."""
    order = _walk(body)
    if not any(x.doubt for x in order):
        return
    _count(order)
    plain, each = body.chars - body.link_chars, body.chars / max(body.tags, 1)
    holds: dict[int, tuple[bool, int]] = {}  # whether a subtree has an article, main or h1, and its paragraphs
    for x in reversed(order):
        kids = [holds[id(k)] for k in x.kids if not isinstance(k, str)]
        holds[id(x)] = x.tag in ("article", "main", "h1") or any(a for a, _ in kids), (x.tag == "p") + sum(n for _, n in kids)

    def goes(x: Node) -> bool:
        most = 2 * (x.chars - x.link_chars) > plain
        if most and x.doubt == 1:
            return False
        if x.doubt == 1:
            return x.link_chars >= LINK_SHARE * x.chars or x.chars < each * max(x.tags, 1)
        if not most:
            return True
        article, paragraphs = holds[id(x)]
        return not (article or not x.comments and paragraphs > 1)

    todo = [body]
    while todo:
        x = todo.pop()
        x.kids = [k for k in x.kids if isinstance(k, str) or not k.doubt or not goes(k)]
        todo.extend(k for k in x.kids if not isinstance(k, str))


def measure(body: Node) -> list[Node]:
    """Fill counts, density, density sum and the best node of every subtree."""
    order = _walk(body)
    _count(order)
    ratio = body.link_chars / body.chars if body.chars else 0.0
    for x in reversed(order):
        c, t, lc, lt = x.chars, max(x.tags, 1), x.link_chars, max(x.link_tags, 1)
        if c:
            base = math.log(c * lc / max(c - lc, 1) + ratio * c + math.e)
            x.density = c / t * math.log(max(c / max(lc, 1) * t / lt, 1.0)) / math.log(base + 1)
        else:
            x.density = 0.0
        kids = [k for k in x.kids if not isinstance(k, str)]
        x.total = sum(k.density for k in kids)
        x.best = x
        for k in kids:
            b = k.best
            if b.tag in CONTAINER and (b.total > x.best.total or x.best.tag not in CONTAINER):
                x.best = b
    return order


def content_nodes(body: Node) -> list[Node]:
    """Subtrees that are content; inside an article or main, lists of links go."""
    measure(body)
    if not body.chars:
        return []
    path, x = [body], body
    while x is not body.best:
        x = next(k for k in x.kids if not isinstance(k, str) and k.best is body.best)
        path.append(x)
    threshold = min(x.density for x in path)
    # An article or main element around the centre is content as a whole, and
    # so are headings that stand beside the path to the centre.
    whole = next((x for x in path[1:] if x.tag in ("article", "main")), None)
    out, todo = [], [body]
    kept: set[int] = set()
    if whole is not None:
        kept.add(id(whole))
        out.append(whole)
        on_path, inner = {id(x) for x in path}, [whole]
        while inner:
            x = inner.pop()
            x.kids = [k for k in x.kids if isinstance(k, str) or id(k) in on_path or k.tag not in CONTAINER
                      or k.density >= threshold or 2 * k.link_chars <= k.chars]
            inner.extend(k for k in x.kids if not isinstance(k, str))
    for x in path[:-1]:
        out.extend(k for k in x.kids if not isinstance(k, str) and k.tag in HEADING and k.chars)
    while todo:
        x = todo.pop()
        if x.density < threshold or not x.chars:
            continue
        if id(x.best) not in kept:
            kept.add(id(x.best))
            out.append(x.best)
        if x.best is not x:
            todo.extend(k for k in reversed(x.kids) if not isinstance(k, str) and k is not x.best)
    return out


def blocks(body: Node, roots: list[Node]) -> list[str]:
    """Text blocks of the kept subtrees, in page order."""
    keep, out, run = {id(x) for x in roots}, [], []

    def close() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    todo: list[tuple[Node | str | None, bool]] = [(body, False)]
    while todo:
        x, inside = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            if inside:
                run.append(x)
        elif x.tag == "br":
            run.append(" ")
        else:
            inside = inside or id(x) in keep
            if x.tag in BLOCK:
                close()
                todo.append((None, inside))
            todo.extend((k, inside) for k in reversed(x.kids))
    close()
    return out


def main_text(html: str | None) -> str:
    body = parse(html or "")
    prune(body)
    return "\n\n".join(blocks(body, content_nodes(body)))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in ``out``; ``html`` goes."""
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c not in (html, out)]
    df = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string())], [*keep, out])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != html] + [f"`{out}` string"])
    return df.mapInArrow(run, schema)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    got = extract(table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
