"""Main text of web pages by consensus of each host's pages.

Every container of a page is scored by the text it holds itself. From the best one the page climbs to the nearest
container that holds the whole article, and votes for its generalised path of tags and classes; containers without a class
are told apart by their place among their like. The host's winning path is then extracted again from each page that it fits:
one whose best container it holds, most of whose article it holds, or whose best container is one that the host's other
pages have beside their article. Any other page is read by its own container.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.operators.joins import salted_join

NEARLY_ALL = 0.8  # of its parent's text; a container outside any article that holds less is not the whole article
BESIDE_SHARE = 20  # a path that a host has beside its articles is found there on one page in so many
MAX_BROADCAST_HOSTS = 200_000  # beyond this many hosts their paths are joined by a shuffle

# HTML elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
SKIPPED = frozenset(
    "nav footer aside form button select menu dialog head script style textarea title noscript template iframe svg math "
    "canvas audio video object xmp".split()
)
CONTAINERS = frozenset("body main article section div td".split())
PLACED = ("div", "section", "td")
BLOCKS = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption center".split()
)
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
CLOSED_BY_SAME = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
    "td": ("tr",), "th": ("tr",), "option": ("select",),
}
# A class, id or role is boilerplate as a whole token, or before a word that only says what kind of box it is.
BOILERPLATE = re.compile(
    r"(?:^| )(?:(?:site|global)[-_])?(?:ads?|advert\w*|banner|breadcrumbs?|byline|comments?|cookies?|consent|disqus|footer|foot|header|legal|login|"
    r"masthead|menu|modal|nav\w*|newsletter|notice|pagination|pager|popup|promo\w*|related|recommend\w*|reply|replies|respond|"
    r"search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|tags?|toolbar|widget)"
    r"(?:[-_](?:area|bar|block|bottom|box|buttons?|container|inner|left|links?|list|menu|right|section|top|wrap\w*|#))*(?:$| )",
    re.I,
)
# Reader comments have these words in any part of a class, id or role, unless it only tells a state of the page.
COMMENT_WORDS = frozenset("comment comments cmt cmts commentlist commentarea commenters disqus replies respond responses".split())
STATE_WORDS = frozenset("has have no with without open closed on off enabled disabled show hide hidden allow".split())
# In an article a titled section about such a matter is part of it.
MATTERS = re.compile(r"(?:^| )(?:banner|legal|login|menu|nav|notice|pagination|search|shar(?:e|ing)|signup|social|tags?|toolbar|widget)(?:$|[-_ ])", re.I)
# What these name is boilerplate around an article, but in it only if it is mostly links.
IN_ARTICLE = re.compile(r"(?:^| )(?:foot|footer|header|legal|notice|related|reply|tags?)(?:$|[-_ ])", re.I)
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 figure figcaption".split())
ARTICLE_HINT = re.compile(r"(?:^|[-_ ])(?:article|body|content|entry|main|post|story|text)(?:$|[-_ ])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    __slots__ = ("tag", "label", "children", "parent", "skipped", "place")

    def __init__(self, tag: str, label: str, parent: Node | None):
        self.tag, self.label, self.parent, self.children = tag, label, parent, []
        self.skipped = tag in SKIPPED  # `mark` adds elements that are boilerplate by their label
        self.place = 0  # among containers of its tag without a class below one parent; 0 if it is the only one

    def path(self) -> str:
        """Tags and generalised classes, or places, from the root: numbers become #."""
        names, node = [], self
        while node is not None and node.tag:
            names.append(f"{node.tag}.{node.label}" if node.label else f"{node.tag}[{node.place}]" if node.place else node.tag)
            node = node.parent
        return ">".join(reversed(names))


def _label(attributes: str) -> str:
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".split()
    return " ".join(re.sub(r"\d+", "#", name.lower()) for name in names)


def parse(page: str | None) -> Node:
    """The tree of a page; elements that are left open close as browsers close them. NULL is an empty page."""
    page = page or ""
    root = node = Node("", "", None)
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            target = node
            while target.tag and target.tag != tag:
                target = target.parent
            if target.tag:
                # An inline end tag does not close the block around it.
                crossed, up = False, node
                while up is not target:
                    crossed, up = crossed or up.tag in BLOCKS, up.parent
                if not crossed or tag in BLOCKS:
                    node = target.parent
            continue
        if tag in CLOSES_P:
            node = _close(node, ("p",), ("button", "td", "th", "table"))
        if tag in CLOSED_BY_SAME:
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            node = _close(node, same, CLOSED_BY_SAME[tag])
        child = Node(tag, _label(m[3]), node)
        node.children.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            child.children.append(page[at:close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            node = child
    number(root)
    mark(root)
    return root


def number(root: Node) -> None:
    stack = [root]
    while stack:
        inner = [c for c in stack.pop().children if isinstance(c, Node)]
        stack.extend(inner)
        for tag in PLACED:
            alike = [c for c in inner if c.tag == tag and not c.label]
            for i, child in enumerate(alike if len(alike) > 1 else (), 1):
                child.place = i


def about_comments(label: str) -> bool:
    return any(parts & COMMENT_WORDS and not parts & STATE_WORDS for parts in (set(re.split("[-_]", name)) for name in label.split()))


def mark(root: Node) -> None:
    """Skips elements that are boilerplate by their label.

    One that holds most of the page's text outside links is a wrapper and stays, unless it holds the comments or an article is
    elsewhere; so do all if nothing else has text. Headings and figures in an article stay, and so do notes and titled sections in it that are not
    mostly links. Reader comments go wherever they are.
    """
    # (node, in an article, text outside links, in links, main heading, title and paragraph, article)
    labelled: list[tuple[Node, bool, int, int, bool, bool, bool]] = []
    done: list[tuple[int, int, bool, bool, bool, bool]] = []
    stack: list[tuple[Node, bool, bool, bool, int]] = [(root, False, False, False, 0)]
    while stack:
        item, seen, linked, within, kept = stack.pop()
        if not seen:
            linked, inside = linked or item.tag == "a", within or _is_article(item)
            inner = [c for c in item.children if isinstance(c, Node) and not c.skipped]
            stack.append((item, True, linked, within, len(inner)))
            stack.extend((c, False, linked, inside, 0) for c in inner)
            continue
        below = done[len(done) - kept:]
        del done[len(done) - kept:]
        own = sum(len(c.strip()) for c in item.children if isinstance(c, str))
        plain = sum(b[0] for b in below) + (0 if linked else own)
        links = sum(b[1] for b in below) + (own if linked else 0)
        head = item.tag in ("h1", "main") or any(b[2] for b in below)
        title = item.tag in TITLES or any(b[3] for b in below)
        prose = (item.tag == "p" and plain > links) or any(b[4] for b in below)
        article = (item.tag in ("article", "main") and plain > 0) or any(b[5] for b in below)
        done.append((plain, links, head, title, prose, article))
        if item.label and item.tag not in ("body", "html", "article", "main") and (BOILERPLATE.search(item.label) or about_comments(item.label)):
            labelled.append((item, within, plain, links, head, title and prose, article))
    whole, somewhere = done[0][0], done[0][5]
    chosen = []
    for node, within, plain, links, head, titled, article in labelled:
        comments = about_comments(node.label)
        spared = 2 * plain > whole and (head or not comments) and (within or article or not somewhere)
        if within and not comments:
            kept = IN_ARTICLE.search(node.label) or (titled and MATTERS.search(node.label))
            spared = spared or node.tag in HEADINGS or (kept and plain > links)
        if not spared:
            chosen.append(node)
            node.skipped = True
    if chosen and not _has_text(root):
        for node in chosen:
            node.skipped = False


def _has_text(root: Node) -> bool:
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        for child in node.children:
            if isinstance(child, str):
                if not linked and child.strip():
                    return True
            elif not child.skipped:
                stack.append((child, linked))
    return False


def _close(node: Node, tags: tuple[str, ...], limits: tuple[str, ...]) -> Node:
    up = node
    while up.tag and up.tag not in limits:
        if up.tag in tags:
            return up.parent
        up = up.parent
    return node


def blocks(node: Node) -> list[str]:
    """The text of each block below a node in page order, one space for any white space, without boilerplate."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    # Entries of the stack are nodes and texts to visit, or None where a block ends.
    stack: list[Node | str | None] = [*reversed(node.children)]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif item.skipped:
            if item.tag in BLOCKS:
                flush()
        elif item.tag == "br":
            line.append(" ")
        else:
            if item.tag in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()
    return out


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or bool(node.tag in CONTAINERS and node.tag != "body" and ARTICLE_HINT.search(node.label))


def best_container(root: Node) -> tuple[Node | None, dict[int, tuple[float, int]]]:
    """The container of the highest score, and by container its characters outside links and boilerplate and its main headings.

    A container's score is the characters in its own paragraphs and headings, plus half of what the containers below it
    hold, less the text of links; articles count more, boilerplate nothing. The page itself is a container of what is in no
    other. None if nothing has text.
    """
    best: tuple[float, Node] | None = None
    good: dict[int, tuple[float, int]] = {}
    # With a stack of its own to bear deep pages; `done` holds (own text, text in containers, main headings).
    done: list[tuple[float, float, int]] = []
    stack: list[tuple[Node, bool, int]] = [(root, False, 0)]
    while stack:
        item, seen, kept = stack.pop()
        if not seen:
            inner = [c for c in item.children if isinstance(c, Node) and not c.skipped]
            stack.append((item, True, len(inner)))
            stack.extend((c, False, 0) for c in reversed(inner))
            continue
        below = done[len(done) - kept:]
        del done[len(done) - kept:]
        own = float(sum(len(c.strip()) for c in item.children if isinstance(c, str)))
        own += sum(b[0] for b in below)
        nested = sum(b[1] for b in below)
        heads = sum(b[2] for b in below) + (item.tag == "h1")
        if item.tag == "a":
            own = 0.0
        if item.tag in CONTAINERS or item.parent is None:
            weight = 1.5 if item.tag in ("article", "main") or ARTICLE_HINT.search(item.label) else 1.0
            value = weight * own + 0.5 * nested
            if value > 0 and (best is None or value > best[0]):
                best = value, item
            good[id(item)] = own + nested, heads
            own, nested = 0.0, own + nested
        done.append((own, nested, heads))
    return (None if best is None else best[1]), good


def widen(best: Node, good: dict[int, tuple[float, int]]) -> Node:
    """The nearest container that holds the whole article around the best one.

    From there the way goes up to the article around it, and on while a parent holds clearly more text or the only main
    heading.
    """
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    around = [node for node in around if id(node) in good]
    articles = [i for i, node in enumerate(around) if node.tag == "article"]
    hinted = [i for i, node in enumerate(around) if _is_article(node)]
    top = articles[-1] if articles else hinted[0] if hinted else 0
    chosen = around[0]
    for i, node in enumerate(around[1:], 1):
        (held, heads), (text, all_heads) = good[id(chosen)], good[id(node)]
        if text > held and (i <= top or held < NEARLY_ALL * text or (all_heads and not heads)):
            chosen = node
    return chosen


def find(root: Node, path: str) -> list[Node]:
    """The outermost nodes with the path, in page order."""
    wanted = re.split(r"[.\[]", path.rsplit(">", 1)[-1], maxsplit=1)[0]
    found: list[Node] = []
    stack: list[Node | str] = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, str) or node.skipped:
            continue
        if node.tag == wanted and node.path() == path:
            found.append(node)
        else:
            stack.extend(reversed(node.children))
    return found


def page_paths(root: Node) -> tuple[str | None, str | None]:
    """The path of the container of the page's article, and that of the best container beside it."""
    best, good = best_container(root)
    if best is None:
        return None, None
    chosen = widen(best, good)
    chosen.skipped = True
    other = best_container(root)[0] if chosen.parent is not None else None
    chosen.skipped = False
    return chosen.path(), None if other is None or _inside(chosen, [other]) else other.path()


def _inside(node: Node | None, nodes: list[Node]) -> bool:
    while node is not None:
        if any(node is other for other in nodes):
            return True
        node = node.parent
    return False


def page_text(root: Node, path: str | None, beside: list[str] | None) -> str:
    """The text below the host's path if it fits the page, else below the page's own container.

    `beside` holds the paths that the host has beside its articles.
    """
    best, good = best_container(root)
    nodes = find(root, path) if path is not None else []
    text = "\n".join(line for node in nodes for line in blocks(node))
    if best is None or (text and _inside(best, nodes)):
        return text
    own = "\n".join(blocks(widen(best, good)))
    fits = 2 * len(text) > len(own) or best.path() in (beside or ())
    return text if text and fits else own


def with_host(pages: DataFrame) -> DataFrame:
    """`host` of each page's url in lower case; empty where there is none."""
    return pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, beside): pages whose article has the path, and pages whose next best container has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(host, *page_paths(parse(page.as_py()))) for host, page in zip(batch.column(0).to_pylist(), batch.column(1))]
            rows = [(host, own, 1) for host, own, _ in found if own is not None] + [(host, other, 0) for host, _, other in found if other is not None]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "vote"])

    rows = pages.select("host", "html").mapInArrow(run, "host string, path string, vote int")
    return rows.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.sum(1 - F.col("vote")).alias("beside"))


def winning_paths(counted: DataFrame) -> DataFrame:
    """(host, path, beside) from the votes: the path with most votes, the first in order of its text among equals, and the
    paths that the host has beside its articles on one page in BESIDE_SHARE or more, which are no more than that."""
    order = F.struct(-F.col("votes"), F.col("path"))
    winners = counted.where("votes > 0").groupBy("host").agg(F.min_by("path", order).alias("path"), F.sum("votes").alias("pages"))
    others = counted.where("beside > votes").select("host", F.col("path").alias("other"), F.col("beside").alias("_n"))
    others = others.join(winners.select("host", "pages"), "host").where(F.col("_n") * BESIDE_SHARE >= F.col("pages"))
    others = others.groupBy("host").agg(F.sort_array(F.collect_list("other")).alias("beside"))
    return winners.drop("pages").join(others, "host", "left")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page; text is empty if nothing was found.

    Pages with a NULL or odd url share the host "". Pages of one host are never gathered: votes are summed, and the
    winners, one per host, are broadcast when they are few and joined with a salt otherwise.
    """
    pages = with_host(pages.select("page_id", "url", "html"))
    counted = votes(pages).persist()
    winners = winning_paths(counted).persist()
    n_hosts = winners.count()
    counted.unpersist()
    if n_hosts <= MAX_BROADCAST_HOSTS:
        joined = pages.join(F.broadcast(winners), "host", "left")
    else:
        joined = salted_join(pages, winners, "host", ["page_id", "url"])
    schema = T.StructType([
        pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            texts = [page_text(parse(page.as_py()), path, beside) for page, path, beside in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return joined.select("page_id", "url", "html", "path", "beside").mapInArrow(run, schema)
