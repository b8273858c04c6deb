"""Main text of HTML pages by site style trees.

The pages of a host are merged into one tree. An element of it is a tag with its
class and id below the same elements; it has the styles (sequences of children) and
the texts that the pages show there. Its presentation importance is the entropy of
its styles over the pages that hold it, its content importance falls with the
entropy of its texts: what stands on all pages alike tells nothing. On each page
the two are joined from the leaves up, and branches of low importance are removed.

Entropy can't tell a menu of ever new links from an article, nor an article that a
site shows twice from a notice; so elements that HTML or their class name as
menus, adverts, forms and the like have importance 0, and those it names as the
article have 1.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices
from txlake.sources.shared import stage

#: Branches below this importance go, if so many pages of the host hold them.
LEAST_IMPORTANCE = 0.3
LEAST_PAGES = 4
#: How much an element's importance leans on its children's, by how many it has.
DECAY = 0.9

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)
    |<(?P<raw>script|style|noscript|template|iframe|svg|math|object|textarea|select|title)\b(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+>.*?(?:</(?P=raw)\b[^>]*>|\Z)
    |<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>
    |<[!?/][^>]*>
    |</?[a-z][^>]*\Z
    |(?P<text>[^<]+|<)""",
    re.S | re.I | re.X,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

#: Fixed by HTML: tags that stand inside a line, that have no end, and that an opening tag ends.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("article aside blockquote body div dl footer form header html main nav ol section table td th ul".split())
#: What isn't part of a main text, by tag and by words of class, id or role.
NOISE_TAGS = frozenset("head nav footer aside form button dialog menu".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice popup promo "
    "related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_TAGS = frozenset({"article", "main"})
#: Noise that an article inside it doesn't end; forms and classes may be a page's wrapper.
FIRM_NOISE = NOISE_TAGS - {"form"}
#: Tags that no class makes noise: the page as a whole, and a single block of text.
PLAIN_TAGS = frozenset("html body article main p h1 h2 h3 h4 h5 h6 pre blockquote td th".split())
#: First and last parts of names that tell of a page's state and not of an element's purpose.
STATE_FIRST = frozenset("has no not with without is".split())
STATE_LAST = frozenset("open opened closed active inactive hidden visible enabled disabled".split())


@dataclass
class Node:
    """An element of one page; ``parts`` are its children and the numbers of its own blocks, in order.

    ``noise`` is its own or inherited; ``firm`` is noise that nothing inside ends, and
    ``freed`` is noise where an article inside a wrapper that looks like noise ends it.
    """

    key: int
    label: str
    noise: bool
    main: bool
    firm: bool = False
    freed: bool = False
    parts: list[Node | int] = field(default_factory=list)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def parse(page: str) -> tuple[Node, list[str]]:
    """The page's tree and its blocks of text, in page order, white space as one space."""
    root = Node(0, "", False, False)
    stack, tags = [root], [""]
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        words = html.unescape("".join(line)).split()
        line.clear()
        if words:
            stack[-1].parts.append(len(blocks))
            blocks.append(" ".join(words))

    def pop_to(i: int) -> None:
        end_block()
        del stack[i:], tags[i:]

    for m in _TOKEN.finditer(page):
        if m["text"]:
            line.append(m["text"])
            continue
        if m["raw"]:
            if m["raw"].lower() not in ("script", "style", "template"):
                end_block()
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag in INLINE and (tag not in tags if m["close"] else not _is_noise(tag, m["attrs"])):
            continue  # part of the line, unless its class makes it noise
        if m["close"]:
            if tag in tags:
                pop_to(len(tags) - 1 - tags[::-1].index(tag))
            else:
                end_block()
            continue
        end_block()
        if tag in VOID:
            continue
        for i in range(len(tags) - 1, 0, -1):
            if tags[i] in ENDS_ITSELF.get(tag, ()) or tags[i] == "p" and tag not in INLINE:
                pop_to(i)
                break
            if tags[i] in HOLDS and not (tag in ("tr", "td", "th") and tags[i] in ("td", "th")):
                break
        words = _words(m["attrs"])
        label = f"{tag}.{'.'.join(words)}"
        up = stack[-1]
        inside = up.main or tag in MAIN_TAGS or "main" in words and tag not in NOISE_TAGS
        own = _is_noise(tag, m["attrs"]) or tag == "header" and not up.main
        firm = up.firm or tag in FIRM_NOISE or tag == "header" and not up.main
        freed = firm or own or up.freed and not (inside and not up.main)
        node = Node(_hash(f"{up.key}/{label}"), label, up.noise or own, inside, firm, freed)
        up.parts.append(node)
        if not m["attrs"].endswith("/") or tag in HOLDS:
            stack.append(node)
            tags.append(tag)
    end_block()
    _free_articles(root)
    return root, blocks


def _free_articles(root: Node) -> None:
    """Where all of a page's articles lie inside wrappers that look like noise, the articles aren't noise."""
    every = [root]
    for node in every:
        every += [p for p in node.parts if isinstance(p, Node)]
    main = [n for n in every if n.main and n.parts]
    if main and all(n.noise for n in main):
        for node in every:
            node.noise = node.freed


def _names(attrs: str) -> list[str]:
    """Whole names in class, id and role."""
    if not attrs or "=" not in attrs:
        return []
    return [name for m in _NAMES.finditer(attrs) for name in (m[1] or m[2] or m[3] or "").lower().split()]


def _words(attrs: str) -> list[str]:
    return [w for name in _names(attrs) for w in _SPLIT.split(name) if w]


def _names_noise(name: str) -> bool:
    parts = [w for w in _SPLIT.split(name) if w]
    return bool(parts) and not NOISE_WORDS.isdisjoint(parts) and parts[0] not in STATE_FIRST and parts[-1] not in STATE_LAST


def _is_noise(tag: str, attrs: str) -> bool:
    return tag in NOISE_TAGS or tag not in PLAIN_TAGS and any(map(_names_noise, _names(attrs)))


def facts(root: Node, blocks: list[str]) -> set[tuple[int, bool, int]]:
    """(element, whether it is a style, its hash) for what a page adds to its site's tree; one style for each element."""
    styles: dict[int, set[str]] = {}
    found: set[tuple[int, bool, int]] = set()
    todo = [root]
    while todo:
        node = todo.pop()
        order = [p.label if isinstance(p, Node) else "#" for p in node.parts]
        run = [x for i, x in enumerate(order) if i == 0 or x != order[i - 1]]
        styles.setdefault(node.key, set()).add(" ".join(run))
        for p in node.parts:
            if isinstance(p, Node):
                todo.append(p)
            else:
                found.add((node.key, False, _hash(blocks[p])))
    found.update((key, True, _hash("|".join(sorted(s)))) for key, s in styles.items())
    return found


def main_text(root: Node, blocks: list[str], site: dict[int, tuple[float, float]]) -> str:
    """The blocks that are left; ``site``: presentation and content importance of elements on enough pages."""
    order: list[tuple[Node, Node | None]] = [(root, None)]
    for node, _ in order:
        order += [(p, node) for p in node.parts if isinstance(p, Node)]
    worth: dict[int, float] = {}
    low: dict[int, bool] = {}
    for node, _ in reversed(order):
        shown, told = site.get(node.key, (1.0, 1.0))
        below = [worth[id(p)] if isinstance(p, Node) else told for p in node.parts]
        lean = DECAY ** len(below) if below else 0.0
        value = (1 - lean) * shown + lean * sum(below) / len(below) if below else shown
        only_text = all(isinstance(p, int) for p in node.parts)
        worth[id(node)] = 1.0 if node.main else told if only_text and node.parts else value
        under = all(low[id(p)] if isinstance(p, Node) else told < LEAST_IMPORTANCE for p in node.parts)
        low[id(node)] = node.noise or under and worth[id(node)] < LEAST_IMPORTANCE
    has_main = any(n.main and not n.noise and n.parts for n, _ in order)
    kept, gone, open_text = [], set(), []
    noisy = {id(root)} if root.noise else set()
    for node, up in order:
        apart = up is None or node.main and not node.noise and not up.main  # an article stands or falls by itself
        if node.noise or not apart and id(up) in noisy:
            noisy.add(id(node))
        else:
            open_text += [p for p in node.parts if isinstance(p, int)]
        if low[id(node)] or not apart and id(up) in gone:
            gone.add(id(node))
        elif node.main or not has_main:
            kept += [p for p in node.parts if isinstance(p, int) and (node.main or site.get(node.key, (1.0, 1.0))[1] >= LEAST_IMPORTANCE)]
    return " ".join(blocks[i] for i in sorted(kept or open_text))  # a page of shared text alone keeps what isn't noise


def site_tree(pages: DataFrame) -> DataFrame:
    """``host, elements array<struct<key, shown, told>>``: importance of the elements that enough pages hold; copies are one page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found: Counter = Counter()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found.update((host, *f) for f in facts(*parse(page)))
            host, key, style, value = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(style, pa.bool_()), pa.array(value, pa.int64()), pa.array(found.values(), pa.int64())],
                names=["host", "key", "style", "value", "n"],
            )

    distinct = pages.groupBy("host", F.xxhash64("html").alias("copy")).agg(F.first("html").alias("html"))
    each = distinct.select("host", "html").mapInArrow(run, "host string, key long, style boolean, value long, n long")
    counted = each.groupBy("host", "key", "style", "value").agg(F.sum("n").alias("n"))
    spread = F.col("n") * F.log("n")
    sums = counted.groupBy("host", "key").agg(
        F.sum(F.when(F.col("style"), F.col("n"))).alias("m"),
        F.sum(F.when(F.col("style"), spread)).alias("styles"),
        F.sum(F.when(~F.col("style"), F.col("n"))).alias("texts"),
        F.sum(F.when(~F.col("style"), spread)).alias("shared"),
    ).where(F.col("m") >= LEAST_PAGES)
    shown = F.lit(1.0) - F.col("styles") / (F.col("m") * F.log("m"))
    told = F.when(F.col("texts") > 0, F.lit(1.0) - F.col("shared") / (F.col("texts") * F.log("m"))).otherwise(1.0)
    return sums.groupBy("host").agg(F.collect_list(F.struct("key", shown.alias("shown"), told.alias("told"))).alias("elements"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every row of ``page_id, url, html``.

    A null or empty page has the empty text; pages without a host (null or odd
    urls) are one site; repeated rows are kept, null ids too; other columns are
    ignored; an empty table gives no rows. Each host's tree holds only elements
    that at least ``LEAST_PAGES`` of its pages share.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host")
    )
    sites = stage(site_tree(rows), "sites")  # read back, Spark knows its size and broadcasts it only if small

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[int, tuple[float, float]]] = {}
        for batch in slices(batches):
            out = []
            for host, page, elements in zip(*(batch.column(c) for c in ("host", "html", "elements")), strict=True):
                if (name := host.as_py()) not in known:
                    if len(known) >= 1000:
                        known.clear()
                    known[name] = {e["key"]: (e["shown"], e["told"]) for e in elements.as_py() or ()}
                out.append(main_text(*parse(page.as_py()), known[name]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"]
            )

    return rows.join(sites, "host", "left").mapInArrow(run, "page_id long, url string, text string")
