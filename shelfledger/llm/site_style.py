"""Main text of web pages by a site style tree.

All pages of a host are laid over each other, every branch of them: a node of the tree is a path of tags and classes, and holds
how its content and its layout differ between the host's pages. Both are entropies, scaled to 0..1 by the
number of pages. A branch that reads the same on every page has no importance and is removed. A branch of links has importance

    (1 - GAMMA ** blocks) * layout + GAMMA ** blocks * content

as the more blocks it has, the more its layout tells: a list of links laid out alike on all pages is a menu, though the
links be others. Menus are removed outside articles.

Pages with the same text count once, so copies of a page are no evidence against it. Where a page marks its article, the text is
the article's without its unimportant branches; there a branch
goes only from pages on which it reads as on LEAST_PAGES pages, and only if the greater part of the article
stays. A branch on fewer than LEAST_PAGES pages of a host is not judged by the tree.

What the tree does not decide, as on small hosts or where a branch has other words on each page, is decided by marks: menus,
headers, footers, sidebars, notices, adverts, forms and reader comments which say of themselves that they are no content are
removed on every page. Scripts, styles and hidden elements are no text at all.

A class or id says that an element is no content if each part of it between hyphens does or only tells place
or kind ("share-buttons", not "related-work"). It says nothing of headings, paragraphs, code and <main>, nor,
inside an article, does an id, which may be the slug of a heading, but for those of reader comments. An
element around <main> stays, and so does one around an <article> where no other article is marked; that
article, like one that has such a name itself, then counts as any other branch.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import released, small, stored

LEAST_PAGES = 4
LEAST_IMPORTANCE = 0.3
LEAST_OF_LINKS = 0.6  # of a branch of links
GAMMA = 0.9
BROADCAST_BYTES = 32 << 20  # of judged branches; larger tables of them are joined by host

# Tags and names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCKS - {"body", "html", "caption", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot"}
REMOVED_TAGS = frozenset("""head title nav footer aside form button select option input textarea label fieldset script style noscript
template iframe object svg canvas dialog menu""".split())
NEVER_TEXT = frozenset("head title select option input textarea script style noscript template iframe object svg canvas".split())
REMOVED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
REMOVED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies
consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup comment comments disqus respond replies
share sharing social related recommended breadcrumb breadcrumbs pagination pager nav navbar navigation menu sidebar side footer
widget widgets skip toolbar login""".split())
OUTSIDE_NAMES = frozenset("header masthead topbar".split())  # removed outside an article only
COMMENT_NAMES = frozenset("comment comments disqus respond replies".split())
DOUBTFUL_NAMES = frozenset("related sharing side notice notices promotion replies respond".split())  # alone and inside an article no sign
PLACES = frozenset("""area bar block blocks bottom box button buttons container inner item items left link links list main page post posts
reader right section site thread top user wrap wrapper""".split())
NEVER_BY_NAME = frozenset("body html main h1 h2 h3 h4 h5 h6 p pre code".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<(?:/|!)?\Z", re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|\Z|["'])""", re.I)
KEEP, ASK, DROP, NAMED, COMMENTS = 2, 1, 0, -1, -2  # the last two: dropped by their names alone


@lru_cache(100_000)
def _says(name: str, inside: bool, doubtful: bool) -> frozenset[str]:
    """The words by which a class or id says that an element is no content, or none. ``doubtful``: a
    doubtful word alone is enough."""
    parts = [x for x in re.split("[-_]+", name) if x]
    telling = REMOVED_NAMES if inside else REMOVED_NAMES | OUTSIDE_NAMES
    said = telling.intersection(parts)
    if any(x not in telling and x not in PLACES and not x.isdigit() for x in parts) or (len(parts) == 1 and not doubtful and said <= DOUBTFUL_NAMES):
        return frozenset()
    return said


def _judged(tag: str, attributes: str, inside: bool) -> tuple[int, str]:
    """What an element says of itself, and its class."""
    if tag in REMOVED_TAGS or (tag == "header" and not inside):
        return DROP, ""
    kept = KEEP if tag in ("article", "main") else ASK
    if not attributes.strip():
        return kept, ""
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    name, role = found.get("class", ""), found.get("role", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
    if hidden or (role in REMOVED_ROLES and tag not in ("body", "html", "main")):
        return DROP, name
    if role in ("main", "article"):
        kept = KEEP
    if tag in NEVER_BY_NAME or role == "main":
        return kept, name
    said = {w for x in name.split() for w in _says(x, inside, not inside)}
    by_id = {w for x in found.get("id", "").split() for w in _says(x, inside, False)}
    said |= by_id & COMMENT_NAMES if inside else by_id
    if not said or (kept == KEEP and inside and not said & COMMENT_NAMES):
        return kept, name
    if kept == KEEP and not inside:
        return ASK, name
    return (COMMENTS if said & COMMENT_NAMES else NAMED), name


class Block(NamedTuple):
    path: str
    inside: bool  # an article
    said: str
    dropped: bool  # by what an element around it says of itself
    linked: bool  # all its text is in links


def branches(page: str) -> list[Block]:
    """The page's blocks of text in order."""
    found, articles, around_article, around_main = _branches(page, frozenset())
    around = around_main if articles else around_main | around_article
    return _branches(page, frozenset(around))[0] if around else found


def _hidden(attributes: str) -> bool:
    if "hidden" not in attributes.lower() and "display" not in attributes.lower():
        return False
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    return "hidden" in found or found.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", "")))


def _branches(page: str, spared: frozenset[int]) -> tuple[list[Block], int, set[int], set[int]]:
    """The blocks, the number of articles, and where the elements start that would be dropped by their names
    alone with an article or with <main> in them. Names at the ``spared`` places say nothing."""
    out: list[Block] = []
    stack: list[tuple[str, str, int, bool, int, bool, bool]] = []  # tag, path, judgement, inside an article, start, no text, in a link
    articles, around_article, around_main = 0, set(), set()
    text: list[str] = []
    unlinked: list[bool] = []  # whether a piece of the block stands outside links

    def close_block() -> None:
        if text:
            said = " ".join(references.unescape("".join(text)).split())
            if said:
                path, judged, inside = (stack[-1][1], stack[-1][2], stack[-1][3]) if stack else ("", ASK, False)
                out.append(Block(path, inside, said, judged <= DROP, not any(unlinked)))
            text.clear()
            unlinked.clear()

    def pop_to(k: int) -> None:
        while len(stack) > k:
            if stack[-1][0] in BLOCKS or stack[-1][2] <= DROP:
                close_block()
            stack.pop()

    def add(said: str) -> None:
        if said and not (stack and stack[-1][5]):
            text.append(said)
            if not said.isspace():
                unlinked.append(not (stack and stack[-1][6]))

    def open_at(tags: tuple[str, ...], stop: tuple[str, ...]) -> int | None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in stop:
                return None
        return None

    at = 0
    for m in TAG.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if at == len(page) and not page.endswith(">"):
            break  # cut off inside a tag
        if m[2]:
            k = open_at((tag,), ())
            if k is not None:
                pop_to(k)
            elif tag in BLOCKS:
                close_block()
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "body":
            k = open_at(("head",), ())
            if k is not None:
                pop_to(k)
        if tag in ENDS_P and (k := open_at(("p",), ("table", "td", "th", "button", "object"))) is not None:
            pop_to(k)
        if tag in SIBLINGS and (k := open_at(SIBLINGS[tag], CONTAINERS[tag])) is not None:
            pop_to(k)
        if tag in BLOCKS:
            close_block()
        if tag in VOID or m[4].endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "span", "em", "strong"):
            continue
        path, judged, inside, silent, linked = (*stack[-1][1:4], *stack[-1][5:]) if stack else ("", ASK, False, False, False)
        own, name = _judged(tag, m[4], inside)
        if judged != DROP:
            if own < DROP and (m.start() in spared or judged > DROP and any(x[0] in ("pre", "code") for x in stack)):
                own = ASK
            article = tag == "article" and own != COMMENTS
            if judged < DROP:
                if own == KEEP and tag == "main":
                    around_main.update(x[4] for x in stack if x[2] < DROP)
                elif article and judged == NAMED and own != DROP and not any(x[0] == "article" for x in stack):
                    around_article.update(x[4] for x in stack if x[2] < DROP)
                judged = DROP if own == DROP else min(judged, own)
            elif own <= DROP:
                judged = own
            else:
                if article and own == KEEP:
                    articles += 1
                    if spared and not inside and any(x[4] in spared for x in stack):
                        own = ASK
                judged = max(judged, own)
                inside = inside or own == KEEP
            if judged <= DROP and tag not in BLOCKS and tag not in ("label", "button", "input"):
                close_block()
        if tag in BLOCKS:
            path = f"{path}/{tag}.{name}" if name else f"{path}/{tag}"
        stack.append((tag, path, judged, inside, m.start(), silent or tag in NEVER_TEXT or _hidden(m[4]), linked or tag == "a"))
    add(page[at:])
    close_block()
    return out, articles, around_article, around_main


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


class Node(NamedTuple):
    content: int
    layout: int
    blocks: int
    linked: bool


def _above(path: str) -> list[tuple[str, str]]:
    """The nodes from the root to a path, each with what of the path lies below it."""
    steps = path.split("/")[1:]
    return [("/" + "/".join(steps[:k]), "/".join(steps[k:])) for k in range(1, len(steps) + 1)]


def _by_node(found: list[Block]) -> dict[str, Node]:
    """Hashes of the content and of the layout of each node of a page, its number of blocks, and whether they are links."""
    nodes: dict[str, tuple[list[str], list[str], list[bool]]] = {}
    above: dict[str, list[tuple[str, str]]] = {}
    for block in found:
        if block.path not in above:
            above[block.path] = _above(block.path)
        own = str(_hash(block.said))
        for node, rest in above[block.path]:
            content, layout, linked = nodes.setdefault(node, ([], [], []))
            content.append(own)
            layout.append(rest)
            linked.append(block.linked)
    return {node: Node(_hash("\n".join(c)), _hash("\n".join(ly)), len(c), all(a)) for node, (c, ly, a) in nodes.items()}


def _article(found: list[Block]) -> tuple[list[Block], bool]:
    """The blocks of a page's article, or else of the page, that no mark drops; and whether an article is marked."""
    kept = [b for b in found if not b.dropped]
    marked = any(b.inside for b in kept)
    return [b for b in kept if b.inside or not marked], marked


NODES = "host string, whole bigint, path bigint, content bigint, layout bigint, blocks bigint, linked boolean"


@released
def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of each page; ``whole`` is the text of its article, or else of all of it."""
    for batch in batches:
        out = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = branches(page or "")
            whole = _hash("\n".join(b.said for b in _article(found)[0]))
            out += [(host, whole, _hash(path), *node) for path, node in _by_node(found).items()]
        if out:
            kinds = (pa.string(), *[pa.int64()] * 5, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in NODES.split(", ")])


def _times(nodes: DataFrame, what: str) -> DataFrame:
    return nodes.groupBy("host", "path", what).agg(F.count("*").alias("n"))


def _entropy(nodes: DataFrame, what: str) -> DataFrame:
    """(host, path, pages, entropy scaled to 0..1) of the column ``what``."""
    sums = _times(nodes, what).groupBy("host", "path").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"))
    return sums.select(
        "host", "path", "pages",
        F.when(F.col("pages") > 1, 1 - F.col("s") / (F.col("pages") * F.log("pages"))).otherwise(1.0).alias(what),
    )


def importances(nodes: DataFrame) -> DataFrame:
    """(host, path, pages, content, layout, blocks, linked) of the nodes of each host's tree."""
    shape = nodes.groupBy("host", "path").agg(F.avg("blocks").alias("blocks"), F.min("linked").alias("linked"))
    judged = _entropy(nodes, "content").join(_entropy(nodes, "layout").drop("pages"), ["host", "path"])
    return judged.join(shape, ["host", "path"])


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, low, same, menus): the hashed paths of each host's unimportant nodes, the hashed contents that
    these have on LEAST_PAGES pages or more, and the hashed paths of its menus. ``pages``: host, html."""
    nodes = pages.filter("host is not null").select("host", "html").mapInArrow(_nodes, NODES)
    nodes = stored(nodes.distinct(), "nodes")
    discount = F.pow(F.lit(GAMMA), F.col("blocks"))
    of_links = F.col("linked") & ((1 - discount) * F.col("layout") + discount * F.col("content") < LEAST_OF_LINKS)
    low = stored(
        importances(nodes).filter(F.col("pages") >= LEAST_PAGES)
        .select("host", "path", (F.greatest("content", "layout") < LEAST_IMPORTANCE).alias("low"), of_links.alias("menu")).filter("low or menu"),
        "low-paths",
    )
    unimportant = low.filter("low").select("host", "path")
    often = _times(nodes.join(small(unimportant, low.count()), ["host", "path"], "left_semi"), "content").filter(F.col("n") >= LEAST_PAGES)
    every = low.select(
        "host", F.when(F.col("low"), F.col("path")).alias("low"), F.lit(None).cast("bigint").alias("content"), F.when(F.col("menu"), F.col("path")).alias("menu")
    ).union(often.select("host", F.lit(None).cast("bigint"), "content", F.lit(None).cast("bigint")))
    return every.groupBy("host").agg(F.collect_set("low").alias("low"), F.collect_set("content").alias("same"), F.collect_set("menu").alias("menus"))


NONE: frozenset[int] = frozenset()


def _unimportant(found: list[Block], marked: bool, low: frozenset[int], same: frozenset[int], menus: frozenset[int]):
    """A function that says whether the tree removes a block: it lies below an unimportant node or, outside articles, a menu. Inside an
    article a node goes only where its content is among ``same``."""
    nodes = _by_node(found) if low and marked else {}
    known: dict[tuple[str, bool], bool] = {}

    def removed(block: Block) -> bool:
        key = block.path, block.inside
        if key not in known:
            hashes = [(node, _hash(node)) for node, _ in _above(block.path)]
            known[key] = any(h in low and (not marked or nodes[node].content in same) for node, h in hashes) or (
                not block.inside and any(h in menus for _, h in hashes))
        return known[key]

    return removed


def main_text(page: str | None, low: frozenset[int], same: frozenset[int] = NONE, menus: frozenset[int] = NONE) -> str:
    """The text of a page's article, or else of the page, without the branches that the tree removes."""
    found = branches(page or "")
    texts, marked = _article(found)
    if low or menus:
        removed = _unimportant(found, marked, low, same, menus)
        kept = [b for b in texts if not removed(b)]
        if marked and 2 * sum(len(b.said) for b in kept) < sum(len(b.said) for b in texts):
            kept = texts
        texts = kept
    return "\n".join(b.said for b in texts)


def removed_chars(page: str | None, low: frozenset[int], same: frozenset[int] = NONE, menus: frozenset[int] = NONE) -> tuple[int, int]:
    """How many characters of a page's text the tree removes, and how many the marks remove that the tree leaves."""
    found = branches(page or "")
    texts, marked = _article(found)
    left = main_text(page, low, same, menus)
    removed = _unimportant(found, marked, low, same, menus)
    outside = [b for b in found if b not in texts]
    by_tree = sum(len(b.said) for b in outside if removed(b)) + sum(len(b.said) for b in texts) + max(0, len(texts) - 1) - len(left)
    return by_tree, sum(len(b.said) for b in outside if not removed(b))


def _judge(held, run, names: list[str], kinds: list):
    """``run`` of each page with its host's branches, which are broadcast or else stand beside it."""
    @released
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            hosts, pages = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            beside = zip(*(batch.column(k).to_pylist() for k in (4, 5, 6))) if held is None else None
            out = []
            for host, page in zip(hosts, pages):
                if beside is not None:
                    sets = [frozenset(x or ()) for x in next(beside)]
                else:
                    if host not in known:
                        known[host] = [frozenset(x) for x in held.value.get(host, ((), (), ()))]
                    sets = known[host]
                out.append(run(page, *sets))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [*batch.schema.names[:2], *names])

    return task


def _judged_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str, run, names: list[str], kinds: list, schema: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    rows = pages.select(
        F.col(id_col), F.col(url_col), F.when(host != "", host).alias("host"), F.col(html_col).cast("string").alias("html")
    )
    low = stored(low_branches(rows), "low")
    size = low.agg(F.coalesce(F.sum(F.length("host") + 8 * (F.size("low") + F.size("same") + F.size("menus"))), F.lit(0))).first()[0]
    held = None
    if size <= BROADCAST_BYTES:
        held = pages.sparkSession.sparkContext.broadcast({r["host"]: (r["low"], r["same"], r["menus"]) for r in low.collect()})
    else:
        rows = rows.join(low, "host", "left").select(id_col, url_col, "host", "html", "low", "same", "menus")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(_judge(held, run, names, kinds), f"{own}, {schema}")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars. Null html gives an empty text. A page without a host in
    its url belongs to no site, so only its own marks count. Rows repeating a page each get its text, and count once in the tree.
    Columns besides the three may have any name. The judged branches of all hosts are broadcast up to ``BROADCAST_BYTES``."""
    found = _judged_pages(pages, id_col, url_col, html_col, lambda *a: (main_text(*a),), ["text"], [pa.string()], "text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def removals(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, by_tree, by_marks: the characters removed by the tree, and by marks alone."""
    return _judged_pages(
        pages, id_col, url_col, html_col, removed_chars, ["by_tree", "by_marks"], [pa.int64(), pa.int64()], "by_tree bigint, by_marks bigint"
    )
