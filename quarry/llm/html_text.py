"""Main text of web pages by removing site templates.

Method: every page is parsed into elements; the hash of an element's subtree
(tag, texts, children) is counted per host in Spark, once per different page.
Subtrees that recur on many pages of their host are template and are deleted,
as are elements that say what they are (nav, footer, ads, forms, comments ...).
What remains of the article is the text, block by block. Inside an article only
containers are held to be template, not its paragraphs: a passage that many
articles share is still text; and only whole class names speak there, as parts
of names (``side-by-side``, ``social-history``) belong to articles.

Copies of a page are one page: pages of a host with the same body (all from
``<body`` on) share a weight of one between them, so an article that was
fetched several times doesn't turn into template. The numbers of copies, where
there are any, and the recurring subtrees are written as sorted hash arrays that
the workers map; counts go through one shuffle of hashes, summed on the map
side. The pages themselves are never shuffled.

Parsing is linear in the page: a tail without ``>`` is scanned once, and end
tags look for their start tag only where one is open.

Defined cases: null or empty html gives an empty text; a null url, or one
without host, belongs to the host "" (structure still removes); null and
repeated ids are rows like others, repeated pages one page of their host; an
empty table gives an empty result; broken markup is read as far as it goes;
further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import apply_groups, map_batches
from quarry.llm.common import shared_dir, shuffle_width, written
from quarry.llm.store import Shards, save, shard_bits, written_shards

MIN_PAGES = 3  #: a template subtree is on at least so many pages of its host
MIN_SHARE = 0.2  #: and on this share of them,
MAIN_SHARE = 0.5  #: or on this one for a container inside an article;
ENOUGH = 1000  #: on large hosts so many pages are enough for a container outside
PAGES = 256  #: pages parsed before their hashes are looked up
FLUSH = 1 << 18  #: different hashes a counting task holds
SLACK = 1e-6  #: for rounding in sums of weights

# Names of elements and of the parts that are no main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DROP = frozenset(
    "nav header footer aside form script style noscript iframe template svg math button select option "
    "textarea input label dialog menu head title object canvas audio video".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_BLOCK = HEADING | frozenset("p li dd dt td th pre blockquote figcaption summary caption address".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "nav navbar navigation menu menubar topbar footer sidebar side aside ad ads adv advert adverts advertisement "
    "advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup share sharing social related recommended breadcrumb "
    "breadcrumbs comment comments commentlist disqus replies reply respond form login search widget pagination "
    "pager toolbar masthead skip copyright legal".split()
)

#: Whole class names and ids that mark a part inside an article as well.
PARTS = frozenset(
    "comment comments commentlist comment-list comments-area disqus reply replies respond ad ads advert adverts advertisement "
    "advertising adbox sponsor sponsored promo promotion newsletter subscribe share sharing share-buttons related recommended "
    "breadcrumb breadcrumbs pagination pager sidebar notice notices cookie cookies consent popup modal nav navbar navigation "
    "menu footer toolbar widget".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("tag", "drop", "kids", "parent", "hash", "main", "holds", "article", "top")

    def __init__(self, tag: str, parent: Node | None, drop: bool):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.kids: list[Node | str] = []
        self.hash = b""
        self.holds = False  # around an article
        self.article = tag == "article" or parent is not None and parent.article  # in or at one
        self.top = tag == "main" or parent is not None and parent.top  # in or at a main element
        self.main = False  # inside an article or main element that stays


def _is_part(tag: str, attrs: str, inside: bool) -> bool:
    """Whether tag and attributes say that an element is no main text;
    ``inside``: of an article or main element."""
    if tag in DROP:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            if tag == "article":
                if {"comment", "comments", "reply"}.intersection(re.split(r"[^a-z]+", value)):
                    return True
            elif PARTS.intersection(value.split()) if inside else NAMES.intersection(re.split(r"[^a-z]+", value)):
                return True
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


class _Reader:
    """The open elements while a page is read."""

    def __init__(self):
        self.root = self.node = Node("#root", None, False)
        self.open: dict[str, int] = {}

    def push(self, tag: str, attrs: str) -> Node:
        kid = Node(tag, self.node, _is_part(tag, attrs, self.node.article or self.node.top))
        self.node.kids.append(kid)
        return kid

    def enter(self, kid: Node) -> None:
        self.node = kid
        self.open[kid.tag] = self.open.get(kid.tag, 0) + 1

    def leave(self, up: Node) -> None:
        """Back to ``up``, out of everything below it."""
        while self.node is not up:
            self.open[self.node.tag] -= 1
            self.node = self.node.parent

    def close(self, tag: str) -> None:
        if self.open.get(tag):
            up = self.node
            while up.tag != tag:
                up = up.parent
            self.leave(up.parent)

    def imply(self, tag: str) -> None:
        """The end tags that a start tag implies."""
        if tag in CLOSES_P and self.open.get("p"):
            up = self.node
            while up is not self.root and up.tag != "p" and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                self.leave(up.parent)
        if any(self.open.get(t) for t in CLOSES.get(tag, ())):
            up = self.node
            while up is not self.root and up.tag not in SCOPE.get(tag, ()):
                if up.tag in CLOSES[tag]:
                    return self.leave(up.parent)
                up = up.parent
        return None


def parse(page: str) -> Node:
    """A tree of elements and texts; never fails."""
    reader = _Reader()
    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        if at > last:
            # No tag ends behind here: text, up to a comment that stays open.
            stop = min([i for i in (page.find("<!--", at), page.find("<![CDATA[", at)) if i >= 0], default=end)
            reader.node.kids.append(page[at:stop])
            break
        m = TOKEN.search(page, at, end)
        if m is None:
            reader.node.kids.append(page[at:])
            break
        if m.start() > at:
            reader.node.kids.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if closing:
            reader.close(tag)
            continue
        reader.imply(tag)
        kid = reader.push(tag, attrs)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at) if at <= last else None
            at = stop.end() if stop else end
        elif tag not in VOID and not attrs.endswith("/"):
            reader.enter(kid)
    return reader.root


def _order(root: Node) -> list[Node]:
    """All elements, parents before children (no recursion: depth is open)."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(k for k in node.kids if isinstance(k, Node))
    return out


def hashed(root: Node, host: str) -> list[tuple[Node, int]]:
    """The subtrees that may be template, with their host-wide hashes."""
    nodes = _order(root)
    for node in nodes:
        node.main = node.tag in ("article", "main") and not node.drop or bool(node.parent and node.parent.main)
    for node in reversed(nodes):
        node.holds = any(k.holds or k.main for k in node.kids if isinstance(k, Node))
        h = xxhash.xxh64(node.tag)
        for k in node.kids:
            h.update(b"\x01" + k.hash if isinstance(k, Node) else b"\x02" + " ".join(k.split()).encode("utf-8", "surrogatepass"))
        node.hash = h.digest()
    salt = xxhash.xxh64(host).digest()
    return [
        (n, xxhash.xxh64(salt + n.hash).intdigest()) for n in nodes
        if n.tag in BLOCK and n.tag not in ("html", "body", "article", "main", "hr") and n.kids
        and not (n.main and n.tag in TEXT_BLOCK) and not (n.holds and not n.main)
    ]


def page_text(root: Node) -> str:
    """The blocks of the article (else of the main element, else of the page)."""
    kept, todo = [], [root]
    while todo:  # elements below a dropped one are gone
        node = todo.pop()
        if not node.drop:
            kept.append(node)
            todo.extend(k for k in node.kids if isinstance(k, Node))
        elif node.tag == "header" and node.article:
            # An article's own header keeps its headings.
            node.kids, node.drop = _headings(node), False
            kept.append(node)
            todo.extend(node.kids)
    for tag, inside in (("article", "article"), ("main", "top")):
        tops = [n for n in kept if n.tag == tag and not getattr(n.parent, inside)]
        if tops:
            break
    else:
        tops = [root]
    if len(tops) > 1:
        place = {id(n): i for i, n in enumerate(_document_order(root))}
        tops.sort(key=lambda n: place[id(n)])
    blocks: list[str] = []
    for top in tops:
        _blocks(top, blocks)
    return "\n".join(blocks)


def _headings(node: Node) -> list[Node]:
    """The headings below ``node`` in page order, none inside another."""
    out, todo = [], [node]
    while todo:
        at = todo.pop()
        if at.tag in HEADING:
            out.append(at)
        else:
            todo.extend(reversed([k for k in at.kids if isinstance(k, Node)]))
    return out


def _document_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed([k for k in node.kids if isinstance(k, Node)]))
    return out


def _blocks(top: Node, out: list[str]) -> None:
    held: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    todo: list = [top]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            held.append(item)
        elif item.drop:
            if item.tag in BLOCK:
                flush()
        else:
            if item.tag == "br":
                held.append(" ")
                continue
            block = item.tag in BLOCK
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(item.kids))
    flush()


def host_of(url: str | None) -> str:
    m = HOST.match((url or "").strip())
    return m[1].lower() if m else ""


def _page_key(host: str, body: int) -> int:
    return xxhash.xxh64(b"page\0" + host.encode("utf-8", "surrogatepass"), seed=body & (1 << 64) - 1).intdigest()


def _host_key(host: str) -> int:
    return xxhash.xxh64("host\0" + host).intdigest()


def _pages(batches) -> Iterator[dict]:
    """A key per (host, body)."""
    for b in batches:
        keys = [_page_key(host_of(u), h) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield {"key": np.array(keys, np.uint64).view(np.int64)}


def _count(folder: str, bits: int, there: frozenset[int]):
    """(hash, pages): different pages of a task on which a subtree is, each of
    n copies of a page counting 1 / n; a host's own hash counts its pages."""

    def run(batches) -> Iterator[dict]:
        copies, counts = Shards(folder, bits, "page", ("copies",), there), {}
        for b in batches:
            hosts = [host_of(u) for u in b.column(0).to_pylist()]
            keys = np.array([_page_key(h, body) for h, body in zip(hosts, b.column(2).to_pylist())], np.uint64)
            known, place = np.unique(keys, return_inverse=True)
            weight = 1.0 / np.maximum(copies.find(known)[1][0], 1)[place]
            for host, page, w in zip(hosts, b.column(1), weight.tolist()):
                found = {k for _, k in hashed(parse(page.as_py() or ""), host)}
                found.add(_host_key(host))
                for k in found:
                    counts[k] = counts.get(k, 0.0) + w
                if len(counts) >= FLUSH:
                    yield _rows(counts)
                    counts = {}
        yield _rows(counts)

    return run


def _rows(counts: dict[int, float]) -> dict:
    keys = np.fromiter(counts, np.uint64, len(counts))
    return {"key": keys.view(np.int64), "pages": np.fromiter(counts.values(), np.float64, len(counts))}


def _stored(counts: DataFrame, value: str, folder: str, bits: int, names: tuple[str, str]) -> frozenset[int]:
    """Writes (key, value) as sorted arrays, a shard per task; returns the shards."""

    def write(t):
        keys, n, shard = (t.column(c).to_numpy() for c in ("key", value, "shard"))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        save(folder, f"{names[0]}-{shard[0]:06d}", keys[order])
        save(folder, f"{names[1]}-{shard[0]:06d}", n[order])
        return {"shard": [int(shard[0])], "keys": [len(keys)]}

    dealt = counts.withColumn("shard", F.shiftrightunsigned("key", 64 - bits).cast("int"))
    return written_shards(written(apply_groups(dealt, ["shard"], write, "shard int, keys long"), "template-shards"))


def _with_body(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(url, html, body): the hash of what stands from ``<body`` on."""
    start = F.greatest(F.locate("<body", F.lower(F.col(html))), F.lit(1))
    body = F.when(F.col(html).isNotNull(), F.substring(F.col(html), start, F.length(html)))
    return pages.select(F.col(url).alias("url"), F.col(html).alias("html"), F.xxhash64(body).alias("body"))


def template_store(pages: DataFrame, url: str, html: str) -> tuple[str, int, frozenset[int]]:
    """Counts subtrees per host; writes those on MIN_PAGES different pages or
    more. Returns the folder, the bits of a shard's number and the shards."""
    spark = pages.sparkSession
    folder, bits = shared_dir(spark, "templates"), shard_bits(shuffle_width(spark))
    rows = _with_body(pages, url, html)
    copies = map_batches(rows.select("url", "body"), _pages, "key long").groupBy("key").agg(F.count("*").alias("n"))
    several = _stored(copies.where("n > 1"), "n", folder, bits, ("page", "copies"))
    counts = map_batches(rows, _count(folder, bits, several), "key long, pages double").groupBy("key").agg(F.sum("pages").alias("pages"))
    # The weights of n copies add up to 1 but for rounding.
    return folder, bits, _stored(counts.where(F.col("pages") >= MIN_PAGES - SLACK), "pages", folder, bits, ("key", "pages"))


def is_template(node: Node, pages: float, of_host: float) -> bool:
    """Whether a subtree on so many pages of a host with ``of_host`` is template."""
    need = (MAIN_SHARE if node.main else MIN_SHARE) * of_host
    if not node.main and node.tag not in TEXT_BLOCK:
        need = min(need, ENOUGH)
    return pages >= max(MIN_PAGES, need) - SLACK


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_template): the main text of every page
    and how many of its subtrees were deleted as site template."""
    folder, bits, there = template_store(pages, url, html)
    kind = pages.schema[key].dataType.simpleString()

    def run(batches) -> Iterator[dict]:
        store = Shards(folder, bits, "key", ("pages",), there)
        for b in batches:
            for at in range(0, max(b.num_rows, 1), PAGES):
                part = b.slice(at, PAGES)
                trees, keys = [], []
                for u, page in zip(part.column(1), part.column(2)):
                    host, root = host_of(u.as_py()), parse(page.as_py() or "")
                    found = hashed(root, host)
                    trees.append((root, found, _host_key(host)))
                    keys += [k for _, k in found] + [trees[-1][2]]
                wanted = np.unique(np.array(keys, np.uint64))
                _, (n,) = store.find(wanted)
                count = dict(zip(wanted.tolist(), n.tolist()))
                texts, cut = [], []
                for root, found, host in trees:
                    gone = 0
                    for node, k in found:
                        if is_template(node, count[k], count[host]) and not node.drop:
                            node.drop, gone = True, gone + 1
                    texts.append(page_text(root))
                    cut.append(gone)
                yield {"page_id": part.column(0), "url": part.column(1), "text": texts,
                       "n_chars": [len(t) for t in texts], "n_template": cut}

    return map_batches(pages.select(key, url, html), run, f"page_id {kind}, url string, text string, n_chars long, n_template long")


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages)
