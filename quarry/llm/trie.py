"""Conversation prefix trie in balanced-parentheses shards.

Every distinct sequence of first turns is a node of one trie over all
conversations. Sequences are range-sorted, so a shard's part of the trie is its
rows' depth-first order, and it is encoded as balanced parentheses: a node
opens at ``2 * preorder - depth``. The running excess lies in blocks with their
minimum and maximum; ``findclose`` looks into the node's own block, climbs the
blocks' ranges to the first one that holds the target and looks into that. The
close delimits the subtree: leaf pairs ``()`` are counted by rank, members and
savings by cumulative arrays over preorder.

Only nodes on a shard's first or last path can lie in other shards as well.
These spines carry what hangs below them in closed subtrees; neighbouring
spines merge by node, in groups of ``FAN`` shards per round, and are encoded and
solved in the same way until one trie is left. All else is final at once.

A turn is 20 bytes: md5 of role and text, and the text's UTF-8 length. A
sequence is the bytes of its turns, a node's key their md5. Equal sequences are
one row before the shards (their ids hashed as a stream, so no list of them is
held). A task holds ``BLOCK`` sequences at a time plus one spine.

Defined cases: null roles and texts are empty; rows with a null conv_id belong
to no conversation and are left out; turns sort by turn (null first), role,
then md5 of the text; repeated rows are turns of their own; a conversation
without turns ends at the root; an empty table gives an empty result; further
columns are left out. A sequence must fit into one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.arrow import apply_groups, map_batches
from quarry.llm.common import written

TOKEN = 20  #: bytes per turn in a sequence
BLOCK = 50_000  #: sequences of a shard that are encoded at once
FAN = 64  #: shards whose spines merge in one round
WIDTH = 256  #: parentheses per block of excess
IDS = 12  #: ids of one range of 2 ** IDS are joined before they are hashed
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, key binary, open_parent binary"
)
SPINE = (
    "key binary, above binary, depth long, size long, ends long, ends_sha256 string, first long, "
    "children long, leaves long, members long, saved long"
)
PART = f"place long, {SPINE}, {', '.join(f'node_{f.strip()}' for f in NODE.split(','))}"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token): every turn's place from 1 and its 20 bytes in hex."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    same = F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text).alias("h"),
        F.concat(same, F.lpad(F.hex(F.octet_length(text)), 8, "0")).alias("token"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "h")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "token")


def sequences(placed: DataFrame) -> DataFrame:
    """(conv_id, path) of turns (conv_id, pos, token); a row with pos 0 and an
    empty token stands for a conversation that may have no turns."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "token")))
    return placed.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id", F.unhex(F.array_join(F.transform("rows", lambda r: r["token"]), "")).alias("path")
    )


def _same_paths(paths: DataFrame) -> DataFrame:
    """(path, n, first, ends_sha256): one row per distinct sequence. The ids
    are joined per range of ids, then hashed range by range."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    ranges = paths.groupBy("path", F.shiftright("conv_id", IDS).alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), ids.alias("ids"),
    )
    lined = ranges.repartition("path").sortWithinPartitions("path", "range").select("path", "n", "first", "ids")

    def run(batches):
        path = n = first = sha = None
        for b in batches:
            out = []
            for p, more, least, part in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if sha is not None and p == path:
                    n, first = n + more, min(first, least)
                    sha.update(b"," + part.encode())
                    continue
                if sha is not None:
                    out.append((path, n, first, sha.hexdigest()))
                path, n, first, sha = p, more, least, hashlib.sha256(part.encode())
            yield columns(out)
        if sha is not None:
            yield columns([(path, n, first, sha.hexdigest())])

    def columns(out):
        return {c: [r[i] for r in out] for i, c in enumerate(("path", "n", "first", "ends_sha256"))}

    return map_batches(lined, run, "path binary, n long, first long, ends_sha256 string")


class Trie:
    """Nodes in preorder, as columns of numbers and lists. ``merged``: they
    were spine nodes before, so others may look for them by key."""

    def __init__(self, merged: bool):
        self.merged = merged
        self.key, self.above, self.sha = [], [], []
        self.depth, self.parent, self.size, self.ends, self.first = [], [], [], [], []
        self.children, self.leaves, self.members, self.saved = [], [], [], []

    def add(self, key, above, parent, depth, size, ends=0, sha=None, first=None, children=0, leaves=0, members=0, saved=0) -> int:
        values = (key, above, parent, depth, size, ends, sha, np.iinfo(np.int64).max if first is None else first, children, leaves, members, saved)
        names = ("key", "above", "parent", "depth", "size", "ends", "sha", "first", "children", "leaves", "members", "saved")
        for name, value in zip(names, values, strict=True):
            getattr(self, name).append(value)
        return len(self.key) - 1


def from_paths(rows: list[tuple]) -> Trie:
    """The trie of sorted, distinct (path, n, first, ends_sha256)."""
    trie = Trie(False)
    start = hashlib.md5()
    chain, sums, last = [trie.add(start.digest(), None, -1, 0, 0)], [start], b""
    for path, n, first, sha in rows:
        same, most = 0, min(len(path), len(last))
        while same < most and path[same:same + TOKEN] == last[same:same + TOKEN]:
            same += TOKEN
        depth = same // TOKEN
        del chain[depth + 1:], sums[depth + 1:]
        for at in range(same, len(path), TOKEN):
            token = path[at:at + TOKEN]
            sums.append(sums[-1].copy())
            sums[-1].update(token)
            size = int.from_bytes(token[16:], "big")
            chain.append(trie.add(sums[-1].digest(), sums[-2].digest(), chain[-1], len(chain), size))
        end = chain[-1]
        trie.ends[end], trie.first[end], trie.sha[end] = n, first, sha
        last = path
    return trie


def from_spines(rows: list[dict]) -> Trie:
    """The trie of neighbouring shards' spines, in the shards' order and each
    in preorder: a node of several shards is one."""
    trie, at = Trie(True), {}
    for r in rows:
        i = at.get(r["key"])
        if i is None:
            parent = at[r["above"]] if r["above"] is not None else -1
            i = at[r["key"]] = trie.add(r["key"], r["above"], parent, r["depth"], r["size"])
        trie.ends[i] += r["ends"]
        trie.sha[i] = trie.sha[i] or r["ends_sha256"]
        trie.first[i] = min(trie.first[i], r["first"])
        for name in ("children", "leaves", "members", "saved"):
            getattr(trie, name)[i] += r[name]
    return trie


class Excess:
    """Balanced parentheses as their running excess, in blocks with minimum
    and maximum, and pairs of blocks above them."""

    def __init__(self, parens: np.ndarray):
        excess = np.cumsum(parens, dtype=np.int64)
        blocks = -(-len(excess) // WIDTH)
        self.rows = np.pad(excess, (0, blocks * WIDTH - len(excess)), constant_values=np.iinfo(np.int64).max).reshape(blocks, WIDTH)
        top = np.where(self.rows == np.iinfo(np.int64).max, np.iinfo(np.int64).min, self.rows).max(1)
        self.low, self.high = [self.rows.min(1)], [top]
        while len(self.low[-1]) > 1:
            odd = len(self.low[-1]) % 2
            self.low.append(np.pad(self.low[-1], (0, odd), constant_values=np.iinfo(np.int64).max).reshape(-1, 2).min(1))
            self.high.append(np.pad(self.high[-1], (0, odd), constant_values=np.iinfo(np.int64).min).reshape(-1, 2).max(1))

    def _holds(self, level: int, block: int, target: int) -> bool:
        return block < len(self.low[level]) and self.low[level][block] <= target <= self.high[level][block]

    def _next_block(self, block: int, target: int) -> int:
        """The first block from ``block`` on whose range holds ``target``."""
        level = 0
        while not self._holds(level, block, target):
            block += 1
            while block % 2 == 0 and level + 1 < len(self.low):
                block, level = block // 2, level + 1
        while level:
            block, level = block * 2, level - 1
            if not self._holds(level, block, target):
                block += 1
        return block

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``opens`` close: the first later
        place whose excess is one below the open's."""
        out = np.empty(len(opens), np.int64)
        column = np.arange(WIDTH)
        for a in range(0, len(opens), 4096):
            at = opens[a:a + 4096]
            block, place = at // WIDTH, at % WIDTH
            target = self.rows[block, place] - 1
            hit = (self.rows[block] == target[:, None]) & (column > place[:, None])
            found, where = hit.any(1), hit.argmax(1)
            for i in np.flatnonzero(~found):
                block[i] = self._next_block(int(block[i]) + 1, int(target[i]))
                where[i] = (self.rows[block[i]] == target[i]).argmax()
            out[a:a + 4096] = block * WIDTH + where
        return out


def solve(trie: Trie, last: bool) -> tuple[list[dict], list[dict]]:
    """(final nodes, spine nodes) of a shard; all are final if it is the
    ``last``. Spine nodes take in what their final children hold."""
    n = len(trie.key)
    number = lambda name: np.array(getattr(trie, name), np.int64)
    depth, parent, size, first = number("depth"), number("parent"), number("size"), number("first")
    opens = 2 * np.arange(n) - depth
    parens = np.full(2 * n, -1, np.int8)
    parens[opens] = 1
    closes = Excess(parens).findclose(opens)
    # Preorder ranks: the nodes of a subtree are those that open up to its close.
    stop = np.cumsum(parens == 1)[closes]
    inside = lambda values: (lambda sums: sums[stop] - sums[:n])(np.concatenate([[0], np.cumsum(values)]))
    pairs = np.zeros(2 * n, np.int64)
    pairs[:-1] = (parens[:-1] == 1) & (parens[1:] == -1)
    hanging = number("children")
    pairs[opens] &= hanging == 0  # a node with closed children is no leaf
    members = inside(number("ends") + number("members"))
    leaf_rank = np.concatenate([[0], np.cumsum(pairs)])
    leaves = leaf_rank[closes] - leaf_rank[opens] + inside(number("leaves"))
    saved = inside((members - 1) * size + number("saved"))
    children = hanging + np.bincount(parent[1:], minlength=n)
    by_depth = np.argsort(depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)[:0:-1]:
        np.minimum.at(first, parent[level], first[level])

    spine = np.zeros(n, bool)
    if not last:
        chain = np.flatnonzero(depth != np.arange(n))
        spine[: chain[0] if len(chain) else n] = True
        at = n - 1
        while at >= 0:
            spine[at], at = True, int(parent[at])
    final = []
    own_first, own = number("first"), {k: number(k) for k in ("children", "leaves", "members", "saved")}
    for i in np.flatnonzero(~spine):
        p = int(parent[i])
        known = p < 0 or not spine[p]
        final.append({
            "conv_id": int(first[i]), "depth": int(depth[i]), "parent_conv_id": int(first[p]) if known and p >= 0 else None,
            "n_convs": int(members[i]), "n_children": int(children[i]), "n_leaves": int(leaves[i]),
            "saved_tokens": int(saved[i]), "ends_sha256": trie.sha[i] or NO_ENDS,
            "key": trie.key[i] if trie.merged else None, "open_parent": None if known else trie.key[p],
        })
        if not known:
            own["children"][p] += 1
            own["leaves"][p] += leaves[i]
            own["members"][p] += members[i]
            own["saved"][p] += saved[i]
            own_first[p] = min(own_first[p], first[i])
    kept = [{
        "key": trie.key[i], "above": trie.above[i], "depth": int(depth[i]), "size": int(size[i]), "ends": trie.ends[i],
        "ends_sha256": trie.sha[i], "first": int(own_first[i]), **{k: int(v[i]) for k, v in own.items()},
    } for i in np.flatnonzero(spine)]
    return final, kept


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _columns(final: list[dict], spine: list[dict]) -> dict:
    """Rows of both kinds: finals with a null ``place``."""
    kept, nodes = _names(SPINE), _names(NODE)
    no, none = [None] * len(final), [None] * len(spine)
    out = {"place": no + list(range(len(spine)))}
    out |= {c: no + [r[c] for r in spine] for c in kept}
    return out | {f"node_{c}": [r[c] for r in final] + none for c in nodes}


def _shard(batches) -> Iterator[dict]:
    """One partition's sorted sequences, block by block, to final nodes and
    the spine of the whole partition."""
    rows, spine = [], None

    def close(rows, spine):
        final, own = solve(from_paths(rows), False)
        if spine is None:
            return final, own
        more, own = solve(from_spines(spine + own), False)
        return final + more, own

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            rows.append(row)
            if len(rows) == BLOCK:
                final, spine = close(rows, spine)
                rows = []
                yield _columns(final, [])
    if rows:
        final, spine = close(rows, spine)
        yield _columns(final, [])
    if spine is not None:
        yield _columns([], spine)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """The nodes of all (conv_id, path), as the query's columns."""
    lined = _same_paths(paths).repartitionByRange("path").sortWithinPartitions("path")
    parts = map_batches(lined.select("path", "n", "first", "ends_sha256"), _shard, PART)
    # Partitions are in the order of their ranges.
    parts = written(parts.withColumn("shard", F.spark_partition_id().cast("long")), "trie-shards")
    found = [parts.where("place IS NULL")]
    while True:
        spines = parts.where("place IS NOT NULL")
        ends = spines.agg(F.min("shard").alias("a"), F.max("shard").alias("b")).first()
        if ends["a"] is None:
            break
        last = ends["b"] // FAN == ends["a"] // FAN
        group = F.floor(F.col("shard") / FAN).cast("long")

        def merge(t, last=last):
            rows = sorted(t.to_pylist(), key=lambda r: (r["shard"], r["place"]))
            final, spine = solve(from_spines(rows), last)
            return {**_columns(final, spine), "shard": [rows[0]["group"]] * (len(final) + len(spine))}

        keep = ["shard", "place", *_names(SPINE)]
        parts = written(apply_groups(spines.select(group.alias("group"), *keep), ["group"], merge, f"{PART}, shard long"), "trie-spines")
        found.append(parts.where("place IS NULL"))
        if last:
            break
    names = _names(NODE)
    nodes = reduce(DataFrame.unionByName, [f.select(*(F.col(f"node_{c}").alias(c) for c in names)) for f in found])
    up = nodes.where("key IS NOT NULL").select(F.col("key").alias("k"), F.col("conv_id").alias("up"))
    return nodes.join(up, F.col("open_parent") == F.col("k"), "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of conversations (conv_id, turn, role, text)."""
    return trie_nodes(sequences(turns(conversations)))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): conversation c takes the first h turns of conversation
    c - c % 5, then its own after its first h, h = crc32(c) % 9."""
    own = written(turns(conversations), "trie-turns")
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    ids = own.select("conv_id").distinct()
    heads = own.where("pos <= 8").groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("head")
    )
    taken = (
        ids.withColumn("h", h).withColumn("from", F.col("conv_id") - F.col("conv_id") % 5)
        .join(heads, F.col("from") == F.col("base"))
        .select("conv_id", F.explode(F.slice("head", F.lit(1), F.col("h").cast("int"))).alias("t"))
        .select("conv_id", "t.pos", "t.token")
    )
    everyone = ids.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("token"))
    return sequences(everyone.unionByName(taken).unionByName(own.where(F.col("pos") > h)))


def digest(conversations: DataFrame) -> DataFrame:
    return trie_nodes(rebuilt(conversations))


ORACLE_SQL = r"""
WITH bits AS (SELECT i::UBIGINT AS i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT),
    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS v FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM bits),
own AS (
  SELECT conv_id, md5(coalesce(role, '') || chr(0) || coalesce(text, '')) AS token, strlen(coalesce(text, '')) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, (xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
    lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 9)::BIGINT AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
built AS (
  SELECT i.conv_id, o.pos, o.token, o.size FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 5 AND o.pos <= h
  UNION ALL SELECT i.conv_id, o.pos, o.token, o.size FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos > h),
lists AS (
  SELECT i.conv_id, coalesce(list(token ORDER BY pos) FILTER (pos IS NOT NULL), []) AS tokens, coalesce(list(size ORDER BY pos) FILTER (pos IS NOT NULL), []) AS sizes
  FROM ids i LEFT JOIN built b ON i.conv_id = b.conv_id GROUP BY i.conv_id),
members AS (
  SELECT conv_id, d AS depth, md5(array_to_string(tokens[1:d], ',')) || ':' || d AS node,
    CASE WHEN d > 0 THEN md5(array_to_string(tokens[1:d - 1], ',')) || ':' || (d - 1) END AS parent,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(tokens) AS ends
  FROM lists, range(len(tokens) + 1) t(d)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node),
kids AS (SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node AS top, b.node FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
totals AS (
  SELECT top, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM below JOIN nodes USING (node) LEFT JOIN kids ON kids.parent = nodes.node GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.top = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.parent = n.node
"""
