"""N-gram Jaccard join by vertical partitioning.

A document's set holds its different five-word shingles. Two documents link
when their Jaccard similarity reaches 3/4. The steps:

1. Tasks hash the shingles and send them, delta-coded and sorted, to shards by
   hash. A shard counts documents per shingle and sends back those that two or
   more documents have: others can't overlap. Their global order is by
   document count, rare ones first.
2. A document that shares less than 3/4 of its shingles links with nothing.
   Documents with equal sets form a class, from here on one row.
3. In the global order, classes that link share one of the first n - ceil(3n/4)
   + 1 shingles of each. Connecting the classes of each such shingle to its
   smallest class gives clusters; links lie within clusters.
4. A cluster is cut into blocks; a cell is a pair of blocks. It cuts the
   global order into fragments, counts the partial overlaps of all pairs of
   the cell fragment by fragment, and sums them per pair, until no pair can
   reach the threshold any more. All pairs' counts live in the cell's memory
   only: out go, per class, its links and a root of its component.
5. The roots' components give every document its class's component.

No task holds a whole cluster or class: clusters come in blocks of bounded
size. A shingle group does lie in one task: a shard holds all documents of its
shingles, as the map side joins a batch's postings without summing them. More
shuffle partitions make shards smaller but don't split one shingle's group.

Defined cases: null and blank texts have an empty set and link with nothing;
rows with a null id link with nothing and have no component; repeated rows and
ids are rows like others (rows of one text form one class); fewer than five
words make one shingle; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import apply_groups, map_batches
from quarry.llm.common import packed, shared_dir, shuffle_width, unpacked, written
from quarry.llm.components import connected_components
from quarry.llm.store import Shards, save, shard_bits, written_shards
from quarry.llm.tokens import documents, mix

N = 5  #: words of a shingle
TOKENS, DOCS = 1 << 20, 60_000  #: words and documents (16 bits) of a batch
KEY_BITS = 48  #: of a shingle's hash that are sent
CELL = 512  #: classes of a block
FRAGMENT = 4096  #: different shingles of a cell's fragment
_ODD = np.uint64(0x9FB21C651E98DF25)
POSTS, DOC_ROWS = 0, 1
SENT = "kind int, shard long, batch long, a binary, b binary, c binary, d binary"


def shingles(words: np.ndarray) -> np.ndarray:
    """The sorted different shingle hashes of a document's word hashes."""
    n = min(N, len(words))
    if not n:
        return np.empty(0, np.uint64)
    m = len(words) - n + 1
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h = mix(h * _ODD + words[j : j + m])
    return np.unique(h)


def _deltas(keys: np.ndarray, low: int) -> bytes:
    """Sorted keys as 32-bit differences, or as 64-bit ones where they must."""
    d = np.diff(keys, prepend=np.uint64(low))
    return d.astype("<u4").tobytes() if not len(d) or int(d.max()) < 1 << 32 else d.astype("<u8").tobytes()


def _undelta(blob: bytes, n: int, low: int) -> np.ndarray:
    d = np.frombuffer(blob, "<u4" if len(blob) == 4 * n else "<u8").astype(np.uint64)
    return np.cumsum(d, dtype=np.uint64) + np.uint64(low)


def _low(shard: int, bits: int) -> int:
    return shard << (KEY_BITS - bits)


def _sender(bits: int):
    def run(batches) -> Iterator[dict]:
        task, chunk = TaskContext.get().partitionId(), 0
        ids, sets, held = [], [], 0
        for b in batches:
            data = b.column(1).cast(pa.binary())
            for at in range(0, b.num_rows, 256):
                part = [v.as_py() or b"" for v in data.slice(at, 256)]
                for i, h in documents(part):
                    ids.append(b.column(0)[at + i].as_py())
                    sets.append(shingles(h))
                    held += len(h)
                    if held >= TOKENS or len(ids) >= DOCS:
                        yield _send(ids, sets, (task << 24) + chunk, bits)
                        ids, sets, held, chunk = [], [], 0, chunk + 1
        if ids:
            yield _send(ids, sets, (task << 24) + chunk, bits)

    return run


def _send(ids: list, sets: list[np.ndarray], batch: int, bits: int) -> dict:
    size = np.array([len(s) for s in sets], "<i8")
    every = np.concatenate(sets)
    local = np.repeat(np.arange(len(sets), dtype="<u2"), size)
    first = np.minimum(np.cumsum(size) - size, max(len(every) - 1, 0))
    prints = []
    for x in (every, mix(every ^ _ODD)):
        total = np.add.reduceat(x, first) if len(every) else np.zeros(len(sets), np.uint64)
        prints.append(np.where(size > 0, total, 0).astype("<u8"))
    # Documents: ids with a flag for null, sizes, fingerprints of the sets.
    known = np.array([i is not None for i in ids])
    doc = np.array([i or 0 for i in ids], "<i8")
    # The batch's own group: negative numbers are not shards.
    rows = [(DOC_ROWS, -1 - batch, batch, doc.tobytes(), known.tobytes(), size.tobytes(), prints[0].tobytes() + prints[1].tobytes())]
    key = every >> np.uint64(64 - KEY_BITS)
    order = np.argsort(key, kind="stable")
    key, local = key[order], local[order]
    bounds = np.searchsorted(key >> np.uint64(KEY_BITS - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    for s in range(1 << bits):
        x, y = bounds[s], bounds[s + 1]
        if x < y:
            rows.append((POSTS, s, batch, _deltas(key[x:y], _low(s, bits)), local[x:y].tobytes(), b"", b""))
    return dict(zip(("kind", "shard", "batch", "a", "b", "c", "d"), zip(*rows)))


def _count_shard(bits: int):
    """Sends a shard's shared shingles back to the batches that have them, as
    positions in the global order: document count, then hash."""

    def run(t: pa.Table) -> dict:
        names = ("kind", "batch", "a", "b", "c", "d")
        if t.column("kind")[0].as_py() == DOC_ROWS:
            return {n: t.column(n).to_pylist() for n in names}
        low = _low(t.column("shard")[0].as_py(), bits)
        batches, local, key = t.column("batch").to_pylist(), [], []
        for a, b in zip(t.column("a").to_pylist(), t.column("b").to_pylist()):
            local.append(np.frombuffer(b, "<u2"))
            key.append(_undelta(a, len(local[-1]), low))
        of = np.repeat(np.arange(len(batches)), [len(x) for x in local])
        key, local = np.concatenate(key), np.concatenate(local)
        order = np.argsort(key, kind="stable")
        key, local, of = key[order], local[order], of[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.append(first, len(key)))
        keep = np.repeat(count >= 2, count)
        place = np.repeat(np.minimum(count, 65535).astype(np.uint64) << np.uint64(KEY_BITS), count) | key
        place, local, of = place[keep], local[keep], of[keep]
        order = np.argsort(of, kind="stable")
        place, local, of = place[order], local[order], of[order]
        bounds = np.searchsorted(of, np.arange(len(batches) + 1))
        rows = [
            (POSTS, batches[i], place[x:y].astype("<u8").tobytes(), local[x:y].tobytes(), b"", b"")
            for i, (x, y) in enumerate(zip(bounds[:-1], bounds[1:])) if x < y
        ]
        return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}

    return run


def _gather(t: pa.Table) -> dict:
    """A batch's documents with their shared shingles, in the global order."""
    kind = t.column("kind").to_numpy()
    meta = t.filter(pa.array(kind == DOC_ROWS)).to_pylist()[0]
    posts = t.filter(pa.array(kind == POSTS))
    doc, known = np.frombuffer(meta["a"], "<i8"), np.frombuffer(meta["b"], bool)
    size, prints = np.frombuffer(meta["c"], "<i8"), np.frombuffer(meta["d"], "<i8").reshape(2, -1)
    place = np.frombuffer(b"".join(posts.column("a").to_pylist()), "<u8")
    local = np.frombuffer(b"".join(posts.column("b").to_pylist()), "<u2")
    order = np.lexsort((place, local))
    place, local = place[order], local[order]
    bounds = np.searchsorted(local, np.arange(len(doc) + 1))
    shared = np.diff(bounds)
    able = known & (size > 0) & (4 * shared >= 3 * size)
    return {
        "doc_id": pa.array(doc, mask=~known), "n_shingles": size, "f1": prints[0], "f2": prints[1],
        "places": [place[bounds[i] : bounds[i + 1]].tobytes() if able[i] else None for i in range(len(doc))],
    }


def document_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, places): per row its set's size and
    fingerprint; places of the shared shingles where a link is possible."""
    bits = shard_bits(shuffle_width(docs.sparkSession) // 2)
    sent = map_batches(docs.select(F.col(key).cast("long"), text), _sender(bits), SENT)
    back = apply_groups(sent, ["kind", "shard"], _count_shard(bits), "kind int, batch long, a binary, b binary, c binary, d binary")
    sets = apply_groups(back, ["batch"], _gather, "doc_id long, n_shingles long, f1 long, f2 long, places binary")
    return sets.withColumn("node", F.when(F.col("places").isNotNull(), F.xxhash64("f1", "f2", "n_shingles")))


def _prefixes(batches) -> Iterator[dict]:
    """(node, place): the places on which linked classes must meet."""
    for b in batches:
        nodes, places = [], []
        for node, n, blob in zip(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)):
            p = np.frombuffer(blob.as_py(), "<i8")
            # Shingles that no other document has come first in the order.
            p = p[: max(0, n - -(-3 * n // 4) + 1 - (n - len(p)))]
            nodes.append(np.full(len(p), node))
            places.append(p)
        if nodes:
            yield {"node": np.concatenate(nodes), "place": np.concatenate(places)}


def overlaps(sets: list[np.ndarray], size: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Overlaps of the sets ``rows`` with the sets ``cols``: summed over the
    fragments of the global order; stops when no pair can reach 3/4."""
    every, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    vocabulary, word = np.unique(every, return_inverse=True)
    common = np.bincount(word, minlength=len(vocabulary)) >= 2
    column = np.cumsum(common) - 1
    keep = common[word]
    word, of = column[word[keep]], of[keep]
    order = np.argsort(word, kind="stable")
    word, of = word[order], of[order]
    total = np.zeros((len(rows), len(cols)), np.float32)
    need = np.ceil(3 * (size[rows][:, None] + size[cols][None, :]) / 7 - 1e-9)
    left = np.bincount(of, minlength=len(sets)).astype(np.float32)
    for at in range(0, int(common.sum()), FRAGMENT):
        x, y = np.searchsorted(word, (at, at + FRAGMENT))
        part = np.zeros((len(sets), FRAGMENT), np.float32)
        part[of[x:y], word[x:y] - at] = 1
        total += part[rows] @ part[cols].T
        left -= part.sum(axis=1)
        if not (total + np.minimum(left[rows][:, None], left[cols][None, :]) >= need).any():
            break
    return total


def _cell(t: pa.Table) -> dict:
    """(node, root, links) of a cell's clusters: links within one block, or
    between two different blocks; ``docs`` counts a class's documents."""
    cluster, block = t.column("cluster").to_numpy(), t.column("block").to_numpy()
    node, docs = t.column("node").to_numpy(), t.column("docs").to_numpy()
    size, blobs = t.column("n_shingles").to_numpy(), t.column("places").combine_chunks()
    cross = t.column("i")[0].as_py() != t.column("j")[0].as_py()
    order = np.argsort(cluster, kind="stable")
    first = np.flatnonzero(np.r_[True, cluster[order][1:] != cluster[order][:-1]])
    out = {"node": [], "root": [], "links": []}
    for members in np.split(order, first[1:]):
        if len(members) < 2:
            continue
        sets = [np.frombuffer(blobs[int(i)].as_py(), "<u8") for i in members]
        n, mine = size[members], block[members]
        if cross:
            a, b = np.flatnonzero(mine == mine.min()), np.flatnonzero(mine != mine.min())
        else:
            a = b = np.arange(len(members))
        both = overlaps(sets, n, a, b)
        linked = np.zeros((len(members), len(members)), bool)
        linked[np.ix_(a, b)] = 7 * both >= 3 * (n[a][:, None] + n[b][None, :])
        linked |= linked.T
        np.fill_diagonal(linked, False)
        links = linked @ docs[members]
        root = _roots(linked, node[members])
        some = links > 0
        out["node"].append(node[members][some])
        out["root"].append(root[some])
        out["links"].append(links[some])
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def _roots(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    root, todo = np.zeros(len(node), np.int64), np.ones(len(node), bool)
    for i in range(len(node)):
        if todo[i]:
            seen = np.zeros(len(node), bool)
            seen[i] = True
            new = seen
            while new.any():
                reach = linked[new].any(axis=0) & ~seen
                seen |= reach
                new = reach
            root[seen] = node[seen].min()
            todo &= ~seen
    return root


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row: its set's
    size, the smallest id reachable by links, and how many rows it links
    with."""
    sets = written(document_sets(docs, key, text), "join-sets")
    classes = written(
        sets.where("node is not null").groupBy("node")
        .agg(F.min("doc_id").alias("least"), F.count("*").alias("docs"),
             F.first("n_shingles").alias("n_shingles"), F.first("places").alias("places")),
        "join-classes",
    )
    prefixes = written(map_batches(classes.select("node", "n_shingles", "places"), _prefixes, "node long, place long"), "join-prefixes")
    leaders = prefixes.groupBy("place").agg(F.min("node").alias("leader"), F.max("node").alias("other"))
    leaders = written(leaders.where("leader <> other").drop("other"), "join-leaders")
    near = prefixes.join(leaders, "place").where("node <> leader").select("node", "leader").distinct()
    clusters = connected_components(near, "node", "leader", "join-clusters")
    # Blocks of clusters. Small clusters share a cell, which compares within
    # clusters only; the cells of a large one are the pairs of its blocks.
    sizes = clusters.groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("members"))
    placed = (
        clusters.withColumnRenamed("label", "cluster").join(written(sizes, "join-sizes"), "cluster")
        .withColumnRenamed("node", "at").join(classes, F.col("at") == F.col("node")).drop("at")
        .withColumn("blocks", F.ceil(F.col("members") / CELL).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    small = F.col("blocks") == 1
    bins = max(1, clusters.count() // CELL)
    placed = (
        placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
        .withColumn("cell", F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(F.col("cluster")))
        .withColumn("blocks", F.least("blocks", F.lit(2)))
        .select("blocks", "cell", "i", "j", "cluster", "block", "node", "docs", "n_shingles", "places")
    )
    found = written(apply_groups(placed, ["blocks", "cell", "i", "j"], _cell, "node long, root long, links long"), "join-links")
    links = found.groupBy(F.col("node").alias("_n")).agg(F.sum("links").alias("links"))
    labels = connected_components(found, "node", "root", "join-components")
    rooted = labels.join(classes.select(F.col("node").alias("_m"), "least"), F.col("node") == F.col("_m"))
    low = rooted.groupBy(F.col("label").alias("_l")).agg(F.min("least").alias("component"))
    per_class = written(
        classes.select(F.col("node").alias("_c"), "least", "docs")
        .join(labels, F.col("_c") == F.col("node"), "left").drop("node")
        .join(written(low, "join-lowest"), F.col("label") == F.col("_l"), "left")
        .join(links, F.col("_c") == F.col("_n"), "left")
        .select("_c", F.coalesce("component", "least").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("docs") - 1).alias("links")),
        "join-classes-done",
    )
    return sets.join(per_class, F.col("node") == F.col("_c"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null
    ids last; of rows with that id, the first read). Texts without words link
    with nothing, so all such rows stay. Same columns, whatever their names; an
    empty table stays empty. The rows
    that go are written as sorted arrays, which the workers map, so the texts
    are not shuffled."""
    spark = docs.sparkSession
    base = written(packed(docs, at=F.monotonically_increasing_id()), "join-rows")
    field = F.col("row").getField
    joined = join(base.select("at", field(text).alias("text")), "at", "text").select(F.col("doc_id").alias("of"), "component_id")
    ids = base.select("at", field(key).alias("id"))
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "at")
    grouped = written(joined.join(ids, F.col("of") == F.col("at")).select("component_id", rank.alias("rank")), "join-rank")
    stay = grouped.groupBy(F.col("component_id").alias("_c")).agg(F.min("rank").alias("first"))
    # Written, so that the join has two plain shuffles and a hot group is split.
    gone = grouped.join(written(stay, "join-first"), F.col("component_id") == F.col("_c")).where(F.col("rank.at") != F.col("first.at"))
    folder, bits = shared_dir(spark, "join-gone"), shard_bits(shuffle_width(spark) // 4)
    # Spread by a multiplicative hash, as row numbers fill few top bits.
    keys = gone.select(F.col("rank.at").alias("at"))

    def spread(at: np.ndarray) -> np.ndarray:
        return mix(at.astype(np.uint64))

    def deal(batches) -> Iterator[dict]:
        for b in batches:
            k = spread(b.column(0).to_numpy())
            yield {"key": k.view(np.int64), "shard": (k >> np.uint64(64 - bits)).astype(np.int32)}

    def write(t: pa.Table) -> dict:
        shard = t.column("shard")[0].as_py()
        save(folder, f"gone-{shard:06d}", np.sort(t.column("key").to_numpy().view(np.uint64)))
        return {"shard": [shard]}

    there = written_shards(
        written(apply_groups(map_batches(keys, deal, "key long, shard int"), ["shard"], write, "shard int"), "join-gone-shards")
    )
    at = base.columns.index("at")

    def keep(batches) -> Iterator[pa.RecordBatch]:
        shards = Shards(folder, bits, "gone", (), there)
        for b in batches:
            k = spread(b.column(at).to_numpy())
            order = np.argsort(k)
            hit = np.empty(len(k), bool)
            hit[order] = shards.find(k[order])[0]
            yield b.filter(pa.array(~hit))

    return unpacked(map_batches(base, keep, base.schema), docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    return join(docs)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS t
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN []::VARCHAR[]
    WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i : i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       (SELECT min(root) FROM reach r WHERE r.doc_id = w.doc_id) AS component_id,
       (SELECT count(*) FROM links l WHERE l.x = w.doc_id) AS n_links
FROM w LEFT JOIN n USING (doc_id)
"""
