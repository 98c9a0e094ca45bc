"""Interpolated modified Kneser-Ney bigram model.

Counting: tasks hash the words of their documents, sum n-grams locally and
send them to shards by hash. A shard's task adds the counts up and writes its
n-grams as sorted hash arrays, one array per count class (1, 2, 3 and more:
the classes of the discounts), and passes on what the lower order needs: how
many different successors a context has per class, how many different
predecessors a word has. A second shuffle brings those to the words' shards,
which write sorted word arrays. Scoring: workers map the arrays and look up
the sorted n-grams of a batch; no task loads the model, and no model passes
through the driver (only about 16 sums do).

Probabilities, with counts c, classes' discounts D and contexts u:
P(w|u) = (c(uw) - D) / c(u) + g(u) * P(w), g(u) the mass taken from u;
P(w) = (N(.w) - D') / N(..) + g' / (V + 1), N counting different bigrams; an
unseen context leaves P(w). Words are 64-bit hashes; the two words of a bigram
are kept as 40 bits each.

Defined cases: a null or empty text is one end token; null doc_ids are in
training (there is no remainder) and rows like others; repeated rows count as
often as they are there; without training rows every probability is 1 / (V +
1) = 1; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.arrow import apply_groups, map_batches
from quarry.llm.common import shared_dir, shuffle_width, written
from quarry.llm.store import Shards, save, shard_bits, written_shards
from quarry.llm.tokens import documents, mix

COUNT_TOKENS = 3 << 20  #: tokens summed up locally before they are sent
SCORE_TOKENS = 1 << 20  #: tokens scored at once
#: Hashes of the marks, which no word has but by a 64-bit collision.
START, END = np.uint64(0x5354415254215354), np.uint64(0xE4E44D41524B21E0)
ID_BITS = 40
WORDS, PAIRS, AFTER, BEFORE, TOTALS = range(5)
BLOB = "kind int, shard int, a binary, b binary, n binary"


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def word_id(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - ID_BITS)


def pair_key(prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
    return mix(mix(prev + np.uint64(1)) + cur)


def _put(ids: np.ndarray) -> bytes:
    return np.ascontiguousarray(ids.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _get(blobs: pa.ChunkedArray) -> np.ndarray:
    raw = np.frombuffer(b"".join(blobs.to_pylist()), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.reshape(-1).view("<u8").copy()


def _numbers(blobs: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind)


def _runs(batches, column: int, limit: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows' other columns and word hashes, about ``limit`` tokens at a time."""
    rows, held, n = [], [], 0
    for b in batches:
        data = b.column(column).cast(pa.binary())
        for at in range(0, b.num_rows, 256):
            part = [v.as_py() or b"" for v in data.slice(at, 256)]
            for i, h in documents(part):
                rows.append((b, at + i))
                held.append(h)
                n += len(h) + 1
                if n >= limit:
                    yield rows, held
                    rows, held, n = [], [], 0
    if rows:
        yield rows, held


def _sequence(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Previous and current token of every position of some documents."""
    prev = np.concatenate([x for h in held for x in ((START,), h)]).astype(np.uint64)
    cur = np.concatenate([x for h in held for x in (h, (END,))]).astype(np.uint64)
    return prev, cur


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _split(kind: int, shard: np.ndarray, parts: int, a, b, n) -> Iterator[tuple]:
    """Rows of one blob per shard; ``shard`` is sorted."""
    bounds = np.searchsorted(shard, np.arange(parts + 1))
    for i in range(parts):
        x, y = bounds[i], bounds[i + 1]
        if x < y:
            yield kind, i, a(x, y), b(x, y), n(x, y)


def _columns(rows: list[tuple]) -> dict:
    return dict(zip(("kind", "shard", "a", "b", "n"), zip(*rows))) if rows else {k: [] for k in ("kind", "shard", "a", "b", "n")}


def _counter(bits: int):
    def run(batches) -> Iterator[dict]:
        for _, held in _runs(batches, 0, COUNT_TOKENS):
            prev, cur = _sequence(held)
            words, n = _sums(np.append(cur, START), np.append(np.ones(len(cur), np.int64), 0))
            n = n.astype("<i8")
            yield _columns(list(_split(
                WORDS, (words >> np.uint64(64 - bits)).astype(np.int64), 1 << bits,
                lambda x, y: words[x:y].tobytes(), lambda x, y: b"", lambda x, y: n[x:y].tobytes(),
            )))
            prev, cur = word_id(prev), word_id(cur)
            key = pair_key(prev, cur)
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            count = np.diff(np.append(first, len(key))).astype("<u4")
            prev, cur = prev[order[first]], cur[order[first]]
            yield _columns(list(_split(
                PAIRS, (key[first] >> np.uint64(64 - bits)).astype(np.int64), 1 << bits,
                lambda x, y: _put(prev[x:y]), lambda x, y: _put(cur[x:y]), lambda x, y: count[x:y].tobytes(),
            )))

    return run


def _pair_shard(folder: str, bits: int):
    """Adds up a shard: words are passed on, bigrams are written."""

    def run(t: pa.Table) -> dict:
        kind, shard = t.column("kind")[0].as_py(), t.column("shard")[0].as_py()
        if kind == WORDS:
            words, n = _sums(_numbers(t.column("a"), "<u8"), _numbers(t.column("n"), "<i8"))
            return _columns([(WORDS, shard, words.tobytes(), b"", n.astype("<i8").tobytes())])
        prev, cur, n = _get(t.column("a")), _get(t.column("b")), _numbers(t.column("n"), "<u4").astype(np.int64)
        key = pair_key(prev, cur)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        n = np.add.reduceat(n[order], first)
        key, prev, cur = key[first], prev[order[first]], cur[order[first]]
        del order
        save(folder, f"one-{shard:06d}", key[n == 1])
        save(folder, f"two-{shard:06d}", key[n == 2])
        more = n >= 3
        save(folder, f"more-{shard:06d}", key[more])
        save(folder, f"count-{shard:06d}", n[more] if n.max() >> 32 else n[more].astype(np.uint32))
        rows = []
        ids, of = np.unique(prev, return_inverse=True)
        per = np.stack([np.bincount(of[m], minlength=len(ids)) for m in (n == 1, n == 2, more)], axis=1).astype("<i4")
        rows += _split(AFTER, (ids >> np.uint64(ID_BITS - bits)).astype(np.int64), 1 << bits,
                       lambda x, y: _put(ids[x:y]), lambda x, y: b"", lambda x, y: per[x:y].tobytes())
        seen, k = np.unique(cur, return_counts=True)
        k = k.astype("<i4")
        rows += _split(BEFORE, (seen >> np.uint64(ID_BITS - bits)).astype(np.int64), 1 << bits,
                       lambda x, y: _put(seen[x:y]), lambda x, y: b"", lambda x, y: k[x:y].tobytes())
        rows.append((TOTALS, shard, b"", b"", np.array([(n == i).sum() for i in (1, 2, 3, 4)], "<i8").tobytes()))
        return _columns(rows)

    return run


META = "shard int, has_pairs long, types long, tokens long, pairs long, docs long, " + ", ".join(
    f"{x}{i} long" for x in ("t", "m") for i in (1, 2, 3, 4)
)


def _word_shard(folder: str, bits: int):
    """Writes a shard of words with what their contexts and predecessors are."""

    def run(t: pa.Table) -> dict:
        kind, shard = t.column("kind").to_numpy(), t.column("shard")[0].as_py()
        part = lambda k: t.filter(pa.array(kind == k))
        w = part(WORDS)
        words, c = _sums(_numbers(w.column("a"), "<u8"), _numbers(w.column("n"), "<i8"))
        ids = word_id(words)
        a = part(AFTER)
        after, per = _get(a.column("a")), _numbers(a.column("n"), "<i4").reshape(-1, 3).astype(np.int64)
        n = np.zeros((len(words), 3), np.int64)
        for j in range(3):
            keys, s = _sums(after, per[:, j])
            n[:, j] = _at(keys, s, ids)
        p = part(BEFORE)
        before = _at(*_sums(_get(p.column("a")), _numbers(p.column("n"), "<i4").astype(np.int64)), ids)
        before[c == 0] = 0
        save(folder, f"word-{shard:06d}", words)
        save(folder, f"c-{shard:06d}", c)
        for name, values in (("before", before), ("n1", n[:, 0]), ("n2", n[:, 1]), ("n3", n[:, 2])):
            save(folder, f"{name}-{shard:06d}", values if len(values) and values.max() >> 32 else values.astype(np.uint32))
        totals = _numbers(part(TOTALS).column("n"), "<i8").reshape(-1, 4).sum(axis=0) if (kind == TOTALS).any() else np.zeros(4, np.int64)
        # Totals come from the shard of pairs with this number.
        out = {"shard": shard, "has_pairs": (kind == TOTALS).any(), "types": (c > 0).sum(), "tokens": c.sum(), "pairs": before.sum(), "docs": c[words == END].sum()}
        out |= {f"t{i + 1}": totals[i] for i in range(4)} | {f"m{i}": (before == i).sum() for i in (1, 2, 3, 4)}
        return {k: [int(v)] for k, v in out.items()}

    return run


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, values[i], 0)


def discounts(n: list[int]) -> np.ndarray:
    """The three discounts from the counts of counts 1 to 4; where a count is
    missing, a class's discount stays between 0 and its count."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.5
    d = [(i + 1) - (i + 2) * y * n[i + 1] / n[i] if n[i] else y for i in range(3)]
    return np.clip(d, 0.0, [1.0, 2.0, 3.0])


class Model:
    """What a worker needs to score: sums and the folder of the arrays."""

    def __init__(self, folder: str, bits: int, sums: dict, words: frozenset[int], pairs: frozenset[int]):
        self.folder, self.bits, self.sums = folder, bits, sums
        self.word_shards, self.pair_shards = words, pairs
        self.pair_discount = discounts([sums[f"t{i}"] for i in (1, 2, 3, 4)])
        self.word_discount = discounts([sums[f"m{i}"] for i in (1, 2, 3, 4)])

    def open(self) -> None:
        pairs = lambda name, *columns: Shards(self.folder, self.bits, name, columns, self.pair_shards)
        self.words = Shards(self.folder, self.bits, "word", ("c", "before", "n1", "n2", "n3"), self.word_shards)
        self.one, self.two, self.more = pairs("one"), pairs("two"), pairs("more", "count")

    def tokens(self, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Training count and log10 probability of every token of documents."""
        s = self.sums
        prev, cur = _sequence(held)
        words, at = np.unique(cur, return_inverse=True)
        _, (c, before, n1, n2, n3) = self.words.find(words)
        _, (_, _, s1, s2, s3) = self.words.find(np.array([START]))
        # P(w): the lower order.
        classes = np.minimum(before, 3).astype(np.int64)
        d = np.r_[0.0, self.word_discount]
        pairs = max(s["pairs"], 1)
        left = d[1] * s["m1"] + d[2] * s["m2"] + d[3] * max(s["types"] - s["m1"] - s["m2"], 0)
        left = left / pairs if s["pairs"] else 1.0
        lower = np.maximum(before - d[classes], 0.0) / pairs + left / (s["types"] + 1)
        # c(u) and g(u); the index of the previous token is the current one's, shifted.
        d = np.r_[0.0, self.pair_discount]
        total = np.append(c, s["docs"]).astype(np.float64)
        mass = np.append(d[1] * n1 + d[2] * n2 + d[3] * n3, d[1] * s1[0] + d[2] * s2[0] + d[3] * s3[0])
        of = np.r_[len(words), at[:-1]]
        of[prev == START] = len(words)
        total, mass = total[of], mass[of]
        count = self._pairs(pair_key(word_id(prev), word_id(cur)))
        seen = total > 0
        total = np.maximum(total, 1)
        upper = np.maximum(count - d[np.minimum(count, 3)], 0.0) / total
        p = np.where(seen, upper + mass / total * lower[at], lower[at])
        return c[at].astype(np.int64), np.log10(p)

    def _pairs(self, key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        key = key[order]
        count = self.one.find(key)[0] + 2 * self.two.find(key)[0].astype(np.int64)
        hit, (n,) = self.more.find(key)
        count = np.where(hit, n, count).astype(np.int64)
        out = np.empty(len(key), np.int64)
        out[order] = count
        return out


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts all of ``docs`` and writes the arrays to the shared folder."""
    spark = docs.sparkSession
    folder, bits = shared_dir(spark, "kneser-ney"), shard_bits(shuffle_width(spark) // 2)
    counted = map_batches(docs.select(text), _counter(bits), BLOB)
    pairs = apply_groups(counted, ["kind", "shard"], _pair_shard(folder, bits), BLOB)
    meta = written(apply_groups(pairs, ["shard"], _word_shard(folder, bits), META), "kneser-ney-sums")
    sums = meta.groupBy().sum(*meta.columns[1:]).first()
    pairs = written_shards(meta.where("has_pairs > 0"))
    return Model(folder, bits, dict(zip(meta.columns[1:], [v or 0 for v in sums])), written_shards(meta), pairs)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))

    def run(batches) -> Iterator[dict]:
        model.open()
        n, v = model.sums["tokens"], model.sums["types"]
        for at, held in _runs(batches, 2, SCORE_TOKENS):
            c, logs = model.tokens(held)
            length = np.array([len(h) + 1 for h in held])
            first = np.cumsum(length) - length
            total = lambda x: np.add.reduceat(x, first)
            yield {
                "doc_id": [b.column(0)[i].as_py() for b, i in at], "held_out": [b.column(1)[i].as_py() for b, i in at],
                "n_tokens": length, "n_known": total((c > 0).astype(np.int64)),
                "train_tokens": np.full(len(at), n, np.int64),
                "base_score": total(np.log10((c + 0.5) / (n + 0.5 * (v + 1)))), "score": total(logs),
            }

    scored = map_batches(rows, run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def digest(docs: DataFrame) -> DataFrame:
    return score(docs, train(docs.where(~held_out(F.col("doc_id")))))
