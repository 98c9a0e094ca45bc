"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, repeated for up to
``repeats`` passes. A queue entry's virtual finish time is its source's
cumulative tokens, up to and with the entry, divided by the source's target.
The entries of all sources are range-sorted by finish time and the total budget
truncates the sorted queue: that alone decides what is taken. At virtual time 1
every source has had its target, so an entry that lasts beyond it stands in the
queue in packets of ``PACKET`` words, each with its own finish time; a source
misses its target by a few packets, not by a long document.

No task sees a whole source or the whole queue: both running sums are taken
within ranges (of the shuffle order, and of the finish time) plus the totals
of the ranges before. The targets are one window over the sources, a row each.
Built-in functions only.

Defined cases: null or blank texts have size 0 and take 0; a null source is a
source of its own, last in order; null doc_ids and repeated rows are entries
like others (equal rows are interchangeable); an empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, hash_unit, packed, unpacked, word_count, written

WEIGHTS = (5, 2, 1)  #: fixed values: repeating over the sources in order
REPEATS = 3  #: a source gives at most so many times its size
RANGES = 4096  #: ranges of the shuffle order and of the finish time
PACKET = 8  #: words of a packet of an entry that lasts beyond time 1


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target): shares of all
    sizes by weight; a target stops at ``repeats`` times its source's size and
    the excess goes to the others by weight. One row per source, so this runs
    as one small window."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    df = sizes.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * repeats)
    # Sources fill up in the order of cap / weight. If those before this one
    # are full, the others share the rest at this level per unit of weight.
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    df = (
        df.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("full_w", F.coalesce(F.sum("w").over(before), F.lit(0)))
    )
    level = (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("full_w"))
    df = df.withColumn("level", level).withColumn(
        # It rises as long as the sources before are full indeed, then falls.
        "stop", F.max("level").over(everything)
    )
    share = F.col("stop") * F.col("w")
    target = F.when(share >= F.col("cap"), F.col("cap").cast("double")).otherwise(share)
    df = df.withColumn("target", F.coalesce(target, F.lit(0.0)))
    # Packets that end behind time 1 share what the budget has left there: a
    # packet per source at most. Until this time the open sources take more.
    open_target = F.sum(F.when(share < F.col("cap"), F.col("target")).otherwise(0.0)).over(everything)
    late = 1.0 + F.coalesce(F.try_divide(2.0 * PACKET * F.count(F.lit(1)).over(everything), open_target), F.lit(0.0))
    return df.select("source", "source_size", "target", late.alias("late"), F.col("total").alias("budget"))


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, row: str | None = None,
) -> DataFrame:
    """Returns (row, doc_id, size, source_size, target, taken): per row of
    ``docs`` the words the mix takes of it, repeats counted. ``row`` names a
    column that numbers the rows; without it they are numbered as read."""
    sized = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        # The shuffle: an order by hash, the same on every run.
        hash_unit(F.lit("mix"), F.col(key).cast("string"), F.md5(F.col(text))).alias("turn"),
        (F.monotonically_increasing_id() if row is None else F.col(row)).alias("row"),
    )
    sized = written(sized, "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    share = targets(sources, weights, repeats).withColumnRenamed("source", "_t")

    # Cumulative tokens of a source in its shuffled order: within ranges of
    # that order, plus the ranges before.
    ranged = sized.withColumn("range", F.floor(F.col("turn") / float(1 << 60) * RANGES).cast("int"))
    so_far = (
        ranged.groupBy(F.col("source").alias("_s"), F.col("range").alias("_r")).agg(F.sum("size").alias("in_range"))
        .withColumn("offset", F.sum("in_range").over(Window.partitionBy("_s").orderBy("_r")) - F.col("in_range"))
        .join(share, F.col("_s").eqNullSafe(F.col("_t")))
        .drop("_t", "in_range")
    )
    within = Window.partitionBy("source", "range").orderBy("turn", "doc_id", "row")
    queue = (
        ranged.withColumn("inside", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(so_far, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
        .drop("_s", "_r")
        .withColumn("first", F.col("offset") + F.col("inside") - F.col("size"))
    )
    # One entry per pass; one that lasts beyond time 1 in packets, as far as the
    # budget can reach.
    whole = F.col("at") + F.col("size") <= F.col("target")
    reach = F.least(F.col("size").cast("double"), F.col("target") * F.col("late") + PACKET - F.col("at"))
    packets = F.sequence(F.lit(0).cast("long"), F.floor((F.greatest(reach, F.lit(1.0)) - 1) / PACKET).cast("long"))
    entries = (
        queue.where("size > 0")
        .withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("at", F.col("lap") * F.col("source_size") + F.col("first"))
        .where(F.col("at") <= F.col("target") * F.col("late"))
        .withColumn("packet", F.explode(F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(packets)))
        .withColumn("n", F.when(whole, F.col("size")).otherwise(F.least(F.col("size") - F.col("packet") * PACKET, F.lit(PACKET))))
        .withColumn("at", F.col("at") + F.when(whole, 0).otherwise(F.col("packet") * PACKET))
        .withColumn("finish", (F.col("at") + F.col("n")) / F.col("target"))
        # Global range sort by finish time. Fair queueing spreads the budget
        # evenly over virtual time, so equal ranges of it are equal loads.
        .withColumn("spot", F.floor(F.least("finish", F.lit(2.0)) * RANGES).cast("int"))
        .select("row", "source", "turn", "doc_id", "at", "n", "finish", "spot", "budget")
    )
    entries = written(entries, "mix-queue")
    ahead = (
        entries.groupBy(F.col("spot").alias("_spot")).agg(F.sum("n").alias("in_spot"))
        .withColumn("served", F.sum("in_spot").over(Window.orderBy("_spot")) - F.col("in_spot"))
        .drop("in_spot")
    )
    line = Window.partitionBy("spot").orderBy("finish", F.col("source").asc_nulls_last(), "at", "turn", "doc_id", "row")
    left = F.col("budget") - F.col("served") - F.col("upto") + F.col("n")
    taken = (
        entries.withColumn("upto", F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .join(ahead, F.col("spot") == F.col("_spot"))
        .withColumn("take", F.least(F.greatest(left, F.lit(0)), F.col("n")))
        .groupBy(F.col("row").alias("_row")).agg(F.sum("take").alias("taken"))
    )
    return (
        queue.select("row", "doc_id", "size", "source_size", "target")
        .join(taken, F.col("row") == F.col("_row"), "left")
        .select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def repeat_rows(
    docs: DataFrame, text: str = "text", chars: str = "n_chars", key: str = "doc_id", source: str = "source", **mix_options
) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it whole, then
    once more cut to the words left over; rows taken 0 times go (null, empty
    and blank texts among them). Same columns, whatever their names; ``chars``,
    if there, counts a cut text's code points. Repeated rows are rows of their
    own; an empty table stays empty."""
    names = docs.columns
    base = written(packed(docs, at=F.monotonically_increasing_id()), "mix-docs")
    field = F.col("row").getField
    plain = base.select(field(key).alias("doc_id"), field(source).alias("source"), field(text).alias("text"), "at")
    per = mix(plain, row="at", **mix_options).where("taken > 0")
    per = per.select(F.col("row").alias("of"), "size", "taken")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    df = (
        base.join(per, F.col("at") == F.col("of"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("n", F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")))
    )
    pieces = F.regexp_extract_all(field(text), F.lit(rf"[{SPACE}]*+[^{SPACE}]++"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("n").cast("int")), "")
    short = F.col("n") < F.col("size")
    df = df.withColumn("body", F.when(short, cut).otherwise(field(text)))
    changed = {text: F.col("body")}
    if chars in names:
        changed[chars] = F.when(short, F.length("body").cast(docs.schema[chars].dataType)).otherwise(field(chars))
    return unpacked(df, names, **changed)


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs).drop("row")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', 'mix', doc_id::VARCHAR, md5(text))), 1, 15))::BIGINT AS turn
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w,
         source_size * 3 AS cap FROM src),
filled AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total, sum(w) OVER ()::BIGINT AS all_w,
         coalesce(sum(cap) OVER before, 0)::BIGINT AS full_, coalesce(sum(w) OVER before, 0)::BIGINT AS full_w
  FROM weighted
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
  SELECT *, max((total - full_) / (all_w - full_w)) OVER () AS stop
  FROM filled),
shares AS (
  SELECT source, source_size, cap, total, stop * w < cap AS open,
         coalesce(CASE WHEN stop * w >= cap THEN cap::DOUBLE ELSE stop * w END, 0) AS target FROM levelled),
whole AS (
  SELECT *, 1.0::DOUBLE + coalesce(2.0::DOUBLE * 8 * count(*) OVER () / nullif(sum(CASE WHEN open THEN target ELSE 0.0::DOUBLE END) OVER (), 0), 0) AS late FROM shares),
queue AS (
  SELECT s.*, w.source_size, w.target, w.late, w.total,
         (sum(size) OVER (PARTITION BY s.source ORDER BY turn, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT - size AS first
  FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source),
laps AS (SELECT q.*, lap * source_size + first AS start FROM queue q, range(3) t(lap) WHERE size > 0),
entries AS (
  SELECT * EXCLUDE (p), start + p * 8 AS spot, CASE WHEN start + size <= target THEN size ELSE least(size - p * 8, 8) END AS n
  FROM laps, range(CASE WHEN start + size <= target THEN 1 ELSE (size + 7) // 8 END) t(p)
  WHERE start + p * 8 <= target * late + 8),
served AS (
  SELECT *, (sum(n) OVER (ORDER BY (spot + n) / target, source NULLS LAST, spot, turn, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM entries),
taken AS (SELECT doc_id, source, turn, sum(least(greatest(total - upto + n, 0), n))::BIGINT AS taken FROM served GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM queue q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id AND q.turn = t.turn AND q.source IS NOT DISTINCT FROM t.source
"""
