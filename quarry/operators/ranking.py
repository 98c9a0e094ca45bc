"""Iterative page ranking over link lines.

Input lines read ``page target target ...`` (blank separated). Semantics
kept exactly:

* targets of one line are a set (duplicates on the line count once);
* the start rank is ``1 / n`` over the distinct pages that own a line;
* each round a page sends ``rank / |targets of the line|`` to every target
  of each of its lines (a page on two lines contributes from both);
* the new rank of a page is the sum of what it receives, so a page nobody
  links to drops out, and a page without a line of its own stops sending;
* no damping unless ``damping`` is given, no dangling-mass redistribution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import head, tail_distinct
from quarry.functions.strings import split_words
from quarry.operators.rounds import Rounds
from quarry.operators.skew import hot_slices


def parse_link_lines(
    lines: DataFrame, text_col: str = "value", line_id_col: str | None = None
) -> DataFrame:
    """``(line_id, page, targets)`` from text lines; blank lines are skipped.

    The targets array is bounded by the length of its own input line.
    Without ``line_id_col`` a unique id is generated per line.
    """
    words = split_words(F.col(text_col))
    lid = F.col(line_id_col) if line_id_col else F.monotonically_increasing_id()
    parsed = lines.select(lid.alias("line_id"), words.alias("_w"))
    return parsed.filter(F.size("_w") > 0).select(
        "line_id", head(F.col("_w")).alias("page"), tail_distinct(F.col("_w")).alias("targets")
    )


def link_edges(links: DataFrame) -> DataFrame:
    """Long form of parsed lines: ``(line_id, page, target, n_targets)``."""
    return links.select(
        "line_id",
        "page",
        F.explode("targets").alias("target"),
        F.size("targets").alias("n_targets"),
    )


def edges_as_links(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """A graph's distinct edges as link edges ``(page, target)``, one line per
    source page. They carry no count: a page's out-degree belongs to the page
    table and is divided there (see :func:`out_degrees`)."""
    return edges.select(F.col(src).alias("page"), F.col(dst).alias("target")).distinct()


def out_degrees(link_edges_df: DataFrame) -> DataFrame:
    """``(page, degree)``: the number of edges of each page."""
    return link_edges_df.groupBy("page").agg(F.count(F.lit(1)).alias("degree"))


def initial_ranks(link_edges_df: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """``1 / n`` for each distinct page owning a line (``pages`` may supply
    the owners when some lines have no targets)."""
    owners = (pages if pages is not None else link_edges_df.select("page")).distinct()
    n = owners.select(F.count(F.lit(1))).scalar()
    return owners.select("page", (F.lit(1.0) / n).alias("rank"))


def shares(ranks: DataFrame, degrees: DataFrame | None) -> DataFrame:
    """``(page, share)``: what a page sends along an edge; the whole rank
    where the edges carry their lines' target counts (``degrees`` None)."""
    if degrees is None:
        return ranks.select("page", F.col("rank").alias("share"))
    return ranks.join(degrees, "page").select("page", (F.col("rank") / F.col("degree")).alias("share"))


def _message(link_edges_df: DataFrame):
    if "n_targets" in link_edges_df.columns:
        return F.col("share") / F.col("n_targets")
    return F.col("share")


def contributions(link_edges_df: DataFrame, ranks: DataFrame, degrees: DataFrame | None = None) -> DataFrame:
    """One round's messages per edge: ``(page, target, contrib)``; edges of
    pages without a rank send nothing (inner join). The count divided by is
    the edge's ``n_targets``, or else the page's degree."""
    if degrees is None and "n_targets" not in link_edges_df.columns:
        degrees = out_degrees(link_edges_df)
    return link_edges_df.join(shares(ranks, degrees), "page").select(
        "page", "target", _message(link_edges_df).alias("contrib")
    )


def pagerank(
    link_edges_df: DataFrame,
    iterations: int = 10,
    damping: float | None = None,
    pages: DataFrame | None = None,
    checkpoint_every: int = 3,
    partitions: int | None = None,
    state: str | None = None,
) -> DataFrame:
    """Ranks after ``iterations`` rounds as ``(page, rank)``, highest first.

    The edges are partitioned and cached once, on the page and, for pages
    that own more edges than an even partition, on a salt
    (``operators.skew``): a hot page's edges lie in several partitions in
    every round. A round moves the pages' shares (one row per page, a hot one
    once per slice) and sums the contributions per target with map-side
    partial sums. Out-degrees are divided in the page table, so no round and
    no preparation joins edges with counts.

    Every ``checkpoint_every`` rounds, and after the last, the ranks are
    written as a table under the shared checkpoint directory. With ``state``,
    a folder, these tables, the edges and the degrees stay there: a call on
    the same folder and input goes on after the last round that was kept
    (also towards more rounds than the call before it asked for).
    """
    spark = link_edges_df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = "n_targets" in link_edges_df.columns
    given = [link_edges_df, *([pages] if pages is not None else [])]
    rounds = Rounds(spark, state, "pagerank", given, damping=damping, partitions=n_parts)
    base = rounds.keep(
        "link-edges", lambda: link_edges_df.select("page", "target", *(["n_targets"] if counted else []))
    )
    hot = hot_slices(base, "page", n_parts, lambda df, name: rounds.keep(name, lambda: df))
    edges = partitioned_edges(base, hot, n_parts).persist()
    degrees = None if counted else rounds.keep("out-degrees", lambda: out_degrees(base))
    try:
        start = rounds.keep("ranks-0", lambda: initial_ranks(base, pages))
        n_pages = start.select(F.count(F.lit(1))).scalar() if damping is not None else None
        done = min(rounds.last("ranks") or 0, iterations)
        while not rounds.whole(f"ranks-{done}"):  # more rounds are there than are asked for
            done -= 1
        ranks = rounds.keep(f"ranks-{done}", lambda: start)
        for i in range(done, iterations):
            sent = hot.repeat(shares(ranks, degrees)).repartition(n_parts, "page", "salt")
            summed = (
                edges.join(sent, ["page", "salt"])
                .groupBy(F.col("target").alias("page"))
                .agg(F.sum(_message(edges)).alias("rank"))
            )
            if damping is not None:
                summed = summed.select(
                    "page",
                    ((F.lit(1.0 - damping) / n_pages) + F.lit(damping) * F.col("rank")).alias("rank"),
                )
            ranks = summed
            if (i + 1) % checkpoint_every == 0 or i + 1 == iterations:
                ranks = rounds.keep(f"ranks-{i + 1}", lambda made=ranks: made)
    finally:
        edges.unpersist()
    return ranks.orderBy(F.col("rank").desc(), F.col("page").asc())


def partitioned_edges(base: DataFrame, hot, n_parts: int) -> DataFrame:
    """Edges in ``n_parts`` partitions by (page, salt), sorted within."""
    return hot.spread(base, "target").repartition(n_parts, "page", "salt").sortWithinPartitions("page", "salt")
