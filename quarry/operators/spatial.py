"""All pairs of points within a distance, by grid cells.

``grid_cells`` / ``grid_push`` expose the coarse grid step by step: a point
goes to cell ``(floor(x/c), floor(y/c))`` and is copied to its own cell and
the four forward cells ``(0,+1) (+1,+1) (+1,0) (+1,-1)``.

Coordinates must be finite: a NaN or infinite one raises an error that names
the column (null coordinates are left out by ``close_pairs``).

``close_pairs`` returns every unordered pair of input rows lying within
``threshold`` (inclusive) as ``(id_a, id_b)`` with ``id_a <= id_b`` in the
ids' own order, once. Two rows with the same id within the threshold give
``(p, p)``. It runs as one equi join on a *fine* grid of side
``threshold / 2`` (a hair larger: the rounding of a cell index stays below
that margin for coordinates up to about 1e9 thresholds). Every candidate is
checked by distance:

* two points in the same fine cell are within the threshold (the cell
  diagonal is ~0.71 x threshold), so same-cell candidates are results;
* a pair within the threshold lies in cells at most two apart per axis, so
  each point is also copied to the 12 cells of a half-neighbourhood
  (every unordered cell pair once).

Cross-cell candidates between cells A and B number ``|A||B| <=
(|A|^2 + |B|^2)/2``, i.e. they are bounded by the same-cell results, so the
work is linear in input plus output even when one cell holds a large share
of the points. Identical rows are collapsed first (map-side). A cell with more
candidates than an even partition is split over several by a salt, and the plan
contains no cartesian or nested-loop join.

The pairs may be many times the points, so none is shuffled, sorted or hashed
without need: two ids of one point each meet in one candidate only, and their
pairs go out as the join finds them. Only those of an id with several points
(or of a null id) can come twice and pass a ``distinct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.geometry import cell_index, euclidean
from quarry.session import cut_lineage

# Forward cells of the coarse scheme, fixed by the operator's definition:
# up, up-right, right, down-right.
FORWARD_OFFSETS = [(0, 1), (1, 1), (1, 0), (1, -1)]


def finite(column: str):
    """The column as a double; NaN and infinity raise."""
    c = F.col(column).cast("double")
    bad = F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, F.raise_error(F.lit(f"column {column}: coordinates must be finite")).cast("double")).otherwise(c)


def grid_cells(
    points: DataFrame,
    cell_size: float,
    id_col: str = "id",
    x_col: str = "x",
    y_col: str = "y",
) -> DataFrame:
    """``(cx, cy, id, x, y)``: each point with its grid cell."""
    if cell_size <= 0:
        raise ValueError("cell_size must be positive")
    return points.select(
        cell_index(finite(x_col), cell_size).alias("cx"),
        cell_index(finite(y_col), cell_size).alias("cy"),
        F.col(id_col).alias("id"),
        F.col(x_col).alias("x"),
        F.col(y_col).alias("y"),
    )


def _offsets_column(offsets: list[tuple[int, int]]):
    return F.array(
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets]
    )


def grid_push(cells: DataFrame) -> DataFrame:
    """Each ``(cx, cy, ...)`` row copied to its home cell and the four
    forward cells; adds ``home`` (true for the original cell)."""
    offs = _offsets_column([(0, 0)] + FORWARD_OFFSETS)
    exploded = cells.select("*", F.explode(offs).alias("_o"))
    rest = [c for c in cells.columns if c not in ("cx", "cy")]
    return exploded.select(
        (F.col("cx") + F.col("_o.dx")).alias("cx"),
        (F.col("cy") + F.col("_o.dy")).alias("cy"),
        *rest,
        ((F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)).alias("home"),
    )


# Half of the 5x5 neighbourhood around a cell (excluding the cell itself):
# every unordered pair of distinct cells within two steps is covered once.
def _half_neighbourhood() -> list[tuple[int, int]]:
    out = []
    for dx in range(-2, 3):
        for dy in range(-2, 3):
            if dx > 0 or (dx == 0 and dy > 0):
                out.append((dx, dy))
    return out


def close_pairs(
    points: DataFrame,
    threshold: float,
    id_col: str = "id",
    x_col: str = "x",
    y_col: str = "y",
) -> DataFrame:
    """Distinct ``(id_a, id_b)`` of row pairs within ``threshold``."""
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    side = threshold / 2.0 * (1.0 + 1e-6)
    pts = points.select(
        F.col(id_col).alias("id"), finite(x_col).alias("x"), finite(y_col).alias("y")
    ).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    # Identical rows collapse to one point with a multiplicity; a point
    # present more than once pairs with itself.
    uniq = pts.groupBy("id", "x", "y").agg(F.count(F.lit(1)).alias("mult"))
    several = uniq.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("id", F.lit(True).alias("_m"))
    uniq = cut_lineage(
        uniq.join(several, "id", "left").select(
            "id",
            "x",
            "y",
            "mult",
            F.coalesce("_m", F.col("id").isNull()).alias("several"),
            cell_index(F.col("x"), side).alias("cx"),
            cell_index(F.col("y"), side).alias("cy"),
        ),
        "close-points",
    )
    self_pairs = uniq.filter(F.col("mult") > 1).select(
        F.col("id").alias("id_a"), F.col("id").alias("id_b")
    )
    offs = _offsets_column([(0, 0)] + _half_neighbourhood())
    moved = uniq.select(
        F.col("id").alias("id2"),
        F.col("x").alias("x2"),
        F.col("y").alias("y2"),
        F.col("several").alias("several2"),
        F.explode(offs).alias("_o"),
        "cx",
        "cy",
    ).select(
        "id2",
        "x2",
        "y2",
        "several2",
        ((F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)).alias("same"),
        (F.col("cx") + F.col("_o.dx")).alias("cx"),
        (F.col("cy") + F.col("_o.dy")).alias("cy"),
    )
    home = uniq.select("id", "x", "y", "several", "cx", "cy")
    n_parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    home, moved = _salted(home, moved, offs, n_parts)
    same_cell_order = F.struct("id", "x", "y") < F.struct(
        F.col("id2"), F.col("x2"), F.col("y2")
    )
    within = euclidean(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")) <= F.lit(
        float(threshold)
    )

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        # Spread by number, so that few bytes of points with many pairs are
        # not coalesced into one task.
        keys = ["cx", "cy", "salt"]
        pairs = left.repartition(n_parts, *keys).join(right.repartition(n_parts, *keys), keys).filter(
            within & F.when(F.col("same"), same_cell_order).otherwise(F.lit(True))
        )
        return pairs.select(
            F.least("id", "id2").alias("id_a"), F.greatest("id", "id2").alias("id_b")
        )

    once = near(home.filter(~F.col("several")), moved.filter(~F.col("several2")))
    again = near(home.filter("several"), moved).unionByName(
        near(home.filter(~F.col("several")), moved.filter("several2"))
    )
    return once.unionByName(again.unionByName(self_pairs).distinct())


def _salted(home: DataFrame, moved: DataFrame, offs, partitions: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``salt``: a cell with more candidates than an even
    partition has its moved rows in as many slices as it fills and its home
    rows once per slice. There are at most ``partitions`` such cells."""
    cells = home.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_h"))
    reached = cells.select("_h", F.explode(offs).alias("_o"), "cx", "cy").groupBy(
        (F.col("cx") + F.col("_o.dx")).alias("cx"), (F.col("cy") + F.col("_o.dy")).alias("cy")
    ).agg(F.sum("_h").alias("_m"))
    work = cut_lineage(
        cells.join(reached, ["cx", "cy"]).select("cx", "cy", (F.col("_h").cast("double") * F.col("_m")).alias("_w")),
        "close-cells",
    )
    even = F.greatest(work.select(F.sum("_w")).scalar() / F.lit(partitions), F.lit(1.0))
    hot = F.broadcast(
        work.filter(F.col("_w") > even).select(
            "cx", "cy", F.least(F.ceil(F.col("_w") / even), F.lit(partitions)).cast("int").alias("_slices")
        )
    )
    slices = F.coalesce("_slices", F.lit(1))
    salt = F.pmod(F.xxhash64("id2", "x2", "y2"), slices).cast("int")
    return (
        home.join(hot, ["cx", "cy"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), slices - 1))).drop("_slices"),
        moved.join(hot, ["cx", "cy"], "left").withColumn("salt", salt).drop("_slices"),
    )


def close_pair_count(pairs: DataFrame, alias: str = "n_pairs") -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias(alias))
