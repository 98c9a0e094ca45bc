import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import spatial as S
from quarry.plans.explain import has_cross_product


def brute(rows, t):
    out = set()
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = rows[i], rows[j]
            if math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) <= t:
                out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


def _pairs(spark, rows, t):
    df = spark.createDataFrame(rows, "id string, x double, y double")
    return {(r.id_a, r.id_b) for r in S.close_pairs(df, t).collect()}


def test_close_pairs_equal_brute_force_with_duplicates(spark):
    rnd = random.Random(7)
    rows = [(f"p{i}", rnd.uniform(0, 3), rnd.uniform(0, 3)) for i in range(300)]
    rows.append(rows[5])  # repeated row
    rows.append(("p9", rows[9][1] + 0.01, rows[9][2]))  # repeated id nearby
    rows.append(("dup", 1.0, 1.0))
    rows.append(("dup", 1.0, 1.0))
    got = _pairs(spark, rows, 0.25)
    assert got == brute(rows, 0.25)
    assert ("dup", "dup") in got and ("p5", "p5") in got and ("p9", "p9") in got


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "c", "d", "e", "f"]),
            st.floats(-2, 2, allow_nan=False).map(lambda v: round(v, 2)),
            st.floats(-2, 2, allow_nan=False).map(lambda v: round(v, 2)),
        ),
        max_size=40,
    ),
    st.sampled_from([0.1, 0.5, 0.75, 1.0]),
)
def test_close_pairs_property(spark, rows, t):
    assert _pairs(spark, rows, t) == brute(rows, t)


def test_boundary_distance_inclusive(spark):
    rows = [("a", 0.0, 0.0), ("b", 0.75, 0.0), ("c", 0.0, 0.7500001)]
    assert _pairs(spark, rows, 0.75) == {("a", "b")}


def test_no_cartesian_in_plan(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0)], "id string, x double, y double")
    assert not has_cross_product(S.close_pairs(df, 0.5))


def test_grid_cells_and_push(spark):
    df = spark.createDataFrame([("a", 1.0, 0.7), ("b", -0.1, 1.5)], "id string, x double, y double")
    cells = {r.id: (r.cx, r.cy) for r in S.grid_cells(df, 0.75).collect()}
    assert cells == {"a": (1, 0), "b": (-1, 2)}
    pushed = sorted((r.cx, r.cy, r.home) for r in S.grid_push(S.grid_cells(df, 0.75)).collect() if r.id == "a")
    assert pushed == sorted([(1, 0, True), (1, 1, False), (2, 1, False), (2, 0, False), (2, -1, False)])


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf")])
def test_non_finite_coordinates_raise(spark, bad):
    df = spark.createDataFrame([("a", bad, 0.0), ("b", 0.0, 0.0)], "id string, x double, y double")
    with pytest.raises(Exception, match="must be finite"):
        S.close_pairs(df, 0.5).collect()
    with pytest.raises(Exception, match="must be finite"):
        S.grid_cells(df, 0.5).collect()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=2, max_size=25), st.sampled_from([0.0, 1e5, 1e8]))
def test_pairs_far_from_the_origin(spark, steps, origin):
    t = 0.5
    rows = [(f"p{i}", origin + a * t / 2, origin + b * t / 2) for i, (a, b) in enumerate(steps)]
    got = {(r.id_a, r.id_b) for r in S.close_pairs(spark.createDataFrame(rows, "id string, x double, y double"), t).collect()}
    want = {
        (min(p, q), max(p, q)) for i, (p, x, y) in enumerate(rows) for q, u, v in rows[:i]
        if ((x - u) ** 2 + (y - v) ** 2) ** 0.5 <= t
    }
    assert got == want


def test_pairs_of_single_points_pass_no_distinct(spark):
    """The pairs are many times the points: they are neither hashed nor shuffled."""
    rows = [(f"p{i}", 0.001 * i, 0.0) for i in range(40)]
    pairs = S.close_pairs(spark.createDataFrame(rows, "id string, x double, y double"), 0.5)
    assert pairs.count() == 40 * 39 // 2
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    top = [line.strip(" :+-") for line in plan.splitlines()]
    assert top[0].startswith("Union")  # no aggregate over all pairs


def test_a_hot_cell_is_shared_by_the_tasks(spark):
    """Points of one cell, few bytes with many pairs, are joined by many tasks."""
    rows = [(f"p{i:03}", 1.0 + i * 1e-6, 1.0) for i in range(400)] + [("far", 9.0, 9.0)]
    pairs = S.close_pairs(spark.createDataFrame(rows, "id string, x double, y double"), 0.5)
    by_task = [len(part) for part in pairs.rdd.glom().collect()]
    assert sum(by_task) == 400 * 399 // 2 == len({tuple(r) for r in pairs.collect()})
    assert sum(n > 0 for n in by_task) >= 4 and max(by_task) < 0.6 * sum(by_task)


def test_null_and_repeated_ids_keep_each_pair_once(spark):
    rows = [("a", 0.0, 0.0), ("a", 0.1, 0.0), ("a", 0.1, 0.0), ("b", 0.0, 0.1), ("c", 0.1, 0.1), ("c", 0.1, 0.1),
            (None, 0.0, 0.2), (None, 0.1, 0.2), ("d", 5.0, 5.0)]
    got = sorted((r.id_a, r.id_b) for r in S.close_pairs(spark.createDataFrame(rows, "id string, x double, y double"), 1.0)
                 .where("id_a IS NOT NULL").collect())
    assert got == [("a", "a"), ("a", "b"), ("a", "c"), ("b", "b"), ("b", "c"), ("c", "c")]
