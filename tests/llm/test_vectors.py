import numpy as np
import pytest

from quarry.llm import permutation, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "a", "b", "c") for i, v in rows], SCHEMA)


def brute(rows, scale, k=20):
    ok = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = np.asarray(v, np.float32).astype(np.float64)
        ok[i] = v if i not in ok else min(ok[i], v, key=list)
    out = []
    for q in (i for i in ok if i % 20 == 0):
        a = np.floor(ok[q] * scale) if scale else ok[q]
        s = [(-float(a @ (np.floor(v * scale) if scale else v)), i) for i, v in ok.items() if i != q and len(v) == len(a)]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(sorted(s)[:k])]
    return sorted(out)


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], float(r["score"])) for r in df.collect())


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8)) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(20, rows[20][1]), (41, rng.normal(size=8)), (41, rng.normal(size=8))]  # repeated ids
    rows += [(None, np.ones(8)), (2000, None), (2020, []), (2040, [None] * 8), (2060, [float("nan")] * 8), (2080, [float("inf")] + [0] * 7)]
    return rows + [(3000, [1, 2]), (3001, [2, 1])]  # another dimension


def test_topk_equals_brute_force(spark, awkward):
    assert rows_of(topk.digest(table(spark, awkward))) == brute(awkward, 64)


@pytest.mark.parametrize("nodes", [1, 3, 8])
def test_topk_over_blocks_and_nodes(spark, awkward, nodes, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS", 40)
    monkeypatch.setattr(vectors, "QUERIES", 4)
    assert rows_of(topk.search(table(spark, awkward), nodes=nodes)) == brute(awkward, 64)


def test_topk_of_large_and_few_components(spark):
    rows = [(i, [(-1) ** i * 1e5 * i, 3.0, -2.5e4]) for i in range(25)]
    assert rows_of(topk.digest(table(spark, rows))) == brute(rows, 64)
    few = [(0, [1.0]), (1, [2.0]), (20, [-1.0])]
    assert rows_of(topk.digest(table(spark, few))) == brute(few, 64)
    assert topk.digest(table(spark, [])).count() == 0


def test_permutation_with_a_full_budget_is_exact(spark, awkward):
    # Zero vectors take no part.
    got = rows_of(permutation.search(table(spark, [*awkward, (4000, [0.0] * 8)]), budget=1.0))
    want = brute(awkward, None)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert permutation.digest(table(spark, [])).count() == 0


def test_footrule_from_shared_pivots():
    rng = np.random.default_rng(1)
    near = np.stack([rng.permutation(12)[:5] for _ in range(50)])
    row, place, bound = permutation._post(near, 12)
    q, n = rng.permutation(12)[:5], 5
    shared = np.zeros(50, int)
    for at, p in enumerate(q):
        part = slice(bound[p], bound[p + 1])
        shared[row[part]] += np.minimum(place[part], n - at)
    for i in range(50):
        there = {p: j for j, p in enumerate(near[i])}
        mine = {p: j for j, p in enumerate(q)}
        distance = sum(abs(there.get(p, n) - mine.get(p, n)) for p in set(there) | set(mine))
        assert distance == n * (n + 1) - 2 * shared[i]


def test_recall_of_the_index(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, None)}
    got = {(r["query_id"], r["vec_id"]) for r in permutation.digest(df).collect()}
    assert len(got & want) / len(want) >= 0.9


def test_a_third_of_equal_vectors(spark, monkeypatch):
    """Copies take one place of the budget: their queries get the smallest ids,
    others their neighbours, and the order of the rows changes nothing."""
    rng = np.random.default_rng(9)
    hot = rng.normal(size=16)
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=16)) for i in range(3000)]
    monkeypatch.setattr(vectors, "ROWS", 700)
    got = rows_of(permutation.digest(table(spark, rows)))
    want = brute(rows, None)
    of_hot = [r[:3] for r in got if r[0] % 3 == 0]
    assert of_hot == [r[:3] for r in want if r[0] % 3 == 0]
    assert len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    turned = [rows[i] for i in rng.permutation(len(rows))]
    assert rows_of(permutation.digest(table(spark, turned).repartition(5))) == got


def test_recall_holds_on_small_tables(spark):
    """No size is searched in another way: blocks of some hundred rows too."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [(i, centres[i % 20] + 0.7 * rng.normal(size=16)) for i in range(500)]
    got = {(r["query_id"], r["vec_id"]) for r in permutation.digest(table(spark, rows)).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows, None)}
    assert len(got & want) >= 0.9 * len(want)
