import numpy as np
import pytest

from morrowcart.llm import embedding_dedup as V


def _brute(ids, x, labels, cosine=V.COSINE):
    n = len(ids)
    ok = [lab is not None and v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v) for v, lab in zip(x, labels)]
    links, comp = [0] * n, list(range(n))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    u = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(x, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and labels[i] == labels[j] and len(u[i]) == len(u[j]) and float(u[i] @ u[j]) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                comp[max(a, b, key=lambda k: ids[k])] = min(a, b, key=lambda k: ids[k])
    return {ids[i]: (links[i], ids[root(i)], ids[root(i)] == ids[i]) for i in range(n)}


def _table(spark, ids, x, labels):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], lab) for i, v, lab in zip(ids, x, labels)],
                                 "vec_id long, embedding array<double>, label int")


def _clustered(rng, n, dim=32, groups=40, noise=0.02):
    centre = rng.normal(size=(groups, dim))
    g = rng.integers(0, groups, n)
    return centre[g] + noise * rng.normal(size=(n, dim)) * np.linalg.norm(centre[g], axis=1, keepdims=True)


def _result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_edges_match_brute_force(spark):
    rng = np.random.default_rng(1)
    x = [list(v) for v in _clustered(rng, 60, 8, 12)]
    x += [x[0], x[0], [2 * c for c in x[1]], [0.0] * 8, None, [], [float("nan")] + [1.0] * 7, [float("inf")] * 8, [None] + [1.0] * 7, x[3][:4], [1e300] * 8, [1e300] * 8]
    labels = [int(i) % 3 for i in range(len(x))]
    labels[5] = labels[6] = None
    ids = [int(i) * 7 + 1 for i in rng.permutation(len(x))]
    assert _result(V.near_duplicates(_table(spark, ids, x, labels))) == _brute(ids, x, labels)


def test_null_ids_repeats_and_empty(spark):
    t = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    rows = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in V.near_duplicates(t).collect()), key=str)
    assert rows == [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, False)]
    assert V.near_duplicates(t.where("false")).count() == 0


@pytest.mark.parametrize("max_cell", [10_000, 300])
def test_forest_recall(spark, max_cell):
    """Small leaves, and cells that have to be split over tasks: recall of rows and links against all pairs."""
    rng = np.random.default_rng(2)
    n = 1500
    x = _clustered(rng, n, 32, 300, 0.018)
    x[1000:1200] = x[1000] + 0.01 * rng.normal(size=(200, 32)) * np.linalg.norm(x[1000])  # one dense group
    ids = list(range(n))
    want = _brute(ids, x, [1] * n)
    got = _result(V.near_duplicates(_table(spark, ids, x, [1] * n), leaf=128, max_cell=max_cell, sample_rows=2000))
    assert len(got) == n
    assert all(got[i][0] <= want[i][0] for i in ids)            # no pair below the threshold, none counted twice
    assert sum(got[i][0] for i in ids) >= 0.95 * sum(want[i][0] for i in ids)
    assert sum(got[i][1] == want[i][1] for i in ids) >= 0.97 * n


@pytest.mark.parametrize("max_cell", [20_000, 1000])
def test_all_links_of_a_dense_group_of_many_leaves(spark, max_cell):
    """Distinct near-copies, many times LEAF, in one cell and as a group over several."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=64)
    x = np.concatenate([centre + 0.01 * rng.normal(size=(3000, 64)) * np.linalg.norm(centre) / 8 * 8 ** 0.5, rng.normal(size=(1500, 64))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= V.COSINE).sum(axis=1) - 1
    assert want[:3000].mean() > 2000 and 3000 > 5 * V.LEAF
    got = _result(V.near_duplicates(_table(spark, list(range(4500)), x, [1] * 4500), max_cell=max_cell, sample_rows=3000))
    assert [got[i][0] for i in range(4500)] == want.tolist()
    assert {got[i][1] for i in range(3000)} == {0}
