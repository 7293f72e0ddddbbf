import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from morrowcart.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def _plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, in Python integers: {(id, components): (code, error)}, books, label errors."""
    kept = [(i, [float(x) for x in e], lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dim = -(-max((len(e) for _, e, _ in kept), default=0) // parts) * parts
    n = dim // parts
    ints = [[math.floor(Fraction(x) * scale) for x in e] + [0] * (dim - len(e)) for _, e, _ in kept]
    cut = lambda v, p: v[p * n:(p + 1) * n]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, ints[r][:len(kept[r][1])]))[:entries]
    books = [[cut(ints[r], p) for r in order] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in ints:
                groups.setdefault(near(cut(v, p), books[p])[0], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    got = [[near(cut(v, p), books[p]) for p in range(parts)] for v in ints]
    out = [(k[0], "".join(f"{i:02x}" for i, _ in g), min(V.LONG_MAX, sum(d for _, d in g)), k[2]) for k, g in zip(kept, got)]
    by = {}
    for _, _, e, lab in out:
        by[lab] = min(V.LONG_MAX, by.get(lab, 0) + e)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by[lab], sha) for i, c, e, lab in out), key=str)


def _got(df, **how):
    return sorted((tuple(r) for r in V.compress(df, **how).collect()), key=str)


def test_matches_all_entries_compared(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 0.2, (30, 64))
    rows = [(int(i), [float(x) for x in np.float32(centres[i % 30] + rng.normal(0, 0.03, 64))], int(i % 4) if i % 9 else None) for i in rng.permutation(300)]
    rows += [(900, rows[3][1], 1), (901, rows[3][1], None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = _plain(rows)
    assert _got(df) == want
    assert _got(df.repartition(5), bits=6) == want and _got(df, bits=11) == want  # the cell's size changes no result


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 1), (2, [None, 1.0], 1), (3, [inf] * 8, 1), (4, [nan] * 8, 2), (5, [], None), (None, [0.5] * 3, None), (6, [0.5] * 3, 1), (6, [0.25] * 3, 1),
            (6, [0.25] * 3, 1), (7, [-0.1] * 20, 2), (8, [1e-4] * 20, 2), (9, [3e38, -3e38] * 10, 2), (10, [-1e-9] * 4, 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).withColumns({"code": F.lit("old"), "error": F.lit(1), "_label": F.lit(2), "label_error": F.lit(0)})
    floats = [(i, e if e is None else [None if x is None else float(np.float32(x)) for x in e], lab) for i, e, lab in rows]
    assert _got(df) == _plain(floats)
    none = V.compress(df.where("false"))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert V.compress(df.where("vec_id < 5")).count() == 0
    only_empty = df.where("vec_id = 5")
    assert [r.code for r in V.compress(only_empty).collect()] == ["00" * 8]
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>")).where("vec_id > 5")
    big = [(20, [1e300, -1e300, 2.0], 1), (21, [1e-300], 1)]
    df2 = doubles.select("vec_id", "embedding", "label").union(spark.createDataFrame(big, "vec_id long, embedding array<double>, label int"))
    assert _got(df2) == _plain([r for r in floats if r[0] and r[0] > 5] + big)


def test_cells_keep_every_nearest_entry_and_drop_others():
    rng = np.random.default_rng(4)
    book = rng.integers(-2000, 2000, (16, 4))
    x = rng.integers(-2500, 2500, (5000, 4))
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    for bits in (4, 7, 9, 12):
        g = V.Grid(book, bits, memo=300)  # forgets often
        for part in np.array_split(x, 7):
            e, b = g.nearest(part)
            dd = ((part[:, None] - book[None]) ** 2).sum(axis=2)
            assert (e == dd.argmin(axis=1)).all() and (b == dd.min(axis=1)).all()
    g = V.Grid(book, 7)
    g.nearest(x)
    assert g.compared < 0.5 * d.size  # dominated entries are not compared
    done = g.computed
    g.nearest(x)
    assert g.computed == done and g.looked_up == 2 * len(x)  # every cell is remembered


def test_two_cells_of_one_hash_stay_apart(monkeypatch):
    rng = np.random.default_rng(6)
    book, x = rng.integers(-900, 900, (16, 3)), rng.integers(-999, 999, (400, 3))
    monkeypatch.setattr(V.Grid, "_hash", lambda self, cells: np.full(len(cells), 7, np.uint64))
    g = V.Grid(book, 6)
    for part in (x[:100], x[100:]):
        assert (g.nearest(part)[0] == ((part[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


@pytest.mark.parametrize("hot", [0.34, 0.9])
def test_hot_label_and_copies(spark, hot):
    rng = np.random.default_rng(8)
    base = [[float(x) for x in np.float32(v)] for v in rng.normal(0, 0.1, (20, 16))]
    rows = [(i, base[0] if rng.random() < hot else base[int(rng.integers(20))], 5 if rng.random() < hot else int(rng.integers(40))) for i in range(400)]
    assert _got(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)) == _plain(rows)
