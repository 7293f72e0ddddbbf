import numpy as np
from pyspark.sql import functions as F

from morrowcart.llm import quality as Q
from morrowcart.llm.queries import op4_quality
from llm_fixtures import docs_of  # noqa: F401


def _auc(s, y):
    a, b = s[y == 1], s[y == 0]
    return ((a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean())


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_quality(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert len(got) > 500 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    assert _auc(got["score"].to_numpy(), got["quality"].to_numpy()) > 0.98
    assert (got["predicted"] == got["quality"]).mean() > 0.97


def test_statistics_by_hand(docs_of):
    text = "Ab ab ab!\nAb ab ab!\n\nX1 |"
    row = dict(zip(Q.STATS, Q.statistics(docs_of([(1, text)])).first().x))
    n = len(text)
    assert np.isclose(row["log_bytes"], np.log1p(n)) and np.isclose(row["log_words"], np.log1p(8))
    assert np.isclose(row["digits"], 1 / n) and np.isclose(row["upper"], 3 / n) and np.isclose(row["symbols"], 3 / n)
    assert np.isclose(row["repeated_word"], 1 - 4 / 8)          # ab, ab!, x1, |
    assert np.isclose(row["repeated_neighbour"], 2 / 8)         # a-z folded: ab ab, ab ab
    assert np.isclose(row["repeated_line"], 1 - 3 / 4)
    assert np.isclose(row["symbol_ends"], 3 / 8) and np.isclose(row["bars"], 1 / 8)


def test_edges(spark, docs_of):
    good, junk = [f"the {w} went over the hill and saw {w * 2}" for w in "abcdefghij"], [f"%%% {w} !!! ???" * 4 for w in "abcdefghij"]
    docs = docs_of([(1, None), (2, ""), (3, "fine text here " * 5), (3, "fine text here " * 5), (None, "x"), (5, "y " * 400_000)]
                   + [(100 + i, t) for i, t in enumerate(good + junk)])
    labels = spark.createDataFrame([(100 + i, int(i < 10), 0) for i in range(20)] * 3 + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = Q.classify(docs, labels, F.lit(True)).collect()
    assert len(rows) == 26 and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id == 3]
    score = {r.doc_id: r.score for r in rows}
    assert same[0] == same[1] and min(score[100 + i] for i in range(10)) > max(score[110 + i] for i in range(10))
    assert {r.score for r in Q.classify(docs, labels.where("false"), F.lit(True)).collect()} == {0.5}
    assert Q.classify(docs.where("false"), labels, F.lit(True)).count() == 0
    assert {r.score for r in Q.classify(docs, labels.where("quality = 1"), F.lit(True)).collect()} == {1.0}


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    s = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-s))).astype(float)
    k, v = Q.isotonic(s, y)
    assert (np.diff(k) > 0).all() and (np.diff(v) > -0.05).all() and v.min() > 0 and v.max() < 1


def test_raw_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    k = len(Q.STATS)
    m = Q.Model(rng.normal(size=k), rng.uniform(0.5, 2, k), rng.normal(0, 1 / np.sqrt(k), (k, 256)), rng.uniform(0, 6.3, 256), rng.normal(size=257), np.empty(0), np.empty(0))
    x = rng.normal(size=(97, k))
    whole = m.raw(x)
    for size in (1, 2, 3, 7, 8, 31, 64):
        assert (np.concatenate([m.raw(x[i:i + size]) for i in range(0, len(x), size)]) == whole).all()
    assert len(set(m.raw(np.repeat(x[:1], 50, axis=0)))) == 1


def test_knots_of_nearly_equal_scores_are_one():
    s = np.array([0.1, 0.5, 0.5 + 4e-16, 0.5 + 1e-9, 0.9])
    k, _ = Q.isotonic(s, np.array([0.0, 0.3, 0.4, 0.6, 1.0]))
    assert (np.diff(k) >= Q.KNOT_GAP).all() and len(k) == 3


def test_statistics_do_not_depend_on_the_documents_around():
    texts = ["fine text here " * 5, "a\n\nb\n", "\n", "Ab ab\nAb ab\nx |"]
    encode = lambda ts: (np.frombuffer("".join(ts).encode(), np.uint8), np.cumsum([0] + [len(t.encode()) for t in ts]))
    alone = [Q._statistics(*encode([t]))[0] for t in texts]
    rng = np.random.default_rng(5)
    for _ in range(20):
        pick = [int(i) for i in rng.integers(-2, len(texts), 9)]  # negative: an empty document
        rows = Q._statistics(*encode(["" if i < 0 else texts[i] for i in pick]))
        for i, row in zip(pick, rows):
            assert (row == (alone[i] if i >= 0 else 0)).all()
