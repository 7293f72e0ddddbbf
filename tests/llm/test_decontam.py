import random

import numpy as np
import pytest

from morrowcart.llm import decontam as D
from llm_fixtures import docs_of  # noqa: F401

rng = random.Random(4)
VOCAB = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
COMMON = VOCAB[:40]


def _prose(n):
    return [rng.choice(COMMON) if rng.random() < 0.5 else rng.choice(VOCAB) for _ in range(n)]


ITEMS = [_prose(n) for n in (15, 18, 30, 40, 58, 150) for _ in range(8)]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(i, " ".join(w).capitalize() + ".") for i, w in enumerate(ITEMS)] + [(900, None), (901, "")], "item_id long, text string")


def _edited(w, rate):
    return [rng.choice(VOCAB) if rng.random() < rate else x for x in w[:-5]] + w[-5:]


def test_verbatim_and_paraphrased_items_are_found_and_clean_texts_left(docs_of, bench):
    rows, planted = [], {}
    for i, w in enumerate(ITEMS):
        for rate in (0.0, 0.15):
            k = len(rows)
            body = _edited(w, rate)
            text = " ".join(_prose(rng.randint(0, 200)) + ["\n"] + [x.upper() if j % 3 == 0 else x + "," for j, x in enumerate(body)] + _prose(rng.randint(0, 200)))
            rows.append((k, text))
            planted[k] = (i, rate)
    n = len(rows)
    rows += [(n + k, " ".join(_prose(rng.randint(1, 600)))) for k in range(200)]
    rows += [(n + 500 + k, " ".join(ITEMS[k][:5])) for k in range(10)]      # a few words of an item are no leak
    got = [(r.doc_id, r.item_id) for r in D.find_leaks(docs_of(rows), bench).collect()]
    assert len(got) == len(set(got))
    right = {d for d, i in got if d in planted and planted[d][0] == i}
    assert {d for d, (_, rate) in planted.items() if rate == 0} <= right
    assert len(right) >= 0.9 * len(planted)
    assert all(d in planted for d, _ in got)
    kept = {r.doc_id for r in D.drop_leaks(docs_of(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in got}


def test_lcs_against_dynamic_programme():
    r = random.Random(1)
    for _ in range(200):
        a, b = [[r.randint(0, 9) for _ in range(r.randint(1, 70))] for _ in range(2)]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert D.lcs(b, D.masks_of(a), len(a)) == t[-1][-1]


def test_latent_space_holds_the_leading_directions(spark, docs_of):
    """The sketch against the exact matrix of TF-IDF passages."""
    rows = [(i, " ".join(_prose(D.PASSAGE))) for i in range(120)]
    total, df, y = D.corpus_sketch(docs_of(rows))
    assert total == 120
    from morrowcart.llm.common import word_hashes
    t = np.zeros((120, len(df)))
    for i, text in rows:
        raw = text.encode()
        t[i, D._bucket(word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), D._SEPARATES)[0])] = 1
    assert (df == t.sum(axis=0)).all()
    assert np.allclose(y, t.T @ (t @ D._gaussian().astype(float)), rtol=1e-3, atol=1e-2)


def test_edges(docs_of, bench, spark, monkeypatch):
    leak = " ".join(ITEMS[20])
    rows = [(1, None), (2, ""), (3, leak), (3, leak), (None, leak), (4, " ".join(_prose(120_000)) + " " + leak), (5, "... !!!")]
    got = sorted(((r.doc_id, r.item_id) for r in D.find_leaks(docs_of(rows), bench).collect()), key=str)
    assert got == [(3, 20), (3, 20), (4, 20), (None, 20)]
    assert D.find_leaks(docs_of(rows), bench.where("item_id >= 900")).count() == 0
    assert D.find_leaks(docs_of(rows).where("false"), bench).count() == 0
    assert D.drop_leaks(docs_of(rows), bench.where("false")).count() == len(rows)
    clash = docs_of(rows[:3]).selectExpr("*", "1 AS row", "2 AS b", "3 AS item_id")
    assert sorted((r.doc_id, r.row, r.b, r.item_id) for r in D.drop_leaks(clash, bench).collect()) == [(1, 1, 2, 3), (2, 1, 2, 3)]
    monkeypatch.setattr(D, "SLICE", 10)  # a large benchmark is searched in slices
    assert sorted(((r.doc_id, r.item_id) for r in D.find_leaks(docs_of(rows), bench).collect()), key=str) == got


def test_verbatim_items_of_a_large_benchmark_are_found(spark, docs_of):
    """Thousands of items: each keeps its own direction, so none is lost among the others."""
    r = random.Random(7)
    vocab = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9))) for _ in range(20_000)]
    weights = [1 / (k + 5) for k in range(len(vocab))]
    items = [r.choices(vocab, weights, k=r.randint(15, 59)) for _ in range(2500)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    picked = r.sample(range(len(items)), 120)
    rows = [(k, " ".join(r.choices(vocab, weights, k=r.randint(60, 150)) + items[i] + r.choices(vocab, weights, k=r.randint(60, 150)))) for k, i in enumerate(picked)]
    rows += [(1000 + k, " ".join(r.choices(vocab, weights, k=300))) for k in range(100)]
    got = {(x.doc_id, x.item_id) for x in D.find_leaks(docs_of(rows), bench).collect()}
    assert got == set(enumerate(picked))


def test_a_text_moves_once(docs_of, bench):
    """`drop_leaks` hands the rows over without a second copy of their texts."""
    leak = " ".join(ITEMS[20])
    out = D.drop_leaks(docs_of([(1, None), (2, ""), (3, leak), (4, "an own text")]), bench)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, None, None), (2, "", 0), (4, "an own text", 11)]
    assert "encode(" not in out._jdf.queryExecution().analyzed().toString()
