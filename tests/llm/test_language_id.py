import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from morrowcart.llm import language_id as L
from morrowcart.llm.common import PIECE
from morrowcart.llm.queries import op1_language_id
from llm_fixtures import docs_of  # noqa: F401

EN = ["the cat and the dog ran over the hill", "she said that the water was cold and clear", "there is nothing like the sea"]
FR = ["le chat et le chien sont dans la maison", "elle a dit que l'eau était froide et claire", "il n'y a rien de tel que la mer"]


@pytest.fixture(scope="module")
def train(docs_of):
    return docs_of([(i, t, "en") for i, t in enumerate(EN)] + [(10 + i, t, "fr") for i, t in enumerate(FR)])


def _clean(t):
    out, gap = [], False
    for c in t.lower():
        if c.isalpha():
            out += [" "] * gap + [c]
            gap = False
        else:
            gap = True
    return ("   " + "".join(out) + " " * gap).encode()


def _brute(texts, text):
    """Code length by walking the contexts one byte at a time."""
    seen = defaultdict(Counter)
    for t in texts:
        b = _clean(t)
        for i in range(3, len(b)):
            for k in range(4):
                seen[k, b[i - k:i]][b[i]] += 1
    # contexts of order k are counted over the positions that have all 3 bytes before them
    b, bits = _clean(text), 0.0
    for i in range(3, len(b)):
        for k in (3, 2, 1, 0):
            c = seen.get((k, b[i - k:i]))
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if b[i] in c:
                bits -= math.log2(c[b[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(train, docs_of):
    model = L.fit(train)
    assert model.langs == ["en", "fr"]
    tests = ["the sea and the hill", "la maison du chien", "zzz qqq", "été", "a"]
    got = {r.doc_id: r for r in L.predict(docs_of(list(enumerate(tests))), model).collect()}
    for i, t in enumerate(tests):
        bits = {"en": _brute(EN, t), "fr": _brute(FR, t)}
        best = min(bits, key=bits.get)
        n = len(_clean(t)) - 3
        assert got[i].lang_pred == best
        assert got[i].bits_per_byte == pytest.approx(bits[best] / n, abs=1e-9)
        assert got[i].score == pytest.approx(1 / sum(2 ** (bits[best] - v) for v in bits.values()), abs=1e-9)


def test_edges(spark, train, docs_of):
    model = L.fit(train)
    long = "the cat and the dog " * (3 * PIECE // 20)
    rows = L.predict(docs_of([(1, None), (2, ""), (3, "123 !?"), (4, long), (5, "the dog"), (5, "the dog"), (None, "le chien")]), model).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 7
    assert [(by[i].lang_pred, by[i].score) for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[4].lang_pred == "en" and 0 <= by[4].score <= 1
    short = L.predict(docs_of([(1, "the cat and the dog " * 400)]), model).first()
    assert by[4].bits_per_byte == pytest.approx(short.bits_per_byte, rel=1e-3)  # no cut in between
    assert by[None].lang_pred == "fr"
    none = L.predict(docs_of([(1, "hello")]), L.fit(train.where("false")))
    assert none.first().lang_pred == "und"
    assert L.predict(train.where("false"), model).count() == 0
    kept = L.keep_known(docs_of([(1, "the dog"), (2, "42"), (3, None)]).selectExpr("*", "text AS row", "doc_id AS b"), model)
    assert [(r.doc_id, r.row, r.b) for r in kept.collect()] == [(1, "the dog", 1)]


def test_work_arrays_stay_small():
    """A worker's arrays are bounded whatever a batch or a text holds, and no gram is lost or met twice."""
    off = np.concatenate(([0], np.cumsum([3, 40, 5_000_000, 700, *[2_000] * 2_000])))
    buf = np.random.default_rng(3).integers(97, 123, off[-1], dtype=np.uint8)
    met, n = np.zeros(len(off) - 1, np.int64), 0
    tracemalloc.start()
    for part, o, first in L._split_long(buf, off):
        g, doc = L._grams(part, o)
        np.add.at(met, first + doc, 1)
        n = max(n, len(g))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert met.tolist() == np.maximum(np.diff(off) - L.ORDER, 0).tolist()
    assert n <= 2 * L.SLICE and peak < 50e6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op1_language_id(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.count() > 200
    assert got.where("lang_pred = lang").count() / got.count() > 0.97
