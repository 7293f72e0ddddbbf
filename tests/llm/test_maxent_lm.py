import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import docs_of  # noqa: F401
from morrowcart.llm import maxent_lm as M
from morrowcart.llm.queries import op13_maxent_lm


def _words(text):
    fold = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", fold) + [None]  # None: the end


def _base(train, text):
    """(n_tokens, n_known, N, base score) by the definition."""
    c = Counter(w for t in train for w in _words(t))
    n, v = sum(c.values()), len(c)
    own = _words(text)
    return len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)


def _arrays(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def test_query_counts_and_base_score(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op13_maxent_lm(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    import zlib
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    train = [t for i, t in docs.items() if not held[i]]
    c = Counter(w for t in train for w in _words(t))
    n, v = sum(c.values()), len(c)
    for r in got:
        own = _words(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(c[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_better_than_counts_on_held_out_texts(spark):
    r = op13_maxent_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.1  # a factor of 1.26 a token


def test_keys_are_found_by_their_leading_bits():
    rng = np.random.default_rng(5)
    none = np.zeros(M.BUCKETS)
    crowd = (np.uint64(7) << np.uint64(60)) + rng.integers(0, 1 << 20, 40, dtype=np.uint64)  # share their leading bits
    for keys in (np.unique(np.concatenate([rng.integers(0, 1 << 63, 5_000, dtype=np.uint64) * np.uint64(2), crowd])), np.array([0], np.uint64), np.array([2**64 - 1], np.uint64)):
        v = M.Vocabulary(1, len(keys), 0, keys, np.arange(len(keys)) + 1, np.full(len(keys), -1), none, none, none)
        asked = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), crowd, np.array([0, 2**64 - 1], np.uint64)])
        held = {int(k): i + 1 for i, k in enumerate(keys)}
        assert v.look_up(asked, np.zeros(len(asked), np.int16))[1].tolist() == [held.get(int(t), -1) for t in asked]


@pytest.mark.parametrize("table", [0, 7, 60])
def test_tokens_outside_the_table_are_joined(spark, docs_of, table):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 40) % 300) for _ in range(30)]
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    model = M.fit(docs.where("doc_id % 3 <> 0"), table=table, rounds=0)
    train = [t for i, t in enumerate(texts) if i % 3]
    assert len(model.vocabulary.keys) <= table
    for r in M.score(docs, model).collect():
        size, known, n, base = _base(train, texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n) and r.base_score == pytest.approx(base, rel=1e-12)
        assert r.score == pytest.approx(_model_score(model, train, texts[r.doc_id]), rel=1e-6)


def _model_score(model, train, text):
    """Token by token from the weights, with dictionaries."""
    v, w = model.vocabulary, model.weights
    c = Counter(x for t in train for x in _words(t))
    buf, off = _arrays([text])
    token, tail, _ = M.tokens(buf, off)
    bucket = v.look_up(token, tail)[0].tolist()
    total = 0.0
    for i, (b, word) in enumerate(zip(bucket, _words(text))):
        one, two, three = (np.uint64(bucket[i - k] if i >= k else M.BUCKETS) for k in (1, 2, 3))
        f = [M.mix(np.array([x], np.uint64) + s)[0] for x, s in zip((one, one * np.uint64(M.BUCKETS + 1) + two, two, three), M._SALTS)]
        k, m = divmod(b, M.MEMBERS)
        for weights, bias, target, hashes in ((w.of_class, v.class_bias, k, f),
                                              (w.of_member, v.member_bias[k], m, [M.mix(np.array([x ^ np.uint64(0)], np.uint64) + M._SALTS[M.FEATURES] * np.uint64(k + 1))[0] for x in f])):
            z = bias.astype(float) + sum(weights[int(h >> np.uint64(64 - M.ROW_BITS))].astype(float) for h in hashes)
            total += (z[target] - np.log(np.exp(z).sum())) / math.log(10)
        total += math.log10(c[word] + 1) - v.inside[b]
    return total


def test_trained_scores_token_by_token(spark, docs_of):
    texts = ["the cat sat on the mat " * 5, "a dog ran to the cat", "", None, "the the the"] * 6
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    model = M.fit(docs)
    assert np.abs(model.weights.of_class).max() > 0.01
    for r in M.score(docs, model).collect():
        assert r.score == pytest.approx(_model_score(model, texts, texts[r.doc_id]), rel=1e-5)


def test_probabilities_add_up_to_one(spark, docs_of):
    rng = np.random.default_rng(7)
    words = [f"w{i}{'abc'[i % 3]}" for i in range(2000)]
    texts = [" ".join(words[int(x)] for x in rng.zipf(1.1, 200) % 2000) for _ in range(40)]
    model = M.fit(docs_of(list(enumerate(texts))))
    v, w = model.vocabulary, model.weights
    buf, off = _arrays(texts[:2])
    token, tail, doc = M.tokens(buf, off)
    f = M.features(v.look_up(token, tail)[0], doc)[:5]
    for row in f:
        all_ = np.arange(M.BUCKETS)
        assert np.exp(M._factors(w, v, np.tile(row, (M.BUCKETS, 1)), all_)[1]).sum() == pytest.approx(1, abs=1e-4)
    # inside a bucket: known tokens, and one share for the unseen in shared buckets
    counts = {np.int64(r.token).astype(np.int64): (r.tail, r.n) for r in model.counts.collect()}
    keys = np.array(list(counts)).view(np.uint64)
    bucket = v.look_up(keys, np.array([t for t, _ in counts.values()], np.int16))[0]
    share = np.bincount(bucket, weights=[(n + 1) for _, n in counts.values()], minlength=M.BUCKETS) / 10 ** v.inside
    shared = np.arange(M.BUCKETS) % M.MEMBERS >= M.OWN_MEMBERS
    assert np.allclose(share[shared], 1 - 10 ** -v.inside[shared])
    assert set(np.round(share[~shared], 9)) <= {0.0, 1.0}


def test_a_step_follows_the_gradient(spark, docs_of, monkeypatch):
    texts = ["a b c a b d e a b c", "c c d a b"] * 3
    model = M.fit(docs_of(list(enumerate(texts))), rounds=0)
    v, rng = model.vocabulary, np.random.default_rng(1)
    w = M.Weights(*[rng.normal(0, 0.3, x.shape) for x in (model.weights.of_class, model.weights.of_member)])
    v.class_bias, v.member_bias = v.class_bias.astype(float), v.member_bias.astype(float)
    token, tail, doc = M.tokens(*_arrays(texts))
    bucket = v.look_up(token, tail)[0]
    t = M.Trainer(w, v, rate=1.0)
    t.learn(bucket, doc)
    rows = M._rows(M.features(bucket, doc))
    for row in rows[:6, 0]:
        step = (t.w.of_class[row] - w.of_class[row]) * np.sqrt(t.seen[0][row] + 1)
        for c in range(0, M.CLASSES, 7):
            parts = []
            for d in (1e-5, -1e-5):
                x = M.Weights(w.of_class.copy(), w.of_member)
                x.of_class[row, c] += d
                parts.append(M.log10_buckets(x, v, bucket, doc).sum() * np.log(10))
            assert step[c] == pytest.approx((parts[0] - parts[1]) / 2e-5, abs=1e-3)


def test_segment_sums():
    rng = np.random.default_rng(0)
    p = rng.normal(size=(500, 4))
    key = np.sort(rng.zipf(1.4, 900) % 97)
    take = rng.integers(0, 500, 900)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    g, by, size = M._segment_sums(p, take, at)
    want = np.zeros((97, 4))
    np.add.at(want, key, p[take])
    assert np.allclose(g, want[key[at[by]]]) and (size == np.bincount(key, minlength=97)[key[at[by]]]).all() and size[0] > 12


def test_edges(spark, docs_of):
    rows = [(1, None), (1, ""), (None, "Alone here"), (2, "x " * 300_000), (3, "É é É"), (3, "É é É"), (4, " \t\n")]
    docs = docs_of(rows).withColumns({"score": F.lit("old"), "n_tokens": F.lit(0), "at": F.lit(9), "rare": F.lit("r"), "row": F.lit(1)})
    model = M.fit(docs.where("doc_id IS NOT NULL"))
    got = M.score(docs, model)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "at", "rare", "row", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    out = got.collect()
    assert len(out) == 7 and all(r.train_tokens == 300_000 + 6 + 6 and r["at"] == 9 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 4)} == {1} and len({(r.score, r.base_score) for r in out if r.doc_id == 3}) == 1
    train = [t for i, t in rows if i]
    alone = next(r for r in out if r.doc_id is None)
    assert alone.base_score == pytest.approx(_base(train, "Alone here")[3]) and alone.n_known == 1
    nothing = M.fit(docs.where("false"))
    blank = M.score(docs, nothing).collect()
    assert len(blank) == 7 and all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score) for r in blank)
    assert M.score(docs.where("false"), model).count() == 0


def test_reruns_agree(spark):
    one, two = (sorted((r.doc_id, r.score, r.base_score) for r in op13_maxent_lm(spark, SF_SMALL).collect()) for _ in range(2))
    assert one == two
