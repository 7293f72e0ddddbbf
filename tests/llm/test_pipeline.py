"""The corpus pipeline: each stage on its own input, and what the stages promise together."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF_SMALL
from morrowcart.llm import line_chunks
from morrowcart.llm.common import BATCH, bounded_batches
from test_jaccard_join import _brute
from llm_fixtures import docs_of  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for i, (_, f) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing"]
    for s in stages[1:-1]:
        assert s.columns == stages[0].columns and s.dtypes == stages[0].dtypes


def test_each_stage_against_brute_force(spark, stages):
    rows = [{r.doc_id: r for r in s.collect()} for s in stages]
    # language ID keeps every text with letters in a learned language
    assert set(rows[0]) - set(rows[1]) <= {i for i, r in rows[0].items() if len(re.findall(r"[^\W\d_]", r.text or "")) < 20}
    # line dedup: only what stands elsewhere went
    left = {r.doc_id: r.text for r in line_chunks.dedup_lines(stages[1]).collect()}
    assert {i: r.text for i, r in rows[2].items()} == {i: t for i, t in left.items() if t.strip() or t == rows[1][i].text}
    assert all(r.n_chars == len(r.text) for r in rows[2].values() if r.text != rows[1][r.doc_id].text)
    # one document of each group
    comp = _brute(sorted((i, r.text) for i, r in rows[2].items()))
    assert set(rows[3]) == {i for i, (_, c) in comp.items() if c == i}
    # no benchmark item is left
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    gone = set(rows[3]) - set(rows[4])
    assert gone == {i for i, r in rows[3].items() if any(b in r.text for b in bench)}
    # the mix
    assert set(rows[5]) <= set(rows[4])
    for r in rows[5].values():
        assert r.size == len(rows[4][r.doc_id].text.split()) and 0 < r.taken <= 3 * r.size


def test_run_equals_the_stages(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF_SMALL).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_near_duplicates_link_by_five_words_at_four_fifths(spark, docs_of):
    base = [f"w{i}" for i in range(50)]
    near, far = list(base), list(base)
    near[20] = far[20] = far[40] = "other"

    def share(a, b, n):
        a, b = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for w in (a, b))
        return len(a & b) / len(a | b)
    assert share(base, near, 5) >= 0.8 and share(base, near, 4) < 0.85 and share(base, far, 5) < 0.8
    kept = C.join_near_duplicates(spark, docs_of([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base[::-1]))]), SF_SMALL)
    assert {r.doc_id for r in kept.collect()} == {1, 3}
    kept = C.join_near_duplicates(spark, docs_of([(1, " ".join(base)), (2, " ".join(far))]), SF_SMALL)
    assert {r.doc_id for r in kept.collect()} == {1, 2}


def test_rows_of_one_id_are_judged_apart(spark, docs_of):
    words = [f"w{i}" for i in range(60)]
    one, near, other = " ".join(words), " ".join(words[:-1] + ["else"]), " ".join(f"z{i}" for i in range(40))
    docs = docs_of([(2, one), (5, near), (5, other), (5, other), (7, None), (8, None), (None, one), (9, "")])
    docs = docs.withColumn("row_id", F.lit("clash"))
    got = sorted(((r.doc_id, r.text) for r in C.join_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(2, one), (5, other), (7, None), (8, None), (None, one), (9, "")], key=str)


def test_texts_reach_workers_in_small_batches(spark):
    """A task's texts are not one batch of an executor's memory; a bound the session names stays."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    texts = spark.range(0, 300, numPartitions=1).select(F.repeat(F.lit("word "), 20_000).alias("text"))  # 30 MB
    before = spark.conf.get(BATCH) if BATCH in spark.conf.getAll else None
    try:
        spark.conf.unset(BATCH)
        for _, stage in C.STAGES:
            spark.conf.unset(BATCH)
            stage(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20), SF_SMALL)
            got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
            assert max(got) <= 5 << 20 and sum(got) >= 30_000_000
        spark.conf.set(BATCH, "1m")
        bounded_batches(spark)
        assert spark.conf.get(BATCH) == "1m"
    finally:
        spark.conf.set(BATCH, before) if before else spark.conf.unset(BATCH)
