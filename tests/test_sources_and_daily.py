"""Tolerant CSV input, sketches of distinct users, and the daily run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from morrowcart.config import FeatureOptions
from morrowcart.functions import names as N
from morrowcart.operators import approx as A
from morrowcart.operators import extras as X
from morrowcart.operators.datasets import training_set
from morrowcart.plans import registry as R
from morrowcart.plans.incremental import DailyRun
from morrowcart.sources import fixture
from morrowcart.sources.files import TooManyRejects, check_rejects, read_raw_log_tolerant
from morrowcart.sources.sinks import write_rejects

HEADER = fixture.LOG_HEADER


def _csv(path, lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def test_rejects_name_their_reason(spark, tmp_path):
    good = ["1,2,1,,3,2014-12-01 00", "1,2,4,geo,3,2014-12-31 23"]
    bad = {"malformed": ["a,2,1,,3,2014-12-01 00", "1,2,1,,3", "1,2,1,,3,2014-12-01 00,more", "1,2,1.5,,3,2014-12-01 00"], "no_user": [",2,1,,3,2014-12-01 00", ",,9,,,"],
           "no_item": ["1,,1,,3,2014-12-01 00"], "bad_behavior": ["1,2,5,,3,2014-12-01 00", "1,2,,,3,2014-12-01 00"],
           "bad_time": ["1,2,1,,3,2014-12-01", "1,2,1,,3,2014-02-30 01", "1,2,1,,3,2014-12-01 24", "1,2,1,,3,", "1,2,1,,3,yesterday 01"]}
    path = _csv(tmp_path / "log.csv", good + [x for v in bad.values() for x in v])
    ok, rejects = read_raw_log_tolerant(spark, path)
    assert sorted(r.time for r in ok.collect()) == ["2014-12-01 00", "2014-12-31 23"]
    assert ok.columns == HEADER.split(",")
    got = {}
    for r in rejects.collect():
        got.setdefault(r.reason, []).append(r.record)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in bad.items()}
    assert sorted(got["malformed"]) == sorted(bad["malformed"])  # the line as delivered
    assert check_rejects(ok, rejects, 0.9) == {k: len(v) for k, v in bad.items()}
    with pytest.raises(TooManyRejects, match="malformed"):
        check_rejects(ok, rejects, 0.5)
    write_rejects(rejects, str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects" / "reason=bad_time")).count() == 5
    assert ok.select("user_id").count() == 2  # reading fewer columns rejects no fewer rows


def test_empty_delivery_and_wrong_header(spark, tmp_path):
    ok, rejects = read_raw_log_tolerant(spark, _csv(tmp_path / "empty.csv", []))
    assert ok.count() == 0 and check_rejects(ok, rejects, 0.0) == {}
    ok, _ = read_raw_log_tolerant(spark, _csv(tmp_path / "wrong.csv", ["1,2,1,,3,2014-12-01 00"], HEADER.replace("item_id", "thing")))
    with pytest.raises(Exception, match="header|HEADER"):
        ok.collect()


def test_sketches_stay_within_their_error(spark):
    n = [40_000, 9_000, 600, 3]
    cols = ["CAST(id AS BIGINT) AS user_id", "CAST(k AS BIGINT) AS item_id", "CAST(0 AS BIGINT) AS item_category", "DATE '2024-01-20' + CAST(id % 3 AS INT) AS day", "1 AS hour", "1 AS behavior_type"]
    log = None
    for k, size in enumerate(n):
        part = spark.range(size).union(spark.range(size // 2)).withColumn("k", F.lit(k)).selectExpr("row_number() OVER (PARTITION BY id ORDER BY id) - 1 AS again", "id", "k")
        part = part.selectExpr("id", "k", "again").selectExpr(*[c if "day" not in c else "DATE '2024-01-20' + CAST((id + again) % 3 AS INT) AS day" for c in cols])
        log = part if log is None else log.unionByName(part)
    days = R.days(spark).filter("label_day = DATE '2024-01-28'")
    exact = {r.item_id: r.i_uniq_w_1 for r in X.item_unique_users(log, days).collect()}
    got = {r.item_id: r for r in A.item_unique_users_approx(log, days).collect()}
    stored = {r.item_id: r.i_uniq_w_1 for r in A.item_unique_users_approx(None, days, sketches=A.daily_user_sketches(log)).collect()}
    assert exact == dict(enumerate(n)) and stored == {k: r.i_uniq_w_1 for k, r in got.items()}
    for k, size in enumerate(n):
        assert abs(got[k].i_uniq_w_1 - size) <= 4 * A.relative_error() * size and got[k].i_uniq_w_2 == 0
    assert got[3].i_uniq_w_1 == 3
    coarse = A.item_unique_users_approx(log, days, lg_k=8).filter("item_id = 0").first().i_uniq_w_1
    assert abs(coarse - n[0]) <= 4 * A.relative_error(8) * n[0]


def test_sketches_as_a_feature_option(spark):
    lg = R.log(spark, SF_SMALL)
    names = ["label_day", "user_id", "item_id", *N.uniq_names()]
    got = training_set(spark, lg, R.CAL, opts=FeatureOptions(approx_users=True)).select(names)
    want = training_set(spark, lg, R.CAL).select(names)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def _stamps(path):
    return {d: {f: os.stat(os.path.join(path, d, f)).st_mtime_ns for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")}
            for d in os.listdir(path) if "=" in d}


def test_a_day_rewrites_only_its_partitions(spark, tmp_path):
    raw, items = fixture.raw_log(spark, SF_SMALL), fixture.item_table(spark, SF_SMALL)
    day = dt.date(2024, 1, 26)
    run = DailyRun(spark, R.CAL, str(tmp_path), wanted=R.DAILY_FEATURES)
    first = run.add(raw.filter(~F.col("time").startswith(str(day))), items)
    assert day not in first["days"] and len(first["label_days"]) == 15
    before = {t: _stamps(run.path(t)) for t in ("clean_log", "activity", "training_set")}
    again = run.add(raw.filter(F.col("time") >= "2024-01-25").filter(F.col("time") < "2024-01-27"), items)
    assert again["days"] == [day]  # the 25th was delivered again, unchanged
    assert again["label_days"] == run.affected([day]) and 0 < len(again["label_days"]) < 15
    after = {t: _stamps(run.path(t)) for t in ("clean_log", "activity", "training_set")}
    for t in ("clean_log", "activity"):
        assert {d for d in after[t] if after[t][d] != before[t].get(d)} == {f"day={day}"}
    changed = {d for d in after["training_set"] if after["training_set"][d] != before["training_set"].get(d)}
    assert changed == {f"label_day={d}" for d in again["label_days"]}
    whole = training_set(spark, R.log(spark, SF_SMALL), R.CAL).select(run.training_set().columns)
    assert whole.exceptAll(run.training_set()).count() == 0 == run.training_set().exceptAll(whole).count()
    assert run.add(raw, items) == {"days": [], "label_days": []}  # all of it again: nothing to do
    assert _stamps(run.path("training_set")) == after["training_set"]


def test_a_run_that_died_is_repeated(spark, tmp_path, monkeypatch):
    raw, items = fixture.raw_log(spark, SF_SMALL), fixture.item_table(spark, SF_SMALL)
    run = DailyRun(spark, R.CAL, str(tmp_path), wanted=R.DAILY_FEATURES)
    with monkeypatch.context() as m:
        m.setattr(DailyRun, "_build", lambda self, labels: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run.add(raw, items)
    assert run.manifest() == {}
    run.add(raw, items)
    assert run.training_set().count() == 326 and len(run.manifest()) > 20
