"""Skew: a third of all events on one user and a third on one item.

The skewed tables are derived from the driver's events table; AQE's skew-join
thresholds are lowered so that skewed partitions are really split. Results
must still equal the DuckDB oracle on the same derived tables.
"""


import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = (ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long"))
                         .otherwise(F.col("user_id")))
             .withColumn("props", F.when(F.col("event_id") % 3 == 1, F.lit('{"k": 7}'))
                         .otherwise(F.col("props"))))
    hot.write.parquet(f"{d}/events.parquet")
    spark.read.parquet(f"{SF_SMALL}/part.parquet").write.parquet(f"{d}/part.parquet")
    return d


@pytest.fixture(scope="module")
def skew_con(skewed_dir):
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir}/{t}.parquet/*.parquet')")
    return con


@pytest.fixture()
def skew_conf(spark, monkeypatch):
    from morrowcart.operators import skew

    # small thresholds so the hot user and item take the broadcast path here
    monkeypatch.setattr(skew, "MIN_HOT_ROWS", 1)
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 100)
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["training_set", "item_unique_users", "user_active_days",
                                  "negative_sample", "scoring_set"])
def test_skewed_matches_oracle(spark, skew_con, skewed_dir, skew_conf, name):
    hot = spark.read.parquet(f"{skewed_dir}/events.parquet").filter("user_id = 0").count()
    total = spark.read.parquet(f"{skewed_dir}/events.parquet").count()
    assert hot * 3 >= total - 3
    r = compare(spark, skew_con, E.queries()[name], E.oracle_sql()[name], skewed_dir)
    assert r["ok"], r


def test_split_hot_join_equals_plain_join(spark):
    from morrowcart.operators.skew import hot_keys, split_hot_join

    left = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    right = spark.range(0, 3000, 2).selectExpr("id AS k", "id * 10 AS w")
    hot = hot_keys(left, ["k"], max_hot=10, min_rows=1).collect()
    assert [r.k for r in hot] == [0]
    got = split_hot_join(left, right, ["k"], max_hot=10, min_rows=1)
    want = left.join(right, ["k"], "left")
    assert got.count() == 3000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_keys_are_bounded(spark):
    from morrowcart.operators.skew import hot_keys

    left = spark.range(10000).selectExpr("id % 50 AS k")
    # every key holds 200 rows = 1/50 of all rows: with max_hot=20 none is hot
    assert hot_keys(left, ["k"], max_hot=20, min_rows=1).count() == 0
    assert hot_keys(left, ["k"], max_hot=100, min_rows=1).count() == 50


def test_hot_path_is_taken_under_skew(spark, skewed_dir, skew_conf):
    from morrowcart.operators import samples as SM, calendar as C
    from morrowcart.operators.skew import hot_keys
    from morrowcart.plans import registry as R

    keys = SM.train_labels(R.log(spark, skewed_dir), C.train_spine(spark, R.CAL))
    hot = hot_keys(keys, ["label_day", "user_id"]).collect()
    assert 0 < len(hot) <= 100
    assert 0 in {r.user_id for r in hot}
