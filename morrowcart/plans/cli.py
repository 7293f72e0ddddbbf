"""Command line: the batch job over CSV inputs (the original's two scripts).

    python -m morrowcart.plans.cli clean --log user.csv --items item.csv --out DIR
    python -m morrowcart.plans.cli run   --log user.csv --items item.csv --out DIR \\
        [--end-label 2014-12-18] [--score-day 2014-12-18] [--max-iter 900] [--top-k 700]
        [--learner histogram|mllib]
        [--behaviors 2 3] [--aligned-score] [--lookback-ratios] [--grid-lookbacks 2 5]
        [--span-days] [--full-training-set] [--evaluate]

``clean`` writes the cleaned log (Parquet, partitioned by day) to DIR/clean_log;
``run`` also builds the features, samples, fits, scores and writes the top-k
pairs to DIR/result (CSV with header). The session comes from the usual
``spark-submit`` configuration; DIR must be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from pyspark.sql import SparkSession

from ..config import BoostParams, Calendar, FeatureOptions, ModelParams, RunConfig
from ..session import build_session
from ..sources.files import read_item_table_csv, read_raw_log_csv
from .batch_job import BatchJob


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="morrowcart")
    p.add_argument("command", choices=["clean", "run"])
    p.add_argument("--log", required=True, help="interaction log CSV (with header)")
    p.add_argument("--items", required=True, help="item table CSV (with header)")
    p.add_argument("--out", required=True, help="output folder (shared storage)")
    p.add_argument("--end-label", type=dt.date.fromisoformat)
    p.add_argument("--score-day", type=dt.date.fromisoformat)
    p.add_argument("--blackout", nargs="*", type=dt.date.fromisoformat,
                   help="contiguous days dropped from the log")
    p.add_argument("--max-iter", type=int)
    p.add_argument("--learner", choices=["histogram", "mllib"], help="second-order boosting (default) or MLlib's")
    p.add_argument("--top-k", type=int)
    p.add_argument("--behaviors", nargs="+", type=int, help="behaviours that make a sample pair (default: all)")
    p.add_argument("--aligned-score", action="store_true", help="scoring window as that of a training label day")
    p.add_argument("--lookback-ratios", action="store_true", help="5- and 3-day ratios as features")
    p.add_argument("--grid-lookbacks", nargs="+", type=int, default=[], help="user hour grids over the last k days")
    p.add_argument("--span-days", action="store_true", help="days between first and last touch as features")
    p.add_argument("--full-training-set", action="store_true", help="features for all training pairs, not only the drawn")
    p.add_argument("--evaluate", action="store_true")
    return p


def config_from(args) -> RunConfig:
    cal = Calendar.reference()
    if args.blackout is not None:
        cal = dataclasses.replace(cal, blackout_days=tuple(args.blackout))
    if args.end_label or args.score_day:
        end = args.end_label or cal.end_label
        cal = cal.with_end(end, args.score_day or end)
    cfg = RunConfig(calendar=cal)
    if args.max_iter:
        cfg = dataclasses.replace(cfg, model=dataclasses.replace(ModelParams(), max_iter=args.max_iter),
                                  boost=dataclasses.replace(BoostParams(), rounds=args.max_iter))
    if args.learner:
        cfg = dataclasses.replace(cfg, learner=args.learner)
    if args.top_k:
        cfg = dataclasses.replace(cfg, top_k=args.top_k)
    return dataclasses.replace(
        cfg, behaviors=tuple(args.behaviors) if args.behaviors else None, aligned_score=args.aligned_score,
        features=FeatureOptions(args.lookback_ratios, tuple(args.grid_lookbacks), args.span_days),
        full_training_set=args.full_training_set)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or build_session()
    job = BatchJob(spark, config_from(args), args.out)
    raw = read_raw_log_csv(spark, args.log)
    items = read_item_table_csv(spark, args.items)
    if args.command == "clean":
        job.clean(raw, items)
    else:
        job.run(raw, items, evaluate=args.evaluate)
    print(json.dumps(job.timings))
    return job.timings


if __name__ == "__main__":
    main()
