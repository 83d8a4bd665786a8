"""Command line: batch stages, sampling of the sources, the scoring stream, its compaction and the day replay.

    spark-submit riskmart/plans/jobs.py stages --raw … --root … [--stages bronze silver …]
    spark-submit riskmart/plans/jobs.py sample --raw … --target … --fraction 0.05
    spark-submit riskmart/plans/jobs.py score  --root … --servers … --topic …
    spark-submit riskmart/plans/jobs.py replay --root … --servers … --topic … --day 182 [--pause 2]
    spark-submit riskmart/plans/jobs.py compact --root … [--grace-hours 24]
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from riskmart.config import Layout, RiskConfig
from riskmart.plans import serving, stages
from riskmart.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("stages", help="run batch stages in order")
    batch.add_argument("--raw", help="folder of the raw CSV files")
    batch.add_argument("--stages", nargs="+", choices=stages.ORDER, default=list(stages.DEFAULT))
    batch.add_argument("--negative-fraction", type=float, default=1.0, help="share of negatives to train on")
    batch.add_argument("--trees", type=int, default=60)
    batch.add_argument("--without-baseline", action="store_true")
    batch.add_argument("--review-cost", type=float, default=5.0)
    batch.add_argument("--chargeback-cost", type=float, default=25.0)
    batch.add_argument("--buckets", type=int, help="buckets of the bronze tables: cleaning then needs no shuffle")

    sample = jobs.add_parser("sample", help="sample the raw files by key")
    sample.add_argument("--raw", required=True)
    sample.add_argument("--target", required=True)
    sample.add_argument("--fraction", type=float, default=0.05)
    sample.add_argument("--seed", type=int, default=42)

    score = jobs.add_parser("score", help="score a message stream")
    score.add_argument("--keep-alerts", action="store_true", help="continue the stored stream instead of a new one")
    score.add_argument("--stream-id", default="alerts")
    replay = jobs.add_parser("replay", help="send one stored day, hour by hour")
    replay.add_argument("--day", type=int, required=True)
    replay.add_argument("--pause", type=float, default=2.0, help="seconds between two hours")
    compact = jobs.add_parser("compact", help="rewrite the batches of the stored stream into a folder per day")
    compact.add_argument("--grace-hours", type=float, default=24.0, help="how long replaced files stay for readers that have begun")
    for p in (score, replay):
        p.add_argument("--servers", required=True)
        p.add_argument("--topic", default="transactions")
    for p in (batch, score, replay, compact):
        p.add_argument("--root", required=True, help="root folder of the tables")
        p.add_argument("--format", default="parquet")
    return parser.parse_args(argv)


def config_from(args: argparse.Namespace) -> RiskConfig:
    cfg = RiskConfig()
    if args.job == "stages":
        return replace(
            cfg, negative_fraction=args.negative_fraction, trees=args.trees, with_baseline=not args.without_baseline,
            review_cost=args.review_cost, chargeback_cost=args.chargeback_cost,
        )
    if args.job == "score":
        return replace(cfg, keep_alerts=args.keep_alerts)
    return replace(cfg, replay_day=args.day, replay_pause_s=args.pause) if args.job == "replay" else cfg


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    cfg, spark = config_from(args), build_session(f"riskmart-{args.job}")
    try:
        if args.job == "stages":
            stages.run_stages(spark, Layout(args.root, args.format, args.buckets), cfg, args.raw, args.stages)
        elif args.job == "sample":
            serving.sample_sources(spark, args.raw, args.target, cfg, args.fraction, args.seed)
        elif args.job == "score":
            serving.score_topic(spark, Layout(args.root, args.format), cfg, args.servers, args.topic, args.stream_id).awaitTermination()
        elif args.job == "compact":
            serving.compact_stream(spark, Layout(args.root, args.format), args.grace_hours * 3600)
        else:
            serving.replay_topic(spark, Layout(args.root, args.format), cfg, args.servers, args.topic)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
