"""Command line: ``python -m ridemart <command> ...``.

    build      --green PATH --yellow PATH --zones CSV --out DIR [--fmt parquet|csv] [--test-run]
    load-month --service S --month YYYY-MM --src PATH --target DIR [--fmt parquet|csv]
    backfill   --service S --start YYYY-MM --end YYYY-MM --raw-root DIR --target DIR [--per year]
    land       --service S --src PATH --raw-root DIR [--fmt parquet|csv]
    stream     --service S --raw-root DIR --target DIR --checkpoint DIR
    train      --trips PATH --model DIR
    score      --model DIR --requests JSONL --out DIR

Every command runs on the ambient Spark session (``spark-submit -m ridemart``
on a cluster); the master and resources come from the submit options.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ridemart.specs import Config, spec


def _read(spark: SparkSession, path: str, s, fmt: str):
    from ridemart.sources.files import read_trips_csv, read_trips_parquet
    return read_trips_csv(spark, path, s) if fmt == "csv" else read_trips_parquet(spark, path, s)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ridemart")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--green"), b.add_argument("--yellow"), b.add_argument("--zones", required=True)
    b.add_argument("--out", required=True), b.add_argument("--fmt", default="parquet")
    b.add_argument("--test-run", action="store_true")
    lm = sub.add_parser("load-month")
    for a in ("--service", "--month", "--src", "--target"):
        lm.add_argument(a, required=True)
    lm.add_argument("--fmt", default="parquet")
    bf = sub.add_parser("backfill")
    for a in ("--service", "--start", "--end", "--raw-root", "--target"):
        bf.add_argument(a, required=True)
    bf.add_argument("--per", default=None), bf.add_argument("--fmt", default="parquet")
    ld = sub.add_parser("land")
    for a in ("--service", "--src", "--raw-root"):
        ld.add_argument(a, required=True)
    ld.add_argument("--fmt", default="parquet"), ld.add_argument("--src-fmt", default="csv")
    ld.add_argument("--month", default=None, help="the month this delivery is for; without it a history is split by pickup")
    st = sub.add_parser("stream")
    for a in ("--service", "--raw-root", "--target", "--checkpoint"):
        st.add_argument(a, required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--trips", required=True), tr.add_argument("--model", required=True)
    sc = sub.add_parser("score")
    for a in ("--model", "--requests", "--out"):
        sc.add_argument(a, required=True)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"ridemart-{args.cmd}").getOrCreate()
    from ridemart.session import ensure_checkpoint_dir, pin_time_zone
    pin_time_zone(spark)
    ensure_checkpoint_dir(spark)

    if args.cmd == "build":
        from ridemart.plans.pipeline import build
        from ridemart.sources.files import load_seed
        sources = {}
        if args.green:
            sources[spec("green")] = _read(spark, args.green, spec("green"), args.fmt)
        if args.yellow:
            sources[spec("yellow")] = _read(spark, args.yellow, spec("yellow"), args.fmt)
        res = build(spark, sources, load_seed(spark, args.zones), args.out, Config(is_test_run=args.test_run))
        for r in res.checks.collect():
            print(json.dumps(r.asDict()))
    elif args.cmd == "load-month":
        from ridemart.plans.pipeline import load_month
        n = load_month(spark, spec(args.service), args.month, args.src, args.target, args.fmt)
        print(json.dumps({"month": args.month, "inserted": n}))
    elif args.cmd == "backfill":
        from ridemart.plans.pipeline import backfill
        print(json.dumps(backfill(spark, spec(args.service), args.start, args.end, args.raw_root, args.target,
                                  args.fmt, args.per)))
    elif args.cmd == "land":
        from ridemart.sources.files import land_raw
        s = spec(args.service)
        print(land_raw(_read(spark, args.src, s, args.src_fmt), args.raw_root, s, args.month, fmt=args.fmt))
    elif args.cmd == "stream":
        from ridemart.streaming.months import stream_months
        stream_months(spark, spec(args.service), args.raw_root, args.target, args.checkpoint).awaitTermination()
    elif args.cmd == "train":
        from ridemart.operators import ml
        trips = _read(spark, args.trips, spec("yellow"), "parquet")
        ml.save_model(ml.train_tip_model(ml.ml_table(trips)), args.model)
    elif args.cmd == "score":
        from ridemart.operators import ml
        req = spark.read.text(args.requests).withColumnRenamed("value", "request")
        ml.score_instances(ml.load_model(args.model), req, "request").write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
