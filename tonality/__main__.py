"""Command line: ``python -m tonality {classify,score,stream} ...``.

Uses the active/default Spark configuration (spark-submit or local)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tonality.plans.jobs import classify_reviews, score_reviews, stream_reviews


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tonality")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("classify", help="train and evaluate the classifier chain")
    c.add_argument("--reviews", required=True)
    c.add_argument("--report", required=True)
    c.add_argument("--model")
    c.add_argument("--label-mode", default="raw", choices=["raw", "three_class", "binary"])
    c.add_argument("--scores", help="per-review lexicon scores (parquet or tuple text)")
    c.add_argument("--average", default="micro", choices=["micro", "weighted"])
    c.add_argument("--num-features", type=int, default=1 << 18)
    s = sub.add_parser("score", help="per-review mean lexicon score")
    s.add_argument("--reviews", required=True)
    s.add_argument("--lexicon", required=True)
    s.add_argument("--boosters")
    s.add_argument("--negators")
    s.add_argument("--out", required=True)
    s.add_argument("--format", default="parquet", choices=["parquet", "text"])
    t = sub.add_parser("stream", help="score newly arriving review files")
    t.add_argument("--model", required=True)
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--trigger", default="10 seconds")
    t.add_argument("--available-now", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"tonality-{a.cmd}").getOrCreate()
    if a.cmd == "classify":
        classify_reviews(spark, a.reviews, a.report, a.model, a.label_mode, a.scores, a.average,
                         num_features=a.num_features)
    elif a.cmd == "score":
        score_reviews(spark, a.reviews, a.lexicon, a.out, a.boosters, a.negators, a.format)
    else:
        q = stream_reviews(spark, a.model, a.input, a.output, a.checkpoint, a.trigger,
                           a.available_now)
        if not a.available_now:
            q.awaitTermination()


if __name__ == "__main__":
    main()
