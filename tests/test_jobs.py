"""End-to-end jobs on JSON reviews written from the stand-in table."""

import os

from tonality.plans.jobs import classify_reviews, score_reviews, stream_reviews
from tonality.schemas import RUN_REPORT
from tonality.sources.review_files import write_review_csv
from tonality.sources.reviews import standin_reviews, write_reviews_json

from paths import SF_SMALL


def test_jobs_end_to_end(spark, tmpdir_fresh):
    d = tmpdir_fresh
    reviews = os.path.join(d, "reviews")
    write_reviews_json(standin_reviews(spark, SF_SMALL), reviews)
    lex = os.path.join(d, "lexicon.csv")
    with open(lex, "w") as f:
        f.write("token,valence\nthis,1.9\nthat,-1.5\nfrom,2.3\nwith,0.8\nby,-2.1\nwas,-0.6\n")
    neg = os.path.join(d, "negators.csv")
    with open(neg, "w") as f:
        f.write("token\nit\nbe\n")
    score_reviews(spark, reviews, lex, os.path.join(d, "scores"), negators_path=neg)
    score_reviews(spark, reviews, lex, os.path.join(d, "scores_txt"), fmt="text")
    scores = spark.read.parquet(os.path.join(d, "scores"))
    assert scores.count() == spark.read.json(reviews).count()
    plain = classify_reviews(spark, reviews, os.path.join(d, "report1"), os.path.join(d, "model"),
                             label_mode="three_class", num_features=1 << 12).collect()[0]
    with_lex = classify_reviews(spark, reviews, os.path.join(d, "report2"),
                                label_mode="three_class",
                                scores_path=os.path.join(d, "scores_txt"),
                                num_features=1 << 12).collect()[0]
    assert plain.total == with_lex.total > 0
    assert spark.read.schema(RUN_REPORT).json(os.path.join(d, "report1")).count() == 1
    src = os.path.join(d, "in")
    write_review_csv(spark.read.json(reviews).selectExpr("text AS review").limit(5), src)
    stream_reviews(spark, os.path.join(d, "model"), src, os.path.join(d, "out"),
                   os.path.join(d, "ckpt"), available_now=True)
    assert spark.read.parquet(os.path.join(d, "out")).count() == 5
