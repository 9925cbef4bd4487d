import os
import shutil

from pyspark.sql import functions as F

from tonality.operators.split import split_by_key
from tonality.plans.checks import labelled_reviews, scored_reviews
from tonality.plans.classifier import (ablation, build_classifier, fit, predict, run_report,
                                       train_and_predict, trainable)
from tonality.schemas import RUN_REPORT
from tonality.session import scratch_path
from tonality.sources.models import load_model, save_model
from tonality.streaming.score_stream import score_new_files

from paths import SF_SMALL

SMALL = dict(num_features=1 << 12)


def test_chain_stages_and_lexicon_variant(spark):
    plain = build_classifier()
    lex = build_classifier(lexicon_col="vader")
    assert [type(s).__name__ for s in plain.getStages()] == [
        "Tokenizer", "StopWordsRemover", "HashingTF", "IDF", "LogisticRegression"]
    assert [type(s).__name__ for s in lex.getStages()] == [
        "Tokenizer", "StopWordsRemover", "HashingTF", "IDF", "VectorAssembler", "LogisticRegression"]
    lr = plain.getStages()[-1]
    assert lr.getMaxIter() == 10 and lr.getRegParam() == 0.001
    assert plain.getStages()[2].getNumFeatures() == 262144
    assert plain.getStages()[3].getMinDocFreq() == 5


def test_fit_predict_and_roundtrip(spark):
    rows = trainable(labelled_reviews(spark, SF_SMALL))
    train, test = split_by_key(rows, "review_id")
    model = fit(build_classifier(**SMALL), train)
    pred = predict(model, test, keep=("review_id", "label")).orderBy("review_id").collect()
    assert len(pred) == test.count() > 0
    path = scratch_path(spark, "test-model")
    save_model(model, path)
    again = predict(load_model(path), test, keep=("review_id", "label")).orderBy("review_id").collect()
    assert [r.prediction for r in pred] == [r.prediction for r in again]
    assert {r.prediction for r in pred} <= {1.0, 2.0, 3.0}


def test_run_report_and_ablation_shapes(spark):
    import time
    start = time.time()
    _, pred = train_and_predict(labelled_reviews(spark, SF_SMALL), **SMALL)
    rep = run_report(spark, pred, start)
    r = rep.collect()[0]
    assert rep.schema == RUN_REPORT
    assert r.accuracy == r.precision == r.recall == r.f1 and r.total == pred.count()
    assert r.end >= r.start and r.total_time >= 0
    w = run_report(spark, pred, start, average="weighted").collect()[0]
    assert w.accuracy == r.accuracy
    ab = ablation(spark, scored_reviews(spark, SF_SMALL), **SMALL).collect()
    assert [x.variant for x in ab] == ["no_lexicon", "lexicon"]
    assert ab[0].total == ab[1].total > 0     # same rows in both variants


def _csv(path, rows):
    with open(path, "w", newline="") as f:
        f.write("review\r\n")
        for r in rows:
            f.write(r + "\r\n")


def test_stream_scores_only_new_files(spark, tmpdir_fresh):
    rows = trainable(labelled_reviews(spark, SF_SMALL))
    model = fit(build_classifier(**SMALL), rows)
    src = os.path.join(tmpdir_fresh, "in")
    os.makedirs(src)
    _csv(os.path.join(src, "a.csv"), ['"this, was ""fine"""', "plain words", '"two\r\nlines"'])
    _csv(os.path.join(src, "b.csv"), ["by the way", '"from here"', "that one"])
    out = os.path.join(tmpdir_fresh, "out")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    score_new_files(spark, src, model, out, ckpt)
    first = spark.read.parquet(out).collect()
    assert len(first) == 6
    assert 'this, was "fine"' in {r.review for r in first}
    assert "review" not in {r.review for r in first}          # header lines never scored
    _csv(os.path.join(src, "c.csv"), ["with new text", '"is this it?"', "on and on"])
    score_new_files(spark, src, model, out, ckpt)
    second = spark.read.parquet(out).collect()
    assert len(second) == 9                                   # only the new file was added
