"""The optimizer on occupied dimensions gives the full fit's coefficients."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from tonality.plans.checks import scored_reviews
from tonality.plans.classifier import build_classifier, fit, predict, trainable
from tonality.session import scratch_path

from paths import SF_CHECK


@pytest.fixture(scope="module")
def rows(spark):
    return trainable(scored_reviews(spark, SF_CHECK)).cache()


@pytest.mark.parametrize("lexicon_col,labels", [(None, 3), ("vader", 3), ("vader", 2)])
def test_same_coefficients_and_predictions(spark, rows, lexicon_col, labels):
    df = rows if labels == 3 else rows.withColumn("label", (rows.label > 2).cast("double"))
    chain = build_classifier(lexicon_col=lexicon_col, num_features=1 << 14)
    compact, full = fit(chain, df), fit(chain, df, compact=False)
    a, b = compact.stages[-1], full.stages[-1]
    assert [type(s) for s in compact.stages] == [type(s) for s in full.stages]
    assert np.abs(a.coefficientMatrix.toArray() - b.coefficientMatrix.toArray()).max() < 1e-6
    assert np.abs(a.interceptVector.toArray() - b.interceptVector.toArray()).max() < 1e-6
    assert (a.getRegParam(), a.getMaxIter(), a.getFeaturesCol(), a.numClasses) == (0.001, 10, "features", b.numClasses)
    assert len(a.coefficientMatrix.values) < b.coefficientMatrix.toArray().size / 2

    def predictions(m):
        return {r.review_id: r.prediction for r in predict(m, df, keep=("review_id",)).collect()}
    want = predictions(full)
    assert predictions(compact) == want
    path = scratch_path(spark, "compact-model")
    compact.write().save(path)
    assert predictions(PipelineModel.load(path)) == want


def test_rows_without_any_known_term(spark):
    """All features constant: only the intercept is left."""
    df = spark.createDataFrame([(f"r{i}", f"word{i}", float(i % 2)) for i in range(20)], "review_id string, text string, label double")
    model = fit(build_classifier(num_features=1 << 10), df)
    assert np.abs(model.stages[-1].coefficientMatrix.toArray()).max() == 0
    assert model.transform(df).count() == 20


def test_the_optimizer_sees_no_attribute_metadata(spark, rows):
    from tonality.plans import classifier
    train = rows.limit(50)
    assembled = classifier.Pipeline(stages=build_classifier(lexicon_col="vader", num_features=256).getStages()[:-1]).fit(train).transform(train)
    assert assembled.schema["features"].metadata
    assert not classifier._without_attributes(assembled, "features").schema["features"].metadata
