"""Logistic-regression text classifier chains and their evaluation.

Stage chain (MLlib): Tokenizer -> StopWordsRemover -> HashingTF -> IDF
[-> VectorAssembler with the lexicon score] -> LogisticRegression.
IDF is fitted on the training part only, inside ``fit``.

``num_features`` defaults to 2^18; tests pass smaller values to keep the
coefficient matrix small.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import (IDF, HashingTF, StopWordsRemover, Tokenizer, VarianceThresholdSelector,
                                VectorAssembler)
from pyspark.ml.linalg import SparseMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.fixed import (HASHING_NUM_FEATURES, IDF_MIN_DOC_FREQ, LR_MAX_ITER,
                            LR_REG_PARAM, NLTK_ENGLISH_STOP_WORDS)
from tonality.operators.metrics import micro_metrics, weighted_metrics
from tonality.operators.resampling import REPLICATES, paired_interval
from tonality.operators.split import split_by_key
from tonality.schemas import RUN_REPORT
from tonality.session import scratch_path


def build_classifier(lexicon_col: str | None = None, text_col: str = "text",
                     label_col: str = "label",
                     stop_words: Sequence[str] | None = NLTK_ENGLISH_STOP_WORDS,
                     num_features: int = HASHING_NUM_FEATURES,
                     min_doc_freq: int = IDF_MIN_DOC_FREQ, max_iter: int = LR_MAX_ITER,
                     reg_param: float = LR_REG_PARAM) -> Pipeline:
    """Five stages, or six with ``lexicon_col`` appended to the TF-IDF vector.

    ``stop_words=None`` uses Spark's default English list."""
    tokenizer = Tokenizer(inputCol=text_col, outputCol="words")
    remover = StopWordsRemover(inputCol="words", outputCol="no_stops")
    if stop_words is not None:
        remover.setStopWords(list(stop_words))
    hashing = HashingTF(inputCol="no_stops", outputCol="hashing", numFeatures=num_features)
    idf_out = "features1" if lexicon_col else "features"
    idf = IDF(inputCol="hashing", outputCol=idf_out, minDocFreq=min_doc_freq)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, labelCol=label_col,
                            featuresCol="features")
    stages = [tokenizer, remover, hashing, idf]
    if lexicon_col:
        stages.append(VectorAssembler(inputCols=["features1", lexicon_col], outputCol="features"))
    stages.append(lr)
    return Pipeline(stages=stages)


def trainable(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Rows the chain can learn from: text and label both present."""
    return df.filter(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())


# Each optimizer pass aggregates one dense gradient (classes x features) per
# partition, so a partition should hold enough rows to pay for it.
MIN_ROWS_PER_FIT_PARTITION = 20_000


def fit_partitions(rows: DataFrame) -> DataFrame:
    """``rows`` persisted (memory, spilling to disk) and, when it has fewer
    rows than its partitions can use, coalesced (narrow, no shuffle) to one
    partition per ``MIN_ROWS_PER_FIT_PARTITION`` rows. Large inputs keep
    their partitioning."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    n = rows.count()
    target = max(1, math.ceil(n / MIN_ROWS_PER_FIT_PARTITION))
    if target < rows.rdd.getNumPartitions():
        return rows.coalesce(target)
    return rows


def expanded(model: LogisticRegressionModel, occupied: Sequence[int], num_features: int) -> LogisticRegressionModel:
    """``model``, fitted on the ``occupied`` dimensions only, over all ``num_features``: the other
    coefficients are 0. The matrix is sparse, so a saved model stays as small as the fit."""
    compact = model.coefficientMatrix.toArray()
    columns = np.asarray(occupied, np.int32)
    held = [np.flatnonzero(row) for row in compact]
    matrix = SparseMatrix(compact.shape[0], num_features, np.cumsum([0, *map(len, held)]).astype(np.int32),
                          np.concatenate([columns[h] for h in held]), np.concatenate([row[h] for row, h in zip(compact, held)]),
                          isTransposed=True)
    java = model._java_obj
    sc = SparkSession.active().sparkContext
    # MLlib has no Python constructor for a model of given coefficients.
    full = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        java.uid(), _py2java(sc, matrix), _py2java(sc, model.interceptVector), model.numClasses, compact.shape[0] > 1)
    out = LogisticRegressionModel(full)
    out._resetUid(model.uid)
    given = model.extractParamMap()
    out._set(**{p.name: v for p, v in given.items() if model.isSet(p) and out.hasParam(p.name)})
    out._transfer_params_to_java()
    return out


COMPACT_COL = "_compact_features"


def _without_attributes(df: DataFrame, features_col: str) -> DataFrame:
    """``df`` without the metadata of its feature vector. ``VectorAssembler`` names each of the 2^18
    buckets there, and every task of every optimizer pass would deserialise them."""
    return df.select(*[F.col(c).alias(c, metadata={}) if c == features_col else F.col(c) for c in df.columns])


def fit(pipeline: Pipeline, train: DataFrame, compact: bool = True) -> PipelineModel:
    """Fit a chain whose last stage is the classifier.

    The feature stages (tokenizer ... IDF [, assembler]) are fitted on the
    training rows with their own partitioning; the feature vectors are then
    computed once and persisted, and only the optimizer's input is
    size-partitioned (``fit_partitions``). Lost blocks are recomputed from the
    deterministic lineage (the key split is a pure function of the key).

    With ``compact`` the optimizer sees only dimensions that vary in the training
    rows (of 2^18 hash buckets, those hit by a term of weight above 0): the
    others have coefficient 0 in any case. Its gradients and line searches
    then cost the occupied dimensions, and the coefficients are expanded back, so
    the fitted chain has the same stages and predictions as without."""
    stages = pipeline.getStages()
    classifier = stages[-1]
    owned = not train.is_cached          # release only what this call persisted
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    features = None
    try:
        feature_model = Pipeline(stages=stages[:-1]).fit(train)
        cols = [classifier.getLabelCol(), classifier.getFeaturesCol()]
        features = fit_partitions(_without_attributes(feature_model.transform(train).select(*cols), cols[1]))
        if not compact:
            return PipelineModel(stages=[*feature_model.stages, classifier.fit(features)])
        selector = VarianceThresholdSelector(featuresCol=cols[1], outputCol=COMPACT_COL, varianceThreshold=0.0).fit(features)
        occupied = selector.selectedFeatures
        if not occupied:
            return PipelineModel(stages=[*feature_model.stages, classifier.fit(features)])
        small = classifier.copy().setFeaturesCol(COMPACT_COL).fit(
            _without_attributes(selector.transform(features).select(cols[0], COMPACT_COL), COMPACT_COL))
        n = features.first()[cols[1]].size
        fitted = expanded(small, occupied, n).setFeaturesCol(cols[1])
        return PipelineModel(stages=[*feature_model.stages, fitted])
    finally:
        if features is not None:
            features.unpersist()
        if owned:
            train.unpersist()


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
    cols = [c for c in keep if c in df.columns]
    return model.transform(df).select(*cols, "prediction")


def train_and_predict(df: DataFrame, key: str = "review_id", lexicon_col: str | None = None,
                      **params) -> tuple[PipelineModel, DataFrame]:
    """Key split (reproducible), fit on train, predictions for test."""
    rows = trainable(df)
    train, test = split_by_key(rows, key)
    model = fit(build_classifier(lexicon_col=lexicon_col, **params), train)
    return model, predict(model, test, keep=(key, "label"))


def run_report(spark: SparkSession, pred: DataFrame, start: float,
               average: str = "micro") -> DataFrame:
    """One row: ``accuracy, total, precision, recall, f1, start, end, total_time``.

    ``average`` is ``micro`` (P = R = F1 = accuracy) or ``weighted``."""
    if average == "micro":
        m = micro_metrics(pred).first()
        vals = (m["accuracy"], m["total"], m["precision"], m["recall"], m["f1"])
    elif average == "weighted":
        m = weighted_metrics(pred).first()
        vals = (m["accuracy"], m["total"], m["weighted_precision"], m["weighted_recall"],
                m["weighted_f1"])
    else:
        raise ValueError("average must be 'micro' or 'weighted'")
    end = time.time()
    return spark.createDataFrame([(*vals, float(start), end, end - start)], RUN_REPORT)


def ablation(spark: SparkSession, scored: DataFrame, key: str = "review_id",
             lexicon_col: str = "vader", **params) -> DataFrame:
    """The same chain with and without the lexicon feature, on the same split
    and the same rows. Two rows: ``variant, accuracy, total, precision,
    recall, f1, start, end, total_time``."""
    rows = trainable(scored).filter(F.col(lexicon_col).isNotNull())
    train_rows, test = split_by_key(rows, key)
    train = train_rows.persist(StorageLevel.MEMORY_AND_DISK)
    test = test.persist(StorageLevel.MEMORY_AND_DISK)
    reports = []
    try:
        for variant, col in (("no_lexicon", None), ("lexicon", lexicon_col)):
            start = time.time()
            model = fit(build_classifier(lexicon_col=col, **params), train)
            pred = model.transform(test).select("label", "prediction")
            rep = run_report(spark, pred, start).withColumn("variant", F.lit(variant))
            reports.append(rep.select("variant", *RUN_REPORT.names))
    finally:
        train_rows.unpersist()
        test.unpersist()
    return reports[0].unionByName(reports[1])


def ablation_interval(scored: DataFrame, key: str = "review_id", lexicon_col: str = "vader",
                      replicates: int = REPLICATES, **params) -> DataFrame:
    """What the lexicon feature gains on the test part, with its paired bootstrap
    interval: a is the chain without it, b the chain with it, both on the same rows.
    One row a key is expected, as everywhere in the split. The rows are written once to shared
    scratch: both chains read them for training and for the test part, and would otherwise
    each time join texts, labels and scores anew."""
    path = scratch_path(scored.sparkSession, "ablation-rows")
    trainable(scored).filter(F.col(lexicon_col).isNotNull()).write.parquet(path)
    rows = scored.sparkSession.read.schema(scored.schema).parquet(path)
    _, without = train_and_predict(rows, key, **params)
    _, with_it = train_and_predict(rows, key, lexicon_col=lexicon_col, **params)
    pred = without.withColumnRenamed("prediction", "a").join(
        with_it.select(key, F.col("prediction").alias("b")), key)
    return paired_interval(pred, key, replicates=replicates)
