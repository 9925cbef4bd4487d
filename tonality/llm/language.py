"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text's features are its lower-cased character 1- to 4-grams over letters (other
characters become one boundary), hashed into ``BUCKETS``. Their embeddings are
averaged and a linear softmax gives the language; both layers are fitted with
mini-batch stochastic gradient descent in numpy on a bounded sample. A part of the
sample fits the softmax temperature and the rejection threshold.

Sample bound: ``max_per_lang`` rows in expectation for each label, taken by a hash
of doc_id and text, rows equal in both and in label once; their (bucket, share) features, at most
``BUCKETS`` per row, go to one task, which fits the model. Only the model reaches the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no
labelled row every text is ``und``; rows are predicted one by one, so repeated
rows agree; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, StructField, StructType

BUCKETS = 1 << 14
DIM = 16
MAX_PER_LANG = 600
REJECT_QUANTILE = 0.001
UND = "und"


def subwords(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their share of all n-grams; empty without a letter."""
    low = text.lower()
    if not any(map(str.isalpha, low)):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    chars = np.frombuffer((" " + low + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, where = np.unique(chars, return_inverse=True)
    letter = np.array([chr(c).isalpha() if c < 0xD800 or c > 0xDFFF else False for c in kinds])[where]
    keep = letter | np.concatenate(([True], letter[:-1]))
    codes = np.where(letter, chars, 32)[keep].astype(np.uint64)
    total = np.zeros(BUCKETS, np.int64)
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, 5):
            h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
            total += np.bincount(((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(50)).astype(np.int64),
                                 minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / total.sum()).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        pairs = [subwords(t) for t in b["text"]]
        yield pd.DataFrame({"lang": b["lang"], "order": b["order"], "at": [p[0] for p in pairs],
                            "share": [p[1] for p in pairs]})


class Model:
    """Embeddings, softmax weights, labels, temperature and rejection threshold."""

    def __init__(self, langs, emb, weights, bias, temperature=1.0, threshold=0.0):
        self.langs, self.emb, self.weights, self.bias = langs, emb, weights, bias
        self.temperature, self.threshold = temperature, threshold

    def logits(self, rows) -> np.ndarray:
        h = np.stack([share @ self.emb[at] for at, share in rows])
        return h @ self.weights + self.bias

    def probabilities(self, rows) -> np.ndarray:
        return softmax(self.logits(rows) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_rows(rows, labels, epochs: int = 12, rate: float = 4.0, seed: int = 7, batch: int = 16) -> Model:
    """SGD over (buckets, shares) rows; every fifth row calibrates."""
    langs = sorted(set(labels))
    y = np.array([langs.index(v) for v in labels])
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.5, (BUCKETS, DIM)).astype(np.float32)
    w, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    held = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(train), max(1, len(train) // batch)):
            if not len(part):
                continue
            h = np.stack([rows[i][1] @ emb[rows[i][0]] for i in part])
            err = softmax(h @ w + bias)
            err[np.arange(len(part)), y[part]] -= 1
            back = err @ w.T
            w -= step / len(part) * h.T @ err
            bias -= step / len(part) * err.sum(axis=0)
            for i, g in zip(part, back):
                emb[rows[i][0]] -= (step * rows[i][1])[:, None] * g[None, :]
    model = Model(langs, emb, w, bias)
    check = np.flatnonzero(held)
    if len(check):
        z = model.logits([rows[i] for i in check])
        loss = {t: -np.log(softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean()
                for t in (0.25, 0.5, 1.0, 2.0, 4.0)}
        model.temperature = min(loss, key=loss.get)
        p = softmax(z / model.temperature)
        right = p.argmax(axis=1) == y[check]
        if right.any():
            model.threshold = float(np.quantile(p.max(axis=1)[right], REJECT_QUANTILE)) * 0.5
    return model


def _trained(group: pd.DataFrame) -> pd.DataFrame:
    """One row: the pickled model of the whole sample, in the order of its hashes."""
    group = group.sort_values(["order", "lang"], kind="stable")
    feats = [(np.asarray(a, np.int32), np.asarray(s, np.float32)) for a, s in zip(group["at"], group["share"])]
    return pd.DataFrame({"model": [pickle.dumps(fit_rows(feats, group["lang"].tolist()))]})


def fit(labelled: DataFrame, max_per_lang: int = MAX_PER_LANG) -> Model | None:
    """A model from (doc_id, text, lang) rows with a lang and a text."""
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang", "doc_id")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per label
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, max_per_lang / n))])
    order = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit("sample"))
    unit = F.pmod(order, F.lit(1_000_000)) / F.lit(1_000_000.0)
    kept = rows.withColumn("order", order).filter(unit < F.element_at(share, F.col("lang")))
    schema = StructType([StructField("lang", rows.schema["lang"].dataType),
                         StructField("order", kept.schema["order"].dataType),
                         StructField("at", ArrayType(IntegerType())), StructField("share", ArrayType(FloatType()))])
    once = kept.select("text", "lang", "order").dropDuplicates(["order", "lang"])
    sample = once.mapInPandas(_features, schema).filter(F.size("at") > 0)
    # The sample is bounded, so one task learns from it; only the model comes to the driver.
    trained = sample.groupBy(F.lit("sample")).applyInPandas(_trained, "model binary").first()
    return pickle.loads(trained["model"]) if trained else None


def predict(docs: DataFrame, model: Model | None, reject: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended. With ``reject``, a best
    probability below the calibrated threshold also gives ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x DIM floats: 1 MB
    limit = model.threshold if model is not None and reject else 0.0

    @F.pandas_udf("struct<lang_pred string, score double>")
    def guess(text: pd.Series) -> pd.DataFrame:
        m = shared.value
        rows = [subwords(t) if t is not None and m is not None else ((), ()) for t in text]
        some = [i for i, r in enumerate(rows) if len(r[0])]
        lang, score = np.full(len(rows), UND, object), np.zeros(len(rows))
        if some:
            p = m.probabilities([rows[i] for i in some])
            best, top = p.argmax(axis=1), p.max(axis=1)
            for k, i in enumerate(some):
                score[i] = min(1.0, float(top[k]))
                if top[k] >= limit:
                    lang[i] = m.langs[best[k]]
        return pd.DataFrame({"lang_pred": lang, "score": score})

    out = docs.withColumn("_guess", guess(F.col("text")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_guess.lang_pred").alias("lang_pred"),
                      F.col("_guess.score").alias("score"))


def crc32_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def identify(docs: DataFrame, max_per_lang: int = MAX_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score: fitted on rows not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))), max_per_lang)
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")
