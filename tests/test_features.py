from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from tonality.operators.features import (document_frequency, inverse_document_frequency,
                                         term_frequency, tfidf)
from tonality.plans.checks import kept_tokens

from paths import SF_SMALL


def test_term_space_idf_equals_mllib_idf(spark):
    toks = kept_tokens(spark, SF_SMALL).cache()
    n = toks.count()
    idf = {r.term: (r.df, r.idf) for r in
           inverse_document_frequency(document_frequency(toks, "tokens"), n).collect()}
    htf = HashingTF(inputCol="tokens", outputCol="h", numFeatures=1 << 18)
    model = IDF(inputCol="h", outputCol="x", minDocFreq=5).fit(htf.transform(toks))
    weights = model.idf.toArray()
    # bucket of every term: HashingTF over one-term documents (one Spark job)
    terms = spark.createDataFrame([([t],) for t in idf], "tokens array<string>")
    one = HashingTF(inputCol="tokens", outputCol="h", numFeatures=1 << 18).transform(terms)
    buckets = {}
    for r in one.collect():
        buckets.setdefault(int(r.h.indices[0]), []).append(r.tokens[0])
    checked = 0
    for b, terms in buckets.items():
        if len(terms) == 1:
            assert abs(weights[b] - idf[terms[0]][1]) < 1e-12, terms[0]
            checked += 1
    assert checked > 1000
    assert any(df >= 5 for df, _ in idf.values()) and any(w == 0.0 for _, w in idf.values())


def test_tf_totals_and_tfidf_join(spark):
    toks = kept_tokens(spark, SF_SMALL)
    tf = term_frequency(toks, "doc_id", "tokens")
    per_doc = {r.doc_id: r.s for r in tf.groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()}
    sizes = {r.doc_id: r.n for r in toks.select("doc_id", F.size("tokens").alias("n")).collect()}
    assert all(per_doc.get(d, 0) == n for d, n in sizes.items())
    idf = inverse_document_frequency(document_frequency(toks, "tokens"), toks.count())
    a = {(r.doc_id, r.term): r.tfidf for r in tfidf(tf, idf, "doc_id").collect()}
    b = {(r.doc_id, r.term): r.tfidf for r in
         tfidf(tf, idf, "doc_id", max_broadcast_rows=1, salt_buckets=4).collect()}
    assert a == b and len(a) == tf.count()
