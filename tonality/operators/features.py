"""Term features in term space (readable, exact) and hashed space (MLlib).

Term space: ``term_frequency`` (doc, term, tf), ``document_frequency``
(term, df), ``inverse_document_frequency`` (term, df, idf) and ``tfidf``.
All aggregations are ``groupBy`` with map-side partial aggregation, so a
term present in every document still ships one row per task.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.fixed import IDF_MIN_DOC_FREQ
from tonality.functions.arrays import explode_values
from tonality.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small, salted_join
from tonality.session import checkpoint_dir

TFIDF_SALT_BUCKETS = 16


def term_frequency(df: DataFrame, doc_col: str, tokens_col: str) -> DataFrame:
    """(doc, term, tf): occurrences of each term in each document."""
    terms = explode_values(df, F.col(tokens_col), [doc_col], "term")
    return terms.groupBy(doc_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(df: DataFrame, tokens_col: str) -> DataFrame:
    """(term, df): number of documents (rows) containing each term."""
    terms = explode_values(df, F.array_distinct(F.col(tokens_col)), [], "term")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_weight(doc_freq: Column, n_docs: int, min_doc_freq: int = IDF_MIN_DOC_FREQ) -> Column:
    """MLlib's weight: ln((N + 1) / (df + 1)), 0 for terms in fewer than
    ``min_doc_freq`` documents."""
    weight = F.log((F.lit(float(n_docs)) + 1.0) / (doc_freq.cast("double") + 1.0))
    return F.when(doc_freq >= min_doc_freq, weight).otherwise(F.lit(0.0))


def inverse_document_frequency(doc_freq: DataFrame, n_docs: int,
                               min_doc_freq: int = IDF_MIN_DOC_FREQ) -> DataFrame:
    """(term, df, idf). ``n_docs`` is the number of documents the counts came from."""
    return doc_freq.withColumn("idf", idf_weight(F.col("df"), n_docs, min_doc_freq))


def tfidf(tf: DataFrame, idf: DataFrame, doc_col: str,
          max_broadcast_rows: int = MAX_BROADCAST_ROWS,
          salt_buckets: int = TFIDF_SALT_BUCKETS) -> DataFrame:
    """(doc, term, tf, idf, tfidf). The IDF table is checkpointed (it is read
    twice: size check and join). A vocabulary of proven small size is
    broadcast; a larger one is joined with salt, since a common term holds a
    row for almost every document."""
    checkpoint_dir(idf.sparkSession)      # the session's shared folder (set if unset)
    idf = idf.select("term", "idf").checkpoint()
    side, small = broadcast_if_small(idf, max_broadcast_rows)
    if small:
        joined = tf.join(side, "term")
    else:
        joined = salted_join(tf, idf, "term", doc_col, salt_buckets)
    return joined.select(doc_col, "term", "tf", "idf",
                         (F.col("tf").cast("double") * F.col("idf")).alias("tfidf"))


def hashed_term_frequency(df: DataFrame, tokens_col: str, out_col: str = "hashing",
                          num_features: int = 1 << 18) -> DataFrame:
    """MLlib ``HashingTF`` (murmur3 buckets, counts, not binary)."""
    return HashingTF(inputCol=tokens_col, outputCol=out_col,
                     numFeatures=num_features).transform(df)


def vector_total(vec: Column) -> Column:
    """Sum of a vector's values (dense view; use with small ``num_features``)."""
    return F.aggregate(vector_to_array(vec), F.lit(0.0), lambda acc, x: acc + x)
