"""The driver contract: every exact check agrees with its DuckDB twin (sf0.001)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod

from paths import SF_SMALL

SURVEY_EXACT = ("scan_reviews_json parse_score_lines scores_roundtrip project_reviews unquote_lines "
                "drop_header drop_first_lines label_three_class label_binary label_raw join_scores split_by_key split_exact tokenize "
                "stop_words_default stop_words_custom hashed_tf_totals term_frequency document_frequency "
                "inverse_document_frequency tfidf_terms sentences_exploded lexicon_sentence "
                "sentences_learned lexicon_doc_mean lexicon_phrases metrics_micro metrics_weighted confusion_matrix binary_counts paired_interval").split()
SURVEY_PROPERTY = ("split_random assembled_features lr_predict lr_with_lexicon model_roundtrip "
                   "ablation_report ablation_interval run_report stream_score_reviews stream_batches").split()


def test_registered_keys():
    q, sql = entry_mod.queries(), entry_mod.oracle_sql()
    llm = entry_mod.llm_queries
    assert set(q) == set(SURVEY_EXACT) | set(SURVEY_PROPERTY) | set(llm.QUERIES if llm else ())
    assert set(sql) == set(SURVEY_EXACT) | set(llm.ORACLE_SQL if llm else ())


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0) if not math.isnan(v) else "nan"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows))
                        .encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SURVEY_EXACT)
def test_exact_check_matches_duckdb(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and 0.0 <= rows[0].accuracy <= 1.0
