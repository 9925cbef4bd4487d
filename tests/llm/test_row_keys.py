"""The pipeline's rows without doc_id and repeated rows."""

import collections
import random

import corpus_pipeline
from tonality.llm import ngram_join


def test_keep_one_keeps_single_rows(docs):
    a, b = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    rows = [(7, a, "en", "s"), (7, a, "en", "s"), (9, a, "en", "s"), (None, a, "en", "s"), (None, b, "en", "s"), (None, b, "en", "s"),
            (3, "", "en", "s"), (3, "", "en", "s"), (3, None, "en", "s"), (4, "", "en", "s"), (None, "", "en", "s"), (None, None, "en", "s")]
    out = ngram_join.keep_one(docs(rows), n=5, percent=80)
    assert out.columns == docs([]).columns
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == collections.Counter(
        [(7, a), (None, b), (3, ""), (3, None), (4, ""), (None, ""), (None, None)])


def test_contaminated_rows_without_doc_id_go(spark, docs, tmp_path):
    rng = random.Random(9)
    text = lambda n: " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    passage, clean = text(30), text(60)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"{text(20)} {passage}", "en", "a"), (None, clean, "en", "a"), (1, f"{passage} {text(9)}", "en", "a"), (2, clean, "en", "a"),
            (None, None, "en", "a")]
    out = corpus_pipeline.decontamination_stage(spark, docs(rows), str(tmp_path))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(None, clean), (2, clean), (None, None)], key=str)
