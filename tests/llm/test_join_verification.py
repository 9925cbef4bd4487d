"""Operator 9's verification streams sorted rows: a group may span batches, and several share one."""

import pandas as pd
import zstandard

from tonality.llm import ngram_join


def test_groups_are_verified_across_batches():
    words = [f"w{i}" for i in range(60)]
    near, far = words[:-1] + ["x"], [f"f{i}" for i in range(60)]
    rows = [(1, 0, 1, words), (1, 0, 2, near), (1, 0, 3, far), (1, 0, 4, words), (1, 1, 1, words), (1, 1, 5, near),
            (3, 0, 3, far), (3, 0, 3, words), (3, 0, 6, near), (3, 0, 7, far), (3, 0, 8, words[:20])]
    rows = [(a, part, b, zstandard.ZstdCompressor().compress(" ".join(t).encode())) for a, part, b, t in rows]
    frame = pd.DataFrame(rows, columns=["a", "part", "id", "packed"])
    for size in (1, 3, len(rows)):
        batches = (frame.iloc[at:at + size].reset_index(drop=True) for at in range(0, len(frame), size))
        found = pd.concat(list(ngram_join._linked(4, 85)(batches)))
        assert list(found.itertuples(index=False, name=None)) == [(1, 2), (1, 4), (1, 5), (3, 6), (3, 7)]


def test_frequent_tokens_are_counted_over_all_documents(docs, monkeypatch):
    # Tokens in just `seen` of 300 documents: a sample would miss most of them.
    monkeypatch.setattr(ngram_join, "RUN_TOKENS", 40)
    monkeypatch.setattr(ngram_join, "BUCKET_TOKENS", 64)
    rows = [(i, f"own{i} a{i} b{i} c{i} d{i} shared{i % 100} x y z", None, None) for i in range(300)]
    table = docs(rows + [(None, None, None, None), (900, "", None, None)])
    flags = ngram_join.frequent_tokens(table, 4, 3)
    often = [ngram_join.shingle_set(f"shared{k} x y z") for k in range(100)]
    rare = [ngram_join.shingle_set(f"own{i} a{i} b{i} c{i} d{i}") for i in range(300)]
    assert all(ngram_join.passes(flags, s).all() for s in often)
    assert sum(int(ngram_join.passes(flags, s).sum()) for s in rare) < 20
    assert not ngram_join.frequent_tokens(table, 4, 4).any()
    assert not ngram_join.frequent_tokens(docs([]), 4, 1).any()
