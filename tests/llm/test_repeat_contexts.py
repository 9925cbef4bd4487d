"""Operator 10: only contexts that may hold a repeated string travel."""

import random

import numpy as np

from tonality.llm import repeats


def _text(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def test_short_common_strings_send_no_context(docs, monkeypatch):
    rng = random.Random(3)
    common = [_text(rng, 260) for _ in range(5)]
    rows = [(i, _text(rng, 500) + common[i % 5] + _text(rng, 500), None, None) for i in range(60)]
    rows += [(100 + i, _text(rng, 300) + rows[0][1][300:900] + _text(rng, 300), None, None) for i in range(2)]
    sent, written = {}, repeats.written

    def kept(df, name, *more):
        out = written(df, name, *more)
        if "ctx" in out.columns:
            sent["last"] = out.count()
        return out
    monkeypatch.setattr(repeats, "written", kept)
    got = {r.doc_id: r.n_removed for r in repeats.cut_repeats(docs(rows)).collect()}
    assert [got[d] for d in (0, 100, 101)] == [600, 600, 600] and sum(got.values()) == 1800
    assert sent["last"] <= 12


def test_anchors_found_once_do_not_pass(docs, monkeypatch):
    rng = random.Random(4)
    twice = _text(rng, 40_000)
    rows = [(1, twice, None, None), (2, twice, None, None)] + [(10 + i, _text(rng, 40_000), None, None) for i in range(10)]
    places, written = {}, repeats.written

    def kept(df, name, *more):
        out = written(df, name, *more)
        places[name] = out.count()
        return out
    monkeypatch.setattr(repeats, "written", kept)
    monkeypatch.setattr(repeats, "FILTER_BITS", 1 << 16, raising=False)
    repeats.cut_repeats(docs(rows)).collect()
    once = len(repeats.anchors(np.frombuffer(twice.encode(), np.uint8))[0])
    assert places["places"] < 2.5 * once


def test_suffix_order_of_equal_and_different_symbols():
    rng = np.random.default_rng(5)
    for text in (np.zeros(50, np.int64), rng.integers(0, 3, 4000), rng.integers(0, 1 << 12, 900)):
        text = np.append(text, text.max() + 1)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert repeats.suffix_order(text, len(text)).tolist() == want
