"""Operator 9: a large group of near copies is compared with its centre, not with all that resemble it."""

import random

import numpy as np

from tonality.llm import ngram_join


def _brute(texts, n, percent):
    sets = {d: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for d, w in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(texts)
    for i, x in enumerate(ids):
        for y in ids[i + 1:]:
            both = len(sets[x] & sets[y])
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                u, v = sorted((find(x), find(y)))
                root[v] = u
    return {d: find(d) for d in ids}


def _rows(rng, linked, apart):
    base = [f"w{i}" for i in range(100)]

    def edited(edits, common=()):
        w = list(base)
        for k, at in enumerate([*common, *rng.sample(range(0, 100, 7), edits)]):
            w[at] = f"c{at}" if k < len(common) else f"e{rng.random()}"
        return w
    texts = {i: edited(rng.choice((1, 1, 2))) for i in range(linked)}
    # Too far from the centre, in part linked by edits they have in common with one that is not.
    texts |= {1000 + i: edited(5) for i in range(apart)}
    shared = (3, 24, 45)
    texts |= {2000: edited(0, (3,)), 2001: edited(0, (3, 24)), 2002: edited(0, shared), 2003: edited(1, (*shared, 66)), 2004: edited(2, (*shared, 66))}
    order = list(texts)
    rng.shuffle(order)
    return {d: texts[k] for d, k in enumerate(order)}


def test_group_and_what_resembles_it(docs, monkeypatch):
    texts = _rows(random.Random(8), 120, 40)
    made, written = {}, ngram_join.written

    def kept(df, name, *more):
        out = written(df, name, *more)
        if name == "across-pairs":
            made[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join, "written", kept)
    rows = [(d, " ".join(w), None, None) for d, w in texts.items()]
    for n, percent in ((4, 80), (3, 85)):
        out = ngram_join.jaccard_components(docs(rows).repartition(4), n, percent, seen=6)
        assert {r.doc_id: r.component_id for r in out.collect()} == _brute(texts, n, percent)
        if percent == 80:
            assert made["across-pairs"] < 2000  # 40 * 120 if every pair were made


def test_difference_loses_no_link():
    rng = np.random.default_rng(9)
    for percent in (55, 80, 85):
        met = 0
        for _ in range(300):
            centre = np.unique(rng.integers(0, 1 << 40, 60).astype(np.uint64))
            pool = rng.integers(0, 1 << 40, 8).astype(np.uint64)
            near = []
            for _ in range(2):
                out = rng.random(len(centre)) < rng.choice((0.02, 0.1, 0.2))
                near.append(np.unique(np.concatenate((centre[~out], pool[rng.random(8) < 0.6]))))
            (lx, dx, mx), (ly, dy, my) = (ngram_join.difference(s, centre, percent) for s in near)
            both = ngram_join.shared(*near)
            if not ly and both * (100 + percent) >= sum(map(len, near)) * percent:
                met += 1
                assert not lx and not len(dx) or not len(dy) or set(dx[:mx].tolist()) & set(dy.tolist())
                assert not lx or len(dy)
        assert met or percent == 55
