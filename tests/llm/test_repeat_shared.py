"""Operator 10: passages too short to be cut are told by ``n_shared``."""

import random

import numpy as np
import pytest

from tonality.llm import repeats


def _text(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n))


def test_shared_passages_below_400_bytes(docs):
    rng = random.Random(7)
    passage = _text(rng, 300)
    rows = [(i, _text(rng, 400) + passage + _text(rng, 100 * i), None, None) for i in range(3)]
    rows += [(10 + i, _text(rng, 800), None, None) for i in range(5)]
    rows += [(20, passage[20:280], None, None), (21, passage[:120], None, None), (22, None, None, None)]
    own = _text(rng, 300)
    rows += [(30, own + _text(rng, 200) + own, None, None)]  # repeats in one row only
    rows += [(None, rows[3][1][:500], None, None)] * 2
    got = repeats.cut_repeats(docs(rows).repartition(5), shared=True)
    plain = repeats.cut_repeats(docs(rows))
    assert plain.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and got.columns == [*plain.columns, "n_shared"]
    assert sorted(map(str, got.drop("n_shared").collect())) == sorted(map(str, plain.collect()))
    out = {r.doc_id: (r.n_removed, r.n_shared) for r in got.collect()}
    assert all(out[i][0] == 0 and out[i][1] > 0 for i in (0, 1, 2, 20))
    assert all(out[i] == (0, 0) for i in (11, 12, 13, 14, 21, 22, 30))
    assert out[10][0] == 500 and out[10][1] > 0 and out[None][1] > 0


@pytest.mark.parametrize("n", [0, 127, 239, 240, 241, 399, 400, 401, 5000])
@pytest.mark.parametrize("step", [1 << 22, 700])
def test_anchors_of_both_windows(n, step, monkeypatch):
    monkeypatch.setattr(repeats, "STEP", step)
    data = np.random.default_rng(n).integers(97, 100, n).astype(np.uint8)
    h = repeats.gram_hashes(data, 128) if n >= 128 else np.zeros(0, np.uint64)
    low = (h >> np.uint64(24)).tolist()

    def picked(window):
        return [min(range(i, i + window - 127), key=lambda x: (low[x], x)) for i in range(n - window + 1)]
    found, once = repeats.scanned(data, 400, True)
    assert once.tolist() == sorted(set(h[picked(240)].tolist()))
    at = np.concatenate([np.zeros(0, np.int64), *(np.full(b - a, p) for p, a, b in zip(*found[1:]))])
    assert at.tolist() == picked(400)
    assert all(x.tolist() == y.tolist() for x, y in zip(found, repeats.anchors(data)))
