"""Operator 13 against all windows compared word by word."""

import hashlib
import random
import re
import tracemalloc

import pytest

from tonality.llm import rolling
from tonality.llm import substring_dedup as sd


def brute(rows, window=13):
    texts = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    least = {}
    for doc, ws in texts:
        for i in range(len(ws) - window + 1 if doc is not None else 0):
            s = tuple(ws[i:i + window])
            least[s] = min(least.get(s, doc), doc)
    out = []
    for doc, ws in texts:
        cut = set()
        for i in range(len(ws) - window + 1 if doc is not None else 0):
            if least[tuple(ws[i:i + window])] < doc:
                cut.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in cut)
        out.append((doc, len(ws), len(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))


def rows_of(seed):
    rng = random.Random(seed)
    passage, edge = words(rng, 60), words(rng, 13)
    rows = [(i, words(rng, rng.randrange(1, 90)), "en", "s") for i in range(40)]
    rows += [(100 + i, f"{words(rng, 7)}\t{passage}\n {words(rng, 5)}", "en", "s") for i in range(30)]     # hot passage
    rows += [(200, passage.replace(" ", "  "), "en", "s"), (201, edge, "en", "s"), (202, "x " + edge + " x", "en", "s")]
    rows += [(203, " ".join(edge.split()[:12]), "en", "s"), (204, edge.upper(), "en", "s")]                # too short; other words
    rows += [(205, "a " * 500, "en", "s"), (206, "a " * 40, "en", "s"), (207, None, "en", "s"), (208, "", "en", "s"), (209, " \n", "en", "s")]
    rows += [(None, passage, "en", "s"), (None, None, "en", "s"), (None, edge, "en", "s")]
    rows += [(210, passage, "en", "s")] * 5 + [(210, edge + " " + passage, "en", "s"), (-3, passage + " tail", "en", "s")]
    rows += [(300, words(rng, 30_000), "en", "s"), (2**61, words(rng, 3) + "\x0b" + passage, "en", "s")]
    return rows


@pytest.mark.parametrize("settings", [{}, {"bucket_words": 2000}, {"bucket_words": 500, "fanout": 4}])
def test_equals_brute_force(docs, monkeypatch, settings):
    rows = rows_of(5)
    got = sd.remove_repeats(docs(rows).repartition(6), **settings).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_spans_are_maximal_runs(docs):
    rng = random.Random(1)
    p = words(rng, 20)
    out = sd.remove_repeats(docs([(1, p, "en", "s"), (2, f"one {p} two three {p}", "en", "s")])).filter("doc_id = 2").first()
    assert (list(out.span_starts), list(out.span_ends)) == ([1, 23], [21, 43])


def test_empty_table(docs):
    assert sd.remove_repeats(docs([])).collect() == []


def test_rounds_cover_the_buckets():
    assert sd.rounds(0) == [1] and sd.rounds(70) == [70] and sd.rounds(5000) == [1024, 5]
    assert sd.rounds(10**7) == [1024, 1024, 10]


def test_slices_do_not_change_codes(monkeypatch):
    import numpy as np
    raw = np.frombuffer(words(random.Random(3), 500).encode(), np.uint8)
    first, after = rolling.words(raw)
    whole = rolling.word_codes(raw, first, after)
    monkeypatch.setattr(rolling, "SLICE_BYTES", 16)
    assert (rolling.word_codes(raw, first, after) == whole).all() and len(set(whole.tolist())) == len({bytes(raw[a:b]) for a, b in zip(first, after)})


def test_a_chunk_takes_bounded_memory():
    rng = random.Random(5)
    text = words(rng, sd.CHUNK_WORDS).encode()
    rolling._POWERS.clear()
    tracemalloc.start()
    found = sd.chunk_windows([text], 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[0]) == sd.CHUNK_WORDS - 12 and peak < 90e6
