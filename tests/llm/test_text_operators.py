"""Operators 1, 3, 5, 6, 7, 9 and 10 against brute force, with the awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np

from tonality.llm import decontaminate, language, licenses, mix, ngram_join, pii, repeats

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "   ", None, "b"), (None, "some text here now", "en", None),
       (4, "same words here again", "en", "a"), (4, "same words here again", "en", "a"), (5, LONG, "en", "a")]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_mix_budgets_and_reruns(docs):
    rows = ODD + [(i, "word " * (i % 50), "en", "abc"[i % 3]) for i in range(10, 400)]
    out = [tuple(r) for r in mix.mix(docs(rows), rows_per_range=20).collect()]
    assert sorted(out, key=str) == sorted((tuple(r) for r in mix.mix(docs(rows), rows_per_range=20).collect()), key=str)
    assert len(out) == len(rows) and all(t <= 2 * s for _, s, _, _, t in out)
    taken, target = collections.Counter(), {}
    for _, _, source_size, tgt, t in out:
        taken[source_size, tgt] += t
    assert all(abs(t - k[1]) <= 1 for k, t in taken.items())
    total = sum(k[0] for k in taken)
    assert abs(sum(k[1] for k in taken) - 1.5 * total) < 1e-6 * total
    assert mix.mix(docs([])).count() == 0


def test_jaccard_components_equal_brute_force(docs):
    rng = random.Random(3)
    base = [f"v{rng.randrange(400)}" for _ in range(60)]
    texts = []
    for i in range(160):
        words = list(base if i % 2 else [f"u{rng.randrange(90)}" for _ in range(40)])
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(30)}"
        texts.append(" ".join(words))
    rows = ODD + [(100 + i, t, None, None) for i, t in enumerate(texts + texts[:5])] + [(900, "One two", "", ""), (901, "one  TWO", "", "")]

    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0d]+", lower(t))
        return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set())

    sets = {d: grams(t) for d, t, _, _ in rows if d is not None}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    for settings in ({}, {"sample_rate": 1.0, "group": 3}, {"seen": 1}, {"seen": 10**9}):
        out = ngram_join.jaccard_components(docs(rows), **settings).collect()
        assert len(out) == len(rows)
        for r in out:
            if r.doc_id is None:
                assert r.component_id is None
            else:
                assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
    kept = ngram_join.keep_one(docs(rows), n=4, percent=85)
    assert kept.columns == docs([]).columns
    assert {r.doc_id for r in kept.collect()} == {None} | {d for d in sets if find(d) == d}


def test_repeats_equal_brute_force(docs, monkeypatch):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [word(700), word(450), word(380)]
    rows = ODD[:5] + [(i, word(rng.randrange(500)) + rng.choice(shared) + word(rng.randrange(300)), None, None)
                      for i in range(10, 40)] + [(50, "ab" * 700, None, None), (51, word(900), None, None), (51, None, None, None)]
    rows += [rows[-2]]
    count = collections.Counter()
    for _, t, _, _ in rows:
        b = (t or "").encode()
        count.update(b[i:i + 400] for i in range(len(b) - 399))
    want = []
    for d, t, _, _ in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for i in range(len(b) - 399):
            if count[b[i:i + 400]] > 1:
                hit[i:i + 400] = b"\1" * 400
        spans = len(re.findall(b"\1+", bytes(hit)))
        kept = bytes(c for c, h in zip(b, hit) if not h)
        want.append((d, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    for crowd in (3, 1000):
        monkeypatch.setattr(repeats, "CROWD", crowd)
        assert sorted((tuple(r) for r in repeats.cut_repeats(docs(rows)).collect()), key=str) == sorted(want, key=str)
    assert repeats.cut_repeats(docs([])).count() == 0


PLANTED = ("mail a.b@x.example.com or +1 (555) 123-4567, ip 10.0.0.255 not 10.0.0.256, card 4111 1111 1111 1111 "
           "é password=hunter2abc a@b a@b.c_x@d.e 1.2.3.4.5.6.7.8 " + "9" * 300)


def test_pii_base_spans_equal_regex(docs):
    def luhn(v):
        d = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(v))]
        return sum(x - 9 if x > 9 else x for x in d) % 10 == 0
    digits = lambda v: re.sub("[^0-9]", "", v)
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15))
    rows = ODD + [(20, PLANTED, "en", "a"), (21, "1 2 " * 3000, "en", "a"), (22, "0.0.0.00 000.1.2.0255", "en", "a")]
    texts = {d: t for d, t, _, _ in rows}
    for r in pii.find_pii(docs(rows)).collect():
        t = texts[r.doc_id] or ""
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in rules for m in re.finditer(p, t) if ok(m.group())]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) | {""}
    clean = {r.doc_id: r.text for r in pii.redact(docs(rows)).collect()}
    assert "a.b@x.example.com" not in clean[20] and "[email]" in clean[20] and "4111" not in clean[20]
    assert clean[1] is None and clean[5] == LONG and pii.redact(docs([])).count() == 0


def test_license_scan_equals_brute_force(docs):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    rows = ODD + [(30, "All rights reserved. CC-BY cc by, All Rights  Reserved!", "", ""), (31, "é Released under the MIT License.", "", ""),
                  (32, "This work is licensed under the GNU General Public License, version 3.", "", ""), (33, "mit public version", "", "")]
    texts = {d: t for d, t, _, _ in rows}
    out = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    for d, r in out.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(texts[d]))
        at = [(i, lab) for p, lab in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and 0 <= r.score <= 1
    assert out[31].labels == "mit" and out[32].labels == "gpl,gpl-3.0" and out[33].labels == ""


def test_language_held_out_accuracy_and_rejection(docs):
    rng = random.Random(1)
    word = {"en": "the and with this that tion ing".split(), "fr": "le une est dans aux ment eau".split()}
    rows = ODD + [(i, " ".join(rng.choice(word[k]) for _ in range(30)), k, "s") for i in range(100, 300) for k in ("en", "fr")[i % 2:i % 2 + 1]]
    out = {(r.doc_id, r.held_out): r for r in language.identify(docs(rows)).collect()}
    test = [r for (d, h), r in out.items() if h and d is not None and d >= 100]
    assert sum(r.lang_pred == ("en", "fr")[r.doc_id % 2] for r in test) >= 0.95 * len(test) > 0
    assert out[1, language.crc32_of(1) % 3 == 1].lang_pred == "und"
    assert language.identify(docs([])).count() == 0
    assert {r.lang_pred for r in language.identify(docs([(1, "abc", None, None)])).collect()} == {"und"}


def test_decontamination_finds_exact_and_edited_passages(spark, docs):
    rng = random.Random(2)
    text = lambda n: " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(30)) for i in range(5)] + [(8, None), (9, "")]
    edited = items[1][1].split()
    for i in (6, 15, 24):
        edited[i] = "changed"
    rows = ODD + [(50, f"{text(80)} {items[0][1].upper()} {text(50)}", "", ""), (51, f"{text(9)} {' '.join(edited)}", "", ""),
                  (52, text(300), "", "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert set(out) == {(50, 0), (51, 1)} and out[50, 0] == 1.0 and out[51, 1] < 1.0
    assert decontaminate.contaminated(docs([]), bench).count() == 0
    assert decontaminate.contaminated(docs(rows), bench.filter("false")).count() == 0


def test_decontamination_keeps_edited_copies_beside_exact_ones(spark, docs):
    rng = random.Random(8)
    text = lambda n: " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(30)) for i in range(4)]
    rows, want = [], set()
    for i, t in items:
        edited = t.split()
        edited[14] = "changed"
        rows += [(100 + i, f"{text(60)} {t} {text(60)}", "", "")]
        rows += [(1000 + 10 * i + k, f"{text(60)} {' '.join(edited)} {text(60)}", "", "") for k in range(1 + 5 * (i % 2))]
        want |= {(100 + i, i)} | {(1000 + 10 * i + k, i) for k in range(1 + 5 * (i % 2))}
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert set(out) == want and all(v > 0.9 for v in out.values())
    codes = [np.array([rng.randrange(9) for _ in range(n)], np.uint64) for n in (3, 8, 20, 40) for _ in range(20)]
    assert all(decontaminate.align(a, b)[0] <= decontaminate.most_score(a, b) + 1e-12 for a in codes for b in codes)


def test_pii_finds_assigned_secrets_and_handles(docs):
    hexes = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"
    found = {60: f'token = "{hexes}"', 61: "password: 'correct horse'", 62: '"api_key": "abcdefgh"', 63: f"see {hexes} there",
             64: "write to @jane_doe92 soon", 65: "contact @janedoe now", 66: "PASSWORD = swordfish", 67: "pwd=hunter2abc"}
    plain = {70: "The key: nobody knows it", 71: "see @override there", 72: "my-long-chapter-title-2024 ends", 73: "token of thanks"}
    rows = [(d, f"é {t} x", "en", "a") for d, t in {**found, **plain}.items()]
    rows += [(100 + i, f"line @override {i}", "en", "a") for i in range(300)]
    clean = {r.doc_id: r.text for r in pii.redact(docs(rows)).collect()}
    assert all(clean[d] == f"é {t} x" for d, t in plain.items())
    assert clean[60] == "é [secret] x" and clean[61] == "é [secret] x" and clean[62] == 'é "[secret] x' and clean[63] == "é see [secret] there x"
    assert clean[64] == "é write to [handle] soon x" and clean[65] == "é contact [handle] now x"
    assert clean[66] == clean[67] == "é [secret] x" and clean[120] == "line @override 20"
    assert "secret:2:52" in {r.doc_id: r.spans for r in pii.find_pii(docs(rows)).collect()}[60]


def test_language_sample_takes_repeated_rows_once_and_rows_without_id_by_text(docs):
    rows = [(None, f"uno dos tres {k}", "es", None) for k in range(60)] + [(None, "one two three", "en", None)] * 500
    fitted = language.fit(docs(rows), max_per_lang=10_000)
    assert fitted.langs == ["en", "es"]
    assert fitted.probabilities([language.subwords("uno dos tres")])[0].argmax() == 1
    again = language.fit(docs(rows[::-1]).repartition(5), max_per_lang=10_000)
    assert (fitted.emb == again.emb).all() and fitted.threshold == again.threshold
