"""Operator 11 against plain counting of every phrase."""

import random
import re
from collections import Counter

import pytest

from tonality.llm import collocations as co


def brute(rows, min_count, top=2000):
    f, n = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                f.setdefault((lang, k), Counter()).update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    count = {(lang, p): c for (lang, _), held in f.items() for p, c in held.items()}
    cands = {(lang, p): c for (lang, p), c in count.items() if len(p) > 1 and c >= min_count}
    dropped = {(lang, p[i:j]) for (lang, p), c in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and 100 * c >= 100 * cands.get((lang, p[i:j]), 10**18)}
    out = {}
    for (lang, p), a in cands.items():
        if (lang, p) in dropped:
            continue
        cuts = [(1000 * a * n[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]])
                for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, held in out.items() for i, (s, a, p, left, right) in enumerate(sorted(held)[:top]))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "New", "york", "CITY", "straße", "Éa", "a", "\x1cb", "b\xa0c", "\x00z"]
    rows = []
    for i in range(150):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for w in ws)
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "s"))
    rows += [(200 + i, "New York city of the north and of the south pole is here", "en", "s") for i in range(30)]   # a repeated passage
    rows += [(300, "one " * 3000, "en", "s"), (301, None, "en", "s"), (302, "", None, "s"), (303, " ,.\n", "fr", "s"), (None, "the of the of", "", "s")]
    return rows


@pytest.mark.parametrize("min_count,top", [(5, 2000), (20, 2000), (5, 7)])
def test_equals_plain_counting(docs, min_count, top):
    rows = corpus(8)
    got = co.collocations(docs(rows).repartition(4), min_count=min_count, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_count, top)


def test_parse_covers_every_phrase_once():
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefgh") for _ in range(5000))
    chunks, owned, of = co.chunks_of([text.encode(), b"", b"x, y"])
    assert len(chunks) > 100 and set(of.tolist()) == {0, 2} and owned.sum() == 5002
    count = Counter()
    for chunk, own in zip(chunks, owned.tolist()):
        ws = chunk.decode().split(" ")
        count.update(tuple(ws[i:i + k]) for i in range(own) for k in range(1, 6) if i + k <= len(ws))
    ws = text.split(" ")
    want = Counter(tuple(ws[i:i + k]) for k in range(1, 6) for i in range(len(ws) - k + 1))
    want.update([("x",), ("y",)])
    assert count == want


def test_scores_are_exact_beyond_64_bits(spark):
    """1000 * a * n is about 1e29 here."""
    row = spark.sql("SELECT cast(3000000000001 as bigint) a, cast(30000000000000007 as bigint) n, cast(3000000000003 as bigint) l, "
                    "cast(5000000000000 as bigint) r")
    whole = {c: f"cast({c} as decimal(20,0))" for c in "alrn"}
    got = row.selectExpr(f"(1000 * {whole['a']} * {whole['n']}) div ({whole['l']} * {whole['r']}) as s").first().s
    assert got == 1000 * 3000000000001 * 30000000000000007 // (3000000000003 * 5000000000000)


def test_empty_table(docs):
    assert co.collocations(docs([])).collect() == []
