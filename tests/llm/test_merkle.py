"""Operator 12 against a plain recursive tree, in every odd case."""

import hashlib
import zlib

import pytest

from tonality.llm import merkle


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text=...):
    doc_id, body, lang, source, n_chars = row
    parts = [doc_id, source, lang, n_chars, body if text is ... else text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def tree(nodes):
    """Root, and per start node its (place, run) up to the root."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for i, a in enumerate(at):
            paths[i].append((a % 16, runs[a // 16]))
            at[i] = a // 16
        nodes = [h("".join(r)) for r in runs]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: b"" if s is None else b"s" + s.encode())
    built = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[s] = tree([leaf(r) for r in groups[s]])
    root, tops = tree([built[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(groups[s], built[s][1]):
            steps = path + top
            proof = "".join(d for p, run in steps for d in run[:p] + run[p + 1:])
            tampered = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            low = r[1] and "".join(c.lower() if c.isascii() else c for c in r[1])
            node = leaf(r, low) if tampered else leaf(r)
            for p, run in steps:
                node = h("".join(run[:p]) + node + "".join(run[p + 1:]))
            out.append((r[0], leaf(r), built[s][0], root, h(proof), node, node == root))
    return sorted(out, key=str)


CASES = {
    "odd": [(None, "Null id", "en", "a"), (None, None, None, None), (1, "", "en", "a"), (2, "É A", None, "a"),
            (2, "É A", None, "a"), (2, "Zz", "de", "a"), (-7, "X" * 100_000, "en", None), (10**15, "lone", "fr", "ü b"), (9, "q", "fr", "")],
    "sizes": [(i, f"Text {i}", "en", "one") for i in range(16)] + [(100 + i, f"T{i}", "en", "two") for i in range(17)]
             + [(200 + i, f"T{i}", "en", "three") for i in range(257)],
    "many_sources": [(i, f"A{i}", "en", f"s{i % 300}") for i in range(600)],
    "blocks": [(i * 3, f"Body {i}", "en", "hot") for i in range(4096 * 2 + 5)] + [(7, "same", "en", "cold")] * 40,
}


@pytest.mark.parametrize("name", CASES)
def test_manifest_equals_recursive_tree(docs, name):
    rows = CASES[name]
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    got = merkle.document_manifest(docs(rows).repartition(5))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(full)


def test_empty_table(docs):
    assert merkle.document_manifest(docs([])).collect() == []


def test_fields_are_told_apart(docs):
    """Lengths keep values from running into each other, and null from a dash."""
    got = merkle.document_manifest(docs([(1, "a", "b1:c", "s"), (1, "a1:b", "c", "s"), (1, "-", None, "s"), (1, None, "-", "s")]))
    assert len({r.leaf for r in got.collect()}) == 4
