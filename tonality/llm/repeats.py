"""Removing long repeated byte strings with a run-length suffix index.

Every ``LENGTH``-byte window picks an anchor: its smallest hash of ``gram_of(LENGTH)``
bytes (about a third of the window, so that chance matches are rare), leftmost on ties. Equal windows pick equal anchors, so a window can repeat only
among windows with the same anchor hash.

1. Anchor hashes are counted; those found twice or more set bits of a filter. An anchor is a
   smallest hash, so its upper bits are nearly always zero; filters take their slots from the lower ones.
2. For every anchor that passes, a task writes out where its run of windows lies and
   a digest of the bytes it covers, its context. No window lies in two contexts. Equal
   contexts count as one; where the count is two or more all its windows repeat.
3. Anchors with several different contexts are read again with their bytes, once
   each. The room of a window beside its anchor is dealt into ``ROOMS`` classes; all windows of a class
   hold one stretch of bytes around the anchor, its key. A window repeats only where its key is found in
   another context, so each context is trimmed to the classes whose key is, and dropped without any.
   The rest go in shards by anchor hash, about ``SHARD`` contexts each. A shard's texts are sorted into a suffix array, giving a Burrows-Wheeler transform; only at the
   heads and tails of its runs are common lengths with the neighbouring suffix
   computed, and a text-order pass streams the matching statistics of all
   other positions from them (a length shrinks by one per step inside a run).
4. An anchor with more than ``CROWD`` different contexts would make one shard large.
   Its windows are counted by hash instead, spread over all tasks, and hashes found
   twice set bits of a filter. A window that passes repeats, unless a hash found once
   has the same bit; only windows at such bits become rows, for an exact join.
5. Windows found to repeat become byte ranges per document, merged and cut out.
6. On demand ``n_shared`` tells of shorter strings that different rows share; it cuts nothing. Every window of
   ``passage_of(LENGTH)`` (240) bytes picks an anchor of its own, a string of 128 bytes, and ``n_shared`` is how many
   different ones another row has picked too (by 64-bit hash): at least 1 where a row shares 240 bytes with another row, 0 where it shares
   no 128. Hashes found in two rows set bits of a filter; the rows' hashes that pass are joined with them.

Defined results: null text has no bytes; texts under ``LENGTH`` bytes keep
all; repeated rows are repeats of each other; a null doc_id is a row like any other;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import written
from tonality.llm.rolling import BASE, BYTE_CODES, SLICE_BYTES, bit_filter, mix64, passes, powers, prefix_sums

LENGTH = 400
ROOMS = 8
# Bits of the filters that decide whether bytes travel: one key in 64 that should not passes.
BYTES_FILTER_BITS = 64
SHARD = 1500
CROWD = 1000
STEP = 1 << 22
YIELD = 4000
# Suffixes compared at a time; their arrays take about 800 bytes each.
COMPARED = 1 << 14


def _u64(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def gram_of(length: int) -> int:
    """Bytes of an anchor: the largest power of two up to a third of the window."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """uint64 hash of the ``gram`` bytes from each position (a power of two)."""
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while width < gram:
            h = h[:-width] * _u64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
            h ^= h >> np.uint64(32)
            width *= 2
        return h * _u64(0xD6E8FEB86659FD93)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """uint64 hash of the ``length`` bytes from each position: a power of two from
    either end."""
    width = 1 << (length.bit_length() - 1)
    h = gram_hashes(data, width)
    n = len(data) - length + 1
    with np.errstate(over="ignore"):
        x = h[:n] * _u64(0xBF58476D1CE4E5B9) + h[length - width: length - width + n]
    return x ^ (x >> np.uint64(29))


def passage_of(length: int) -> int:
    """Bytes of a passage for ``n_shared``."""
    return length * 3 // 5


def _smallest(h: np.ndarray, needs: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For every one of ``needs`` (ascending): the place of the smallest of that many hashes from each place on,
    leftmost on ties."""
    # 40 bits of hash, then the position: the smallest is leftmost on ties.
    low, have = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64), 1
    for need in needs:
        while have * 2 <= need and have < len(low):
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        at = low[: max(0, len(h) - need + 1)]
        if have < need:
            at = np.minimum(at, low[need - have:][:len(at)])
        yield (at & np.uint64((1 << 24) - 1)).astype(np.int64)


def scanned(data: np.ndarray, length: int, shared: bool) -> tuple[tuple, np.ndarray]:
    """``anchors`` of a text, and if ``shared`` the different hashes of the anchors of its passages: the smallest
    hash in each window of ``passage_of(length)`` bytes."""
    hs, ps, los, his, found, gram = [], [], [], [], [np.zeros(0, np.uint64)], gram_of(length)
    needs = (passage_of(length) - gram + 1, length - gram + 1) if shared else (length - gram + 1,)
    for base in range(0, max(0, len(data) - (needs[0] + gram - 1) + 1), STEP):
        part = data[base: base + STEP + length - 1]
        h = gram_hashes(part, gram)
        *passages, at = _smallest(h, needs)
        found += [h[p[np.concatenate(([True], p[1:] != p[:-1]))]] for p in passages]
        if not len(at):
            continue
        start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        hs.append(h[at[start]])
        ps.append(at[start] + base)
        los.append(start + base)
        his.append(np.append(start[1:], len(at)) + base)
    once = np.unique(np.concatenate(found))
    if not hs:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3), once
    return tuple(map(np.concatenate, (hs, ps, los, his))), once


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, window after the last) of each anchor of a text."""
    return scanned(data, length, False)[0]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass") if text else b"", np.uint8)


def _count_anchors(length: int, shared: bool):
    """(h, passage, c): how often an anchor's hash was found, or in how many rows a passage's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [scanned(_bytes(t), length, shared) for t in b["text"]]
            for passage, hashes in ((False, [x[0] for x, _ in found]), (True, [x for _, x in found])):
                h, c = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "passage": passage, "c": c.astype(np.int64)})
    return run


def digest(ctx: bytes) -> int:
    """64 bits; contexts are told apart by these and their anchor's 64 bits."""
    return int.from_bytes(hashlib.blake2b(ctx, digest_size=8).digest(), "little", signed=True)


# Bits of an anchor's hash for the second filter, apart from those of the first.
AGAIN = 27


def _passing(bits, text: str | None, length: int, again):
    """(bytes, hash, position, first window, window after the last) of the anchors that pass."""
    data = _bytes(text)
    h, p, lo, hi = anchors(data, length)
    take = passes(bits.value, h) & passes(again.value, h >> np.uint64(AGAIN))
    return data.tobytes(), h[take].view(np.int64).tolist(), *[x[take].tolist() for x in (p, lo, hi)]


def _places(bits, passages, length: int):
    """A row per anchor that passes; with ``passages`` a row without windows (n = 0) per text whose passages' hashes pass."""
    columns = ["doc_key", "h", "lo", "n", "ch", "shared"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_key"], b["text"]):
                raw = _bytes(text)
                found, once = scanned(raw, length, passages is not None)
                if passages is not None and len(once := once[passes(passages.value, once)]):
                    rows.append((doc, 0, 0, 0, 0, once.view(np.int64)))
                take = passes(bits.value, found[0])
                data = raw.tobytes()
                for h, lo, hi in zip(found[0][take].view(np.int64).tolist(), found[2][take].tolist(), found[3][take].tolist()):
                    rows.append((doc, h, lo, hi - lo, digest(data[lo: hi + length - 1]), None))
                    if len(rows) >= YIELD:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)
    return run


def _contexts(bits, again, length: int):
    """The contexts of the anchors that pass, with the anchor's place, each once per batch of output."""
    columns = ["h", "ch", "at", "ctx"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = {}
            for text in b["text"]:
                data, hs, ps, los, his = _passing(bits, text, length, again)
                for h, p, lo, hi in zip(hs, ps, los, his):
                    ctx = data[lo: hi + length - 1]
                    rows[h, digest(ctx)] = p - lo, ctx
                    if len(rows) >= YIELD:
                        yield pd.DataFrame([(*k, *c) for k, c in rows.items()], columns=columns)
                        rows = {}
            if rows:
                yield pd.DataFrame([(*k, *c) for k, c in rows.items()], columns=columns)
    return run


def class_width(length: int) -> int:
    return -(-(length - gram_of(length) + 1) // ROOMS)


def class_keys(at: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, held), a row per context and a column per class: the hash of the bytes that all windows
    of a class hold, and whether the context has such windows. ``at``: the anchor's place in each."""
    gram = gram_of(length)
    room, step = length - gram, class_width(length)
    sizes = np.array([len(c) for c in contexts], np.int64)
    start = np.cumsum(sizes) - sizes
    sums = prefix_sums(BYTE_CODES[np.frombuffer(b"".join(contexts), np.uint8)])
    near = np.arange(0, room + 1, step)  # a class's least room to the left of the anchor, and its most
    far = np.minimum(near + step - 1, room)
    held = (at[:, None] >= near) & ((at - sizes + length)[:, None] <= far)
    first = np.where(held, (start + at)[:, None] - near, 0)
    after = np.where(held, (start + at)[:, None] + gram + room - far, 0)
    with np.errstate(over="ignore"):
        keys = mix64((sums[after] - sums[first]) * powers(BASE, len(sums))[first]) + np.arange(len(near), dtype=np.uint64)
    return keys, held


def _slices(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of a batch in parts of about SLICE_BYTES."""
    part = np.cumsum(b["ctx"].map(len).to_numpy(np.int64)) // SLICE_BYTES
    yield from (rows for _, rows in b.groupby(part, sort=False))


def _keys(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rows in _slices(b):
                keys, held = class_keys(rows["at"].to_numpy(), rows["ctx"].tolist(), length)
                yield pd.DataFrame({"key": keys[held].view(np.int64)})
    return run


def _trimmed(found, length: int):
    """(h, ch, off, ctx): contexts cut to the windows from the first to the last class whose key passes,
    and how many windows before them were cut."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = class_width(length)
        for b in batches:
            for rows in _slices(b):
                at = rows["at"].to_numpy()
                keys, held = class_keys(at, rows["ctx"].tolist(), length)
                held &= passes(found.value, keys)
                most = (held.shape[1] - held[:, ::-1].argmax(axis=1)) * step - 1  # room to the left
                low = np.maximum(at - most, 0)
                high = np.minimum(at - held.argmax(axis=1) * step, rows["ctx"].map(len).to_numpy() - length)
                rows = rows.assign(off=low, ctx=[c[x: y + length] for c, x, y in zip(rows["ctx"], low.tolist(), high.tolist())])
                yield rows.loc[held.any(axis=1), ["h", "ch", "off", "ctx"]]
    return run


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Suffix array of ``text`` (integers) by their first ``length`` or more symbols. Keys are of as many
    symbols as 63 bits hold, then of three ranks, or two in a text too long for that."""
    n = len(text)
    bits = (int(text.max()) + 1).bit_length()
    width = 63 // bits
    pad = np.concatenate((text.astype(np.int64) + 1, np.zeros(width - 1, np.int64)))
    key = pad[:n]
    for k in range(1, width):
        key = (key << bits) | pad[k: n + k]
    bits = n.bit_length()
    many = min(3, 63 // bits)
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if width >= length or new[-1] == n - 1:
            return order
        rank = np.zeros(n + (many - 1) * width, np.int64)  # 0: after the end
        rank[order] = new + 1
        key = rank[:n]
        for k in range(1, many):
            key = (key << bits) | rank[k * width: k * width + n]
        width *= many


def common_lengths(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffixes a[i] and b[i], up to ``most``."""
    n, got = len(text), np.zeros(len(a), np.int64)
    span = np.arange(32)
    for first in range(0, len(a), COMPARED):
        live = np.arange(first, min(len(a), first + COMPARED))
        while len(live):
            x, y = a[live] + got[live], b[live] + got[live]
            i, j = x[:, None] + span, y[:, None] + span
            same = (i < n) & (j < n)
            same &= text[np.minimum(i, n - 1)] == text[np.minimum(j, n - 1)]
            run = np.where(same.all(axis=1), 32, same.argmin(axis=1))
            got[live] += run
            live = live[(run == 32) & (got[live] < most)]
    return np.minimum(got, most)


def matching_statistics(text: np.ndarray, most: int) -> np.ndarray:
    """For every position, the length of the longest string from there that also
    starts elsewhere in ``text``; no such string may be longer than ``most``."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    order = suffix_order(text, most + 1)
    bwt = text[order - 1]
    bwt[order == 0] = -1
    rows = np.flatnonzero(bwt[1:] != bwt[:-1])  # the last row of each run but the last
    shared = common_lengths(text, order[rows], order[rows + 1], most)
    out, at = np.zeros(n, np.int64), np.arange(n)
    # Run heads know what they share with the row above, run tails with the row below.
    for sampled in (order[rows + 1], order[rows]):
        known = np.full(n, -1, np.int64)
        known[sampled] = shared
        last = np.maximum.accumulate(np.where(known >= 0, at, -1))
        out = np.maximum(out, np.where(last >= 0, known[np.maximum(last, 0)] - (at - last), 0))
    return out


def _ranges(flag: np.ndarray) -> list[int]:
    """[first, after, first, after, ...] of the runs of true values."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flag.astype(np.int8), [0])))).tolist()


def _shard(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        parts = [np.frombuffer(c, np.uint8).astype(np.int64) for c in group["ctx"]]
        sizes = np.array([len(p) for p in parts])
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        text = np.empty(int(sizes.sum()) + len(parts), np.int64)
        for k, (p, s) in enumerate(zip(parts, starts)):
            text[s: s + len(p)] = p
            text[s + len(p)] = 256 + k  # ends are all different
        long = matching_statistics(text, int(sizes.max())) >= length
        for h, ch, off, s, m in zip(group["h"], group["ch"], group["off"], starts, sizes):
            if found := _ranges(long[s: s + m - length + 1]):
                out.append((h, ch, [off + x for x in found]))
        return pd.DataFrame(out, columns=["h", "ch", "found"])
    return run


def _window_codes(h: int, ctx: bytes, length: int) -> np.ndarray:
    """One uint64 per window of a context, from the window and its anchor."""
    w = window_hashes(np.frombuffer(ctx, np.uint8), length)
    with np.errstate(over="ignore"):
        w = (w ^ np.uint64(h & 0xFFFFFFFFFFFFFFFF)) * _u64(0x94D049BB133111EB)
    return w ^ (w >> np.uint64(31))


def _window_counts(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            w = [_window_codes(h, c, length) for h, c in zip(b["h"], b["ctx"])]
            w, c = np.unique(np.concatenate(w) if w else np.zeros(0, np.uint64), return_counts=True)
            yield pd.DataFrame({"h": w.view(np.int64), "c": c.astype(np.int64)})
    return run


def _certain(bits, length: int):
    """(h, ch, found): the windows whose bit only repeated hashes have set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            twice, doubt = bits.value
            rows = []
            for h, ch, off, ctx in b[["h", "ch", "off", "ctx"]].itertuples(index=False):
                w = _window_codes(h, ctx, length)
                if found := _ranges(passes(twice, w) & ~passes(doubt, w)):
                    rows.append((h, ch, [off + x for x in found]))
            yield pd.DataFrame(rows, columns=["h", "ch", "found"])
    return run


def _doubtful(bits, length: int):
    """(h, ch, at, w): one row per window whose bit hashes found once share."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            twice, doubt = bits.value
            for first in range(0, len(b), YIELD):
                rows = []
                for h, ch, off, ctx in b[["h", "ch", "off", "ctx"]].iloc[first: first + YIELD].itertuples(index=False):
                    w = _window_codes(h, ctx, length)
                    at = np.flatnonzero(passes(twice, w) & passes(doubt, w))
                    rows.extend((h, ch, off + i, x) for i, x in zip(at.tolist(), w[at].view(np.int64).tolist()))
                yield pd.DataFrame(rows, columns=["h", "ch", "at", "w"])
    return run


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for doc, text, found, n in zip(b["doc_id"], b["text"], b["found"], b["n_shared"]):
            data = _bytes(text)
            gone = np.zeros(len(data) + 1, np.int32)
            if found is not None and len(found):
                np.add.at(gone, [r["a"] for r in found], 1)
                np.add.at(gone, [r["b"] for r in found], -1)
            hit = np.cumsum(gone)[:-1] > 0
            out.append((doc, len(data), int(hit.sum()), len(_ranges(hit)) // 2,
                        hashlib.sha256(data[~hit].tobytes()).hexdigest(), n))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"])


def repeated_ranges(docs: DataFrame, length: int = LENGTH, shared: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(doc_key, found): per document key the byte ranges covered by strings of
    ``length`` bytes that also start elsewhere; and if ``shared`` (doc_key, n_shared). ``docs``: doc_key, text."""
    context = docs.sparkSession.sparkContext
    counted = docs.select("text").mapInPandas(_count_anchors(length, shared), "h long, passage boolean, c long")
    twice = written(counted.groupBy("h", "passage").agg(F.sum("c").alias("c")).filter("c > 1").select("h", "passage"), "repeated-anchors")
    repeated, again = twice.filter("not passage").select("h"), twice.filter("passage").select("h")
    bits = context.broadcast(bit_filter(repeated, "h")[1])
    passages = context.broadcast(bit_filter(again, "h")[1]) if shared else None
    places = written(docs.mapInPandas(_places(bits, passages, length), "doc_key binary, h long, lo long, n long, ch long, shared array<long>"), "places")
    held = places.filter("n > 0").drop("shared")
    # The filter lets some hashes found in one row pass; the join does not.
    share = written(places.filter("n = 0").select("doc_key", F.explode("shared").alias("h")).join(again, "h", "left_semi").groupBy(
        "doc_key").agg(F.count_distinct("h").alias("n_shared")), "shared-passages") if shared else None
    unique = written(held.groupBy("h", "ch").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")), "contexts")
    per = written(unique.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "shared-anchors")
    whole = unique.filter("c > 1").select("h", "ch", F.array(F.lit(0).cast("long"), F.col("n")).alias("found"))
    again = context.broadcast(bit_filter(per.select(F.shiftrightunsigned("h", AGAIN).alias("h")), "h", BYTES_FILTER_BITS)[1])
    texts = docs.select("text").mapInPandas(_contexts(bits, again, length), "h long, ch long, at long, ctx binary")
    several = written(texts.groupBy("h", "ch").agg(F.min(F.struct("at", "ctx")).alias("x")).select("h", "ch", "x.*"), "shared-contexts")
    # The filter may let anchors with one context pass: their keys are all different.
    keys = several.mapInPandas(_keys(length), "key long").groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    found = context.broadcast(bit_filter(written(keys.filter("c > 1").select("key"), "class-keys"), "key", BYTES_FILTER_BITS)[1])
    several = written(several.mapInPandas(_trimmed(found, length), "h long, ch long, off long, ctx binary"), "trimmed-contexts")
    dense = written(per.filter(F.col("k") > CROWD).select("h"), "crowded-anchors")
    few = several.join(dense, "h", "left_anti")
    shards = max(1, few.count() // SHARD)
    sharded = few.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard").applyInPandas(
        _shard(length), "h long, ch long, found array<long>")
    crowd = several.join(dense, "h", "left_semi").select("h", "ch", "off", "ctx")
    windows = written(crowd.select("h", "ctx").mapInPandas(_window_counts(length), "h long, c long").groupBy("h").agg(
        F.sum("c").alias("c")), "crowded-windows")
    twice, once = (bit_filter(windows.filter(c).select("h"), "h")[1] for c in ("c > 1", "c = 1"))
    passing = context.broadcast((twice, once))
    found = "h long, ch long, found array<long>"
    certain = crowd.mapInPandas(_certain(passing, length), found)
    rows = crowd.mapInPandas(_doubtful(passing, length), "h long, ch long, at long, w long")
    crowded = certain.union(rows.join(windows.filter("c > 1").select(F.col("h").alias("w")), "w", "left_semi").groupBy(
        "h", "ch").agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + 1))).alias("found")))
    marks = whole.union(sharded).union(crowded)
    pairs = F.expr("transform(sequence(0, cast(size(found) / 2 as int) - 1), "
                   "i -> named_struct('x', found[2 * i], 'y', found[2 * i + 1]))")
    spans = held.select("doc_key", "h", "lo", "ch").join(marks, ["h", "ch"]).select(
        "doc_key", "lo", F.explode(pairs).alias("p"))
    return spans.groupBy("doc_key").agg(F.collect_set(F.struct(
        (F.col("lo") + F.col("p.x")).alias("a"), (F.col("lo") + F.col("p.y") + (length - 1)).alias("b"))).alias("found")), share


def cut_repeats(docs: DataFrame, length: int = LENGTH, shared: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``, and n_shared if ``shared``."""
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"),
                                 F.coalesce("text", F.lit(""))).cast("binary")))
    keyed = docs.select("doc_id", "text", key.alias("doc_key"))
    found, share = repeated_ranges(keyed.select("doc_key", "text"), length, shared)
    found = written(found, "repeats")
    joined = keyed.join(found, "doc_key", "left")
    joined = joined.join(share, "doc_key", "left") if shared else joined.withColumn("n_shared", F.lit(0))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = joined.select("doc_id", "text", "found", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")).mapInPandas(
        _cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long")
    return out if shared else out.drop("n_shared")
