"""Substring dedup: every fixed-length word window is hashed and counted.

A word is removed if a window of ``WINDOW`` words covers it whose word sequence also
starts in a document with a smaller doc_id.

Plan:

1. Documents are hashed in chunks of about ``CHUNK_WORDS`` words: word codes, then the
   Rabin-Karp hash of every window from prefix sums of code * B**-i (64 bits, times
   B**i, mixed). Inside a chunk a window's first document is known at once: all its later
   places are marked there, and only those in the first document go on, so a window that a
   third of all documents hold leaves one document's entries per chunk.
2. Entries (hash, document, place) go to buckets, equal ranges of the hash, as packed arrays:
   one row per chunk and bucket. The number of buckets follows the counted size of the
   texts, so a bucket has about ``BUCKET_WORDS`` entries at any scale; beyond ``FANOUT``
   buckets they are dealt in further rounds, which keeps the packs long.
3. A bucket sorts its entries; a hash's smallest doc_id is its first, and every place of it in a
   larger doc_id is marked.
4. Marked places are grouped by document and merge into maximal removal intervals,
   which are joined to the documents.

Windows are told apart by 64-bit hashes; with N windows about N**2 / 2**65 pairs of different
windows meet by chance (0.0005 for 1.3e8 windows).

Defined results: null and blank texts have no words; a text of fewer words than a window keeps
all; a row without doc_id keeps all its words and marks no others; rows of one doc_id do not mark
each other, whatever their texts (they are told apart by the hash of the text); an empty
table gives no rows; extra columns are ignored; texts may be of any length (a document is never
cut; a chunk holds at least one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import written
from tonality.llm.rolling import prefix_sums, window_hashes, word_codes, words

WINDOW = 13
CHUNK_WORDS = 1 << 19
BUCKET_WORDS = 1 << 19
FANOUT = 1024
BYTES_A_WORD = 6
PACKED = "bucket long, hashes binary, docs binary, rows binary, places binary"

def chunk_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the text and place in it of every window of ``texts``; none spans two texts."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    first, after = words(raw)
    if len(first) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text_of = np.searchsorted(np.cumsum(np.array([len(t) + 1 for t in texts])), first, "right")
    begin = np.searchsorted(text_of, np.arange(len(texts)))
    h = window_hashes(prefix_sums(word_codes(raw, first, after)), window)
    whole = np.flatnonzero(text_of[:len(h)] == text_of[window - 1:])
    of = text_of[whole]
    return h[whole], of, whole - begin[of]


def planes(values: np.ndarray) -> bytes:
    """64-bit values byte by byte, so that bytes alike stand together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(blob: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(kind).ravel()


def later(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of entries sorted by (h, doc): which have a smaller doc of the same h."""
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return doc > np.repeat(doc[start], np.diff(np.append(start, len(h))))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(docs, rows, texts) of about CHUNK_WORDS words; a (doc, row) stands once in a chunk."""
    held, size = {}, 0
    for b in batches:
        for doc, row, text in zip(b["doc"].tolist(), b["row"].tolist(), b["text"]):
            if (doc, row) in held:
                continue
            held[doc, row] = text.encode("utf-8", "surrogatepass")
            size += len(held[doc, row])
            if size >= CHUNK_WORDS * BYTES_A_WORD:
                yield *np.array(list(held), np.int64).T, list(held.values())
                held, size = {}, 0
    if held:
        yield *np.array(list(held), np.int64).T, list(held.values())


def _packs(entries: tuple[np.ndarray, ...], buckets: int) -> list[tuple]:
    """Entries, sorted by hash, as one row for each of ``buckets`` equal ranges of the hash."""
    bucket = ((entries[0] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
    return [(int(bucket[a]), *(planes(x[a:b]) for x in entries)) for a, b in zip(cut, [*cut[1:], len(bucket)])]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "hashes", "docs", "rows", "places"])


def _hashed(window: int, buckets: int):
    """Entries of documents, packed; places marked in the chunk form a pack without hashes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for docs, rows, texts in _chunks(batches):
            h, of, place = chunk_windows(texts, window)
            if not len(h):
                continue
            order = np.lexsort((docs[of], h))
            h, of, place = h[order], of[order], place[order]
            doc, row = docs[of], rows[of]
            marked = later(h, doc)
            out = _packs((h[~marked], doc[~marked], row[~marked], place[~marked]), buckets)
            if marked.any():
                out.append((int(h[0]) % buckets, None, planes(doc[marked]), planes(row[marked]), planes(place[marked])))
            yield _frame(out)
    return run


def _entries(packs: pd.DataFrame) -> tuple[np.ndarray, ...]:
    cols = [np.concatenate([from_planes(x, kind) for x in packs[name]])
            for name, kind in (("hashes", np.uint64), ("docs", np.int64), ("rows", np.int64), ("places", np.int64))]
    order = np.lexsort((cols[1], cols[0]))
    return tuple(c[order] for c in cols)


def _dealt(times: int, buckets: int):
    """Packs of one bucket after the other, dealt anew to ``times`` as many, ``buckets`` in all."""
    def flush(held: list[tuple]) -> pd.DataFrame:
        packs = _frame(held)
        marked = packs["hashes"].isna()
        out = [(b * times, *rest) for b, *rest in packs[marked].itertuples(index=False, name=None)]
        return _frame(out + (_packs(_entries(packs[~marked]), buckets) if not marked.all() else []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for pack in b.itertuples(index=False, name=None):
                if held and (pack[0] != held[0][0] or size >= CHUNK_WORDS):
                    yield flush(held)
                    held, size = [], 0
                held.append(pack)
                size += len(pack[2]) // 8
        if held:
            yield flush(held)
    return run


def _bucket(packs: pd.DataFrame) -> pd.DataFrame:
    """The marked places of one bucket, beside those already marked in their chunk."""
    ready = packs["hashes"].isna()
    out = [[from_planes(x, np.int64) for x in packs.loc[ready, name]] for name in ("docs", "rows", "places")]
    if not ready.all():
        h, *rest = _entries(packs[~ready])
        marked = later(h, rest[0])
        for held, values in zip(out, rest):
            held.append(values[marked])
    return pd.DataFrame({name: np.concatenate(held) for name, held in zip(("doc", "row", "place"), out)})


def spans(places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals (first word, word after) that the windows at ``places`` cover."""
    places = np.unique(places)
    gap = np.flatnonzero(places[1:] > places[:-1] + window)
    return places[np.concatenate(([0], gap + 1))], places[np.concatenate((gap, [len(places) - 1]))] + window


def _merged(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            both = [spans(np.asarray(p, np.int64), window) for p in b["places"]]
            yield pd.DataFrame({"_doc": b["doc"], "_row": b["row"], "span_starts": [x for x, _ in both],
                                "span_ends": [y for _, y in both]})
    return run


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for text, starts, ends in zip(b["text"], b["span_starts"], b["span_ends"]):
            held = (text or "").encode("utf-8", "surrogatepass").split()
            n, removed, left = len(held), 0, []
            if starts is None:
                starts, ends = (), ()
            at = 0
            for x, y in zip(starts, ends):
                left += held[at:x]
                removed, at = removed + int(y - x), y
            left += held[at:]
            out.append((n, removed, hashlib.sha256(b" ".join(left)).hexdigest(), starts, ends))
        frame = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "span_starts", "span_ends"])
        frame.insert(0, "key", b["key"].to_numpy())
        yield frame


def rounds(buckets: int, fanout: int = FANOUT) -> list[int]:
    """Fan-outs, none above ``fanout``, whose product is at least ``buckets``."""
    out = []
    while buckets > 1:
        out.append(min(buckets, fanout))
        buckets = -(-buckets // fanout)
    return out or [1]


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text",
                   bucket_words: int = BUCKET_WORDS, fanout: int = FANOUT) -> DataFrame:
    """Per row: ``key``, n_words, n_removed, kept_sha256, and the maximal removed intervals as
    span_starts and span_ends (word numbers from 0, end exclusive)."""
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    many = written(rows.filter("_id is not null").groupBy("_id").count().filter("count > 1").select(
        F.col("_id").alias("_many")), "repeated-ids")
    rows = rows.join(many, F.col("_id") == F.col("_many"), "left").select(
        "_id", F.col("_id").cast("long").alias("doc"),
        F.when(F.col("_many").isNotNull(), F.xxhash64("text")).otherwise(F.lit(0)).alias("row"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fans = rounds(-(-size // (BYTES_A_WORD * bucket_words)), fanout)
    buckets = fans[0]
    packs = rows.filter("text is not null and doc is not null").select("doc", "row", "text").mapInPandas(
        _hashed(window, buckets), PACKED)
    for times in fans[1:]:
        buckets *= times
        packs = packs.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_dealt(times, buckets), PACKED)
    marked = packs.groupBy("bucket").applyInPandas(_bucket, "doc long, row long, place long")
    merged = marked.groupBy("doc", "row").agg(F.collect_list("place").alias("places")).mapInPandas(
        _merged(window), "_doc long, _row long, span_starts array<long>, span_ends array<long>")
    merged = written(merged, "removed-spans")
    joined = rows.join(merged, (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row")), "left")
    out = joined.select(F.col("_id").cast("string").alias("key"), "text", "span_starts", "span_ends").mapInPandas(
        _kept, "key string, n_words long, n_removed long, kept_sha256 string, span_starts array<long>, span_ends array<long>")
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


ORACLE = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(0, len(ws) - {WINDOW - 1})) AS i FROM w WHERE len(ws) >= {WINDOW}),
seq AS (SELECT doc_id, i, array_to_string(ws[i + 1 : i + {WINDOW}], ' ') AS s FROM win),
small AS (SELECT s, min(doc_id) AS m FROM seq GROUP BY s HAVING count(DISTINCT doc_id) > 1),
cut AS (SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS p FROM seq JOIN small USING (s) WHERE doc_id > m),
gone AS (SELECT doc_id, list(p) AS ps FROM cut GROUP BY doc_id),
kept AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(ps), 0) AS r,
    list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i - 1)) AS k FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""
