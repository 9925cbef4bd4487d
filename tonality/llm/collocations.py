"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces at punctuation and line ends, pieces into words. A window of
``TRIGGER`` words whose hash is 0 modulo ``PERIOD`` is a trigger. A chunk runs from one trigger
(or the piece's start) to the end of the next one (or of the piece), so chunks overlap by exactly a
trigger. Equal chunks of a language form one dictionary entry with its parse frequency, wherever
they stand: copied passages are parsed alike and counted once.

A phrase of up to ``TRIGGER + 1`` words that starts before the next trigger lies whole in its
chunk, and one that starts in the overlap belongs to the next chunk. So counting, in each distinct
chunk, the phrases that start in its own part (the first ``owned`` words), weighted by the
chunk's frequency, counts every occurrence in the corpus once.

Plan: one pass parses the texts into chunks; an aggregation makes the dictionary, which is written.
For words, for pairs and for all longer phrases the dictionary is read, and 64-bit hashes of those
phrases are summed whose words and pairs passed before; the hashes that reach ``MIN_COUNT`` form a
filter of fixed maximal size. The last pass counts the phrases themselves, by their words, where
the filters let them through. A filter lets every frequent phrase pass and is no part of the
result: a full one costs more rows. Scores, drops and ranks are joins and windows over frequent
phrases only, in decimals.

Defined results: a null text has no words; a null lang is ``und``; only a few languages or one, empty
texts and very long ones need no care, since a chunk has a few dozen words (a piece without
trigger is one chunk); equal scores rank by count, then phrase; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import LOWER, UPPER, written
from tonality.llm.rolling import bit_filter, mix64, passes, prefix_sums, window_hashes, word_codes, words

MAX_WORDS = 5
TRIGGER = MAX_WORDS - 1
PERIOD = 16
MIN_COUNT = 100
TOP = 2000
UND = "und"
BATCH_BYTES = 6 << 20
HELD = 1 << 21
SALTS = 16
PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])

# A-Z to lower case, what ends a piece to a line feed, tabs to spaces.
FOLD = bytes(10 if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def chunks_of(texts: list[bytes], period: int = PERIOD) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The chunks of ``texts``: words joined by one space, the number of owned words, the text's number."""
    data = b"\n".join(texts).translate(FOLD)
    raw = np.frombuffer(data, np.uint8)
    first, after = words(raw)
    if not len(first):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    piece = np.cumsum(raw == 10, dtype=np.int32)[first]
    h = window_hashes(prefix_sums(word_codes(raw, first, after)), TRIGGER)
    trigger = np.zeros(len(first), bool)
    trigger[:len(h)] = (h % np.uint64(period) == 0) & (piece[:len(h)] == piece[TRIGGER - 1:])
    new_piece = np.concatenate(([True], piece[1:] != piece[:-1]))
    start = np.flatnonzero(trigger | new_piece)
    end = np.append(start[1:], len(first))
    owned = end - start
    # A next start inside the piece is a trigger: the chunk goes on to that trigger's end.
    inside = np.append(~new_piece[start[1:]], False)
    last = np.where(inside, end + TRIGGER, end) - 1
    bounds = zip(first[start].tolist(), after[last].tolist())
    out = [data[a:b] for a, b in bounds]
    out = [b" ".join(c.split()) if b"  " in c else c for c in out]
    text_end = np.cumsum(np.array([len(t) + 1 for t in texts]))
    return out, owned, np.searchsorted(text_end, first[start], "right")


def _parsed(period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b):
                found, owned, of = chunks_of(part["text"].cast(pa.binary()).to_pylist(), period)
                yield pa.record_batch([part["lang"].take(pa.array(of)), pa.array(owned, pa.int32()),
                                       pa.array(found, pa.binary()).cast(pa.string())], ["lang", "owned", "chunk"])
    return run


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about BATCH_BYTES of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(b["text"]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
        yield b.slice(at, end - at)
        at = end


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", period: int = PERIOD) -> DataFrame:
    """Distinct chunks: lang, owned, chunk, freq (their parse frequency). Written."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"), F.col(text).alias("text"))
    parsed = rows.filter("text is not null").mapInArrow(_parsed(period), "lang string, owned int, chunk string")
    return written(parsed.groupBy("lang", "owned", "chunk").agg(F.count(F.lit(1)).alias("freq")), "chunk-dictionary")


class _Chunks:
    """A run of dictionary rows as arrays over their words."""

    def __init__(self, rows: pa.Table):
        self.data = b"\n".join(rows["chunk"].cast(pa.binary()).to_pylist())
        raw = np.frombuffer(self.data, np.uint8)
        self.first, self.after = words(raw)
        self.sums = prefix_sums(word_codes(raw, self.first, self.after))
        # No chunk is empty, and line feeds stand only between them.
        new = np.concatenate(([True], raw[self.first[1:] - 1] == 10))
        self.of = np.cumsum(new) - 1
        own = np.arange(len(new)) - np.flatnonzero(new)[self.of] < rows["owned"].to_numpy()[self.of]
        self.own, self.freq = own, rows["freq"].to_numpy()
        named = rows["lang"].combine_chunks().dictionary_encode()
        self.names, self.lang = named.dictionary, named.indices.to_numpy()
        joined = [n.encode() for n in self.names.to_pylist()]
        ends = np.cumsum([0, *[len(n) + 1 for n in joined]])
        self.seeds = word_codes(np.frombuffer(b"\n".join(joined), np.uint8), ends[:-1], ends[1:] - 1)[self.lang]

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per place: whether a phrase of n words of one chunk starts there, and its hash."""
        there = np.zeros(len(self.of), bool)
        h = np.zeros(len(self.of), np.uint64)
        if len(self.of) >= n:
            m = len(self.of) - n + 1
            there[:m] = self.of[:m] == self.of[n - 1:]
            with np.errstate(over="ignore"):
                h[:m] = mix64(window_hashes(self.sums, n) + self.seeds[self.of[:m]] * np.uint64(2 * n + 1))
        return there, h

    def levels(self, filters: list[np.ndarray], upto: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places, hashes) for n to ``upto``: phrases whose parts of n - 1 words were let through, and that
        pass themselves where there is a filter for n."""
        ok = None
        for n in range(1, upto + 1):
            there, h = self.hashes(n)
            if ok is not None:
                there[:-1] &= ok[:-1] & ok[1:]
                there[-1:] = False
            if n <= len(filters):
                there[there] = passes(filters[n - 1], h[there])
            at = np.flatnonzero(there & self.own)
            yield n, at, h[at]
            ok = there


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunks]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b["chunk"].nbytes
        if size >= BATCH_BYTES:
            yield _Chunks(pa.Table.from_batches(held))
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield _Chunks(pa.Table.from_batches(held))


def _summed(h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the sum of their weights, and a place of each."""
    order = np.argsort(h)
    s = h[order]
    cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[cut], np.add.reduceat(weight[order], cut), order[cut]


def _hash_counts(filters, low: int, high: int):
    """(h, c) of phrases of ``low`` to ``high`` words, summed over HELD hashes at a time."""
    def sums(held: list[tuple]) -> pa.RecordBatch:
        h, count, _ = _summed(*(np.concatenate(x) for x in zip(*held)))
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(count, pa.int64())], ["h", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for c in _runs(batches):
            for n, at, h in c.levels(filters.value, high):
                if n >= low and len(at):
                    h, count, _ = _summed(h, c.freq[c.of[at]])
                    held.append((h, count))
                    size += len(h)
            if size >= HELD:
                yield sums(held)
                held, size = [], 0
        if held:
            yield sums(held)
    return run


def _phrase_counts(filters):
    """(lang, phrase, k, f), summed over HELD phrases at a time."""
    def sums(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = pa.concat_tables(held).group_by(["lang", "phrase", "k"]).aggregate([("f", "sum")])
        t = t.rename_columns(["lang", "phrase", "k", "f"]).select(["lang", "phrase", "k", "f"])
        yield from t.cast(PHRASES).to_batches(max_chunksize=50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for c in _runs(batches):
            for n, at, h in c.levels(filters.value, len(filters.value)):
                if not len(at):
                    continue
                _, count, some = _summed(h, c.freq[c.of[at]])
                at = at[some]
                found = [c.data[a:b] for a, b in zip(c.first[at].tolist(), c.after[at + n - 1].tolist())]
                held.append(pa.table([c.names.take(pa.array(c.lang[c.of[at]])), pa.array(found, pa.binary()).cast(pa.string()),
                                      pa.array(np.full(len(at), n), pa.int32()), pa.array(count, pa.int64())], schema=PHRASES))
                size += len(at)
            if size >= HELD:
                yield from sums(held)
                held, size = [], 0
        if held:
            yield from sums(held)
    return run


def frequent_phrases(entries: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """lang, phrase, k (words), f for every phrase of up to ``max_words`` words with f >= min_count. Written."""
    context = entries.sparkSession.sparkContext
    filters: list[np.ndarray] = []
    # Words, pairs, then all longer phrases whose pairs passed: three passes instead of one per length.
    for low, high in ((1, 1), (2, 2), (3, max_words)):
        counted = entries.mapInArrow(_hash_counts(context.broadcast(filters), low, high), "h long, c long")
        often = written(counted.groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count).select("h"), f"frequent-{low}")
        found, flags = bit_filter(often, "h")
        if not found:
            break
        filters += [flags] * (high - low + 1)
    counted = entries.mapInArrow(_phrase_counts(context.broadcast(filters)), "lang string, phrase string, k int, f long")
    return written(counted.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count), "phrases")


def _part(split: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(split, start, length), " ")


def _counts_of(rows: DataFrame, part: str, phrases: DataFrame, name: str) -> DataFrame:
    """``rows`` plus the count of their phrase ``part``; a part that many rows share is salted."""
    side = phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias(name),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_with"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase", "cut"), F.lit(SALTS)).cast("int"))
    return salted.join(side, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))
                       & (F.col("_salt") == F.col("_with"))).drop("_lang", "_phrase", "_with", "_salt")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text: str = "text", lang: str = "lang",
                 period: int = PERIOD) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    entries = dictionary(docs, text, lang, period)
    totals = entries.groupBy("lang").agg(F.sum(F.col("owned").cast("long") * F.col("freq")).alias("n"))
    phrases = frequent_phrases(entries, min_count)
    split = F.split("phrase", " ")
    wanted = phrases.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    longer = wanted.filter("k > 2").select("lang", "a", "k", split.alias("ws"))
    longer = longer.select("lang", "a", "k", "ws", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    longer = longer.select("lang", "a", "ws", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    inside = longer.groupBy(F.col("lang").alias("_l"), _part(F.col("ws"), F.col("start"), F.col("size")).alias("_p")).agg(
        F.max("a").alias("_most"))
    wanted = wanted.join(inside, (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("_p")), "left").filter(
        F.col("_most").isNull() | (F.col("_most") * 100 < F.col("a") * 100)).drop("_l", "_p", "_most")
    cuts = wanted.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("head", _part(split, F.lit(1), F.col("cut"))).withColumn(
        "tail", _part(split, F.col("cut") + 1, F.col("k") - F.col("cut")))
    cuts = _counts_of(_counts_of(cuts, "head", phrases, "l"), "tail", phrases, "r")
    cuts = cuts.join(totals.withColumnRenamed("lang", "_l"), F.col("lang") == F.col("_l")).drop("_l")
    whole = {c: f"cast({c} as decimal(20,0))" for c in "alrn"}
    cuts = cuts.withColumn("score", F.expr(f"(1000 * {whole['a']} * {whole['n']}) div ({whole['l']} * {whole['r']})"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("_b")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "_b.l", "_b.r", "n", "_b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = MIN_COUNT, top: int = TOP, max_words: int = MAX_WORDS) -> str:
    return f"""
WITH p AS (SELECT coalesce(lang, '{UND}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(len(ws))) AS i FROM w),
f AS (SELECT lang, k, array_to_string(ws[i + 1 : i + k], ' ') AS phrase, count(*) AS f
  FROM g, range(1, {max_words + 1}) t(k) WHERE i + k <= len(ws) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {min_count}),
s AS (SELECT c.lang, c.a, array_to_string(ws[i + 1 : i + z], ' ') AS phrase
  FROM c, range(2, {max_words}) t(z), range(0, {max_words}) u(i) WHERE z < k AND i + z <= k),
m AS (SELECT lang, phrase, max(a) AS most FROM s GROUP BY ALL),
d AS (SELECT c.* FROM c LEFT JOIN m USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
x AS (SELECT d.lang, d.phrase, d.a, l.f AS l, r.f AS r, n.n, cut,
    ((1000::HUGEINT * d.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM d JOIN range(1, {max_words}) t(cut) ON cut < d.k
  JOIN f l ON l.lang = d.lang AND l.phrase = array_to_string(d.ws[1 : cut], ' ')
  JOIN f r ON r.lang = d.lang AND r.phrase = array_to_string(d.ws[cut + 1 : d.k], ' ')
  JOIN n ON n.lang = d.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= {top}"""


ORACLE = oracle()
