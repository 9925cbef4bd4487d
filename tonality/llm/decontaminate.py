"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. The items' word n-grams set bits of one fixed-size filter (2 MB whatever the
   benchmark's size). Each task slides over its whole texts, keeps n-grams that pass,
   and writes out the passages around them, merging hits closer than the longest item.
2. Hits join the item seeds by hash. A pair's rarest shared seed always belongs to
   the pair, however common it is elsewhere, so every (passage, item) pair with a
   shared seed is a candidate, once.
3. Each pair is aligned word by word (match 2, mismatch and gap -1); score is the best
   local score over a whole match's score. Pairs with too few words in common to reach
   the least score (a bound that holds for every alignment) need no alignment.

Words are runs of letters and digits, lower-cased. Defined results: null or
short texts give no seed and no row; items with fewer words than ``SEED`` use their
whole text as the seed; empty items and null item text match nothing; repeated
documents each get their rows; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import written

SEED = 4
MIN_SCORE = 0.6
FILTER_BITS = 1 << 24
WORD_RE = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD_RE.findall(text.lower()) if text else []


def _codes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=True) if words else np.zeros(0, np.uint64)


def seed_hashes(words: list[str], n: int = SEED) -> np.ndarray:
    """int64 hash of each n-gram in order (one of all words if fewer)."""
    n = min(n, len(words))
    if not n:
        return np.zeros(0, np.int64)
    codes, h = _codes(words), np.uint64(n)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ codes[k: len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
    return h.astype(np.int64)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[float, int]:
    """Best local score over 2 * len(item), and its end in the passage."""
    row, best, end = np.zeros(len(passage) + 1), 0.0, 0
    ramp = np.arange(len(passage) + 1, dtype=float)
    for w in item:
        step = np.maximum(row - 1, 0)
        step[1:] = np.maximum(step[1:], row[:-1] + np.where(passage == w, 2.0, -1.0))
        row = np.maximum.accumulate(step + ramp) - ramp  # gaps along the passage
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at
    return best / (2 * len(item)), end


def most_score(passage: np.ndarray, item: np.ndarray) -> float:
    """No alignment scores more: every word of either side is matched once at most."""
    words, wanted = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
    held = np.bincount(at[words[at] == passage], minlength=len(words))
    return float(np.minimum(held, wanted).sum()) / len(item)


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(i, int(h), len(w)) for i, t in zip(b["item_id"], b["text"])
                for w in [words_of(t)] for h in set(seed_hashes(w).tolist())]
        yield pd.DataFrame(rows, columns=["item_id", "seed", "n_words"])


def _passages_with(bits, reach: int, short: tuple[int, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["text"]):
                words = words_of(text)
                found = []
                for n in (SEED, *short):
                    if len(words) < n:
                        continue
                    h = seed_hashes(words, n)
                    slot = (h.view(np.uint64) >> np.uint64(40)).astype(np.int64)
                    at = np.flatnonzero((flags[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                    found += [(int(i), int(h[i])) for i in at]
                if not found:
                    continue
                found.sort()
                spans = [[found[0]]]
                for hit in found[1:]:
                    if hit[0] - spans[-1][-1][0] <= reach:
                        spans[-1].append(hit)
                    else:
                        spans.append([hit])
                for hits in spans:
                    lo, hi = max(0, hits[0][0] - reach), hits[-1][0] + SEED + reach
                    out.append((doc, lo, " ".join(words[lo:hi]), sorted({h for _, h in hits})))
            yield pd.DataFrame(out, columns=["doc_id", "start", "passage", "seeds"])
    return run


def _aligned(min_score: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, memo = [], {}
            for doc, start, passage, item_id, text in zip(b["doc_id"], b["start"], b["passage"],
                                                          b["item_id"], b["item_text"]):
                if text not in memo:
                    memo[text] = _codes(words_of(text))
                codes = _codes(passage.split(" "))
                if most_score(codes, memo[text]) < min_score:
                    continue
                score, end = align(codes, memo[text])
                if score >= min_score:
                    out.append((doc, item_id, score, start + end))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "end_word"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, item_id, score (0 to 1), end_word: one row per document and item
    found in it (the best alignment)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").filter("text IS NOT NULL")
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    id_type, doc_type = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    seeds = written(items.mapInPandas(_item_seeds, f"item_id {id_type}, seed long, n_words int"), "item-seeds")
    slots = seeds.select(F.expr("shiftrightunsigned(seed, 40)").alias("slot")).distinct()
    # At most FILTER_BITS distinct slots, eight per row.
    bytes_ = slots.groupBy((F.col("slot") / 8).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(slot % 8 as int))")).alias("bits")).toArrow()
    flags = np.zeros(FILTER_BITS // 8, np.uint8)
    flags[bytes_["at"].to_numpy()] = bytes_["bits"].to_numpy().astype(np.uint8)
    facts = seeds.agg(F.max("n_words").alias("longest"), F.collect_set(
        F.when(F.col("n_words") < SEED, F.col("n_words"))).alias("short")).first()
    reach = int(facts.longest or 0) + 8
    find = _passages_with(spark.sparkContext.broadcast(flags.tobytes()), reach, tuple(sorted(facts.short)))
    passages = written(docs.mapInPandas(
        find, f"doc_id {doc_type}, start int, passage string, seeds array<long>"), "passages")
    key = F.xxhash64(F.col("doc_id"), "start", "passage")
    hits = passages.select(key.alias("pid"), F.explode("seeds").alias("seed"))
    pairs = hits.join(seeds.select("seed", "item_id"), "seed").select("pid", "item_id").distinct()
    work = (pairs.join(passages.select(key.alias("pid"), "doc_id", "start", "passage"), "pid")
            .join(items.select("item_id", F.col("text").alias("item_text")), "item_id")
            .select("doc_id", "start", "passage", "item_id", "item_text"))
    scored = work.mapInPandas(_aligned(min_score), f"doc_id {doc_type}, item_id {id_type}, score double, end_word int")
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "end_word")).alias("b"))
    return best.select("doc_id", "item_id", "b.score", "b.end_word")
