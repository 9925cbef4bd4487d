"""Multi-word units: the longest phrases of a table, merged in a word sequence.

Scanning a sentence from the left, the longest listed phrase of 2 to
``MAX_PHRASE_WORDS`` words that starts at a word becomes one unit, and the scan
goes on behind it; so overlaps are settled by the earlier start, then by
length. Units are lower-case words joined by one space.

In-row pass (table of proven small size): the phrases become hash sets by
length, looked up only behind a word that begins a phrase; a unit's length
marks its first word, and one regular expression consumes the marked words
from left to right, which is linear in the sentence. Larger tables meet the
sentence's word groups in a join instead; the merge is the same expression.

Null sentences stay null; a sentence without a phrase keeps its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.functions.arrays import explode_with_position

MAX_PHRASE_WORDS = 4
SALT_BUCKETS = 16
# Marks of units of 1, 2, 3 and 4 words: whitespace, which no word holds.
MARKS = " \t\n\f"
UNIT = r"\f\S*+(?:\s\S*+){3}|\n\S*+(?:\s\S*+){2}|\t\S*+\s\S*+| \S*+"


def normal_phrase(phrase: Column) -> Column:
    """Lower case, single spaces, no space at the ends; over-long phrases raise."""
    p = F.trim(F.regexp_replace(F.lower(phrase), r"\s+", " "))
    return F.when(F.size(F.split(p, " ")) > MAX_PHRASE_WORDS, F.raise_error(F.concat(
        F.lit(f"phrase of more than {MAX_PHRASE_WORDS} words: "), p)).cast("string")).otherwise(p)


def phrases_by_length(phrases: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for p in sorted(set(phrases)):
        out.setdefault(p.count(" ") + 1, []).append(p)
    return out


def unit_lengths(lower: Column, phrases: dict[int, list[str]]) -> Column:
    """Per word: the number of words of the longest phrase that starts there, else 1."""
    firsts = sorted({p.split(" ", 1)[0] for held in phrases.values() for p in held})

    def length(w: Column, i: Column) -> Column:
        longest = None
        for n in sorted(phrases, reverse=True):
            found = F.array_join(F.slice(lower, i + 1, n), " ").isin(phrases[n])
            longest = F.when(found, F.lit(n)) if longest is None else longest.when(found, F.lit(n))
        return F.when(w.isin(firsts), longest.otherwise(F.lit(1))).otherwise(F.lit(1))

    return F.transform(lower, length)


def merge_units(words: Column, lengths: Column) -> Column:
    """``words`` with every marked unit joined by spaces."""
    marked = F.array_join(F.zip_with(words, lengths, lambda w, n: F.concat(
        F.translate(n.cast("string"), "1234", MARKS), w)), "")
    units = F.transform(F.regexp_extract_all(marked, F.lit(UNIT), F.lit(0)),
                        lambda u: F.translate(F.substring(u, 2, 2**31 - 1), MARKS[1:], "   "))
    return F.when(F.exists(lengths, lambda n: n > 1), units).otherwise(words)


def merge_in_row(rows: DataFrame, phrases: list[str], words_col: str = "words") -> DataFrame:
    """``rows`` with the phrases of ``words_col`` merged; no join, no shuffle."""
    by_length = phrases_by_length(phrases)
    if not by_length:
        return rows
    cols = rows.columns
    out = rows.withColumn("_low", F.transform(words_col, F.lower))
    out = out.withColumn("_len", unit_lengths(F.col("_low"), by_length))
    return out.withColumn(words_col, merge_units(F.col(words_col), F.col("_len"))).select(*cols)


def merge_by_join(rows: DataFrame, phrases: DataFrame, keys: list[str], words_col: str = "words") -> DataFrame:
    """The same for a phrase table (column ``w``) of any size: the word groups of each
    sentence meet the table in a join salted by sentence, and a sentence's hits,
    at most one per word, come back to it. ``keys`` tell sentences apart; equal
    sentences with equal keys may share them."""
    grams = rows.select(*keys, F.transform(words_col, F.lower).alias("_low"))
    grams = grams.select(*keys, "_low", F.transform("_low", lambda w, i: F.transform(
        F.sequence(F.lit(2), F.lit(MAX_PHRASE_WORDS)),
        lambda n: F.array_join(F.slice("_low", i + 1, n), " "))).alias("_groups"))
    grams = explode_with_position(grams, F.col("_groups"), keys, "_at", "_grams")
    grams = explode_with_position(grams, F.col("_grams"), [*keys, "_at"], "_n", "w")
    # Groups cut short by the sentence's end repeat the shorter one.
    grams = grams.filter(F.size(F.split("w", " ")) == F.col("_n") + 2)
    side = phrases.select("w").distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1))))
    hits = grams.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(SALT_BUCKETS)).cast("int")).join(side, ["w", "_salt"])
    longest = hits.groupBy(*keys, "_at").agg((F.max("_n") + 2).alias("_n"))
    found = longest.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_n"))).alias("_hits"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = rows.join(found, same, "left")
    # The lengths as one string of digits: ones up to each hit, the hit's length, ones to the end.
    hits, n = F.col("_hits"), F.size(words_col)
    digits = F.array_join(F.transform(hits, lambda h, i: F.concat(
        F.repeat(F.lit("1"), h["_at"] - F.coalesce(F.get(hits, i - 1)["_at"], F.lit(-1)) - 1), h["_n"].cast("string"))), "")
    digits = F.concat(digits, F.repeat(F.lit("1"), n - F.element_at(hits, -1)["_at"] - 1))
    lengths = F.transform(F.split(digits, ""), lambda d: d.cast("int"))
    return out.withColumn(words_col, F.when(F.col("_hits").isNull(), F.col(words_col)).otherwise(
        merge_units(F.col(words_col), lengths))).select(*rows.columns)
