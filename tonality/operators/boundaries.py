"""Sentence boundaries learnt from the texts themselves.

A mark (``.``, ``!``, ``?``) before whitespace may end a sentence; a period does not
after an abbreviation. Which words are abbreviations is learnt without
labels from log-likelihood ratios (Kiss & Strunk 2006), by two aggregations:

1. per word type, how often it stands with and without a final period. A type
   that nearly always has one, is short, holds inner periods and is never seen
   without, is an abbreviation.
2. per (type before, type after, mark), how often a possible boundary lies between
   them. Types that follow sure breaks far more often than elsewhere start
   sentences; pairs around a period that stand together far more often than by
   chance (after an abbreviation, a number or an initial) do not part.

Applied to a text, a period is no boundary after an abbreviation, unless a
capitalised sentence starter follows, nor inside a collocation; all other marks
are. Sentences keep their inner whitespace; a text without any is one sentence, an
empty or null one has none. The learnt sets are applied in the text's own
row while they are of proven small size, else by joins, with equal results. The
orthographic rules of the published method (words seen in lower case elsewhere)
are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.fixed import (ABBREVIATION_SCORE, COLLOCATION_SCORE, PERIOD_GIVEN_ABBREVIATION,
                            STARTER_SCORE)
from tonality.functions.arrays import explode_values, explode_with_position
from tonality.functions.text import TRAILING_SPACE
from tonality.session import scratch_path

MAX_INLINE_TYPES = 100_000
# Between a mark and whitespace; both stay with their segments.
POSSIBLE_BREAK = r"(?<=[.!?])(?=\s)"
# Break mark and the escape that keeps it apart from the text's own characters.
ESCAPE, ESCAPED, BREAK = "\x01", "\x01\x02", "\x01\x03"


@dataclass(frozen=True)
class BoundaryModel:
    abbreviations: DataFrame    # typ, score
    starters: DataFrame         # typ, score
    collocations: DataFrame     # before, after, score


def core(token: Column) -> Column:
    """Lower-case token from its first letter or digit to its last one or its final periods."""
    return F.regexp_replace(F.regexp_replace(F.lower(token), r"^[^\p{L}\p{N}]+", ""), r"[^\p{L}\p{N}.]+$", "")


def word_type(token: Column) -> Column:
    return F.regexp_replace(core(token), r"\.+$", "")


def has_period(token: Column) -> Column:
    """Ends with exactly one period."""
    return core(token).rlike(r"(^|[^.])\.$")


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|" + TRAILING_SPACE, "")


def segments(text: Column) -> Column:
    """The trimmed text cut at every possible boundary; joined they give it back."""
    return F.filter(F.split(_trimmed(text), POSSIBLE_BREAK), lambda s: s != "")


def _first(segment: Column) -> Column:
    return F.regexp_extract(segment, r"^\s*(\S+)", 1)


def _last(segment: Column) -> Column:
    # One mark run ends the segment, and no token before it needs a scan.
    return F.element_at(F.split(segment, r"\s+"), -1)


def type_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Pass 1: typ, n_with (a final period), n_without."""
    words = explode_values(df.select(F.split(_trimmed(F.col(text_col)), r"\s+").alias("_ws")), F.col("_ws"), [], "_w")
    typed = words.select(word_type(F.col("_w")).alias("typ"), has_period(F.col("_w")).alias("_p")).filter("typ <> ''")
    return typed.groupBy("typ").agg(F.count_if("_p").alias("n_with"), F.count_if(~F.col("_p")).alias("n_without"))


def boundary_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Pass 2: before, after (types), period (the mark is one period), n."""
    cut = df.select(segments(F.col(text_col)).alias("_s"))
    cut = cut.select(F.transform("_s", _last).alias("_l"), F.transform("_s", _first).alias("_f"))
    pairs = F.transform(F.slice(F.col("_l"), 1, F.greatest(F.size("_l") - 1, F.lit(0))), lambda w, i: F.struct(
        word_type(w).alias("before"), word_type(F.get(F.col("_f"), i + 1)).alias("after"), has_period(w).alias("period")))
    return explode_values(cut, pairs, [], "_b").select("_b.*").groupBy("before", "after", "period").agg(F.count(F.lit(1)).alias("n"))


def _log_terms(n: Column, of: Column, p: Column) -> Column:
    """n ln p + (of - n) ln(1 - p)."""
    return n * F.log(p) + (of - n) * F.log(F.lit(1.0) - p)


def abbreviation_score(n_with: Column, n_without: Column, typ: Column, n_periods: float, n_words: float) -> Column:
    """How much better "nearly always before a period" explains a type's counts than the
    rate of periods does, weighed down by length and by each time it stands without."""
    n = n_with + n_without
    ratio = -2.0 * (_log_terms(n_with, n, F.lit(n_periods / n_words)) - _log_terms(n_with, n, F.lit(PERIOD_GIVEN_ABBREVIATION)))
    inner = F.length(typ) - F.length(F.replace(typ, F.lit("."), F.lit("")))
    letters = (F.length(typ) - inner).cast("double")
    return ratio * F.exp(-letters) * (inner + 1.0) * F.pow(letters, -n_without)


def pair_score(n_a: Column, n_b: Column, n_ab: Column, n: Column) -> Column:
    """Log-likelihood ratio of b after a, against b anywhere."""
    p, p1 = n_b / n, n_ab / n_a
    p2 = F.when(n > n_a, (n_b - n_ab) / (n - n_a)).otherwise(F.lit(1.0))

    def inside(of: Column, q: Column, terms: Column) -> Column:
        return F.when((of == n_ab) | (q <= 0) | (q >= 1), F.lit(0.0)).otherwise(terms)

    s1, s2 = _log_terms(n_ab, n_a, p), _log_terms(n_b - n_ab, n - n_a, p)
    s3 = inside(n_a, p1, _log_terms(n_ab, n_a, p1))
    s4 = inside(n_b, p2, _log_terms(n_b - n_ab, n - n_a, p2))
    return -2.0 * (s1 + s2 - s3 - s4)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def learn_boundaries(df: DataFrame, text_col: str = "text") -> BoundaryModel:
    """The model of a table of texts; its three tables are written to the shared folder."""
    doubled = [F.col(c).cast("double").alias(c) for c in ("n_with", "n_without")]
    types = _written(type_counts(df, text_col), "types").select("typ", *doubled)
    total = types.agg(F.sum("n_with").alias("p"), F.sum(F.col("n_with") + F.col("n_without")).alias("n")).first()
    n_words, n_periods = float(total.n or 1.0), float(total.p or 0.0)
    rate = min(max(n_periods, 0.5), n_words - 0.5)     # keeps both logarithms finite
    score = abbreviation_score(F.col("n_with"), F.col("n_without"), F.col("typ"), rate, n_words)
    candidates = types.filter((F.col("n_with") > 0) & F.col("typ").rlike(r"\p{L}") & ~F.col("typ").rlike(r"\p{N}"))
    abbreviations = _written(candidates.select("typ", score.alias("score")).filter(F.col("score") >= ABBREVIATION_SCORE),
                             "abbreviations")

    pairs = _written(boundary_counts(df, text_col), "boundaries").withColumn("n", F.col("n").cast("double"))
    known = abbreviations.select(F.col("typ").alias("before"), F.lit(True).alias("abbr"))
    pairs = pairs.join(known, "before", "left").withColumn("abbr", F.coalesce("abbr", F.lit(False)) & F.col("period"))
    counts = types.select("typ", (F.col("n_with") + F.col("n_without")).alias("n_typ"))
    breaks = pairs.filter(~F.col("abbr"))
    n_breaks = F.lit(float(breaks.agg(F.sum("n")).first()[0] or 1.0))
    n_all = F.lit(n_words)
    starts = breaks.groupBy(F.col("after").alias("typ")).agg(F.sum("n").alias("n_ab")).join(counts, "typ")
    starts = starts.withColumn("score", pair_score(n_breaks, F.col("n_typ"), F.col("n_ab"), n_all))
    starters = _written(starts.filter((F.col("score") >= STARTER_SCORE) & (n_all / n_breaks > F.col("n_typ") / F.col("n_ab"))
                                      & F.col("typ").rlike(r"^\p{L}")).select("typ", "score"), "starters")

    tied = F.col("abbr") | F.col("before").rlike(r"^(\p{L}|[\p{N}.,-]*\p{N})$")
    near = pairs.filter(F.col("period") & tied & (F.col("before") != "") & (F.col("after") != ""))
    near = near.join(starters.select(F.col("typ").alias("after")), "after", "left_anti")
    near = near.join(counts.toDF("before", "n_a"), "before").join(counts.toDF("after", "n_b"), "after")
    near = near.withColumn("score", pair_score(F.col("n_a"), F.col("n_b"), F.col("n"), n_all))
    collocations = _written(near.filter((F.col("score") >= COLLOCATION_SCORE) & (n_all / F.col("n_a") > F.col("n_b") / F.col("n"))
                                        ).select("before", "after", "score"), "boundary-pairs")
    return BoundaryModel(abbreviations, starters, collocations)


def _capitalised(token: Column) -> Column:
    """The first letter or digit is an upper-case letter."""
    return F.regexp_replace(token, r"^[^\p{L}\p{N}]+", "").rlike(r"^\p{Lu}")


def _joined(cut: Column, breaks) -> Column:
    """Sentences of the segments ``cut``, with a boundary after segment i where ``breaks(i)``."""
    escaped = F.transform(cut, lambda s, i: F.concat(
        F.replace(s, F.lit(ESCAPE), F.lit(ESCAPED)), F.when(breaks(i), F.lit(BREAK)).otherwise(F.lit(""))))
    return F.filter(F.transform(F.split(F.array_join(escaped, ""), BREAK), lambda s: F.regexp_replace(
        F.replace(s, F.lit(ESCAPED), F.lit(ESCAPE)), r"^\s+", "")), lambda s: s != "")


def _is_any(value: Column, held: list) -> Column:
    return value.isin(held) if held else F.lit(False)


def learned_sentences(df: DataFrame, model: BoundaryModel, id_col: str = "doc_id", text_col: str = "text",
                      max_inline: int = MAX_INLINE_TYPES, hash_col: str | None = None) -> DataFrame:
    """``id_col, sid, sentence``: one row per sentence of every row with a text, with the
    text's xxhash64 as ``hash_col`` if named."""
    rows = df.select(F.col(id_col).alias("_id"), segments(F.col(text_col)).alias("_s"),
                     F.xxhash64(text_col).alias("_h"))
    # Per boundary: the types around it, whether its mark is one period, whether a capital follows.
    rows = rows.select("_id", "_h", "_s", F.transform("_s", _last).alias("_l"), F.transform("_s", _first).alias("_f"))
    rows = rows.select("_id", "_h", "_s", F.transform("_l", word_type).alias("_b"), F.transform("_f", word_type).alias("_a"),
                       F.transform("_l", has_period).alias("_p"), F.transform("_f", _capitalised).alias("_c"))
    heads = [t.limit(max_inline + 1).collect() for t in (model.abbreviations, model.starters, model.collocations)]
    if max(map(len, heads)) <= max_inline:
        abbreviations, starters = ([r.typ for r in h] for h in heads[:2])
        pairs = [f"{r.before} {r.after}" for r in heads[2]]

        def breaks(i: Column) -> Column:
            before, after, next_is_upper = F.get("_b", i), F.get("_a", i + 1), F.get("_c", i + 1)
            abbr = _is_any(before, abbreviations) & ~(next_is_upper & _is_any(after, starters))
            pair = _is_any(F.concat_ws(" ", before, after), pairs)
            return F.coalesce(~(F.get("_p", i) & (abbr | pair)), F.lit(True))
        done = rows.select("_id", "_h", _joined(F.col("_s"), breaks).alias("_out"))
    else:
        done = _joined_by_tables(rows, model)
    out = explode_with_position(done, F.col("_out"), ["_id", "_h"], "sid", "sentence").withColumnRenamed("_id", id_col)
    return out.withColumnRenamed("_h", hash_col) if hash_col else out.drop("_h")


def _joined_by_tables(rows: DataFrame, model: BoundaryModel) -> DataFrame:
    """The same decisions by joins: boundaries at a period meet the learnt tables, and the
    places of those that are none come back to their row."""
    at = F.transform("_b", lambda b, i: F.struct(b.alias("before"), F.get("_a", i + 1).alias("after"),
                                                 F.get("_p", i).alias("period"), F.get("_c", i + 1).alias("upper")))
    each = explode_with_position(rows, at, ["_id", "_h"], "_at", "_v").select("_id", "_h", "_at", "_v.*")
    each = each.filter(F.col("period") & F.col("after").isNotNull())
    each = (each.join(model.abbreviations.select(F.col("typ").alias("before"), F.lit(True).alias("_abbr")), "before", "left")
            .join(model.starters.select(F.col("typ").alias("after"), F.lit(True).alias("_start")), "after", "left")
            .join(model.collocations.select("before", "after", F.lit(True).alias("_pair")), ["before", "after"], "left"))
    kept = F.col("_pair").isNotNull() | (F.col("_abbr").isNotNull() & ~(F.col("upper") & F.col("_start").isNotNull()))
    tied = each.filter(kept).groupBy(F.col("_id").alias("_ti"), F.col("_h").alias("_th")).agg(
        F.array_sort(F.collect_set("_at")).alias("_t"))
    out = rows.join(tied, F.col("_id").eqNullSafe(F.col("_ti")) & (F.col("_h") == F.col("_th")), "left")
    # One digit per segment: 0 where no boundary follows.
    zeros = F.array_join(F.transform("_t", lambda t, i: F.concat(
        F.repeat(F.lit("1"), t - F.coalesce(F.get("_t", i - 1), F.lit(-1)) - 1), F.lit("0"))), "")
    out = out.withColumn("_d", F.split(zeros, ""))
    return out.select("_id", "_h", _joined(F.col("_s"), lambda i: F.coalesce(F.get("_d", i) != "0", F.lit(True))).alias("_out"))
