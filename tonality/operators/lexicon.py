"""Rule-based lexicon sentiment over caller-supplied word tables.

Inputs: a text table, a lexicon ``(token, valence)``, boosters
``(token, incr)`` and negators ``(token)``. Per sentence the published
rules (Hutto & Gilbert 2014) give a compound score in [-1, 1] plus
positive / neutral / negative shares; a document's score is the mean
compound over its sentences.

Plan, one pass over the text and no shuffle of it:

1. narrow: split sentences (``posexplode``), split words, strip edge
   punctuation, lower-case and all-caps flags; per sentence the word count,
   all-caps contrast, first ``but`` and the ``!`` / ``?`` emphasis.
2. In-row path (word tables of proven small size): lexicon membership,
   booster and negator tests are hashed ``IN`` sets (``InSet``), valences a
   ``CASE`` over the distinct values; the rules run as successive array
   passes in the sentence's row, so a sentence is scored where it is read.
3. Join path (larger tables): words become rows carrying their three
   preceding words (no window needed); broadcast hash joins (size checked;
   beyond the bound, shuffle joins salted by document) attach the roles;
   hits plus one anchor row per sentence regroup per
   ``(doc, text hash, sentence)`` with map-side partial aggregation; exact
   duplicate rows fold into one group and are divided back by their count.
4. ``groupBy(doc)``: mean compound, summed as integers of 1e-4 so the
   result does not depend on the summation order; partial aggregation sends
   one row per task and document, so a hot document id stays cheap.

Words of the tables that hold spaces are phrases: before the rules run, the
longest phrases of a sentence merge into units (``operators.phrases``), which
then act like words. That covers idioms, "kind of", "at least" and "without
doubt"; "never so / this" are units with a factor, "least" negates the next
word only (``fixed.PUBLISHED_PHRASES``). Left out of the published rules:
emoji translation. The ``but`` rule uses positions of units.

Both paths give one row per sentence of every input row, repeated rows included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.functions.arrays import explode_values, explode_with_position
from tonality.fixed import (BOOSTER_DAMPING, BUT_AFTER, BUT_BEFORE, CAPS_INCREMENT,
                            CONTRAST_WORD, EXCLAMATION_MAX, EXCLAMATION_WEIGHT, FACTOR_DAMPING,
                            NEGATION_SCALAR, NEGATION_SUFFIX, NEUTRAL_BAND,
                            NORMALIZATION_ALPHA, QUESTION_MANY, QUESTION_WEIGHT)
from tonality.functions.text import count_char, split_sentences, strip_punctuation
from tonality.operators.boundaries import BoundaryModel, learned_sentences
from tonality.operators.joins import MAX_BROADCAST_ROWS, row_count_at_most
from tonality.operators.phrases import merge_by_join, merge_in_row, normal_phrase
from tonality.schemas import BOOSTERS, LEXICON, NEGATORS, PHRASES  # noqa: F401

LOOKBACK = 3
SALT_BUCKETS = 16
# Scoring words up to this many become an in-row hash set (InSet) that picks
# the words worth a row; larger lexicons take the row-per-word path.
MAX_INLINE_WORDS = 100_000


def word_roles(lexicon: DataFrame, boosters: DataFrame | None = None,
               negators: DataFrame | None = None, phrases: DataFrame | None = None) -> DataFrame:
    """One row per lower-case word or phrase: ``w, valence, incr, neg, factor,
    near`` (one union, one ``groupBy``). A word listed twice keeps its largest
    value. ``phrases`` has ``schemas.PHRASES``; a phrase may have any role or
    none, in which case its words only lose their own."""
    def part(df: DataFrame, word: str, **roles) -> DataFrame:
        kinds = {"valence": "double", "incr": "double", "neg": "boolean", "factor": "double", "near": "boolean"}
        fill = {"neg": False, "near": False}
        return df.select(normal_phrase(F.col(word)).alias("w"), *[
            F.coalesce(roles.get(r, F.lit(fill.get(r))).cast(t), F.lit(fill.get(r)).cast(t)).alias(r)
            for r, t in kinds.items()])

    parts = [part(lexicon, "token", valence=F.col("valence"))]
    if boosters is not None:
        parts.append(part(boosters, "token", incr=F.col("incr")))
    if negators is not None:
        parts.append(part(negators, "token", neg=F.lit(True)))
    if phrases is not None:
        parts.append(part(phrases, "phrase", **{c: F.col(c) for c in PHRASES.names[1:]}))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return (rows.filter(F.col("w").isNotNull()).groupBy("w")
            .agg(*[F.max(c).alias(c) for c in ("valence", "incr", "neg", "factor", "near")]))


def punctuation_emphasis(sentence: Column) -> Column:
    bangs = F.least(count_char(sentence, "!"), F.lit(EXCLAMATION_MAX))
    marks = count_char(sentence, "?")
    question = (F.when(marks <= 1, F.lit(0.0))
                .when(marks <= 3, marks * QUESTION_WEIGHT)
                .otherwise(F.lit(QUESTION_MANY)))
    return bangs * EXCLAMATION_WEIGHT + question


def _item(i: Column, lower: Column, caps: Column) -> Column:
    """Word at position ``i``: position, lower form, caps flag and the three
    preceding words with their caps flags."""
    fields = [i.alias("pos"), F.get(lower, i).alias("w"), F.get(caps, i).alias("up")]
    for d in range(1, LOOKBACK + 1):
        fields.append(F.get(lower, i - d).alias(f"p{d}"))
        fields.append(F.get(caps, i - d).alias(f"u{d}"))
    return F.struct(*fields)


def _word_items(lower: Column, caps: Column, scoring_words: list[str] | None) -> Column:
    """Items for every word, or, given the (proven small) set of words that
    carry a valence, only for those: a hashed membership test picks their
    positions, so structs, rows and lookups are made for hits only."""
    if scoring_words is None:
        return F.transform(lower, lambda w, i: _item(i, lower, caps))
    positions = F.filter(F.transform(lower, lambda w, i: F.when(w.isin(scoring_words), i)),
                         lambda i: i.isNotNull())
    return F.transform(positions, lambda i: _item(i, lower, caps))


def _anchor_item() -> Column:
    fields = [F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("w"),
              F.lit(None).cast("boolean").alias("up")]
    for d in range(1, LOOKBACK + 1):
        fields.append(F.lit(None).cast("string").alias(f"p{d}"))
        fields.append(F.lit(None).cast("boolean").alias(f"u{d}"))
    return F.struct(*fields)


def sentence_table(df: DataFrame, id_col: str, text_col: str,
                   boundaries: BoundaryModel | None = None) -> DataFrame:
    """(id, thash, sid, sentence): ``posexplode`` of the sentence split, by
    marks alone or by learnt ``boundaries``.

    Per-row values are projected before the generator, so no sentence row
    carries (or re-hashes) the whole text."""
    if boundaries is not None:
        rows = learned_sentences(df, boundaries, id_col, text_col, hash_col="thash")
        return rows.select(F.col(id_col).alias("doc_id"), "thash", "sid", "sentence")
    rows = df.select(F.col(id_col).alias("doc_id"),
                     F.xxhash64(F.col(text_col)).alias("thash"),
                     split_sentences(F.col(text_col)).alias("sentences"))
    return explode_with_position(rows, F.col("sentences"), ["doc_id", "thash"], "sid", "sentence")


def _words(sentences: DataFrame) -> DataFrame:
    """(doc_id, thash, sid, punct, words). Sentences from split_sentences are
    trimmed and never hold an empty word, so a plain split on whitespace runs
    gives the words."""
    return sentences.select(
        "doc_id", "thash", "sid",
        punctuation_emphasis(F.col("sentence")).alias("punct"),
        F.transform(F.split(F.col("sentence"), r"\s+"), strip_punctuation).alias("words"))


def _word_rows(per_sentence: DataFrame, scoring_words: list[str] | None = None) -> DataFrame:
    per_sentence = per_sentence.select(
        "doc_id", "thash", "sid", "punct", "words",
        F.transform("words", F.lower).alias("lw"))
    per_sentence = per_sentence.select(
        "doc_id", "thash", "sid", "punct", "lw",
        F.zip_with("words", "lw", lambda w, lo: (F.upper(w) == w) & (lo != w)).alias("caps"))
    n_tok = F.size("lw")
    n_caps = F.size(F.filter("caps", lambda c: c))
    items = F.concat(F.array(_anchor_item()), _word_items(F.col("lw"), F.col("caps"), scoring_words))
    # Sentence-level values first, then the generator: word rows carry only
    # scalars, never the sentence's arrays.
    per_sentence = per_sentence.select(
        "doc_id", "thash", "sid", "punct",
        n_tok.alias("n_tok"),
        ((n_caps > 0) & (n_caps < n_tok)).alias("cap_diff"),
        (F.array_position("lw", CONTRAST_WORD) - 1).alias("but_at"),
        items.alias("items"))
    exploded = explode_values(per_sentence, F.col("items"),
                              ["doc_id", "thash", "sid", "punct", "n_tok", "cap_diff", "but_at"], "it")
    return exploded.select("doc_id", "thash", "sid", "punct", "n_tok", "cap_diff",
                           "but_at", "it.*")


def _lookup(rows: DataFrame, roles: DataFrame, key: str, prefix: str,
            broadcast: bool) -> DataFrame:
    side = roles.select(F.col("w").alias(key), F.col("valence").alias(f"{prefix}v"),
                        F.col("incr").alias(f"{prefix}b"), F.col("neg").alias(f"{prefix}n"),
                        F.col("factor").alias(f"{prefix}f"), F.col("near").alias(f"{prefix}x"))
    if broadcast:
        return rows.join(F.broadcast(side), key, "left")
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "sid"), F.lit(SALT_BUCKETS)))
    salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1))))
    return salted_rows.join(salted_side, [key, "_salt"], "left").drop("_salt")


def _after_role(boosted: Column, negated: Column, near: Column, factor: Column, d: int) -> Column:
    """A boosted valence after the word at distance ``d``: negated, or scaled by its factor."""
    turned = negated | near if d == 1 else negated
    scale = F.lit(1.0) + (factor - 1.0) * FACTOR_DAMPING[d - 1]
    return (F.when(turned, boosted * NEGATION_SCALAR).when(factor.isNotNull(), boosted * scale)
            .otherwise(boosted))


def _signed(v: Column, amount: float) -> Column:
    return F.when(v > 0, F.lit(amount)).otherwise(F.lit(-amount))


def _valence_rules(hits: DataFrame) -> DataFrame:
    """Valence of each lexicon word after caps, booster and negation rules."""
    caps = F.col("up") & F.col("cap_diff")
    out = hits.withColumn("v", F.col("valence") + F.when(caps, _signed(F.col("valence"), CAPS_INCREMENT))
                          .otherwise(F.lit(0.0)))
    for d in range(1, LOOKBACK + 1):
        v = F.col("v")
        prev, pv, pb, pn, pu = (F.col(f"p{d}"), F.col(f"r{d}v"), F.col(f"r{d}b"),
                                F.col(f"r{d}n"), F.col(f"u{d}"))
        applies = prev.isNotNull() & pv.isNull()
        scalar = (F.when(v < 0, -pb).otherwise(pb)
                  + F.when(pu & F.col("cap_diff"), _signed(v, CAPS_INCREMENT)).otherwise(F.lit(0.0)))
        boosted = v + F.when(pb.isNotNull(), scalar * BOOSTER_DAMPING[d - 1]).otherwise(F.lit(0.0))
        negated = F.coalesce(pn, F.lit(False)) | prev.contains(NEGATION_SUFFIX)
        stepped = _after_role(boosted, negated, F.coalesce(F.col(f"r{d}x"), F.lit(False)), F.col(f"r{d}f"), d)
        out = out.withColumn("v", F.when(applies, stepped).otherwise(v))
    but = (F.when((F.col("but_at") >= 0) & (F.col("pos") < F.col("but_at")), F.col("v") * BUT_BEFORE)
           .when((F.col("but_at") >= 0) & (F.col("pos") > F.col("but_at")), F.col("v") * BUT_AFTER)
           .otherwise(F.col("v")))
    return out.withColumn("v", but)


def _sentence_scores(scored: DataFrame) -> DataFrame:
    v = F.col("v")
    agg = scored.groupBy("doc_id", "thash", "sid").agg(
        F.count_if(F.col("pos") < 0).alias("m"),
        F.max("n_tok").alias("n_tok"),
        F.max("punct").alias("punct"),
        F.sum(v).alias("s_raw"),
        F.sum(F.when(v > 0, v + 1.0)).alias("pos_raw"),
        F.sum(F.when(v < 0, v - 1.0)).alias("neg_raw"),
        F.count_if(v != 0).alias("nz"))
    return _finish_sentences(agg)


def _finish_sentences(agg: DataFrame) -> DataFrame:
    """Compound and shares from per-sentence sums (``m`` copies folded in)."""
    m = F.col("m").cast("double")
    s = F.coalesce(F.col("s_raw") / m, F.lit(0.0))
    punct = F.col("punct")
    emphasized = F.when(s > 0, s + punct).when(s < 0, s - punct).otherwise(s)
    compound = F.round(emphasized / F.sqrt(emphasized * emphasized + NORMALIZATION_ALPHA), 4)
    ps = F.coalesce(F.col("pos_raw") / m, F.lit(0.0))
    ns = F.coalesce(F.col("neg_raw") / m, F.lit(0.0))
    ps2 = F.when(ps > F.abs(ns), ps + punct).otherwise(ps)
    ns2 = F.when(ps < F.abs(ns), ns - punct).otherwise(ns)
    neu = F.col("n_tok").cast("double") - F.col("nz").cast("double") / m
    total = ps2 + F.abs(ns2) + neu
    has_words = F.col("n_tok") > 0

    def share(x):
        return F.when(has_words, F.round(F.abs(x / total), 3)).otherwise(F.lit(0.0))

    return agg.select("doc_id", "thash", "sid", "m",
                      F.when(has_words, compound).otherwise(F.lit(0.0)).alias("compound"),
                      share(ps2).alias("pos"), share(neu).alias("neu"), share(ns2).alias("neg"))


MAX_VALUE_GROUPS = 256


def _lookup_expr(w: Column, groups: dict[float, list[str]]) -> Column:
    """Value of ``w`` from hashed membership tests, one per distinct value."""
    expr = None
    for value, words in sorted(groups.items()):
        cond = w.isin(words)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr if expr is not None else F.lit(None).cast("double")


def _in_row_tables(rows) -> dict | None:
    """Word tables as literal sets, or None when a table has too many values."""
    vgroups: dict[float, list[str]] = {}
    bgroups: dict[float, list[str]] = {}
    fgroups: dict[float, list[str]] = {}
    lexicon_words, negators, near = [], [], []
    for r in rows:
        if r.valence is not None:
            lexicon_words.append(r.w)
            if r.incr is None:
                vgroups.setdefault(r.valence, []).append(r.w)
        if r.incr is not None:
            bgroups.setdefault(r.incr, []).append(r.w)
        if r.neg:
            negators.append(r.w)
        if r.near:
            near.append(r.w)
        if r.factor is not None:
            fgroups.setdefault(r.factor, []).append(r.w)
    if max(len(vgroups), len(bgroups), len(fgroups)) > MAX_VALUE_GROUPS:
        return None
    return {"v": vgroups, "b": bgroups, "f": fgroups, "near": sorted(near), "lex": sorted(lexicon_words),
            "neg": sorted(negators), "scoring": sorted(w for ws in vgroups.values() for w in ws)}


def _in_row_sentence_scores(per: DataFrame, t: dict) -> DataFrame:
    """Per sentence, in the sentence's own row (no join, no shuffle)."""
    lexicon_words, negators, scoring = t["lex"], t["neg"], t["scoring"]
    per = per.select("doc_id", "thash", "sid", "punct", "words",
                     F.transform("words", F.lower).alias("lw"))
    per = per.select("doc_id", "thash", "sid", "punct", "lw",
                     F.zip_with("words", "lw", lambda w, lo: (F.upper(w) == w) & (lo != w)).alias("caps"))
    n_tok = F.size("lw")
    n_caps = F.size(F.filter("caps", lambda c: c))
    per = per.select("doc_id", "thash", "sid", "punct", "lw", "caps", n_tok.alias("n_tok"),
                     ((n_caps > 0) & (n_caps < n_tok)).alias("cap_diff"),
                     (F.array_position("lw", CONTRAST_WORD) - 1).alias("but_at"))
    lw, caps, cap_diff = F.col("lw"), F.col("caps"), F.col("cap_diff")

    def base(w, i):
        val = _lookup_expr(w, t["v"])
        return F.when(w.isin(scoring), val + F.when(F.get(caps, i) & cap_diff,
                                                    _signed(val, CAPS_INCREMENT))
                      .otherwise(F.lit(0.0)))
    per = per.withColumn("vals", F.transform(lw, base))
    def make_step(d: int):
        def step(v, i):
            prev = F.get(lw, i - d)
            pb = _lookup_expr(prev, t["b"])
            applies = v.isNotNull() & prev.isNotNull() & ~prev.isin(lexicon_words)
            scalar = (F.when(v < 0, -pb).otherwise(pb)
                      + F.when(F.get(caps, i - d) & cap_diff, _signed(v, CAPS_INCREMENT))
                      .otherwise(F.lit(0.0)))
            boosted = v + F.when(pb.isNotNull(), scalar * BOOSTER_DAMPING[d - 1]).otherwise(F.lit(0.0))
            negated = prev.isin(negators) | prev.contains(NEGATION_SUFFIX)
            near = prev.isin(t["near"]) if t["near"] else F.lit(False)
            factor = _lookup_expr(prev, t["f"])
            if not t["f"] and not (t["near"] and d == 1):   # the common case: a shorter expression
                stepped = F.when(negated, boosted * NEGATION_SCALAR).otherwise(boosted)
            else:
                stepped = _after_role(boosted, negated, near, factor, d)
            return F.when(applies, stepped).otherwise(v)
        return step

    for d in range(1, LOOKBACK + 1):
        per = per.withColumn("vals", F.transform("vals", make_step(d)))
    but_at = F.col("but_at")

    def but(v, i):
        return (F.when((but_at >= 0) & (i < but_at), v * BUT_BEFORE)
                .when((but_at >= 0) & (i > but_at), v * BUT_AFTER).otherwise(v))
    per = per.withColumn("vals", F.filter(F.transform("vals", but), lambda v: v.isNotNull()))
    vals = F.col("vals")
    agg = per.select(
        "doc_id", "thash", "sid", "n_tok", "punct", F.lit(1).cast("bigint").alias("m"),
        F.aggregate(vals, F.lit(0.0), lambda a, v: a + v).alias("s_raw"),
        F.aggregate(vals, F.lit(0.0), lambda a, v: a + F.when(v > 0, v + 1.0).otherwise(F.lit(0.0)))
        .alias("pos_raw"),
        F.aggregate(vals, F.lit(0.0), lambda a, v: a + F.when(v < 0, v - 1.0).otherwise(F.lit(0.0)))
        .alias("neg_raw"),
        F.size(F.filter(vals, lambda v: v != 0)).cast("bigint").alias("nz"))
    return _finish_sentences(agg)


def sentence_scores(df: DataFrame, roles: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text",
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    in_row: bool = True, boundaries: BoundaryModel | None = None) -> DataFrame:
    """Per sentence: ``id, sid, compound, pos, neu, neg``.

    Rows with null text have no sentence. ``roles`` is ``word_roles(...)``.
    Word tables of proven small size (and at most ``MAX_VALUE_GROUPS``
    distinct values) are applied in the sentence's own row as hashed
    membership tests: no join and no shuffle. Otherwise (or with
    ``in_row=False``) words become rows that meet the tables in broadcast
    (or salted) joins and regroup per sentence, and rows folded there
    (same id and text) come out as often as they went in."""
    # One bounded read answers both size questions for the usual small table.
    head = roles.limit(MAX_INLINE_WORDS + 1).collect()
    scoring_words = None
    if len(head) <= MAX_INLINE_WORDS:
        small = len(head) <= max_broadcast_rows
        if small:
            scoring_words = sorted(r.w for r in head
                                   if r.valence is not None and r.incr is None)
    else:
        small = row_count_at_most(roles, max_broadcast_rows)
    words = _words(sentence_table(df, id_col, text_col, boundaries))
    has_phrases = F.col("w").contains(" ")
    if len(head) <= MAX_INLINE_WORDS:
        words = merge_in_row(words, [r.w for r in head if " " in r.w])
    else:
        words = merge_by_join(words, roles.filter(has_phrases), ["doc_id", "thash", "sid"])
    if in_row and scoring_words is not None:
        tables = _in_row_tables(head)
        if tables is not None:
            per_sentence = _in_row_sentence_scores(words, tables)
            return per_sentence.select(F.col("doc_id").alias(id_col), "thash", "sid", "m",
                                       "compound", "pos", "neu", "neg")
    if small:
        # Proven small: kept in memory once, so the four broadcast lookups
        # below do not each recompute it.
        roles = roles.cache()
    words = _word_rows(words, scoring_words)
    first = _lookup(words, roles.withColumn("neg", F.lit(None).cast("boolean")), "w", "r0", small)
    hits = first.filter((F.col("pos") < 0) | (F.col("r0v").isNotNull() & F.col("r0b").isNull()))
    hits = hits.withColumnRenamed("r0v", "valence").drop("r0b", "r0n", "r0f", "r0x")
    for d in range(1, LOOKBACK + 1):
        hits = _lookup(hits, roles, f"p{d}", f"r{d}", small)
    per_sentence = _sentence_scores(_valence_rules(hits))
    # Repeated rows folded into one group come out as rows again.
    per_sentence = per_sentence.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("m").cast("int"))))
    return per_sentence.select(F.col("doc_id").alias(id_col), "thash", "sid", F.lit(1).cast("bigint").alias("m"),
                               "compound", "pos", "neu", "neg")


def document_scores(df: DataFrame, roles: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", score_col: str = "vader",
                    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                    in_row: bool = True, boundaries: BoundaryModel | None = None) -> DataFrame:
    """Per id: mean sentence compound (``score_col``) and sentence count ``n``.

    Rows sharing an id are averaged together over all their sentences. The
    only shuffle is this ``groupBy(id)``, partial-aggregated map-side (one
    row per task and id)."""
    sent = sentence_scores(df, roles, id_col, text_col, max_broadcast_rows, in_row, boundaries)
    units = F.round(F.col("compound") * 10000).cast("bigint") * F.col("m")
    doc = sent.groupBy(id_col).agg(F.sum(units).alias("units"), F.sum("m").alias("n"))
    return doc.select(id_col, (F.col("units").cast("double") / (F.col("n") * 10000.0)).alias(score_col),
                      "n")


def polarity_class(score: Column, classes: int = 3) -> Column:
    """Class from a compound score: three-class 1 / 2 / 3 (negative, neutral,
    positive, neutral band +-0.05) or binary 1 / 0."""
    if classes == 2:
        return F.when(score >= NEUTRAL_BAND, F.lit(1.0)).otherwise(F.lit(0.0))
    return (F.when(score >= NEUTRAL_BAND, F.lit(3.0))
            .when(score <= -NEUTRAL_BAND, F.lit(1.0))
            .otherwise(F.lit(2.0)))


def lexicon_tables(spark: SparkSession, lexicon: list[tuple[str, float]],
                   boosters: list[tuple[str, float]] = (),
                   negators: list[str] = (), phrases: list[tuple] = ()) -> tuple[DataFrame, ...]:
    return (spark.createDataFrame(list(lexicon), LEXICON),
            spark.createDataFrame(list(boosters), BOOSTERS),
            spark.createDataFrame([(w,) for w in negators], NEGATORS),
            spark.createDataFrame(list(phrases), PHRASES))
