"""License scan by a positional rare-token index.

Notices are indexed as word -> postings (notice, position), without stop words and
lead-in words ("Released under", "subject to the terms of"), each word weighted by its IDF over the notices. A file's highest-IDF licence words are looked
up; a posting votes for the place where its notice would start (file position less
notice position), and the weight of the best place over the notice's whole weight is its
score. A notice is reported at MIN_SCORE or more if its mandatory phrases stand in the
file. Each row is scanned by itself: no shuffle, no Python UDF.

Defined results: null or empty texts have no words, null positions, empty labels and
score 0; repeated rows are judged alike; a notice found twice is one label; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.fixed import ENGLISH_STOP_WORDS
from tonality.llm.common import lower_ascii

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_SCORE = 0.6
NEAR_TOP = 0.4
# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Words that lead in to a licence's name and tell nothing about which it is.
LEAD_INS = frozenset("released licensed distributed subject terms".split())
# Label, mandatory phrases, notice.
NOTICES = (
    ("mit", ("mit license",), "Released under the MIT License"),
    ("mit", ("permission is hereby granted free of charge",),
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache-2.0", ("apache license", "version 2 0"), "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", ("gnu general public license", "version 3"), "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", ("gnu general public license", "version 2"), "licensed under the GNU General Public License, version 2"),
    ("lgpl", ("lesser general public license",), "licensed under the GNU Lesser General Public License"),
    ("mpl-2.0", ("mozilla public license",), "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc-4.0", ("cc by nc 4 0",), "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", ("cc by sa 4 0",), "Licensed under CC BY-SA 4.0"),
)


def words_of(text: str) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in re.split(SEPARATORS, low) if w]


def build_index(notices=NOTICES):
    """(idf per word, postings per word, whole weight per notice)."""
    stop = LEAD_INS.union(ENGLISH_STOP_WORDS)
    kept = [[(i, w) for i, w in enumerate(words_of(t)) if w not in stop] for _, _, t in notices]
    df: dict[str, int] = {}
    for words in kept:
        for w in {w for _, w in words}:
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(1 + len(notices) / n) for w, n in df.items()}
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, words in enumerate(kept):
        for i, w in words:
            postings.setdefault(w, []).append((t, i))
    return idf, postings, [sum(idf[w] for _, w in words) for words in kept]


def spaced(text: Column) -> Column:
    """`` w1 w2 ... wn `` with single spaces; one space if there is no word."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" ")), SEPARATORS, " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) if not isinstance(x, Column) else x for kv in pairs for x in kv])


def scan(docs: DataFrame, notices=NOTICES, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    idf, postings, weight = build_index(notices)
    base = "|".join(sorted(BASE))
    pattern = f" ({base})(?= )"
    out = docs.select("doc_id", spaced(F.col("text")).alias("_t"))
    out = out.withColumn("_found", F.regexp_extract_all("_t", F.lit(pattern), F.lit(1)))
    out = out.withColumn("_parts", F.when(F.size("_found") > 0, F.split("_t", pattern, -1)))
    n_words = F.greatest(F.lit(0), _spaces(F.col("_t")) - 1)
    last_len = _spaces(F.element_at("_found", -1)) + 1
    out = out.withColumn("n_words", n_words.cast("long"))
    first = _spaces(F.element_at("_parts", 1)).cast("long")
    last = (F.col("n_words") - (_spaces(F.element_at("_parts", -1)) - 1) - last_len).cast("long")

    # Positions of the file's licence words; the lookup table is as large as the notices.
    at = F.filter(F.transform(F.split(F.trim("_t"), " "), lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                  lambda x: x["w"].isin(sorted(idf)))
    idf_of = _map((w, F.lit(v)) for w, v in sorted(idf.items()))
    places = _map((w, F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in v]))
                  for w, v in sorted(postings.items()))
    out = out.withColumn("_hits", F.transform(at, lambda x: F.struct(
        x["i"].alias("i"), x["w"].alias("w"), F.element_at(idf_of, x["w"]).alias("f"))))
    top = F.array_max(F.transform("_hits", lambda x: x["f"])) * NEAR_TOP
    out = out.withColumn("_top", top)
    out = out.withColumn("_votes", F.array_sort(F.flatten(F.transform(
        F.filter("_hits", lambda x: x["f"] >= F.col("_top")), lambda h: F.transform(
            F.element_at(places, h["w"]), lambda p: F.struct(
                p["t"].alias("t"), (h["i"] - p["p"]).alias("start"), h["f"].alias("f")))))))

    def best(t: int) -> Column:
        """The largest weight at one start, in one pass over sorted votes."""
        mine = F.filter("_votes", lambda v: v["t"] == t)
        zero = F.struct(F.lit(None).cast("int").alias("start"), F.lit(0.0).alias("run"), F.lit(0.0).alias("best"))

        def step(acc: Column, v: Column) -> Column:
            run = F.when(acc["start"] == v["start"], acc["run"]).otherwise(F.lit(0.0)) + v["f"]
            return F.struct(v["start"].alias("start"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

        return F.aggregate(mine, zero, step, lambda acc: acc["best"]) / weight[t]

    scores = [best(t) for t in range(len(notices))]
    out = out.withColumn("_scores", F.when(F.size("_votes") > 0, F.array(*scores)))
    found = []
    for t, (label, phrases, _) in enumerate(notices):
        hit = F.col("_scores")[t] >= min_score - 1e-9
        for p in phrases:
            hit = hit & F.col("_t").contains(f" {p} ")
        found.append(F.when(hit, F.lit(label)))
    base_labels = F.array_sort(F.array_distinct(F.transform(
        "_found", lambda x: F.element_at(_map(sorted(BASE.items())), x))))
    out = out.withColumn("_base", base_labels).withColumn("_more", F.array_compact(F.array(*found)))
    score = F.when(F.size("_found") > 0, F.lit(1.0)).when(
        F.size("_more") > 0, F.least(F.lit(1.0), F.array_max("_scores"))).otherwise(F.lit(0.0))
    some = F.size("_found") > 0
    return out.select(
        "doc_id", "n_words", F.size("_found").cast("long").alias("n_base"), F.when(some, first).alias("first_word"),
        F.when(some, last).alias("last_word"), F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", "_more")), ",").alias("labels"), score.alias("score"))
