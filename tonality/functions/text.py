"""Text column functions, all JVM-side (no Python UDF).

``tokenize`` equals MLlib's ``Tokenizer``: lower case, split on each single
whitespace character, so a double space yields an empty token; trailing
empty tokens vanish, ``""`` gives one empty token and whitespace-only text
gives none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality.fixed import ENGLISH_STOP_WORDS, PUNCTUATION

# The look-behinds let a run match from its first character only, so long runs of
# whitespace or marks cost linear time.
TRAILING_SPACE = r"(?<!\s)\s++$"
# Whitespace after a sentence-final mark ends a sentence.
SENTENCE_BREAK = r"(?<=[.!?])\s+"


def tokenize(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(text), TRAILING_SPACE, "")
    return (F.when(text.rlike(r"^\s+$"), F.array().cast("array<string>"))
            .otherwise(F.split(lowered, r"\s")))


def default_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark's default stop words; languages other than English are asked of
    the running session."""
    if language == "english":
        return ENGLISH_STOP_WORDS
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def remove_stop_words(tokens: Column, words: Sequence[str],
                      case_sensitive: bool = False) -> Column:
    """Tokens not in ``words``. The literal list becomes a hash set (InSet)."""
    if case_sensitive:
        stop = list(dict.fromkeys(words))
        return F.filter(tokens, lambda t: ~t.isin(stop))
    stop = list(dict.fromkeys(w.lower() for w in words))
    return F.filter(tokens, lambda t: ~F.lower(t).isin(stop))


def split_sentences(text: Column) -> Column:
    """Sentences: the trimmed text cut after each run of ``.``, ``!`` or ``?``
    that is followed by whitespace; empty text gives no sentence."""
    trimmed = F.regexp_replace(text, r"^\s+|" + TRAILING_SPACE, "")
    return F.filter(F.split(trimmed, SENTENCE_BREAK), lambda s: s != "")


def sentence_words(sentence: Column) -> Column:
    """Whitespace-separated words of a sentence, no empty ones."""
    return F.filter(F.split(sentence, r"\s+"), lambda w: w != "")


def strip_punctuation(word: Column) -> Column:
    """Edge punctuation removed, unless that leaves two characters or fewer
    (which keeps emoticons such as ``:)`` whole)."""
    stripped = F.trim(word, F.lit(PUNCTUATION))
    return F.when(F.length(stripped) <= 2, word).otherwise(stripped)


def is_all_caps(word: Column) -> Column:
    """Has a cased letter and every cased letter is upper case."""
    return (F.upper(word) == word) & (F.lower(word) != word)


def count_char(text: Column, ch: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))
