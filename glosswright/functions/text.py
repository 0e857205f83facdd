"""Text metrics as column expressions (ids M1 to M20 of the operator list).

Every builder takes a string column and stays in the JVM; only the sequence-matching
similarity needs a vectorised Python function. Null texts give null counts, empty texts 0.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters, digits and underscores with inner apostrophes; the same in Java's and RE2's syntax.
WORD = r"[\p{L}\p{N}_]+(?:'+[\p{L}\p{N}_]+)*"
SENTENCE_END = r"[.!?]+"
VOWELS = r"[aeiouy]+"
LONG_WORD = 7
#: Letters, up to three digits, or one other mark: a stand-in for a tokenizer, not equal to any.
APPROX_TOKEN = r"\p{L}+|\p{N}{1,3}|[^\s\x0b\p{L}\p{N}]+"
ENTITY = r"\b(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}|[A-Z]{2,}(?:\s+[A-Z]{2,})*)\b"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also inside other higher-order functions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze_spaces(text: Column) -> Column:
    """M1: runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"[\s\p{Z}\x1c-\x1f\x85]+", " "))


def words(text: Column) -> Column:
    """M2: lower-cased words in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def word_count(text: Column) -> Column:
    """M3."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def sentence_count(text: Column) -> Column:
    """M4: runs of closing marks, so text without any has 0."""
    return F.regexp_count(text, F.lit(SENTENCE_END)).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """M5: 0.0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def _similarity(left: str | None, right: str | None) -> float | None:
    if left is None or right is None:
        return None
    a, b = " ".join(left.split()), " ".join(right.split())
    if not a or not b:
        return 1.0 if a == b else 0.0
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def sequence_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """M6: matching-blocks ratio of the standard library. Not symmetric: keep (source, result) order."""
    return pd.Series([_similarity(a, b) for a, b in zip(left, right)], dtype="float64")


#: So that a filter on a similarity is not pushed below it and every pair matched twice.
sequence_similarity = sequence_similarity.asNondeterministic()


def token_jaccard(left: Column, right: Column) -> Column:
    """Overlap of word sets: a similarity that SQL can state. 1.0 for two empty texts."""

    def share(p: Column) -> Column:
        union = F.size(F.array_union(p["a"], p["b"]))
        return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(p["a"], p["b"])) / union)

    return F.when(left.isNotNull() & right.isNotNull(), let(F.struct(words(left).alias("a"), words(right).alias("b")), share))


def approx_token_count(text: Column) -> Column:
    """M7 stand-in for where no tokenizer is injected; its name says that it is an estimate."""
    return F.regexp_count(text, F.lit(APPROX_TOKEN)).cast("bigint")


_START, _STOP = r"(?<![^ ])", r"(?![^ ])"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def word_sums(ws: Column, joined: Column, in_order: Column) -> Column:
    """Sums over the words for M8 and M9: words, kinds, words that occur once, letters, long words, syllables, hard words.

    *joined* holds the words with a space between them and *in_order* the same, sorted, so
    that every sum is one regular expression or array function in generated code: no
    explode, no shuffle, no interpreted fold.
    """
    kinds = F.size(F.array_distinct(ws)).cast("bigint")
    several = _count(in_order, rf"{_START}([^ ]+)(?: \1)+{_STOP}")
    n = F.size(ws).cast("bigint")
    return F.struct(
        n.alias("n"), kinds.alias("kinds"), (kinds - several).alias("once"), F.greatest(F.lit(0), F.length(joined) - (n - 1)).cast("bigint").alias("chars"), _count(joined, rf"[^ ]{{{LONG_WORD},}}").alias("long"),
        # a word without a vowel group counts one syllable
        (_count(joined, VOWELS) + _count(joined, rf"{_START}[^ aeiouy]+{_STOP}")).alias("syllables"),
        _count(joined, rf"{_START}[^ aeiouy]*[aeiouy]+[^ aeiouy]+[aeiouy]+[^ aeiouy]+[aeiouy][^ ]*").alias("hard"),
    )


def lexical(sums: Column) -> Column:
    """M8 from word_sums; zeros without words."""
    n = sums["n"]
    return F.struct(
        n.alias("word_count"), sums["kinds"].alias("unique_word_count"), ratio(sums["kinds"], n).alias("unique_ratio"), ratio(sums["once"], n).alias("hapax_ratio"),
        ratio(sums["chars"], n).alias("avg_word_length"), ratio(sums["long"], n).alias("long_word_ratio"),
    )


def readability(sums: Column, sentences: Column) -> Column:
    """M9 from word_sums by the published formulas: Flesch reading ease, automated readability, Gunning fog; null for wordless text."""
    n, s = sums["n"], F.greatest(F.lit(1), sentences)
    ease = 206.835 - 1.015 * (n / s) - 84.6 * (sums["syllables"] / n)
    automated = 4.71 * (sums["chars"] / n) + 0.5 * (n / s) - 21.43
    fog = 0.4 * (n / s + 100 * (sums["hard"] / n))
    some = n > 0
    return F.struct(F.when(some, ease).alias("flesch_reading_ease"), F.when(some, automated).alias("automated_readability_index"), F.when(some, fog).alias("gunning_fog"))


def ease_to_unit(ease: Column) -> Column:
    """0.5 for null, else ease / 100 clamped to [0, 1]."""
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ease / 100)), F.lit(0.5))


def quality_score(n_words: Column, unique: Column, hapax: Column, sentences: Column, ease: Column, long_ratio: Column) -> Column:
    """Weighted lexical variety, sentence density, ease and shortness of words; 0 without words."""
    variety = 0.6 * unique + 0.4 * hapax
    density = F.least(F.lit(1.0), sentences / F.greatest(F.lit(1.0), n_words / 20))
    plainness = 1 - F.least(F.lit(1.0), 2 * long_ratio)
    score = 0.45 * variety + 0.25 * density + 0.25 * ease_to_unit(ease) + 0.05 * plainness
    return F.when(n_words == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def words_per_sentence(n_words: Column, sentences: Column) -> Column:
    """M12."""
    return n_words / F.greatest(F.lit(1), sentences)


#: Frequent words of one language each, for the detector below.
STOP_WORDS = {
    "de": "der die und das ist nicht ein eine mit auf für den dem von".split(),
    "en": "the and of to that was with this it for have had she they".split(),
    "es": "el los las y una por con del para pero como era su más".split(),
    "fr": "le les et une dans que qui pour des du est pas avec était".split(),
}


def language_scores(joined: Column) -> Column:
    """Stop words of each language among the words: struct<n, k, code> of the best, the first in order on ties."""
    hits = {code: _count(joined, f"{_START}(?:{'|'.join(stop)}){_STOP}") for code, stop in STOP_WORDS.items()}
    return F.greatest(*[F.struct(n.alias("n"), F.lit(-k).alias("k"), F.lit(code).alias("code")) for k, (code, n) in enumerate(hits.items())])


def detect_language(best: Column) -> Column:
    """M13 from language_scores; unknown without any stop word."""
    return F.when(best["n"] > 0, best["code"]).otherwise("unknown")


def entities(text: Column) -> Column:
    """Distinct runs of capitalised words or capitals, longer than one character."""
    found = F.transform(F.regexp_extract_all(text, F.lit("(?U)" + ENTITY), F.lit(0)), F.trim)
    return F.array_distinct(F.filter(found, lambda e: F.length(e) > 1))


def topic_hint(text: Column) -> Column:
    """The first 16 words, or a stock phrase."""
    squeezed = squeeze_spaces(text)
    return F.when(squeezed == "", F.lit("general discussion")).otherwise(F.array_join(F.slice(F.split(squeezed, " "), 1, 16), " "))


def new_entities(source: Column, result: Column) -> Column:
    """Entities of the result that the source lacks."""
    return F.size(F.array_except(entities(result), entities(source))).cast("bigint")


def novel_ratio(candidate: Column, source: Column) -> Column:
    """Share of the candidate's words, with repeats, outside the source's vocabulary."""

    def share(p: Column) -> Column:
        # set difference by hash first, then only the few novel words are looked up
        return let(F.array_except(p["a"], p["b"]), lambda novel: ratio(F.size(F.filter(p["a"], lambda w: F.array_contains(novel, w))), F.size(p["a"])))

    return F.when(candidate.isNotNull() & source.isNotNull(), let(F.struct(words(candidate).alias("a"), words(source).alias("b")), share))


def with_sums(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Adds columns of intermediate results, each computed once per row.

    Do not filter on what follows from them in the same plan: the optimizer moves the filter
    below and writes the expressions out again. Cut the lineage first.
    """
    ws, joined, in_order = (f"__{prefix}{c}" for c in ("words", "joined", "in_order"))
    df = df.withColumn(ws, words(F.col(text)))
    df = df.withColumn(joined, F.array_join(ws, " ")).withColumn(in_order, F.array_join(F.sort_array(ws), " "))
    return df.withColumn(f"__{prefix}sums", word_sums(F.col(ws), F.col(joined), F.col(in_order))).withColumn(f"__{prefix}sentences", sentence_count(F.col(text)))


def with_profile(df: DataFrame, text: str, tokens: Column | None = None) -> DataFrame:
    """The analysis block (M2 to M13) as further columns."""
    kept = df.columns
    df = with_sums(df, text).withColumn("__best", language_scores(F.col("__joined"))).withColumn("__tokens", tokens if tokens is not None else approx_token_count(F.col(text)))
    sums, sentences = F.col("__sums"), F.col("__sentences")
    df = df.withColumn("__lex", lexical(sums)).withColumn("__read", readability(sums, sentences))
    n, lex, read = F.col("__lex.word_count"), F.col("__lex"), F.col("__read")
    return df.select(
        *kept, detect_language(F.col("__best")).alias("language"), F.col("__tokens").alias("token_count"), n.alias("word_count"), sentences.alias("sentence_count"),
        *[lex[c].alias(c) for c in ("unique_ratio", "hapax_ratio", "avg_word_length", "long_word_ratio")], *[read[c].alias(c) for c in ("flesch_reading_ease", "automated_readability_index", "gunning_fog")],
        words_per_sentence(n, sentences).alias("avg_words_per_sentence"), quality_score(n, lex["unique_ratio"], lex["hapax_ratio"], sentences, read["flesch_reading_ease"], lex["long_word_ratio"]).alias("quality_score"),
    )


def with_change(df: DataFrame, source: str, result: str, similarity: bool = False) -> DataFrame:
    """Counts of both sides, deltas and ratios, lexical and readability values per side; char_similarity where asked for."""
    kept = df.columns
    for prefix, column in (("source_", source), ("normalized_", result)):
        df = with_sums(df, column, prefix).withColumn(f"__{prefix}tokens", approx_token_count(F.col(column))).withColumn(f"__{prefix}chars", F.length(column).cast("bigint"))
        df = df.withColumn(f"__{prefix}lex", lexical(F.col(f"__{prefix}sums"))).withColumn(f"__{prefix}read", readability(F.col(f"__{prefix}sums"), F.col(f"__{prefix}sentences")))
    out = [F.col(c) for c in kept]
    for name in ("chars", "tokens", "words", "sentences"):
        a, b = [F.col(f"__{side}lex.word_count") if name == "words" else F.col(f"__{side}{name}") for side in ("source_", "normalized_")]
        out += [a.alias(f"source_{name}"), b.alias(f"normalized_{name}"), (b - a).alias(f"{name}_delta"), ratio(b, a).alias(f"{name}_ratio")]
    for side in ("source_", "normalized_"):
        out += [F.col(f"__{side}lex.{k}").alias(f"{side}{k}") for k in ("unique_ratio", "hapax_ratio", "avg_word_length", "long_word_ratio")]
        out += [F.col(f"__{side}read.{k}").alias(f"{side}{k}") for k in ("flesch_reading_ease", "automated_readability_index", "gunning_fog")]
    if similarity:
        out.append(sequence_similarity(F.col(source), F.col(result)).alias("char_similarity"))
    return df.select(*out)
