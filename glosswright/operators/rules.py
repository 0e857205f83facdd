"""Filters, routing and gates as ordered rules: the first that fails names the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first rule whose condition is true, else null. A null condition is not a failure."""
    case = F.when(F.lit(False), F.lit(""))
    for name, failed in rules:
        case = case.when(F.coalesce(failed, F.lit(False)), F.lit(name))
    return case


def required(column: str, of: str) -> Column:
    """The column, or a failed query where it is null."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"{of}: {column} is missing")).cast("double"))


def with_status(rows: DataFrame, *statuses: str) -> DataFrame:
    """P1."""
    return rows.where(F.col("status").isin(*statuses))


def is_short(url: Column, duration: Column) -> Column:
    """A short's address, or a known length between 0 and 61 seconds."""
    return F.coalesce(F.contains(url, F.lit("/shorts/")), F.lit(False)) | F.coalesce((duration > 0) & (duration < 61), F.lit(False))


def is_live(flag: Column, live_status: Column) -> Column:
    """P3."""
    return F.coalesce(flag, F.lit(False)) | F.coalesce(F.lower(live_status).isin("is_live", "was_live", "post_live"), F.lit(False))


def download_route(url: Column, duration: Column, flag: Column, live_status: Column, has_media: Column, include_shorts: bool, include_live: bool) -> Column:
    """Skip reason, failed or ready; a short that is live counts as short."""
    rules = []
    if not include_shorts:
        rules.append(("short_excluded", is_short(url, duration)))
    if not include_live:
        rules.append(("live_excluded", is_live(flag, live_status)))
    return F.coalesce(first_failure([*rules, ("failed", ~F.coalesce(has_media, F.lit(False)))]), F.lit("ready"))


def transcript_route(source: Column, n_segments: Column, language: Column, allowed: Sequence[str], native_only: bool) -> Column:
    """P5: reason to skip a video's transcript, else ready; a null language passes."""
    outside = language.isNotNull() & ~language.isin(*allowed)
    rules = [("language_filtered_manual_transcript", (source == "youtube_manual_filtered") & (n_segments == 0))]
    if native_only:
        rules.append(("no_manual_transcript_and_backend_is_youtube_native", source.isNull()))
    return F.coalesce(first_failure([*rules, ("language_filtered", outside)]), F.lit("ready"))


def empty_transcript(segments: Column) -> Rule:
    """No segment with text."""
    real = F.filter(segments, lambda s: F.coalesce(F.trim(s["text"]) != "", F.lit(False)))
    return "empty_transcript", F.coalesce(F.size(real) == 0, F.lit(True))


def below(column: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else column < F.lit(bound)


def above(column: Column, bound: float | None) -> Column:
    return F.lit(False) if bound is None else column > F.lit(bound)


def quality_rules(cfg) -> list[Rule]:
    """P7 in its order; bounds that are None never fail, values on a bound pass."""
    c = F.col
    return [
        ("language", ~c("language").isin(*cfg.language_allowlist)),
        ("min_tokens", below(c("token_count"), cfg.min_tokens)), ("min_words", below(c("word_count"), cfg.min_words)), ("quality", below(c("quality_score"), cfg.min_quality_score)),
        ("normalize_token_ratio_low", below(c("normalize_token_ratio"), cfg.normalize_min_token_ratio)), ("normalize_token_ratio_high", above(c("normalize_token_ratio"), cfg.normalize_max_token_ratio)),
        ("normalize_length_ratio_low", below(c("normalize_length_ratio"), cfg.normalize_min_length_ratio)), ("normalize_length_ratio_high", above(c("normalize_length_ratio"), cfg.normalize_max_length_ratio)),
        ("normalize_similarity", below(c("normalize_similarity"), cfg.normalize_min_similarity)),
    ]


def missing_minhash(signature: Column) -> Rule:
    """Stands after the rules of P7."""
    return "missing_minhash", signature.isNull()


def talk_rules(cfg, copy_similarity: Column, novelty: Column, asks: Column, must_ask: Column) -> list[Rule]:
    """P11."""
    return [("copy_similarity", copy_similarity > cfg.max_copy_similarity), ("novel_token_ratio", novelty < cfg.min_novel_token_ratio), ("missing_clarifying_question", must_ask & ~asks)]


def edit_rules(cfg, brief: Column, similarity: Column, length_ratio: Column, new_entities: Column) -> list[Rule]:
    """Bounds by brief; a brief without bounds passes. The script bounds are fixed values."""
    of = lambda name, failed: (brief == name) & failed
    low, high = cfg.tighten_target_ratio - cfg.tighten_ratio_tolerance, cfg.tighten_target_ratio + cfg.tighten_ratio_tolerance
    return [
        ("cleanup_similarity_too_low", of("cleanup_filler", similarity < cfg.cleanup_min_similarity)),
        ("cleanup_similarity_too_high", of("cleanup_filler", similarity > cfg.cleanup_max_similarity)),
        ("tighten_ratio_out_of_range", of("tighten_60_percent", ~length_ratio.between(low, high))),
        ("expand_ratio_out_of_range", of("expand_with_examples", ~length_ratio.between(cfg.expand_min_ratio, cfg.expand_max_ratio))),
        ("expand_new_named_entities", of("expand_with_examples", new_entities > cfg.max_new_named_entities)),
        ("script_ratio_out_of_range", of("convert_to_script", ~length_ratio.between(0.6, 1.6))),
        ("script_similarity_too_low", of("convert_to_script", similarity < 0.5)),
    ]


def decide(rows: DataFrame, rules: Sequence[Rule], kept: str = "kept", dropped: str = "dropped") -> DataFrame:
    """Adds ``status`` and ``reason``."""
    judged = rows.withColumn("reason", first_failure(rules))
    return judged.withColumn("status", F.when(F.col("reason").isNull(), kept).otherwise(dropped))


def reason_counts(decisions: DataFrame, *keys: str) -> DataFrame:
    """A5: rows per reason; arrays of reasons count once each."""
    return decisions.where("reason is not null").groupBy(*keys, "reason").agg(F.count("*").alias("n"))


def breaks_circuit(report: DataFrame, max_failure_rate: float) -> DataFrame:
    """Report plus failure_rate (0 for no items) and whether it is over the limit."""
    rate = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("failed") / F.col("total"))
    return report.withColumn("failure_rate", rate).withColumn("broken", F.col("failure_rate") > max_failure_rate)
