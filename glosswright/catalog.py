"""Registered queries of the core operators and, where SQL can state them, their DuckDB SQL.

Every query runs over its whole tables and whole texts. documents stand for normalized
transcripts (their lines for segments); the transcript tables stand for themselves.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswright import external
from glosswright.functions import hashing, parsing, text
from glosswright.operators import dedup, generate, rules, sequences, tables
from glosswright.plans.config import BRIEFS, STAGES, Edit, Filter, Talk
from glosswright.runtime import cut, scratch, spread, table
from glosswright.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(column):
    return F.round(column, 6)


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def once(spark: SparkSession, sf: str, name: str, *keys: str) -> DataFrame:
    """A table without its repeats: by key the row that came first."""
    rows = table(spark, sf, name)
    stamp = next(c for c in ("updated_at", "ingested_at", "created_at") if c in rows.columns)
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*keys).agg(F.min_by(whole, stamp).alias("r")).select("r.*")


# ---- SQL building blocks -----------------------------------------------------------------------

_W = r"[\p{L}\p{N}_]+(?:''+[\p{L}\p{N}_]+)*"
_TOKENS = r"\p{L}+|\p{N}{1,3}|[^\s\x0b\p{L}\p{N}]+"


def _words(t: str) -> str:
    return f"list_transform(regexp_extract_all({t}, '{_W}'), lambda x: lower(x))"


def _tokens(t: str) -> str:
    return f"len(regexp_extract_all({t}, '{_TOKENS}'))"


def _ratio(a: str, b: str) -> str:
    return f"(case when {b} = 0 then 0.0 else {a}::double / {b} end)"


def _squeezed(t: str) -> str:
    return rf"trim(regexp_replace({t}, '[\s\p{{Z}}\x0b\x1c-\x1f\x85]+', ' ', 'g'))"


def _jaccard(a: str, b: str) -> str:
    both = f"len(list_distinct(list_concat({_words(a)}, {_words(b)})))"
    return f"(case when {both} = 0 then 1.0 else len(list_intersect({_words(a)}, {_words(b)}))::double / {both} end)"


def _entities(t: str) -> str:
    plain = rf"regexp_replace(regexp_replace({t}, '[^\P{{L}}\x00-\x7F]', '0', 'g'), '[^\P{{N}}\x00-\x7F]', '0', 'g')"
    return rf"list_distinct(list_filter(list_transform(regexp_extract_all({plain}, '\b(?:[A-Z][a-z]+(?:\s+[A-Z][a-z]+){{0,3}}|[A-Z]{{2,}}(?:\s+[A-Z]{{2,}})*)\b'), lambda x: trim(x)), lambda x: length(x) > 1))"


def _strip_sql(t: str) -> str:
    return rf"trim({t}, E' \t\n\r\x0b\x0c')"


def _lines_sql(t: str) -> str:
    return rf"list_filter(list_transform(regexp_split_to_array({t}, '\r\n|[\n\r]'), lambda x: {_strip_sql('x')}), lambda x: x <> '')"


def _spaced_sql(t: str) -> str:
    return rf"list_filter(regexp_split_to_array({t}, '[\s\x0b]+'), lambda x: x <> '')"


_PROFILE = rf"""
base as (select doc_id, text, {_words("text")} as ws, len(regexp_extract_all(text, '[.!?]+')) as sents, {_tokens("text")} as toks from documents),
lex as (select *, len(ws) as n, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as chars,
  coalesce(list_sum(list_transform(ws, lambda x: (length(x) >= 7)::int)), 0) as longs, map_values(list_histogram(ws)) as freq,
  list_transform(ws, lambda x: greatest(1, len(regexp_extract_all(x, '[aeiouy]+')))) as syl from base),
nums as (select *, coalesce(len(freq), 0) as kinds, coalesce(list_sum(list_transform(freq, lambda c: (c = 1)::int)), 0) as onces, coalesce(list_sum(syl), 0) as syls,
  coalesce(list_sum(list_transform(syl, lambda s: (s >= 3)::int)), 0) as hard from lex),
prof as (select doc_id, text, ws, n as word_count, sents as sentence_count, toks as token_count, kinds,
  {_ratio("kinds", "n")} as unique_ratio, {_ratio("onces", "n")} as hapax_ratio, {_ratio("chars", "n")} as avg_word_length, {_ratio("longs", "n")} as long_word_ratio,
  case when n > 0 then 206.835 - 1.015 * (n / greatest(1, sents)) - 84.6 * (syls / n) end as ease,
  case when n > 0 then 4.71 * (chars / n) + 0.5 * (n / greatest(1, sents)) - 21.43 end as ari,
  case when n > 0 then 0.4 * (n / greatest(1, sents) + 100 * (hard / n)) end as fog from nums),
scored as (select *, case when word_count = 0 then 0.0 else greatest(0, least(1, 0.45 * (0.6 * unique_ratio + 0.4 * hapax_ratio)
  + 0.25 * least(1, sentence_count / greatest(1, word_count / 20)) + 0.25 * coalesce(greatest(0, least(1, ease / 100)), 0.5)
  + 0.05 * (1 - least(1, 2 * long_word_ratio)))) end as quality_score from prof)"""


def _language_sql(ws: str) -> str:
    n = {c: f"len(list_filter({ws}, lambda x: list_contains([{', '.join(repr(w) for w in stop)}], x)))" for c, stop in text.STOP_WORDS.items()}
    top = f"greatest({', '.join(n.values())})"
    cases = " ".join(f"when {v} = {top} then '{c}'" for c, v in n.items())
    return f"case when {top} is null or {top} = 0 then 'unknown' {cases} end"


_ENTRIES_FIRST = """e as (select entry_id, arg_min(edit_brief, created_at) filter (true) as brief, first(input_text order by created_at) as i, first(output_text order by created_at) as o from entries group by entry_id)"""


# ---- M: text metrics ---------------------------------------------------------------------------


@query(f"select doc_id, {_squeezed('text')} as squeezed from documents")
def op_m1_squeeze(spark, sf):
    return docs(spark, sf).select("doc_id", text.squeeze_spaces(F.col("text")).alias("squeezed"))


@query(f"select doc_id, array_to_string({_words('text')}, ' ') as words from documents")
def op_m2_words(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(text.words(F.col("text")), " ").alias("words"))


@query(f"select doc_id, len(regexp_extract_all(text, '{_W}')) as words, len(regexp_extract_all(text, '[.!?]+')) as sentences, {_tokens('text')} as approx_tokens from documents")
def op_m3_m4_m7_counts(spark, sf):
    t = F.col("text")
    return docs(spark, sf).select("doc_id", text.word_count(t).alias("words"), text.sentence_count(t).alias("sentences"), text.approx_token_count(t).alias("approx_tokens"))


@query(None)
def op_m6_similarity(spark, sf):
    """Sequence similarity of source and normalized excerpt; no SQL form, tested against the library."""
    return _excerpt_pairs(spark, sf).select("video_id", "chunk_index", text.sequence_similarity(F.col("text"), F.col("normalized_excerpt")).alias("similarity"))


@query(f"with {_PROFILE} select doc_id, word_count, kinds as unique_word_count, round(unique_ratio, 6) as unique_ratio, round(hapax_ratio, 6) as hapax_ratio, round(avg_word_length, 6) as avg_word_length, round(long_word_ratio, 6) as long_word_ratio from prof where text is not null")
def op_m8_lexical(spark, sf):
    lex = text.with_sums(spread(docs(spark, sf)).where("text is not null"), "text").select("doc_id", text.lexical(F.col("__sums")).alias("m"))
    return lex.select("doc_id", "m.word_count", "m.unique_word_count", *[r6(F.col(f"m.{c}")).alias(c) for c in ("unique_ratio", "hapax_ratio", "avg_word_length", "long_word_ratio")])


@query(f"with {_PROFILE} select doc_id, round(ease, 6) as ease, round(ari, 6) as ari, round(fog, 6) as fog, round(coalesce(greatest(0, least(1, ease / 100)), 0.5), 10) as ease_unit from prof where text is not null")
def op_m9_m10_readability(spark, sf):
    m = text.with_sums(spread(docs(spark, sf)).where("text is not null"), "text").select("doc_id", text.readability(F.col("__sums"), F.col("__sentences")).alias("m"))
    ease = F.col("m.flesch_reading_ease")
    return m.select("doc_id", r6(ease).alias("ease"), r6(F.col("m.automated_readability_index")).alias("ari"), r6(F.col("m.gunning_fog")).alias("fog"), F.round(text.ease_to_unit(ease), 10).alias("ease_unit"))


@query(f"with {_PROFILE} select doc_id, {_language_sql('ws')} as language, token_count, word_count, sentence_count, round(word_count / greatest(1, sentence_count), 6) as avg_words_per_sentence, round(quality_score, 6) as quality_score from scored where text is not null")
def op_m11_m12_m13_profile(spark, sf):
    p = text.with_profile(spread(docs(spark, sf)).where("text is not null"), "text")
    return p.select("doc_id", "language", "token_count", "word_count", "sentence_count", r6(F.col("avg_words_per_sentence")).alias("avg_words_per_sentence"), r6(F.col("quality_score")).alias("quality_score"))


def _excerpt_pairs(spark, sf):
    a = once(spark, sf, "chunk_records", "video_id", "chunk_index").select("video_id", "chunk_index", "normalized_excerpt")
    b = table(spark, sf, "normalize_chunks").groupBy("video_id", "chunk_index").agg(F.max("text").alias("text"))
    return a.join(b, ["video_id", "chunk_index"]).where("normalized_excerpt is not null and text is not null")


_EXCERPTS = """excerpts as (select a.video_id, a.chunk_index, b.text, a.normalized_excerpt as norm from
  (select video_id, chunk_index, arg_min(normalized_excerpt, ingested_at) as normalized_excerpt from chunk_records group by all) a
  join (select video_id, chunk_index, max(text) as text from normalize_chunks group by all) b using (video_id, chunk_index)
  where a.normalized_excerpt is not null and b.text is not null)"""


@query(f"""with {_EXCERPTS}, n as (select video_id, chunk_index, length(text) as sc, length(norm) as nc, {_tokens('text')} as st, {_tokens('norm')} as nt, len({_words('text')}) as sw, len({_words('norm')}) as nw from excerpts)
select video_id, chunk_index, nc - sc as chars_delta, nt - st as tokens_delta, nw - sw as words_delta, round({_ratio('nc', 'sc')}, 6) as chars_ratio, round({_ratio('nt', 'st')}, 6) as tokens_ratio, round({_ratio('nw', 'sw')}, 6) as words_ratio from n""")
def op_m5_m14_change(spark, sf):
    m = text.with_change(_excerpt_pairs(spark, sf), "text", "normalized_excerpt")
    return m.select("video_id", "chunk_index", "chars_delta", "tokens_delta", "words_delta", *[r6(F.col(f"{c}_ratio")).alias(f"{c}_ratio") for c in ("chars", "tokens", "words")])


@query(f"""with s as (select video_id, segment_index, max(trim(text)) as t from transcript_segments where trim(text) <> '' group by all)
select video_id, count(*) as num_segments, sum(length(t))::bigint as num_chars, sum({_tokens('t')})::bigint as token_count, sum(len({_words('t')}))::bigint as word_count, sum(len(regexp_extract_all(t, '[.!?]+')))::bigint as sentence_count, round(avg(length(t)), 6) as avg_segment_chars from s group by video_id""")
def op_m15_a8_transcript_block(spark, sf):
    """Counts per video as sums of its segments' counts; no text leaves its task."""
    t = F.trim(F.col("text"))
    s = table(spark, sf, "transcript_segments").where(t != "").select("video_id", "segment_index", F.length(t).alias("chars"), text.approx_token_count(t).alias("tokens"), text.word_count(t).alias("words"), text.sentence_count(t).alias("sentences"))
    s = s.groupBy("video_id", "segment_index").agg(*[F.max(c).alias(c) for c in ("chars", "tokens", "words", "sentences")])
    sums = {"num_chars": "chars", "token_count": "tokens", "word_count": "words", "sentence_count": "sentences"}
    return s.groupBy("video_id").agg(F.count("*").alias("num_segments"), *[F.sum(c).cast("bigint").alias(k) for k, c in sums.items()], r6(F.avg("chars")).alias("avg_segment_chars"))


@query(f"select doc_id, len({_entities('text')}) as entities from documents where text is not null")
def op_m16_entities(spark, sf):
    return docs(spark, sf).where("text is not null").select("doc_id", F.size(text.entities(F.col("text"))).cast("bigint").alias("entities"))


@query(f"select doc_id, case when {_squeezed('text')} = '' then 'general discussion' else array_to_string(string_split({_squeezed('text')}, ' ')[1:16], ' ') end as topic from documents")
def op_m17_topic(spark, sf):
    return docs(spark, sf).select("doc_id", text.topic_hint(F.col("text")).alias("topic"))


@query("select video_id, min(metrics.duration_seconds) as seconds, bool_or(coalesce(url like '%/shorts/%', false) or coalesce(duration > 0 and duration < 61, false)) as short, bool_or(coalesce(lower(live_status) in ('is_live', 'was_live', 'post_live'), false)) as live, bool_or(media_path is not null) as has_media, max(metrics.media_size_bytes) as bytes from videos group by video_id")
def op_m18_p2_p3_download_block(spark, sf):
    v, c = table(spark, sf, "videos"), F.col
    return v.groupBy("video_id").agg(
        F.min("metrics.duration_seconds").alias("seconds"), F.bool_or(rules.is_short(c("url"), c("duration"))).alias("short"),
        F.bool_or(rules.is_live(F.lit(False), c("live_status"))).alias("live"), F.bool_or(c("media_path").isNotNull()).alias("has_media"), F.max("metrics.media_size_bytes").alias("bytes"),
    )


@query("select video_id, max(try_cast(upload_date as double)) as day, max(try_cast(title as double)) as titled from videos group by video_id")
def op_m19_lenient(spark, sf):
    return table(spark, sf, "videos").groupBy("video_id").agg(F.max(parsing.lenient_double(F.col("upload_date"))).alias("day"), F.max(parsing.lenient_double(F.col("title"))).alias("titled"))


# ---- H: hashes ---------------------------------------------------------------------------------


@query("select doc_id, sha256(text) as hash from documents")
def op_h1_hash(spark, sf):
    return docs(spark, sf).select("doc_id", hashing.text_hash(F.col("text")).alias("hash"))


@query("""select distinct video_id, chunk_index, sha256('{"chunk_index":' || chunk_index || ',"video_id":"' || video_id || '"}') as hash from chunk_records""")
def op_h2_record_hash(spark, sf):
    c = table(spark, sf, "chunk_records").select("video_id", "chunk_index").distinct()
    return c.withColumn("hash", hashing.record_hash(video_id=F.col("video_id"), chunk_index=F.col("chunk_index")))


@query("""select distinct video_id, chunk_index, ('0x' || substr(sha256('{"chunk_index":' || chunk_index || ',"salt":"clarify","video_id":"' || video_id || '"}'), 1, 8))::bigint / 4294967295.0 < 0.4 as ask from chunk_records""")
def op_h3_coin(spark, sf):
    c = table(spark, sf, "chunk_records").select("video_id", "chunk_index").distinct()
    return c.withColumn("ask", generate.must_ask(Talk(), F.col("video_id"), F.col("chunk_index")))


K, THRESHOLD = 128, 0.85
_COEFFICIENTS = f"""gen(i, x) as (select 1, 48271::bigint union all select i + 1, x * 48271 % {dedup.PRIME} from gen where i < {2 * K}),
perm as (select a.i, a.x as a, b.x as b from gen a join gen b on b.i = a.i + {K} where a.i <= {K})"""
_SIGNED = f"""toks as (select distinct doc_id, unnest({_words('text')}) as w from documents where text is not null),
hashed as (select doc_id, ('0x' || substr(sha1(w), 1, 8))::bigint % {dedup.PRIME} as h from toks),
mins as (select doc_id, i, min((a * h + b) % {dedup.PRIME}) as m from hashed, perm group by all),
signed as (select d.doc_id, coalesce(list(m order by i) filter (m is not null), list_transform(range({K}), lambda x: {dedup.PRIME}::bigint)) as s from documents d left join mins using (doc_id) group by d.doc_id)"""


@query(f"with recursive {_COEFFICIENTS}, {_SIGNED} select doc_id, array_to_string(s, ',') as signature from signed")
def op_a7_h6_minhash(spark, sf):
    s = dedup.signatures(table(spark, sf, "documents"), "doc_id", "text", K)
    return s.select("doc_id", F.array_join(F.transform("signature", lambda x: x.cast("string")), ",").alias("signature"))


_GREEDY = """ranked as (select row_number() over (order by doc_id::varchar) as rk, doc_id, s from candidates),
pairs as (select a.rk as lo, b.rk as hi from ranked a join ranked b on a.rk < b.rk where list_sum(list_transform(list_zip(a.s, b.s), lambda p: (p[1] = p[2])::int)) >= 109),
nb as (select r.rk, coalesce(list(p.lo) filter (p.lo is not null), []) as ns from ranked r left join pairs p on p.hi = r.rk group by r.rk),
walk(rk, kept) as (select 0::bigint, []::bigint[] union all select nb.rk, case when list_has_any(kept, ns) then kept else list_append(kept, nb.rk) end from walk join nb on nb.rk = walk.rk + 1),
fate as (select nb.rk, list_min(list_intersect(nb.ns, (select arg_max(kept, rk) from walk))) as dup from nb)"""


@query(f"""with recursive {_COEFFICIENTS}, {_SIGNED}, candidates as (select doc_id, s from signed), {_GREEDY}
select r.doc_id, d.doc_id::varchar as duplicate_of from ranked r join fate on fate.rk = r.rk left join ranked d on d.rk = fate.dup""")
def op_j4_o6_near_duplicates(spark, sf):
    return dedup.near_duplicates(cut(dedup.signatures(table(spark, sf, "documents"), "doc_id", "text", K)), "doc_id", K, THRESHOLD)


# ---- P: rules ----------------------------------------------------------------------------------

FILTER = Filter(language_allowlist=("en", "fr", "de", "es"), min_words=60, min_tokens=80, normalize_min_similarity=None)


def _profiled(documents):
    """Documents as normalized transcripts: their profile, and what squeezing white space changed."""
    p = text.with_profile(documents.where("text is not null"), "text").withColumn("__squeezed", text.squeeze_spaces(F.col("text")))
    return p.select(
        *[c for c in p.columns if c not in ("text", "__squeezed")], text.ratio(text.approx_token_count(F.col("__squeezed")), F.col("token_count")).alias("normalize_token_ratio"),
        text.ratio(F.length("__squeezed"), F.length("text")).alias("normalize_length_ratio"), F.lit(None).cast("double").alias("normalize_similarity"),
    )


@query(None)
def op_p7_excerpt_cascade(spark, sf):
    """All nine rules, with the default bounds of change, on excerpts: their source and normalized text really differ."""
    changed = text.with_change(_excerpt_pairs(spark, sf), "text", "normalized_excerpt").select(
        "video_id", "chunk_index", "normalized_excerpt", F.col("tokens_ratio").alias("normalize_token_ratio"), F.col("chars_ratio").alias("normalize_length_ratio"),
        text.sequence_similarity(F.col("text"), F.col("normalized_excerpt")).alias("normalize_similarity"),
    )
    cfg = dataclasses.replace(FILTER, normalize_min_similarity=Filter.normalize_min_similarity)
    d = rules.decide(text.with_profile(changed, "normalized_excerpt"), rules.quality_rules(cfg))
    return d.select("video_id", "chunk_index", r6(F.col("normalize_similarity")).alias("normalize_similarity"), F.coalesce("reason", "status").alias("outcome"))


_CASCADE = f"""ready as (select *, {_language_sql('ws')} as language, {_ratio(_tokens(_squeezed('text')), 'token_count')} as tr, {_ratio('length(' + _squeezed('text') + ')', 'length(text)')} as lr from scored where text is not null),
judged as (select *, case when language not in ('en', 'fr', 'de', 'es') then 'language' when token_count < 80 then 'min_tokens' when word_count < 60 then 'min_words' when quality_score < 0.2 then 'quality'
  when tr < 0.7 then 'normalize_token_ratio_low' when tr > 1.35 then 'normalize_token_ratio_high' when lr < 0.7 then 'normalize_length_ratio_low' when lr > 1.35 then 'normalize_length_ratio_high' end as reason from ready)"""


@query(f"with {_PROFILE}, {_CASCADE} select doc_id, coalesce(reason, 'kept') as outcome from judged")
def op_p7_cascade(spark, sf):
    return rules.decide(_profiled(spread(docs(spark, sf))), rules.quality_rules(FILTER)).select("doc_id", F.coalesce("reason", "status").alias("outcome"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Profile, ordered rules, then near-duplicates among the survivors: one decision per document."""
    # one pass: the signature is made while the text is at hand, and the text goes no further
    d = dedup.signatures(docs(spark, sf).where("text is not null"), "doc_id", "text", K, keep=("text",))
    judged = rules.decide(_profiled(d), rules.quality_rules(FILTER))
    judged = cut(judged.select("doc_id", "language", "word_count", "token_count", r6(F.col("quality_score")).alias("quality_score"), "reason", F.when(F.col("reason").isNull(), F.col("signature")).alias("signature")))
    near = dedup.near_duplicates(judged.where("reason is null").select("doc_id", "signature"), "doc_id", K, THRESHOLD)
    out = judged.join(near, "doc_id", "left")
    reason = F.coalesce("reason", F.concat(F.lit("dedup:"), "duplicate_of"))
    return out.select("doc_id", F.when(reason.isNull(), "kept").otherwise("dropped").alias("status"), reason.alias("reason"), "language", "word_count", "token_count", "quality_score", "duplicate_of")


@query(f"""with recursive {_COEFFICIENTS}, {_SIGNED}, {_PROFILE}, {_CASCADE}, candidates as (select doc_id, s from signed where doc_id in (select doc_id from judged where reason is null)), {_GREEDY},
near as (select r.doc_id, d.doc_id::varchar as duplicate_of from ranked r join fate on fate.rk = r.rk left join ranked d on d.rk = fate.dup)
select doc_id, case when coalesce(reason, duplicate_of) is null then 'kept' else 'dropped' end as status, coalesce(reason, 'dedup:' || duplicate_of) as reason, language, word_count, token_count, round(quality_score, 6) as quality_score, duplicate_of
from judged left join near using (doc_id)""")
def op_filter_decisions(spark, sf):
    return flagship(spark, sf)


@query(f"with {_PROFILE}, {_CASCADE} select reason, count(*) as n from judged where reason is not null group by reason")
def op_a5_reasons(spark, sf):
    # a filter on a computed column would be pushed below it and compute its folds again: cut first
    return rules.reason_counts(cut(rules.decide(_profiled(spread(docs(spark, sf))), rules.quality_rules(FILTER)).select("reason")))


@query("select distinct video_id, status from transcripts where status = 'ready'")
def op_p1_ready(spark, sf):
    return rules.with_status(table(spark, sf, "transcripts"), "ready").select("video_id", "status").distinct()


@query("""select distinct video_id, case when coalesce(url like '%/shorts/%', false) or coalesce(duration > 0 and duration < 61, false) then 'short_excluded'
  when coalesce(lower(live_status) in ('is_live', 'was_live', 'post_live'), false) then 'live_excluded' when media_path is null then 'failed' else 'ready' end as route from videos""")
def op_p4_route(spark, sf):
    c = F.col
    route = rules.download_route(c("url"), c("duration"), F.lit(False), c("live_status"), c("media_path").isNotNull(), False, False)
    return table(spark, sf, "videos").select("video_id", route.alias("route")).distinct()


@query("select distinct video_id, case when language is not null and language not in ('en', 'en-US', 'eng') then 'language_filtered' else 'ready' end as route from transcripts")
def op_p5_route(spark, sf):
    c = F.col
    route = rules.transcript_route(c("source"), c("num_segments"), c("language"), ["en", "en-US", "eng"], False)
    return table(spark, sf, "transcripts").select("video_id", route.alias("route")).distinct()


@query(r"select doc_id, case when len(list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n+'), lambda x: trim(x, E' \t\n\r\x0b\x0c')), lambda x: x <> '')) = 0 then 'empty_transcript' end as reason from documents where text is not null")
def op_p6_empty_transcripts(spark, sf):
    d = docs(spark, sf).where("text is not null").select("doc_id", readers.transcript_segments(F.to_json(F.struct(F.col("text")))).alias("segments"))
    return d.select("doc_id", rules.first_failure([rules.empty_transcript(F.col("segments"))]).alias("reason"))


@query(f"with {_ENTRIES_FIRST} select entry_id, case when o is null or i is null then 'missing_quality_metrics' else 'missing_metadata' end as reason from e where o is null or i is null or brief is null")
def op_p13_unfit(spark, sf):
    e = once(spark, sf, "entries", "entry_id").select("entry_id", "edit_brief", "input_text", "output_text")
    return generate.unfit(generate.edit_metrics(e, text.token_jaccard)).select("entry_id", "reason")


@query(f"select distinct video_id, chunk_index, 'source_too_short' as reason from chunk_records where coalesce({_tokens('normalized_excerpt')} < 120, true)")
def op_p10_too_short(spark, sf):
    return generate.too_short(table(spark, sf, "chunk_records"), 120).select("video_id", "chunk_index", "reason").distinct()


def _talk_gates(d):
    return d.select("entry_id", r6(F.col("copy_similarity_to_source")).alias("copy_similarity"), r6(F.col("novel_token_ratio")).alias("novelty"), "reason")


def _talks(spark, sf):
    """Entries as one-turn chats about their input."""
    e = once(spark, sf, "entries", "entry_id").where("output_text is not null and input_text is not null")
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(F.col(c), F.lit("")).alias("content"))
    return e.select("entry_id", F.coalesce("metadata.video_id", F.lit("unknown")).alias("video_id"), F.col("metadata.chunk_index").alias("chunk_index"), F.col("input_text").alias("source_text"), F.array(turn("user", "instruction"), turn("assistant", "output_text")).alias("messages"))


_ENTRIES = """e as (select entry_id, arg_min(edit_brief, created_at) as brief, arg_min(input_text, created_at) as i, arg_min(output_text, created_at) as o from entries group by entry_id)"""


@query(f"""with {_ENTRIES}, m as (select entry_id, round({_jaccard('o', 'i')}, 6) as copy_similarity, round({_ratio("len(list_filter(" + _words('o') + ", lambda x: not list_contains(" + _words('i') + ", x)))", "len(" + _words('o') + ")")}, 6) as novelty from e where o is not null and i is not null)
select entry_id, copy_similarity, novelty, case when copy_similarity > 0.8 then 'copy_similarity' when novelty < 0.18 then 'novel_token_ratio' end as reason from m""")
def op_p11_u2_talk_gates(spark, sf):
    cfg = Talk(clarifying_question_probability=0.0)
    return _talk_gates(generate.talk_decisions(_talks(spark, sf), cfg, text.token_jaccard))


@query(None)
def op_p11_u2_talk_gates_sequence(spark, sf):
    """The gates by the matching-blocks ratio that their bounds are made for; no SQL form."""
    return _talk_gates(generate.talk_decisions(_talks(spark, sf), Talk(clarifying_question_probability=0.0)))


@query(None)
def op_p11_h3_talk_gates_asking(spark, sf):
    """All three gates with the default probability: chats that must ask and hold no question are rejected."""
    return _talk_gates(generate.talk_decisions(_talks(spark, sf), Talk()))


def _candidates(spark, sf, similarity=text.sequence_similarity):
    e = once(spark, sf, "entries", "entry_id").where("output_text is not null and input_text is not null")
    return generate.edit_metrics(e.select("entry_id", "edit_brief", "input_text", "output_text", F.col("metadata.video_id").alias("video_id")), similarity)


def _edit_gates(candidates):
    d = generate.edit_decisions(candidates, Edit())
    return d.select("entry_id", "status", "reason", r6(F.col("copy_similarity_to_input")).alias("similarity"), r6(F.col("output_to_input_token_ratio")).alias("length_ratio"), F.col("new_named_entities").alias("new_entities"))


def _edit_summary(candidates):
    s = tables.summary(generate.edit_decisions(candidates, Edit()), "edit_brief", ["copy_similarity_to_input", "output_to_input_token_ratio"])
    return s.select("edit_brief", "attempted", "entries", "dropped", r6(F.col("copy_similarity_to_input_avg")).alias("similarity_avg"), r6(F.col("output_to_input_token_ratio_avg")).alias("ratio_avg"))


_GATES = f"""m as (select entry_id, brief, {_jaccard('o', 'i')} as sim, {_ratio(_tokens('o'), _tokens('i'))} as ratio, len(list_filter({_entities('o')}, lambda x: not list_contains({_entities('i')}, x))) as news from e where o is not null and i is not null),
d as (select *, case when brief = 'cleanup_filler' and sim < 0.45 then 'cleanup_similarity_too_low' when brief = 'cleanup_filler' and sim > 0.995 then 'cleanup_similarity_too_high'
  when brief = 'tighten_60_percent' and (ratio < 0.6 - 0.25 or ratio > 0.6 + 0.25) then 'tighten_ratio_out_of_range' when brief = 'expand_with_examples' and (ratio < 1.05 or ratio > 2.6) then 'expand_ratio_out_of_range'
  when brief = 'expand_with_examples' and news > 10 then 'expand_new_named_entities' when brief = 'convert_to_script' and (ratio < 0.6 or ratio > 1.6) then 'script_ratio_out_of_range'
  when brief = 'convert_to_script' and sim < 0.5 then 'script_similarity_too_low' end as reason from m where brief is not null)"""


@query(f"with {_ENTRIES}, {_GATES} select entry_id, case when reason is null then 'accepted' else 'rejected' end as status, reason, round(sim, 6) as similarity, round(ratio, 6) as length_ratio, news as new_entities from d")
def op_p12_u1_e5_edit_gates(spark, sf):
    return _edit_gates(_candidates(spark, sf, text.token_jaccard))


@query(None)
def op_p12_u1_e5_edit_gates_sequence(spark, sf):
    """The gates by the matching-blocks ratio that their bounds are made for; no SQL form."""
    return _edit_gates(_candidates(spark, sf))


@query(f"with {_ENTRIES}, {_GATES} select brief as edit_brief, count(*) as attempted, count(*) filter (reason is null) as entries, count(*) filter (reason is not null) as dropped, round(coalesce(avg(sim) filter (reason is null), 0), 6) as similarity_avg, round(coalesce(avg(ratio) filter (reason is null), 0), 6) as ratio_avg from d group by brief")
def op_a3_a4_summary(spark, sf):
    return _edit_summary(_candidates(spark, sf, text.token_jaccard))


@query(None)
def op_a3_a4_summary_sequence(spark, sf):
    """The summary of op_p12_u1_e5_edit_gates_sequence."""
    return _edit_summary(_candidates(spark, sf))


@query("select doc_id, case when lower(text) like '%here is the cleaned transcript%' then 'here is the cleaned transcript' when lower(text) like '%here’s the cleaned transcript%' then 'here’s the cleaned transcript' when lower(text) like '%cleaned transcript:%' then 'cleaned transcript:' when lower(text) like '%---%' then '---' when lower(text) like '%note:%' then 'note:' end as phrase from documents")
def op_p14_banned(spark, sf):
    return docs(spark, sf).select("doc_id", parsing.banned_phrase(F.col("text")).alias("phrase"))


@query("with v as (select video_id, arg_min(status, updated_at) as status from videos group by video_id) select count(*) as total, count(*) filter (status = 'ready') as success, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'skipped') as skipped, round(count(*) filter (status = 'failed') / count(*), 6) as failure_rate, count(*) filter (status = 'failed') / count(*) > 0.2 as broken from v")
def op_a1_p15_report(spark, sf):
    r = rules.breaks_circuit(tables.stage_report(once(spark, sf, "videos", "video_id")), 0.2)
    return r.withColumn("failure_rate", r6(F.col("failure_rate")))


# ---- J and A: joins and roll-ups ---------------------------------------------------------------


@query("""with a as (select video_id, arg_min(word_count, updated_at) as words from analyze_metrics group by 1), v as (select video_id, arg_max(status, updated_at) as status from videos group by 1), t as (select video_id, arg_max(num_segments, updated_at) as segments from transcripts group by 1)
select a.video_id, v.status as download_status, t.segments as segments, a.words as words from a left join v using (video_id) left join t using (video_id)""")
def op_j1_assemble(spark, sf):
    newest = lambda name, c: table(spark, sf, name).groupBy("video_id").agg(F.max_by(c, "updated_at").alias(c))
    base = table(spark, sf, "analyze_metrics").groupBy("video_id").agg(F.min_by("word_count", "updated_at").alias("words"))
    full = tables.assemble(base, {"download": newest("videos", "status"), "transcribe": newest("transcripts", "num_segments")})
    return full.select("video_id", F.col("download.status").alias("download_status"), F.col("transcribe.num_segments").alias("segments"), "words")


@query("with c as (select video_id, count(*) as n from normalize_chunks group by 1) select distinct v.video_id, case when c.n is null then 'failed' else 'ready' end as status, coalesce(c.n, 0) as n from videos v left join c using (video_id) where v.status = 'ready'")
def op_j2_upstream(spark, sf):
    kept = rules.with_status(table(spark, sf, "videos"), "ready").select("video_id").distinct()
    chunks = table(spark, sf, "normalize_chunks").groupBy("video_id").agg(F.count("*").alias("n"))
    return tables.with_upstream(kept, chunks, "video_id", "n").select("video_id", "status", F.coalesce("n", F.lit(0)).alias("n"))


def _manifest(spark, sf):
    """What an earlier run left: videos as items, hashed by what their download gave then."""
    v = once(spark, sf, "videos", "video_id")
    outcome = F.when(F.col("status") == "ready", "success").otherwise(F.col("status"))
    return v.select(F.col("video_id").alias("item_id"), outcome.alias("status"), F.sha2(F.coalesce("media_path", F.lit("")), 256).alias("input_hash"))


def _items(spark, sf):
    t = once(spark, sf, "transcripts", "video_id")
    return t.select(F.col("video_id").alias("item_id"), F.sha2(F.concat(F.lit("media/"), F.col("video_id"), F.lit(".m4a")), 256).alias("input_hash"))


_CACHE = """m as (select video_id as item_id, case when status = 'ready' then 'success' else status end as status, sha256(coalesce(media_path, '')) as input_hash from
  (select video_id, arg_min(status, updated_at) as status, arg_min(media_path, updated_at) filter (true) as media_path from videos group by 1)),
i as (select distinct video_id as item_id, sha256('media/' || video_id || '.m4a') as input_hash from transcripts)"""


@query(f"with {_CACHE} select i.* from i where exists (select 1 from m where m.item_id = i.item_id and m.input_hash = i.input_hash and status in ('success', 'skipped'))")
def op_j3_hits(spark, sf):
    return tables.cache_hits(_items(spark, sf), _manifest(spark, sf))


@query(f"with {_CACHE} select i.* from i where not exists (select 1 from m where m.item_id = i.item_id and m.input_hash = i.input_hash and status in ('success', 'skipped'))")
def op_j3_c1_misses(spark, sf):
    return tables.cache_misses(_items(spark, sf), _manifest(spark, sf))


@query("""with c as (select distinct video_id as item_id, sha256('g' || chunk_index) as generation_hash, sha256('q' || (chunk_index % 3)) as gate_hash from normalize_chunks),
made as (select distinct video_id as item_id, sha256('g' || chunk_index) as generation_hash from chunk_records where normalized_excerpt is not null),
judged as (select distinct video_id as item_id, sha256('g' || chunk_index) as generation_hash, sha256('q1') as gate_hash from chunk_records where normalized_excerpt is not null)
select c.*, case when j.item_id is not null then 'all' when m.item_id is not null then 'candidates' else 'none' end as reuse from c left join made m using (item_id, generation_hash) left join judged j using (item_id, generation_hash, gate_hash)""")
def op_j5_c5_two_level_cache(spark, sf):
    g = F.sha2(F.concat(F.lit("g"), F.col("chunk_index").cast("string")), 256).alias("generation_hash")
    items = table(spark, sf, "normalize_chunks").select(F.col("video_id").alias("item_id"), g, F.sha2(F.concat(F.lit("q"), (F.col("chunk_index") % 3).cast("string")), 256).alias("gate_hash")).distinct()
    made = table(spark, sf, "chunk_records").where("normalized_excerpt is not null").select(F.col("video_id").alias("item_id"), g)
    return tables.two_level_cache(items, made, made.withColumn("gate_hash", F.sha2(F.lit("q1"), 256)))


@query("select distinct edit_brief, case edit_brief " + " ".join(f"when '{k}' then '{v}'" for k, v in BRIEFS.items()) + " end as instruction from entries")
def op_j6_instructions(spark, sf):
    return table(spark, sf, "entries").select("edit_brief", tables.lookup(F.col("edit_brief"), BRIEFS).alias("instruction")).distinct()


@query("select source as channel, lang, count(*) as n from documents where source in (select channel_id from channels where main_language <> 'en') group by all")
def op_j7_membership(spark, sf):
    ids = table(spark, sf, "channels").where("main_language <> 'en'").select(F.col("channel_id").alias("source"))
    return tables.membership(table(spark, sf, "documents").select("source", "lang"), ids, "source", True).groupBy(F.col("source").alias("channel"), "lang").agg(F.count("*").alias("n"))


@query("with e as (select entry_id, arg_min(metadata.generator_name, created_at) as g, arg_min(output_text, created_at) filter (true) as o from entries group by 1) select g as generator, count(*) as total, count(*) as success, 0::bigint as failed, 0::bigint as skipped from e group by g")
def op_a2_generators(spark, sf):
    e = once(spark, sf, "entries", "entry_id").select(F.col("metadata.generator_name").alias("generator"), F.lit("ready").alias("status"))
    return tables.stage_report(e, ("ready",), "generator")


@query(f"with w as (select unnest({_words('text')}) as word from documents) select word, count(*) as n from w group by word")
def op_a6_frequencies(spark, sf):
    return docs(spark, sf).select(F.explode(text.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("with e as (select entry_id, arg_min(coalesce(nullif(metadata.video_id, ''), 'unknown'), created_at) as k from entries group by 1) select k as grp, count(*) as n from e group by k")
def op_a9_groups(spark, sf):
    e = once(spark, sf, "entries", "entry_id")
    return e.groupBy(tables.group_key(F.col("metadata.video_id"), True).alias("grp")).agg(F.count("*").alias("n"))


@query(r"""with s as (select video_id, segment_index, arg_min(start_time, ingested_at) filter (start_time is not null) as a, arg_min(end_time, ingested_at) filter (end_time is not null) as b, max(trim(text)) as t from transcript_segments group by all),
c as (select distinct video_id, chunk_index, start_segment_index as x, end_segment_index as y from normalize_chunks)
select c.video_id, c.chunk_index, arg_min(a, segment_index) filter (a is not null) as start_time, arg_max(b, segment_index) filter (b is not null) as end_time, coalesce(string_agg(t, ' ' order by segment_index) filter (t <> ''), '') as text from c join s on s.video_id = c.video_id and s.segment_index between x and y group by all""")
def op_a10_a11_chunk_text(spark, sf):
    """Chunks put together from their segments: an equi-join on the numbers a chunk spans."""
    s = table(spark, sf, "transcript_segments").groupBy("video_id", "segment_index").agg(
        F.min_by("start_time", F.when(F.col("start_time").isNotNull(), F.col("ingested_at"))).alias("a"), F.min_by("end_time", F.when(F.col("end_time").isNotNull(), F.col("ingested_at"))).alias("b"), F.max(F.trim("text")).alias("t"))
    c = table(spark, sf, "normalize_chunks").select("video_id", "chunk_index", "start_segment_index", "end_segment_index").distinct()
    wide = c.select("video_id", "chunk_index", F.explode(F.sequence("start_segment_index", "end_segment_index")).alias("segment_index"))
    i = F.col("segment_index")
    return wide.join(s, ["video_id", "segment_index"]).groupBy("video_id", "chunk_index").agg(
        sequences.first_start(i, F.col("a")).alias("start_time"), sequences.last_end(i, F.col("b")).alias("end_time"), sequences.ordered_text(i, F.col("t")).alias("text"))


@query("""with u as (select distinct video_id as run_id, unnest(['download', 'transcribe']) as stage, case when status = 'failed' then 'failed' else 'completed' end as status from videos)
select run_id, case when bool_or(status = 'failed') then 'failed' when count(distinct stage) filter (status = 'completed') = 2 then 'completed' else 'running' end as status from u group by run_id""")
def op_a12_run_status(spark, sf):
    u = table(spark, sf, "videos").select(F.col("video_id").alias("run_id"), F.explode(F.array(F.lit("download"), F.lit("transcribe"))).alias("stage"), F.when(F.col("status") == "failed", "failed").otherwise("completed").alias("status")).distinct()
    return tables.run_status(u, STAGES[:2])


# ---- O and U: order, samples, splits, sets -----------------------------------------------------


@query("select video_id, arg_max(title, updated_at) as title, min(updated_at) as first_seen from videos where trim(video_id) <> '' group by video_id")
def op_o2_unique_sources(spark, sf):
    v = table(spark, sf, "videos").select("video_id", F.coalesce("title", F.lit("\x00")).alias("title"), "updated_at")
    u = tables.unique_sources(v, "video_id", "updated_at")
    return u.select("video_id", F.nullif("title", F.lit("\x00")).alias("title"), F.col("first_position").alias("first_seen"))


@query("select video_id as run_id, updated_at from videos where status in ('failed') order by updated_at desc, video_id desc limit 1")
def op_o3_resumable(spark, sf):
    runs = table(spark, sf, "videos").select(F.col("video_id").alias("run_id"), "status", F.lit("h").alias("config_hash"), "updated_at")
    return tables.resumable(runs, "h").select("run_id", "updated_at")


@query("with e as (select distinct entry_id from entries) select entry_id from e order by sha256('7|' || entry_id), entry_id limit 20")
def op_o5_sample(spark, sf):
    return tables.sample(table(spark, sf, "entries").select("entry_id").distinct(), 20, 7, "entry_id")


@query("select distinct video_id, chunk_index, (['cleanup_filler', 'tighten_60_percent', 'expand_with_examples', 'convert_to_script'])[(chunk_index + k) % 4 + 1] as brief from (select video_id, chunk_index, unnest(range(2)) as k from chunk_records)")
def op_o7_briefs(spark, sf):
    c = table(spark, sf, "chunk_records").select("video_id", "chunk_index").distinct()
    return c.select("video_id", "chunk_index", F.explode(tables.rotated(tuple(BRIEFS), F.col("chunk_index"), 2)).alias("brief"))


@query("""with ids as (select distinct video_id from chunk_records), n as (select count(*) as n, (count(*) * 0.1::double)::double as w from ids),
r as (select video_id, row_number() over (order by sha256('3407|' || video_id), video_id) as rk from ids)
select video_id from r, n where rk <= case when floor(w) = 0 and n > 1 then 1 else floor(w) end""")
def op_o8_held_out(spark, sf):
    return tables.held_out_groups(table(spark, sf, "chunk_records"), "video_id", 0.1, 3407)


@query("""select kind, count(*) as n from (select 'excerpt' as kind from (select distinct video_id, chunk_index from chunk_records) union all select 'chunk' from (select distinct video_id, chunk_index from normalize_chunks)) group by kind""")
def op_u3_u4_union(spark, sf):
    count = lambda name, kind: table(spark, sf, name).select("video_id", "chunk_index").distinct().agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
    return tables.merged_counts(count("chunk_records", "excerpt"), count("normalize_chunks", "chunk"), "kind").select("kind", "n")


@query(f"""with w as (select doc_id, pos, word from (select doc_id, unnest({_words('text')}) as word, generate_subscripts({_words('text')}, 1) as pos from documents)),
f as (select doc_id, word, min(pos) as p from w group by all) select doc_id, string_agg(word, ' ' order by p) as vocabulary from f group by doc_id""")
def op_u5_vocabulary(spark, sf):
    d = docs(spark, sf).where(F.size(text.words(F.col("text"))) > 0)
    return d.select("doc_id", F.array_join(F.array_distinct(text.words(F.col("text"))), " ").alias("vocabulary"))


def _trim_sql(p: str, t: str) -> str:
    """SQL of sequences.trim_repeat for two expressions."""
    a, b, x, y = _lines_sql(p), _lines_sql(t), _spaced_sql(p), _spaced_sql(t)
    n = f"coalesce(list_max(list_filter(range(1, least(len({a}), len({b}), 3) + 1), lambda k: ({a})[len({a}) - k + 1:] = ({b})[:k])), 0)"
    m = f"coalesce(list_max(list_filter(range(11, least(len({x}), len({y}), 80) + 1), lambda k: ({x})[len({x}) - k + 1:] = ({y})[:k])), 0)"
    return rf"case when {_strip_sql(p)} = '' or {_strip_sql(t)} = '' then {_strip_sql(t)} when {n} > 0 then coalesce(array_to_string(({b})[{n} + 1:], E'\n'), '') when {m} > 0 then coalesce(array_to_string(({y})[{m} + 1:], ' '), '') else {_strip_sql(t)} end"


_FOLDED = "{'size': 0, 'chunk': 0, 'chars': 0, 'taken': 0, 'out': []::int[]}"
_GREEDY_CHUNKS = rf"""l as (select doc_id, string_split(text, E'\n') as lines from documents where text is not null),
f as (select doc_id, lines, list_reduce(list_transform(lines, lambda x: {{'size': length({_strip_sql('x')}), 'chunk': 0, 'chars': 0, 'taken': 0, 'out': []::int[]}}),
  lambda a, e: case when e.size > 0 and a.taken > 0 and (a.chars >= 400 or a.chars + e.size + (a.chars > 0)::int > 550)
    then {{'size': 0, 'chunk': a.chunk + 1, 'chars': e.size, 'taken': 1, 'out': list_append(a.out, a.chunk + 1)}}
    else {{'size': 0, 'chunk': a.chunk, 'chars': case when e.size > 0 then a.chars + e.size + (a.chars > 0)::int else a.chars end, 'taken': a.taken + 1, 'out': list_append(a.out, a.chunk)}} end, {_FOLDED}).out as chunk from l),
x as (select doc_id, unnest(lines) as line, unnest(chunk) as chunk from f)"""
_PARAGRAPHS = rf"list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n+'), lambda x: {_strip_sql('x')}), lambda x: x <> '')"


# ---- Q: sequences ------------------------------------------------------------------------------


@query(f"with {_GREEDY_CHUNKS} select doc_id, chunk::bigint as chunk, count(*) as lines, sum(length({_strip_sql('line')}))::bigint as chars from x group by doc_id, chunk")
def op_q1_chunks(spark, sf):
    """Lines of each document gathered greedily to 400 characters, 550 at most."""
    lines = F.split("text", "\n")
    d = spread(docs(spark, sf)).where("text is not null").select("doc_id", lines.alias("lines"), sequences.chunk_numbers(lines, 400, 550).alias("chunk"))
    return d.select("doc_id", F.explode(F.arrays_zip("lines", "chunk")).alias("x")).groupBy("doc_id", "x.chunk").agg(F.count("*").alias("lines"), F.sum(F.length(sequences.strip(F.col("x.lines")))).alias("chars"))


@query(None)
def op_q2_overlapped_chunks(spark, sf):
    segments = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit(None).cast("double").alias("start"), F.lit(None).cast("double").alias("end"), t.alias("text")))
    d = docs(spark, sf).where("text is not null").select("doc_id", sequences.chunker(400, 550, 80)(segments).alias("c"))
    return d.select("doc_id", F.inline("c")).select("doc_id", "chunk_index", "start_segment_index", "end_segment_index", F.length("text").alias("chars"))


@query(rf"""with c as (select video_id, chunk_index, coalesce(first(normalized_excerpt order by ingested_at), '') as t from chunk_records group by all),
j as (select c.*, coalesce(p.t, '') as p from c left join c p on p.video_id = c.video_id and p.chunk_index = c.chunk_index - 1),
parts as (select *, {_strip_sql('t')} as whole, {_lines_sql('p')} as a, {_lines_sql('t')} as b, {_spaced_sql('p')} as x, {_spaced_sql('t')} as y from j),
sizes as (select *, coalesce(list_max(list_filter(range(1, least(len(a), len(b), 3) + 1), lambda k: a[len(a) - k + 1:] = b[:k])), 0) as n,
  coalesce(list_max(list_filter(range(11, least(len(x), len(y), 80) + 1), lambda k: x[len(x) - k + 1:] = y[:k])), 0) as m from parts)
select video_id, chunk_index, case when {_strip_sql('p')} = '' or whole = '' then whole when n > 0 then coalesce(array_to_string(b[n + 1:], E'\n'), '') when m > 0 then coalesce(array_to_string(y[m + 1:], ' '), '') else whole end as text from sizes""")
def op_q3_trim_repeats(spark, sf):
    """Each excerpt without what repeats the end of the one before it, by an equi-join on neighbouring numbers."""
    c = once(spark, sf, "chunk_records", "video_id", "chunk_index").select("video_id", "chunk_index", F.coalesce("normalized_excerpt", F.lit("")).alias("t"))
    before = c.select("video_id", (F.col("chunk_index") + 1).alias("chunk_index"), F.col("t").alias("p"))
    j = c.join(before, ["video_id", "chunk_index"], "left")
    return j.select("video_id", "chunk_index", sequences.trim_repeat(F.coalesce("p", F.lit("")), F.col("t")).alias("text"))


@query(f"""with p as (select doc_id, {_PARAGRAPHS} as ps from documents where text is not null),
f as (select doc_id, list_reduce(list_transform(ps, lambda x: {{'last': x, 'out': []::varchar[]}}), lambda acc, e: case when ({_trim_sql('acc.last', 'e.last')}) = '' then acc
  else {{'last': {_trim_sql('acc.last', 'e.last')}, 'out': list_append(acc.out, {_trim_sql('acc.last', 'e.last')})}} end, {{'last': '', 'out': []::varchar[]}}) as r from p)
select doc_id, coalesce(array_to_string(r.out, E'\\n\\n'), '') as merged from f""")
def op_q4_merge(spark, sf):
    """Paragraphs of each document merged, with repeats at their seams removed."""
    return spread(docs(spark, sf)).where("text is not null").select("doc_id", sequences.merge_chunks(parsing.paragraphs(F.col("text"))).alias("merged"))


@query("select entry_id, o as expected from (select entry_id, arg_min(output_text, created_at) filter (true) as o, arg_min(input_text, created_at) as i from entries group by 1) where o is not null and i is not null")
def op_q5_expected(spark, sf):
    return _talks(spark, sf).select("entry_id", sequences.expected_answer(F.col("messages")).alias("expected"))


# ---- S, X, K: sources, parsing, sinks ----------------------------------------------------------


@query("select distinct trim(url) as url from videos where trim(url) <> '' and trim(url) not like '#%'")
def op_s1_addresses(spark, sf):
    return readers.address_lines(table(spark, sf, "videos").select(F.col("url").alias("value"))).distinct()


@query("select distinct video_id as id, title from videos where channel_id is not null")
def op_s3_flatten(spark, sf):
    """Channels as playlists of the days' uploads: entries of entries come out one level deep."""
    v = table(spark, sf, "videos").where("channel_id is not null").select("channel_id", "upload_date", "video_id", "title").distinct()
    leaf = F.struct(F.col("video_id").alias("id"), F.col("title").alias("title"))
    days = v.groupBy("channel_id", "upload_date").agg(F.collect_list(leaf).alias("entries"))
    info = days.select(F.array(F.struct(F.col("channel_id").alias("id"), F.col("upload_date").alias("title"), "entries")).alias("entries"))
    return readers.flatten_playlists(info).select("id", "title").distinct()


@query("""with c as (select video_id, language, source = 'youtube_auto' as gen, updated_at as p from transcripts), r as (select *, case when not gen and language in ('en', 'eng') then 1 when not gen then 2 when language in ('en', 'eng') then 3 else 4 end as pr from c where gen is not null)
select video_id, min(pr) as priority from r group by video_id""")
def op_s6_selection(spark, sf):
    t = table(spark, sf, "transcripts").select("video_id", "language", (F.col("source") == "youtube_auto").alias("is_generated"), F.col("updated_at").alias("position")).where("is_generated is not null")
    return readers.choose_transcript(t, ["en", "eng"], True, True).select("video_id", F.col("priority").cast("int").alias("priority"))


@query("select distinct video_id, chunk_index from normalize_chunks")
def op_s9_json_lines(spark, sf):
    """Rows written as JSON lines among broken ones, and read again."""
    c = table(spark, sf, "normalize_chunks")
    good = c.select(F.to_json(F.struct("video_id", "chunk_index")).alias("value"))
    bad = c.select(F.explode(F.array(F.lit(""), F.lit("{broken"), F.lit("[1, 2]"), F.lit("7"))).alias("value")).distinct()
    return readers.json_objects(good.unionByName(bad), "video_id string, chunk_index bigint").distinct()


@query(r"select doc_id, len(list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n+'), lambda x: trim(x, E' \t\n\r\x0b\x0c')), lambda x: x <> '')) as paragraphs from documents where text is not null")
def op_s11_s12_paragraphs(spark, sf):
    """A transcript without segments gives its paragraphs."""
    content = F.to_json(F.struct(F.col("text")))
    return docs(spark, sf).where("text is not null").select("doc_id", F.size(readers.transcript_segments(content)).cast("bigint").alias("paragraphs"))


@query("""select distinct video_id, chunk_index, case when segment_start_idx is null or segment_end_idx is null or chunk_index is null then 'bad_index' when segment_start_idx > segment_end_idx then 'bad_range' when coalesce(trim(normalized_excerpt_path), '') = '' then 'missing_path'
  when coalesce(trim(normalized_excerpt), '') = '' then 'missing_excerpt' when normalized_excerpt_sha256 is null then 'missing_hash' when normalized_excerpt_sha256 <> sha256(normalized_excerpt) then 'hash_differs' end as error from chunk_records""")
def op_s13_chunk_records(spark, sf):
    return readers.chunk_records(table(spark, sf, "chunk_records")).select("video_id", "chunk_index", "error").distinct()


@query(r"select distinct video_id, coalesce(nullif(regexp_extract(url, '(?:v=|/)([0-9A-Za-z_-]{11})(?:[&?]|$)', 1), ''), nullif(regexp_extract(url, 'youtu\.be/([0-9A-Za-z_-]{11})', 1), ''), nullif(regexp_extract(url, 'embed/([0-9A-Za-z_-]{11})', 1), '')) as id from videos")
def op_s15_url_ids(spark, sf):
    return table(spark, sf, "videos").select("video_id", parsing.video_id_of_url(F.col("url")).alias("id")).distinct()


@query("select entry_id, case when o like '%<<<EDIT_OUTPUT_START>>>%<<<EDIT_OUTPUT_END>>>%' then 'empty' else 'missing_start' end as error from (select entry_id, arg_min(output_text, created_at) filter (true) as o from entries group by 1) where o is not null")
def op_x1_between(spark, sf):
    e = once(spark, sf, "entries", "entry_id").where("output_text is not null")
    return e.select("entry_id", parsing.between(F.col("output_text"), *parsing.MARKS["edit"])["error"].alias("error"))


@query("select entry_id, case when coalesce(trim(i), '') = '' or trim(o) = '' then 'blank_content' end as error from (select entry_id, arg_min(instruction, created_at) filter (true) as i, arg_min(output_text, created_at) filter (true) as o, arg_min(input_text, created_at) as s from entries group by 1) where o is not null and s is not null")
def op_x2_chats(spark, sf):
    t = _talks(spark, sf)
    return t.select("entry_id", parsing.chat_messages(F.to_json(F.struct("messages")), 1)["error"].alias("error"))


@query("select distinct video_id, chunk_index, 'Part ' || chunk_index || ' of {' || video_id || '}' as prompt from chunk_records")
def op_x3_prompt(spark, sf):
    c = table(spark, sf, "chunk_records").select("video_id", "chunk_index").distinct()
    return c.withColumn("prompt", parsing.fill("Part {n} of {{{id}}}", n=F.col("chunk_index"), id=F.col("video_id")))


@query("""select a.video_id, a.chunk_index, 'editorial_rewrite' as generator_name, 'v1' as generator_version, 't' as prompt_template_id, a.title, a.segment_start_idx, a.segment_end_idx, a.start_time, a.end_time, a.normalized_excerpt_path as source_excerpt_path, a.normalized_excerpt_sha256 as source_excerpt_sha256,
  'raw/' || a.video_id as raw_excerpt_path, sha256(b.text) as raw_excerpt_sha256, a.normalized_excerpt_path, a.normalized_excerpt_sha256
from (select video_id, chunk_index, unnest(arg_min(x, ingested_at)) from (select video_id, chunk_index, ingested_at, {'title': title, 'segment_start_idx': segment_start_idx, 'segment_end_idx': segment_end_idx, 'start_time': start_time, 'end_time': end_time, 'normalized_excerpt_path': normalized_excerpt_path, 'normalized_excerpt_sha256': normalized_excerpt_sha256} as x from chunk_records) group by video_id, chunk_index) a
join (select video_id, chunk_index, max(text) as text from normalize_chunks group by all) b using (video_id, chunk_index)""")
def op_x5_metadata(spark, sf):
    """All sixteen fields."""
    raw = table(spark, sf, "normalize_chunks").groupBy("video_id", "chunk_index").agg(F.max("text").alias("text"))
    c = once(spark, sf, "chunk_records", "video_id", "chunk_index").join(raw, ["video_id", "chunk_index"])
    c = c.withColumn("raw_excerpt_path", F.concat(F.lit("raw/"), "video_id")).withColumn("raw_excerpt_sha256", hashing.text_hash(F.col("text")))
    return c.select(generate.metadata("editorial_rewrite", "v1", "t", c.columns).alias("m")).select("m.*")


@query("""select video_id, arg_min(status, updated_at) as status, bool_or(metrics is not null) as has_metrics from videos group by video_id""")
def op_k5_metrics(spark, sf):
    m = writers.metric_rows(once(spark, sf, "videos", "video_id"))
    return m.select("video_id", "status", F.coalesce(~F.startswith("metrics", F.lit('{"skip_reason"')), F.lit(False)).alias("has_metrics"))


@query(None)
def op_e4_edits(spark, sf):
    """Requests, stand-in answers, parsing and gates for every excerpt that is long enough."""
    c = once(spark, sf, "chunk_records", "video_id", "chunk_index")
    return generate.run_edits(c, Edit()).select("video_id", "chunk_index", "edit_brief", "status", "reason")


# ---- files, answers and single rules ------------------------------------------------------------


@query("select doc_id, case when text is null then 'missing_minhash' end as reason from documents")
def op_p8_missing_minhash(spark, sf):
    """Documents without a text have no signature."""
    d = dedup.signatures(docs(spark, sf), "doc_id", "text", K, keep=("text",)).withColumn("signature", F.when(F.col("text").isNotNull(), F.col("signature")))
    return rules.decide(d, [rules.missing_minhash(F.col("signature"))]).select("doc_id", "reason")


@query("select entry_id, arg_min(edit_brief, created_at) as edit_brief, 2::bigint as n from (select entry_id, coalesce(edit_brief, '') as edit_brief, created_at from entries) group by entry_id")
def op_k1_k2_json_lines(spark, sf):
    """Rows written as JSON lines over older ones, appended once more and read back."""
    e = once(spark, sf, "entries", "entry_id").select("entry_id", F.coalesce("edit_brief", F.lit("")).alias("edit_brief"))
    path = scratch(spark)
    writers.write_json_lines(e.limit(3), path)
    writers.write_json_lines(e, path)
    writers.write_json_lines(e, path, append=True)
    return readers.read_json_lines(spark, path, "entry_id bigint, edit_brief string").groupBy("entry_id", "edit_brief").agg(F.count("*").alias("n"))


@query("select coalesce(channel_id, 'none') as channel_id, count(distinct video_id) as videos from videos group by 1")
def op_k3_s10_json_file(spark, sf):
    """A small summary written as one JSON file in one step and read back on the driver (40 channels, fixed)."""
    import tempfile

    counts = table(spark, sf, "videos").groupBy(F.coalesce("channel_id", F.lit("none")).alias("channel_id")).agg(F.count_distinct("video_id").alias("videos"))
    with tempfile.TemporaryDirectory() as folder:  # of the driver alone
        writers.write_json(f"{folder}/summary.json", {r.channel_id: r.videos for r in counts.collect()})
        read = readers.read_json(f"{folder}/summary.json", {})
        assert readers.read_json(f"{folder}/none.json", {}) == {}
    return spark.createDataFrame(sorted(read.items()), "channel_id string, videos bigint")


@query("select video_id, count(*) as n, 1 as parts from (select distinct video_id, chunk_index from chunk_records) group by video_id")
def op_k4_sorted(spark, sf):
    """Rows written in order of a key: every key's rows lie together in one file, in order."""
    c, path = table(spark, sf, "chunk_records").select("video_id", "chunk_index").distinct(), scratch(spark)
    writers.write_sorted(c, path, "video_id", "chunk_index")
    read = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    return read.groupBy("video_id").agg(F.count("*").alias("n"), F.count_distinct("file").cast("int").alias("parts"))


@query(f"with {_PROFILE}, {_CASCADE}, d as (select doc_id, case when reason is null then 'kept' else 'dropped' end as status from judged) select 'decisions' as folder, status, count(*) as n from d group by all union all select status, status, count(*) from d group by all")
def op_k6_decision_files(spark, sf):
    """Decisions, kept and dropped as they lie in their three folders."""
    made = rules.decide(_profiled(spread(docs(spark, sf))), rules.quality_rules(FILTER)).select("doc_id", "status", "reason")
    path = scratch(spark)
    writers.write_decisions(made, path)
    folders = [spark.read.parquet(f"{path}/{f}").groupBy("status").agg(F.count("*").alias("n")).select(F.lit(f).alias("folder"), "status", "n") for f in ("decisions", "kept", "dropped")]
    return folders[0].unionByName(folders[1]).unionByName(folders[2])


@query("select doc_id from documents order by doc_id::varchar limit 25")
def op_o1_string_order(spark, sf):
    """The report's first rows in order of the id as a string: 10 stands before 9."""
    return docs(spark, sf).select("doc_id").orderBy(F.col("doc_id").cast("string")).limit(25)


@query("select video_id as run_id, updated_at from videos order by updated_at desc, video_id desc limit 1")
def op_o4_latest_run(spark, sf):
    return tables.latest_run(table(spark, sf, "videos").select(F.col("video_id").alias("run_id"), "updated_at"))


@query(f"""select distinct video_id, sha256('{{"settings":"{hashing.plain_hash(Filter())}","version":"1","video_id":"' || video_id || '"}}') as input_hash from videos""")
def op_h4_input_hash(spark, sf):
    v = table(spark, sf, "videos").select("video_id").distinct()
    return v.withColumn("input_hash", hashing.input_hash(Filter(), "1", video_id=F.col("video_id")))


def _answer_in_parts():
    """A stand-in that answers as hosted models may: a list of parts."""
    return lambda system, user: [{"type": "text", "text": user[: len(user) // 2]}, {"content": user[len(user) // 2 :]}, None]


@query("select doc_id, coalesce(text, '') as answer, null::varchar as error from documents")
def op_x4_e1_answers(spark, sf):
    """Answers that come in parts, put together again."""
    d = docs(spark, sf).withColumn("system", F.lit(""))
    return external.complete(spread(d), "system", "text", _answer_in_parts).select("doc_id", "answer", "error")


@query(r"select doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n+'), lambda x: trim(x, E' \t\n\r\x0b\x0c')), lambda x: x <> ''), chr(10)) as said, lang as language from documents where text is not null")
def op_x6_transcript(spark, sf):
    """Documents as transcripts: their paragraphs are the segments."""
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", "lang", readers.transcript_segments(F.to_json(F.struct("text"))).alias("segments"))
    t = d.select("doc_id", parsing.transcript(F.lit("documents"), F.col("lang"), F.col("segments")).alias("t"))
    return t.select("doc_id", F.col("t.text").alias("said"), F.col("t.language").alias("language"))


@query("select video_id, arg_min(status, updated_at) as status, arg_min(metrics.media_size_bytes, updated_at) filter (true) as bytes from videos where metrics is not null group by video_id")
def op_x7_stage_entry(spark, sf):
    v = once(spark, sf, "videos", "video_id").where("metrics is not null")
    e = v.select("video_id", parsing.stage_entry(F.col("status"), F.col("metrics")).alias("entry"))
    return e.select("video_id", "entry.status", F.col("entry.metrics.media_size_bytes").alias("bytes"))


@query("select distinct video_id, chunk_index, segment_start_idx as first_index from chunk_records")
def op_m20_strict_int(spark, sf):
    """Whole numbers out of texts; anything else would fail the query."""
    c = table(spark, sf, "chunk_records").select("video_id", *[parsing.strict_int(F.col(a).cast("string"), a).alias(b) for a, b in (("chunk_index", "chunk_index"), ("segment_start_idx", "first_index"))])
    return c.distinct()


@query("select distinct video_id, quality_score from analyze_metrics where quality_score is not null")
def op_p9_required(spark, sf):
    """The metric of rows that have it; a row without would fail the query."""
    m = cut(table(spark, sf, "analyze_metrics").where("quality_score is not null").select("video_id", "quality_score"))
    return m.select("video_id", rules.required("quality_score", "analyze").alias("quality_score")).distinct()


@query("select distinct video_id, segment_index, start_time, end_time, trim(text) as said from transcript_segments where trim(text) <> ''")
def op_s11_timed_segments(spark, sf):
    """Segments as a transcript file holds them, read again: trimmed, with their times."""
    s = F.struct(F.col("start_time").alias("start"), F.col("end_time").alias("end"), "text")
    content = F.to_json(F.struct(F.array(s).alias("segments"), F.lit("").alias("text")))
    rows = table(spark, sf, "transcript_segments").select("video_id", "segment_index", F.explode(readers.transcript_segments(content)).alias("s"))
    return rows.select("video_id", "segment_index", F.col("s.start").alias("start_time"), F.col("s.end").alias("end_time"), F.col("s.text").alias("said")).distinct()


def _talk_in_turns():
    """A stand-in for the talk model: question and answer in turn, the answer made of the prompt."""

    def answer(system: str, user: str) -> str:
        words = user.split()
        turns = [{"role": r, "content": c} for k in range(Talk().turn_pairs) for r, c in (("user", f"What about part {k + 1}?"), ("assistant", "In my own words: " + " ".join(words[k::7])))]
        return f"{parsing.MARKS['talk'][0]}\n{json.dumps({'messages': turns})}\n{parsing.MARKS['talk'][1]}"

    return answer


@query(None)
def op_e3_talks(spark, sf):
    """Prompts, stand-in answers, parsing and all gates for every excerpt that is long enough."""
    c = once(spark, sf, "chunk_records", "video_id", "chunk_index")
    made = generate.run_talks(c, Talk(), _talk_in_turns, prompt="{source_excerpt}")
    return made.select("video_id", "chunk_index", "status", "reason", F.size("messages").alias("messages"))


@query(None)
def op_m14_change_block(spark, sf):
    """The whole block of source against normalized excerpt, similarity included."""
    return text.with_change(_excerpt_pairs(spark, sf), "text", "normalized_excerpt", similarity=True).drop("text", "normalized_excerpt")
