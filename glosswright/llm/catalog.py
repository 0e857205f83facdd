"""Registered queries of the training-data operators and their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswright.llm import lang, leaks, pairs, pieces, prose, repetition, splits, tokens, toxicity, turns
from glosswright.runtime import cut, if_small, table


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode(table(spark, sf, "documents"))


def _video_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.text_tokens(table(spark, sf, "chunk_records"), "video_id", "chunk_index", "normalized_excerpt")


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    """analyze_metrics once per video; repeats are the same record, so the earliest stands."""
    m = table(spark, sf, "analyze_metrics").select("video_id", "token_count", "word_count", "language", "updated_at")
    return m.groupBy("video_id").agg(*[F.min_by(c, "updated_at").alias(c) for c in ("token_count", "word_count", "language")])


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.untrusted_counts(_metrics(spark, sf), _video_tokens(spark, sf)).select("video_id")


def video_channels(spark: SparkSession, sf: str) -> DataFrame:
    """(video_id, channel_id, channel, domain, main_language); a null channel_id is told by the channel's name."""
    channels = if_small(table(spark, sf, "channels").select("channel_id", "channel", "domain", "main_language"))
    v = table(spark, sf, "videos").groupBy("video_id").agg(F.max("channel_id").alias("cid"), F.max("channel").alias("cname"))
    by_name = channels.select(F.col("channel").alias("cname"), F.col("channel_id").alias("named_id"))
    v = v.join(by_name, "cname", "left").select("video_id", F.coalesce("cid", "named_id").alias("channel_id"))
    return v.join(channels, "channel_id", "left")


def p7_video_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Usable tokens of each video of analyze_metrics, by exact count, with its settled language."""
    t = _metrics(spark, sf).join(_video_tokens(spark, sf), "video_id", "left")
    t = t.join(video_channels(spark, sf), "video_id", "left")
    # a known spelling is kept unless the text clearly speaks another language
    language = F.coalesce(tokens.video_languages(), lang.canonical(F.col("language")), F.col("main_language"), F.lit("unknown"))
    return t.select("video_id", "channel_id", "channel", "domain", language.alias("language"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def p7_budget(spark: SparkSession, sf: str) -> DataFrame:
    t = p7_video_tokens(spark, sf)
    return t.groupBy("channel", "domain", "language").agg(F.count("*").alias("videos"), F.sum("tokens").alias("tokens"))


def _entry_components(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "entries").select("entry_id", splits.entities(F.col("metadata")).alias("entities"))
    return splits.group_components(e, "entry_id", "entities")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    known = _entry_components(spark, sf).where(~F.startswith("component", F.lit("row:")))
    return splits.broken_groups(table(spark, sf, "entries").select("entry_id", "prev_split"), "entry_id", known, "prev_split")


def p4_splits(spark: SparkSession, sf: str) -> DataFrame:
    targets = [(r.split_name, r.share) for r in table(spark, sf, "split_targets").where("split_name is not null and share > 0").orderBy("split_name").collect()]  # a fixed handful
    return splits.assign(_entry_components(spark, sf), targets).select("entry_id", "component", "split")


def _oversized(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "normalize_chunks").select("video_id", "chunk_index", "start_segment_index", "end_segment_index", "text")
    return pieces.oversized(items, table(spark, sf, "transcript_segments"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.cut_items(_oversized(spark, sf), with_text=False).select("video_id", "chunk_index", F.col("needed").alias("boundary"))


def p5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    cut = pieces.cut_items(_oversized(spark, sf))
    return cut.select("video_id", "chunk_index", F.inline("pieces")).withColumnRenamed("text", "piece")


def live_stream(spark: SparkSession, sf: str, share: float = 0.05) -> list[str]:
    """Ids of the live videos with at least *share* of all segments: at most 1 / share of them."""
    segments = table(spark, sf, "transcript_segments").select("video_id")
    least = share * segments.count()
    big = segments.groupBy("video_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("video_id")
    v = table(spark, sf, "videos")
    live = v.where((F.col("live_status") == "is_live") | F.col("metrics.is_live")).select("video_id")
    return [r.video_id for r in live.join(F.broadcast(big), "video_id", "left_semi").distinct().collect()]


def p6_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Share of repeated content of each excerpt and, with chunk_index -1, each whole transcript."""
    excerpts = repetition.text_repetition(table(spark, sf, "chunk_records"), ["video_id", "chunk_index"], "normalized_excerpt")
    segments = table(spark, sf, "transcript_segments").select("video_id", "segment_index", "text")
    segments = segments.where(~F.col("video_id").isin(live_stream(spark, sf)))
    whole = repetition.sequence_repetition(segments, "video_id", "segment_index", "text")
    shares = excerpts.unionByName(whole.withColumn("chunk_index", F.lit(-1).cast("long")))
    return shares.withColumn("share", F.round("share", 9))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return p6_shares(spark, sf).where("share >= 0.4").select("video_id", "chunk_index")


def p6_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.divergence(table(spark, sf, "chunk_records"), ["video_id", "chunk_index"], "normalized_excerpt")


def _prose(spark: SparkSession, sf: str) -> DataFrame:
    return prose.measure(table(spark, sf, "chunk_records"), ["video_id", "chunk_index"], "normalized_excerpt")


def p2_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics, distance from the language's prose and contributions of each excerpt."""
    measured = _prose(spark, sf)
    return prose.score(measured, prose.fit(measured)).withColumn("kind", prose.kind())


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_statistics(spark, sf).where("kind is not null").select("video_id", "chunk_index", "kind")


def p2_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words counted in the excerpts of each video of analyze_metrics, beside the stored count."""
    counted = _prose(spark, sf).groupBy("video_id").agg(F.sum("words").alias("words"))
    m = _metrics(spark, sf).join(counted, "video_id", "left")
    words = F.coalesce("words", F.lit(0))
    return m.select("video_id", F.col("word_count").alias("stored"), words.alias("counted"), F.coalesce(F.col("word_count") == words, F.lit(False)).alias("agrees"))


def p1_defects(spark: SparkSession, sf: str) -> DataFrame:
    """Defect and clause coverage of every pair."""
    e = table(spark, sf, "entries")
    return pairs.defects(e, pairs.fit(e))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_defects(spark, sf).where("defect is not null").select("entry_id", "defect")


def p9_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Leaked items of each document with the words covered."""
    return leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The documents with leaks, their leaked spans removed or, beyond the coverage limit, dropped."""
    d = table(spark, sf, "documents")
    return leaks.cleaned(d, cut(leaks.spans(d, table(spark, sf, "eval_items"))))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_leaks(spark, sf).select("doc_id", "item_id")


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity of each document in each category."""
    d = table(spark, sf, "documents")
    return toxicity.score(d, toxicity.train(d, table(spark, sf, "toxicity_labels")))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs_ = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("severity")) for c in toxicity.CATEGORIES])).alias("x")
    return p10_scores(spark, sf).select("doc_id", pairs_).where(F.col("x.severity") >= toxicity.SEVERE).select("doc_id", "x.category")


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Share of severe documents per source and category; a null source is a source of its own."""
    s = p10_scores(spark, sf)
    severe = [F.avg((F.col(c) >= toxicity.SEVERE).cast("double")).alias(c) for c in toxicity.CATEGORIES]
    any_of = F.avg((F.greatest(*toxicity.CATEGORIES) >= toxicity.SEVERE).cast("double")).alias("any")
    return s.groupBy("source").agg(F.count("*").alias("documents"), *severe, any_of)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return turns.turns(table(spark, sf, "transcript_segments"), table(spark, sf, "speakers"), video_channels(spark, sf))


def p3_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The clean lines of every turn, in order of (video_id, segment_index, pos)."""
    return turns.lines(table(spark, sf, "transcript_segments"), table(spark, sf, "speakers"), video_channels(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if re.match(r"p\d+_", k)}


#: The video of an entry, as splits.video_key tells it.
_VIDEO_SQL = r"""
keyed as (
  select entry_id, prev_split, coalesce(
    nullif(regexp_extract(plain, '[?&]v=([A-Za-z0-9_-]{11})(?:$|[&#])', 1), ''),
    nullif(regexp_extract(plain, '(?:^|[=/:])([A-Za-z0-9_-]{11})(?:$|[?&#/])', 1), ''),
    nullif(regexp_extract(path, '(?:^|/)chunks/([A-Za-z0-9_-]{11})/', 1), '')) as video
  from (select entry_id, prev_split, metadata.source_excerpt_path as path,
        regexp_replace(metadata.video_id, '^[\s"'']+|[\s"'']+$', '', 'g') as plain from entries)
)"""

_REPEATED_SQL = r"""
live as (select video_id from (select video_id, count(*) as n from transcript_segments group by 1) where n >= 0.05 * (select count(*) from transcript_segments)
  and video_id in (select video_id from videos where live_status = 'is_live' or metrics.is_live)),
segs as (select video_id, segment_index, arg_min(text, ingested_at) as text from transcript_segments where text is not null and video_id not in (select video_id from live) group by all),
units as (select video_id, chunk_index, first(normalized_excerpt order by ingested_at) as text from chunk_records group by all
  union all select video_id, -1, string_agg(text, ' ' order by segment_index) from segs group by video_id),
listed as (select video_id, chunk_index, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as ws from units),
placed as (select video_id, chunk_index, unnest(ws) as w, generate_subscripts(ws, 1) as p from listed),
grams as (select video_id, chunk_index, p, string_agg(w, ' ') over g as gram, count(*) over g as n from placed window g as (partition by video_id, chunk_index order by p rows between current row and 5 following)),
later as (select *, min(p) over (partition by video_id, chunk_index, gram) as first_p from grams where n = 6),
covered as (select video_id, chunk_index, count(distinct p + k) as c from (select video_id, chunk_index, p, unnest(range(6)) as k from later where p > first_p) group by all),
shares as (select l.video_id, l.chunk_index, len(ws) as words, coalesce(c, 0) as repeated, case when len(ws) = 0 then 0.0 else coalesce(c, 0) / len(ws) end as share from listed l left join covered using (video_id, chunk_index))"""

ORACLE = {
    "p2_words": r"""
with m as (select video_id, arg_min(word_count, updated_at) filter (true) as stored from analyze_metrics group by 1),
e as (select video_id, chunk_index, first(normalized_excerpt order by ingested_at) as t from chunk_records group by all),
c as (select video_id, sum(len(regexp_extract_all(t, '[\p{L}\p{N}_]+(?:''+[\p{L}\p{N}_]+)*')))::bigint as counted from e where t is not null group by 1)
select m.video_id, stored, coalesce(counted, 0) as counted, coalesce(stored = coalesce(counted, 0), false) as agrees from m left join c using (video_id)""",
    "p6_shares": "with" + _REPEATED_SQL + " select video_id, chunk_index, words, repeated, round(share, 9) as share from shares where not (chunk_index = -1 and words = 0)",
    "p6_found": "with" + _REPEATED_SQL + " select video_id, chunk_index from shares where share >= 0.4",
    "p4_found": "with" + _VIDEO_SQL + """
select distinct entry_id from keyed where video in
  (select video from keyed where video is not null group by video having count(distinct prev_split) > 1)""",
    "p4_splits": "with" + _VIDEO_SQL + """,
comp as (select entry_id, coalesce('video:' || min(video), 'row:' || entry_id) as component from keyed group by entry_id),
bounds as (select split_name, sum(share) over (order by split_name) as hi, sum(share) over (order by split_name) - share as lo,
  sum(share) over () as total from split_targets),
points as (select entry_id, component, ('0x' || substr(sha256(component), 1, 8))::bigint / 4294967296.0 as x from comp)
select entry_id, component, split_name as split from points join bounds on x * total >= lo and x * total < hi""",
    "p5_found": r"""
with items as (select distinct video_id, chunk_index, start_segment_index as s, end_segment_index as e, text
  from normalize_chunks where length(text) > 1200),
segs as (select video_id, segment_index, max(trim(text, E' \t\n\r\x0b\x0c')) as t from transcript_segments
  where length(trim(text, E' \t\n\r\x0b\x0c')) > 0 group by all),
parts as (select i.video_id, i.chunk_index, t from items i join segs g on g.video_id = i.video_id and g.segment_index between i.s and i.e),
longest as (select video_id, chunk_index, max(length(t)) as seg,
  max(list_max(list_transform(string_split(regexp_replace(t, '([.!?…])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(x)))) as sen,
  max(list_max(list_transform(string_split_regex(t, '\s+'), lambda x: length(x)))) as word
  from parts group by all)
select video_id, chunk_index, case when seg <= 1200 then 'segment' when sen <= 1200 then 'sentence' when word <= 1200 then 'word' else 'none' end as boundary
from longest""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
