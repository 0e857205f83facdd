"""The eight stages over the folders of a run; models, media and training come in as Services."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswright import external
from glosswright.functions import hashing, parsing, text
from glosswright.operators import dedup, generate, rules, sequences, tables
from glosswright.plans.config import PromptTemplate, Settings
from glosswright.runtime import cut
from glosswright.sources import readers, writers

#: Part of every input hash: raise it when a stage gives other results.
VERSION = "1"


def nothing():
    return F.lit(None).cast("string")


@dataclass(frozen=True)
class Services:
    """What is given from outside. A stage that needs one that is missing fails and names it."""

    #: rows of video_id, title, webpage_url, duration, is_live, live_status, media_path
    download: Callable[[SparkSession, Settings], DataFrame] | None = None
    #: builds the recogniser of external.transcribe
    transcribe: Callable | None = None
    #: instead of a recogniser: video_id, source, language, segments
    transcripts: Callable[[SparkSession, Settings], DataFrame] | None = None
    #: each builds a function (system, user) -> answer
    normalize: Callable[[], external.Model] | None = None
    edit: Callable[[], external.Model] | None = None
    talk: Callable[[], external.Model] | None = None
    #: (folder of training rows, folder of held-out rows, folder for the model)
    train: Callable[[str, str, str], object] | None = None
    #: (folder of prompts, folder of the model, folder for results)
    evaluate: Callable[[str, str, str], object] | None = None
    normalize_prompt: str = "{text}"
    talk_prompt: str = "{source_excerpt}"
    talk_system: str = ""
    edit_prompt: str = "{input_text}"
    edit_system: str = "{instruction}"


def with_templates(services: Services, talk: PromptTemplate | None = None, edit: PromptTemplate | None = None) -> Services:
    """Services with the prompts of templates."""
    given = {}
    for name, t in (("talk", talk), ("edit", edit)):
        if t:
            given |= {f"{name}_system": t.system_prompt, f"{name}_prompt": t.user_prompt_template}
    return dataclasses.replace(services, **given)


def staged(catalog: str, transcripts: str) -> dict[str, Callable[[SparkSession, Settings], DataFrame]]:
    """Download and transcripts from files: a catalog in JSON lines and a folder of ID.json transcripts."""

    def download(spark: SparkSession, settings: Settings) -> DataFrame:
        rows = readers.read_catalog(spark, catalog).withColumn("position", F.monotonically_increasing_id())
        path = F.concat(F.lit(transcripts.rstrip("/") + "/"), F.col("id"), F.lit(".json"))
        return tables.unique_sources(rows, "id", "position").select(F.col("id").alias("video_id"), "title", "webpage_url", "duration", "is_live", "live_status", path.alias("media_path"))

    def read(spark: SparkSession, settings: Settings) -> DataFrame:
        files = spark.read.option("wholetext", True).text(transcripts).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^./]+)?$", 1).alias("video_id"))
        language = F.get_json_object("value", "$.language")
        return files.select("video_id", F.lit("youtube_manual").alias("source"), language.alias("language"), readers.transcript_segments(F.col("value")).alias("segments"))

    return {"download": download, "transcripts": read}


def needed(services: Services, name: str) -> Callable:
    given = getattr(services, name)
    if given is None:
        raise RuntimeError(f"no function given for {name}")
    return given


def part(run, stage: str, name: str) -> str:
    return f"{run.stage_folder(stage)}/{name}"


def add(rows: DataFrame, path: str) -> None:
    """Rows (item_id, input_hash and more) of one attempt beside those of earlier ones."""
    rows.withColumn("attempt", F.lit(dt.datetime.now(dt.timezone.utc).isoformat())).write.mode("append").parquet(path)


def results(spark: SparkSession, manifest, stage: str, path: str) -> DataFrame:
    """What the newest attempt gave for each item that now stands as success with the same input."""
    if "://" not in path and not Path(path).exists():
        raise FileNotFoundError(f"{stage} has no results in {path}")
    rows = spark.read.parquet(path)
    done = manifest.stage(stage).where("status = 'success'").select("item_id", "input_hash")
    newest = rows.groupBy("item_id", "input_hash").agg(F.max("attempt").alias("attempt"))
    return rows.join(newest.join(done, ["item_id", "input_hash"]), ["item_id", "input_hash", "attempt"], "left_semi").drop("attempt")


def plain(rows: DataFrame) -> DataFrame:
    return rows.drop("item_id", "input_hash")


def outcome(rows: DataFrame, reason, skipped: bool = False) -> DataFrame:
    """item_id, status, input_hash, reason; a reason stands for a failure, or for an item left out."""
    return rows.select("item_id", F.when(reason.isNull(), "success").otherwise("skipped" if skipped else "failed").alias("status"), "input_hash", reason.alias("reason"))


def keyed(rows: DataFrame, settings: object, **fields) -> DataFrame:
    """H4."""
    return rows.withColumn("item_id", F.col("video_id")).withColumn("input_hash", hashing.input_hash(settings, VERSION, video_id=F.col("video_id"), **fields))


def misses(manifest, stage: str, rows: DataFrame) -> DataFrame:
    return cut(manifest.misses(stage, rows))


def stage_functions(services: Services | None = None) -> dict[str, Callable]:
    """The default stages of run_stages."""
    s = services or Services()

    def download(spark, run, manifest):
        cfg = run.settings.download
        found = cut(needed(s, "download")(spark, run.settings))
        has = F.lit(True) if cfg.media == "none" else F.col("media_path").isNotNull()
        route = rules.download_route(F.col("webpage_url"), F.col("duration"), F.col("is_live"), F.col("live_status"), has, cfg.include_shorts, cfg.include_live)
        rows = keyed(found, cfg, record=F.to_json(F.struct(*[F.col(c) for c in found.columns]))).withColumn("route", route)
        todo = misses(manifest, "download", rows)
        add(todo.where("route = 'ready'").drop("route"), part(run, "download", "videos"))
        status = F.when(F.col("route") == "ready", "success").when(F.col("route") == "failed", "failed").otherwise("skipped")
        manifest.mark("download", todo.select("item_id", status.alias("status"), "input_hash", F.nullif("route", F.lit("ready")).alias("reason")))

    def transcribe(spark, run, manifest):
        cfg = run.settings.transcribe
        videos = plain(results(spark, manifest, "download", part(run, "download", "videos"))).select("video_id", "title", "media_path")
        if s.transcripts is not None:
            given = s.transcripts(spark, run.settings).select("video_id", "source", "language", "segments")
            rows = videos.join(given, "video_id", "left").withColumn("error", F.when(F.col("segments").isNull(), "no_transcript"))
            rows = keyed(rows, cfg, transcript=F.to_json("segments"), language=F.col("language"))
            todo = misses(manifest, "transcribe", rows)
        else:
            todo = misses(manifest, "transcribe", keyed(videos, cfg, media=F.col("media_path")))
            todo = cut(external.transcribe(todo, "media_path", needed(s, "transcribe")).withColumn("source", F.lit(cfg.backend)))
        n = F.coalesce(F.size("segments"), F.lit(0))
        route = rules.transcript_route(F.col("source"), n, F.col("language"), cfg.language_allowlist, cfg.backend == "youtube_native")
        todo = todo.withColumn("left_out", F.when(F.col("error").isNull() & (route != "ready"), route))
        add(todo.where("error is null and left_out is null").select("item_id", "input_hash", "video_id", "title", "source", "language", "segments"), part(run, "transcribe", "transcripts"))
        manifest.mark("transcribe", outcome(todo.where("left_out is null"), F.col("error")).unionByName(outcome(todo.where("left_out is not null"), F.col("left_out"), True)))

    def normalize(spark, run, manifest):
        cfg = run.settings.normalize
        rows = plain(results(spark, manifest, "transcribe", part(run, "transcribe", "transcripts")))
        rows = keyed(rows, [cfg, s.normalize_prompt], title=F.col("title"), transcript=F.to_json("segments"))
        name, empty = rules.empty_transcript(F.col("segments"))
        todo = misses(manifest, "normalize", rows.withColumn("empty", empty))
        model = needed(s, "normalize")
        made = sequences.chunker(cfg.chunk_target_chars, cfg.chunk_hard_max_chars, cfg.chunk_overlap_chars)
        c = cut(todo.where("not empty").select("item_id", "input_hash", "video_id", "title", F.explode(made("segments")).alias("c")).select("item_id", "input_hash", "video_id", "title", "c.*"))
        answers = cut(generate.normalize_chunks(c, model, s.normalize_prompt))
        path = part(run, "normalize", "chunks")
        chunks = c.join(answers.where("ok").drop("ok"), ["video_id", "chunk_index"]).withColumnsRenamed({"start_segment_index": "segment_start_idx", "end_segment_index": "segment_end_idx"})
        chunks = chunks.withColumn("normalized_excerpt_path", F.lit(path)).withColumn("normalized_excerpt_sha256", hashing.text_hash(F.col("normalized_excerpt"))).withColumn("raw_excerpt_path", F.lit(path)).withColumn("raw_excerpt_sha256", hashing.text_hash(F.col("text")))
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "normalized_excerpt"))), lambda x: x["normalized_excerpt"])
        merged = chunks.groupBy("video_id").agg(in_order.alias("t"), F.count("*").alias("num_chunks")).select("video_id", "num_chunks", sequences.merge_chunks(F.col("t")).alias("normalized_text"))
        spoken = F.array_join(F.filter(F.transform("segments", lambda x: sequences.strip(F.coalesce(x["text"], F.lit("")))), lambda t: t != ""), " ")
        pairs = cut(todo.where("not empty").select("item_id", "input_hash", "video_id", "title", spoken.alias("source_text")).join(merged.where("normalized_text <> ''"), "video_id"))
        measured = text.with_change(pairs, "source_text", "normalized_text", similarity=True)
        add(chunks.join(pairs.select("video_id"), "video_id", "left_semi"), path)
        add(measured.drop("source_text"), part(run, "normalize", "texts"))
        ended = todo.join(pairs.select("video_id", F.lit(True).alias("good")), "video_id", "left")
        manifest.mark("normalize", outcome(ended.where("not empty"), F.when(F.col("good").isNull(), "llm_or_parse_error")).unionByName(outcome(ended.where("empty"), F.lit(name), True)))

    def analyze(spark, run, manifest):
        cfg = run.settings.analyze
        rows = plain(results(spark, manifest, "normalize", part(run, "normalize", "texts")))
        kept = rows.select("video_id", "title", "normalized_text", F.col("tokens_ratio").alias("normalize_token_ratio"), F.col("chars_ratio").alias("normalize_length_ratio"), F.col("char_similarity").alias("normalize_similarity"))
        ratios = {c: F.col(c).cast("string") for c in kept.columns if c.startswith("normalize_")}
        todo = misses(manifest, "analyze", keyed(kept, cfg, text=F.col("normalized_text"), title=F.col("title"), **ratios))
        signed = dedup.signatures(todo, "video_id", "normalized_text", cfg.minhash_num_perm, keep=tuple(c for c in todo.columns if c != "video_id"))
        add(text.with_profile(signed, "normalized_text"), part(run, "analyze", "profiles"))
        manifest.mark("analyze", outcome(todo, nothing()))

    def filter_(spark, run, manifest):
        # near-duplicates depend on all texts, so every decision is made anew
        cfg = run.settings.filter
        rows = plain(results(spark, manifest, "analyze", part(run, "analyze", "profiles"))).drop("normalized_text")
        for c in ("word_count", "token_count", "quality_score", "normalize_token_ratio", "normalize_length_ratio", "normalize_similarity"):
            rows = rows.withColumn(c, rules.required(c, "profile"))
        judged = cut(rules.decide(rows, [*rules.quality_rules(cfg), rules.missing_minhash(F.col("signature"))]).drop("status"))
        near = dedup.near_duplicates(judged.where("reason is null").select("video_id", "signature"), "video_id", run.settings.analyze.minhash_num_perm, cfg.dedup_threshold)
        reason = F.coalesce("reason", F.concat(F.lit("dedup:"), "duplicate_of"))
        made = judged.drop("signature").join(near, "video_id", "left").withColumn("reason", reason)
        made = made.withColumn("status", F.when(F.col("reason").isNull(), "kept").otherwise("dropped"))
        writers.write_decisions(made, run.stage_folder("filter"))
        written = keyed(spark.read.parquet(part(run, "filter", "decisions")), cfg, outcome=F.col("status"))
        manifest.mark("filter", outcome(written, F.col("reason"), True))

    def generate_(spark, run, manifest):
        kept = spark.read.parquet(part(run, "filter", "kept")).select("video_id")
        chunks = plain(results(spark, manifest, "normalize", part(run, "normalize", "chunks"))).join(kept, "video_id", "left_semi")
        listed = F.to_json(F.array_sort(F.collect_list(F.struct("chunk_index", "normalized_excerpt_sha256", "raw_excerpt_sha256", "title"))))
        items = chunks.groupBy("video_id").agg(listed.alias("chunks"))
        todo = misses(manifest, "generate", keyed(items, [run.settings.edit, run.settings.talk, s.talk_prompt, s.talk_system, s.edit_prompt, s.edit_system], chunks=F.col("chunks")).drop("chunks"))
        asked = cut(chunks.join(todo, "video_id"))
        edit = asked if run.settings.edit.use_normalized_input else asked.withColumn("normalized_excerpt", F.col("text"))
        edits = generate.run_edits(edit, run.settings.edit, needed(s, "edit"), prompt=s.edit_prompt, system=s.edit_system).withColumn("generator", F.lit("editorial_rewrite"))
        talks = generate.run_talks(asked, run.settings.talk, needed(s, "talk"), s.talk_prompt, s.talk_system).withColumn("generator", F.lit("talk_as_creator"))
        user = F.struct(F.lit("user").alias("role"), F.concat_ws("\n\n", "instruction", "input_text").alias("content"))
        edits = edits.withColumn("messages", F.array(user, F.struct(F.lit("assistant").alias("role"), F.col("output_text").alias("content"))))
        names = ("item_id", "input_hash", "generator", "video_id", "chunk_index", "edit_brief", "instruction", "input_text", "output_text", "messages", "metadata", "status", "reason")
        shape = lambda d, name: d.withColumn("metadata", generate.metadata(name, VERSION, name, d.columns)).select(*[F.col(c) if c in d.columns or c == "metadata" else nothing().alias(c) for c in names])
        made = cut(shape(edits, "editorial_rewrite").unionByName(shape(talks, "talk_as_creator")))
        add(made, part(run, "generate", "examples"))
        good = made.where("status = 'accepted'").select("video_id").distinct().withColumn("good", F.lit(True))
        # without an example a video is skipped; where every answer was lost it has failed
        lost = made.groupBy("video_id").agg(F.bool_and(F.coalesce(F.col("reason") == "llm_or_parse_error", F.lit(False))).alias("lost"))
        ended = cut(todo.join(good, "video_id", "left").join(lost, "video_id", "left"))
        why = F.when(F.col("good").isNull(), F.when(F.col("lost"), "llm_or_parse_error").otherwise("no_valid_examples"))
        status = F.when(why.isNull(), "success").when(F.col("lost"), "failed").otherwise("skipped")
        manifest.mark("generate", ended.select("item_id", status.alias("status"), "input_hash", why.alias("reason")))
        for name in ("editorial_rewrite", "talk_as_creator"):
            rows = examples(spark, run, manifest).where(F.col("generator") == name)
            writers.write_json_lines(rows, part(run, "generate", f"dataset/{name}"))

    def examples(spark, run, manifest):
        """Accepted examples of the videos that are kept now."""
        kept = spark.read.parquet(part(run, "filter", "kept")).select("video_id")
        return plain(results(spark, manifest, "generate", part(run, "generate", "examples"))).where("status = 'accepted'").join(kept, "video_id", "left_semi")

    def once(spark, manifest, stage, key, call):
        item = spark.createDataFrame([(stage, key)], "item_id string, input_hash string")
        if not manifest.misses(stage, item).isEmpty():
            call()
            manifest.mark(stage, outcome(item, nothing()))

    def fingerprint(rows, *settings):
        r = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)")).alias("h")).first()
        return hashing.plain_hash([VERSION, *settings, r.n, r.h])

    def held_out(run, rows):
        return tables.held_out_groups(rows, "video_id", run.settings.train.eval_split_ratio, run.settings.train.seed)

    def train(spark, run, manifest):
        rows = cut(examples(spark, run, manifest))
        if rows.isEmpty():
            raise RuntimeError("no examples to train on")
        folders = [part(run, "train", n) for n in ("train", "eval", "model")]

        def call():
            told = rows.select("video_id", "chunk_index", "generator", generate.training_text(F.col("messages")).alias("text"))
            out = cut(held_out(run, rows))
            writers.write_json_lines(tables.membership(told, out, "video_id", False), folders[0])
            writers.write_json_lines(tables.membership(told, out, "video_id", True), folders[1])
            needed(s, "train")(*folders)

        once(spark, manifest, "train", fingerprint(rows, run.settings.train), call)

    def evaluate(spark, run, manifest):
        rows, cfg = cut(examples(spark, run, manifest)), run.settings.evaluate
        folders = [part(run, "evaluate", "prompts"), part(run, "train", "model"), part(run, "evaluate", "results")]

        def call():
            order = ("video_id", "chunk_index", "generator", "edit_brief")
            named = rows.withColumn("edit_brief", F.coalesce("edit_brief", F.lit("")))  # a null would fall out of the order's key
            prompts = generate.evaluation_prompts(named, held_out(run, rows), "video_id", cfg.num_generation_samples, run.settings.train.seed, *order)
            writers.write_json_lines(prompts, folders[0])
            needed(s, "evaluate")(*folders)

        once(spark, manifest, "evaluate", fingerprint(rows, cfg, run.settings.train), call)

    return dict(download=download, transcribe=transcribe, normalize=normalize, analyze=analyze, filter=filter_, generate=generate_, train=train, evaluate=evaluate)
