"""Generated examples around a model: prompts, parsing, gates and entries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswright.external import complete
from glosswright.functions import hashing, parsing, text
from glosswright.operators import rules, sequences, tables
from glosswright.plans.config import BRIEFS, Edit, Talk
from glosswright.runtime import cut

Similarity = Callable[[Column, Column], Column]


def edit_requests(chunks: DataFrame, cfg: Edit, source: str = "normalized_excerpt") -> DataFrame:
    """One row per chunk and brief of chunks that are long enough, with its instruction."""
    long_enough = text.approx_token_count(F.col(source)) >= cfg.min_source_tokens
    briefs = F.explode(tables.rotated(cfg.briefs, F.col("chunk_index"), cfg.examples_per_chunk)).alias("edit_brief")
    out = chunks.where(long_enough).select("*", briefs)
    return out.withColumn("instruction", tables.lookup(F.col("edit_brief"), BRIEFS)).withColumn("input_text", F.col(source))


def too_short(chunks: DataFrame, min_source_tokens: int, source: str = "normalized_excerpt") -> DataFrame:
    """P10."""
    return chunks.where(F.coalesce(text.approx_token_count(F.col(source)) < min_source_tokens, F.lit(True))).withColumn("reason", F.lit("source_too_short"))


def edit_metrics(rows: DataFrame, similarity: Similarity = text.sequence_similarity) -> DataFrame:
    """Adds similarity, length ratio, counts and new entities of output_text against input_text."""
    a, b = text.approx_token_count(F.col("input_text")), text.approx_token_count(F.col("output_text"))
    return rows.select(
        "*", similarity(F.col("output_text"), F.col("input_text")).alias("copy_similarity_to_input"), text.ratio(b, a).alias("output_to_input_token_ratio"),
        text.new_entities(F.col("input_text"), F.col("output_text")).alias("new_named_entities"), a.alias("input_token_count"), b.alias("output_token_count"),
    )


def edit_decisions(candidates: DataFrame, cfg: Edit) -> DataFrame:
    """E5: accepted or rejected with a reason; candidates without metrics or metadata get no decision."""
    fit = candidates.where(F.col("copy_similarity_to_input").isNotNull() & F.col("output_to_input_token_ratio").isNotNull() & F.col("edit_brief").isNotNull())
    gates = rules.edit_rules(cfg, F.col("edit_brief"), F.col("copy_similarity_to_input"), F.col("output_to_input_token_ratio"), F.col("new_named_entities"))
    return rules.decide(fit, gates, "accepted", "rejected")


def unfit(candidates: DataFrame) -> DataFrame:
    """Candidates that get no decision, with what they lack."""
    missing = F.when(F.col("copy_similarity_to_input").isNull() | F.col("output_to_input_token_ratio").isNull(), "missing_quality_metrics").when(F.col("edit_brief").isNull(), "missing_metadata")
    return candidates.withColumn("reason", missing).where("reason is not null")


def run_edits(chunks: DataFrame, cfg: Edit, model=None, similarity: Similarity = text.sequence_similarity, prompt: str = "{input_text}", system: str = "{instruction}") -> DataFrame:
    """E4 and E5 in one: requests, answers, parsing and gates. A failed answer drops its example only."""
    asked = edit_requests(chunks, cfg)
    values = {c: F.col(c) for c in ("instruction", "input_text", "edit_brief", "title", "video_id", "chunk_index") if c in asked.columns}
    asked = asked.withColumn("system", parsing.fill(system, **values)).withColumn("prompt", parsing.fill(prompt, **values))
    answered = complete(asked, "system", "prompt", model).drop("system", "prompt").withColumn("parsed", parsing.between(F.col("answer"), *parsing.MARKS["edit"]))
    measured = edit_metrics(answered.withColumn("output_text", F.col("parsed.value")), similarity)
    fail = F.when(F.col("error").isNotNull() | F.col("parsed.error").isNotNull(), "llm_or_parse_error")
    judged = edit_decisions(measured.where(fail.isNull()), cfg)
    lost = measured.where(fail.isNotNull()).withColumn("reason", fail).withColumn("status", F.lit("rejected"))
    return judged.unionByName(lost.select(*judged.columns))


def error_reasons(error: Column) -> Column:
    """A5: a model's failure counts under the general reason and under its own."""
    return F.array(F.lit("llm_or_parse_error"), F.concat(F.lit("llm_or_parse_error::"), error))


def must_ask(cfg: Talk, video_id: Column, chunk_index: Column) -> Column:
    """H3: whether a chunk's chat has to ask a clarifying question."""
    return hashing.chosen(cfg.clarifying_question_probability, chunk_index=chunk_index, salt=F.lit("clarify"), video_id=video_id)


def talk_decisions(chats: DataFrame, cfg: Talk, similarity: Similarity = text.sequence_similarity) -> DataFrame:
    """Chats (video_id, chunk_index, source_text, messages) judged against their source."""
    answer = sequences.assistant_text(F.col("messages"))
    m = chats.withColumn("assistant_text", answer)
    m = m.withColumn("copy_similarity_to_source", similarity(F.col("assistant_text"), F.col("source_text"))).withColumn("novel_token_ratio", text.novel_ratio(F.col("assistant_text"), F.col("source_text")))
    asks = F.exists("messages", lambda x: (x["role"] == "assistant") & F.contains(x["content"], F.lit("?")))
    m = m.withColumn("requires_clarifying_question", must_ask(cfg, F.col("video_id"), F.col("chunk_index")))
    gates = rules.talk_rules(cfg, F.col("copy_similarity_to_source"), F.col("novel_token_ratio"), asks, F.col("requires_clarifying_question"))
    return rules.decide(m, gates, "accepted", "rejected")


def run_talks(chunks: DataFrame, cfg: Talk, model=None, prompt: str = "{source_excerpt}", system: str = "", source: str = "normalized_excerpt", similarity: Similarity = text.sequence_similarity) -> DataFrame:
    """E3 in one: prompts, answers, parsing and gates for chunks that are long enough."""
    text_of = F.col(source)
    asked = chunks.where(text.approx_token_count(text_of) >= cfg.min_source_tokens).withColumn("source_text", text_of)
    clarify = F.when(must_ask(cfg, F.col("video_id"), F.col("chunk_index")), "yes").otherwise("no")
    values = {"title": F.col("title"), "video_id": F.col("video_id"), "chunk_index": F.col("chunk_index"), "source_excerpt": text_of, "topic_hint": text.topic_hint(text_of), "turn_pairs": F.lit(cfg.turn_pairs)}
    values |= {"target_tokens_per_assistant_turn": F.lit(cfg.target_tokens_per_assistant_turn), "requires_clarifying_question": clarify}
    asked = asked.withColumn("system", parsing.fill(system, **values)).withColumn("prompt", parsing.fill(prompt, **values))
    answered = cut(complete(asked, "system", "prompt", model)).withColumn("block", parsing.between(F.col("answer"), *parsing.MARKS["talk"]))
    parsed = answered.withColumn("chat", parsing.chat_messages(F.col("block.value"), cfg.turn_pairs)).withColumn("messages", F.col("chat.messages"))
    good = F.col("error").isNull() & F.col("messages").isNotNull()
    judged = talk_decisions(parsed.where(good), cfg, similarity)
    lost = parsed.where(~good).withColumn("reason", F.lit("llm_or_parse_error")).withColumn("status", F.lit("rejected"))
    return judged.unionByName(lost, allowMissingColumns=True)


def metadata(generator: str, version: str, template: str, columns: Sequence[str]) -> Column:
    """The sixteen fields of an entry's metadata; those that *columns* does not hold are null. The source is the normalized excerpt."""
    given = lambda n, kind="string": F.col(n) if n in columns else F.lit(None).cast(kind)
    fixed = [F.lit(generator).alias("generator_name"), F.lit(version).alias("generator_version"), F.lit(template).alias("prompt_template_id")]
    place = [given(n, k).alias(n) for n, k in (("video_id", "string"), ("title", "string"), ("chunk_index", "bigint"), ("segment_start_idx", "bigint"), ("segment_end_idx", "bigint"), ("start_time", "double"), ("end_time", "double"))]
    source = [given(f"normalized_excerpt_{n}").alias(f"source_excerpt_{n}") for n in ("path", "sha256")]
    return F.struct(*fixed, *place, *source, *[given(f"{side}_excerpt_{n}").alias(f"{side}_excerpt_{n}") for side in ("raw", "normalized") for n in ("path", "sha256")])


def normalize_chunks(chunks: DataFrame, model=None, prompt: str = "{text}") -> DataFrame:
    """Cleaned chunks; one failed chunk fails its whole item (``ok`` is per item)."""
    asked = chunks.withColumn("system", F.lit("")).withColumn("prompt", parsing.fill(prompt, text=F.col("text"), title=F.col("title" if "title" in chunks.columns else "video_id"), video_id=F.col("video_id"), chunk_index=F.col("chunk_index")))
    answered = cut(complete(asked, "system", "prompt", model))  # read twice below
    parsed = answered.withColumn("parsed", parsing.between(F.col("answer"), *parsing.MARKS["normalize"]))
    good = F.col("error").isNull() & F.col("parsed.error").isNull() & parsing.banned_phrase(F.col("parsed.value")).isNull()
    rows = parsed.withColumn("good", good).withColumn("normalized_excerpt", F.col("parsed.value"))
    ok = rows.groupBy("video_id").agg(F.bool_and("good").alias("ok"))
    return rows.join(ok, "video_id").select("video_id", "chunk_index", "normalized_excerpt", "ok")


def training_text(messages: Column, end: str = "</s>") -> Column:
    """A chat as one training string: roles in brackets, the end mark after each answer."""
    turn = lambda m: F.concat(F.lit("["), m["role"], F.lit("] "), m["content"], F.when(m["role"] == "assistant", F.lit(end)).otherwise(F.lit("")))
    return F.array_join(F.transform(messages, turn), "\n")


def evaluation_prompts(rows: DataFrame, held_out: DataFrame, key: str, n: int, seed: int, *order: str) -> DataFrame:
    """N rows of held-out groups with the prompt (all turns but the assistant's) and the expected last answer."""
    chosen = tables.sample(tables.membership(rows, held_out, key, True), n, seed, *order)
    prompt = F.filter("messages", lambda m: m["role"] != "assistant")
    return chosen.select(*order, key, prompt.alias("prompt"), sequences.expected_answer(F.col("messages")).alias("expected")) if key not in order else chosen.select(*order, prompt.alias("prompt"), sequences.expected_answer(F.col("messages")).alias("expected"))
