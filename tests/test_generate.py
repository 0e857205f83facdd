import os
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from glosswright import catalog
from glosswright.operators import generate
from glosswright.plans.config import Edit, Talk

SF = "/root/testdata/sf0.001"
FORWARD = " ".join(f"word{i}" for i in range(60))
BACKWARD = " ".join(f"word{i}" for i in reversed(range(60)))


def test_gates_see_the_order_of_words(spark):
    ratio = SequenceMatcher(None, BACKWARD, FORWARD).ratio()
    assert ratio < 0.45  # the same set of words, so a word overlap of 1.0
    df = spark.createDataFrame([("cleanup_filler", FORWARD, BACKWARD)], "edit_brief string, input_text string, output_text string")
    got = generate.edit_decisions(generate.edit_metrics(df), Edit()).first()
    assert got.copy_similarity_to_input == ratio and got.reason == "cleanup_similarity_too_low"
    chats = spark.createDataFrame([("v", 0, FORWARD, [("user", "q"), ("assistant", BACKWARD)])], "video_id string, chunk_index bigint, source_text string, messages array<struct<role:string,content:string>>")
    got = generate.talk_decisions(chats, Talk(clarifying_question_probability=0.0)).first()
    assert got.copy_similarity_to_source == ratio and got.reason == "novel_token_ratio"
    chunks = spark.createDataFrame([("v", 0, " ".join([FORWARD] * 3))], "video_id string, chunk_index bigint, normalized_excerpt string")
    answer = f"<<<EDIT_OUTPUT_START>>>\n{BACKWARD}\n<<<EDIT_OUTPUT_END>>>"
    assert generate.run_edits(chunks, Edit(), lambda: lambda s, u: answer).first().reason == "cleanup_similarity_too_low"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_registered_gates_use_the_ratio(spark):
    def ratio(a, b):
        a, b = " ".join(a.split()), " ".join(b.split())
        return SequenceMatcher(None, a, b).ratio() if a and b else float(a == b)

    e = catalog.once(spark, SF, "entries", "entry_id").where("output_text is not null and input_text is not null")
    want = {r.entry_id: (r.edit_brief, ratio(r.output_text, r.input_text)) for r in e.select("entry_id", "edit_brief", "input_text", "output_text").collect()}
    talk = {r.entry_id: r.copy_similarity for r in catalog.queries()["op_p11_u2_talk_gates_sequence"](spark, SF).collect()}
    assert talk == {k: pytest.approx(s, abs=1e-6) for k, (_, s) in want.items()}
    edit = catalog.queries()["op_p12_u1_e5_edit_gates_sequence"](spark, SF).cache()
    assert {r.entry_id: r.similarity for r in edit.collect()} == {k: pytest.approx(s, abs=1e-6) for k, (b, s) in want.items() if b}
    summary = catalog.queries()["op_a3_a4_summary_sequence"](spark, SF)
    assert summary.agg(F.sum("entries")).first()[0] == edit.where("status = 'accepted'").count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")
def test_queries_reach_every_gate(spark):
    asked = catalog.queries()["op_p11_h3_talk_gates_asking"](spark, SF)
    assert asked.where("reason = 'missing_clarifying_question'").count() > 0
    cascade = catalog.queries()["op_p7_excerpt_cascade"](spark, SF)
    assert cascade.where("normalize_similarity is null").count() == 0 and cascade.where("outcome = 'normalize_similarity'").count() > 0


def _echo():
    return lambda system, user: f"<<<EDIT_OUTPUT_START>>>\n{system} / {user}\n<<<EDIT_OUTPUT_END>>>"


def test_instruction_and_prompts_reach_the_model(spark):
    from glosswright.plans.config import BRIEFS

    chunks = spark.createDataFrame([("v", k, " ".join([FORWARD] * 3)) for k in range(4)], "video_id string, chunk_index bigint, normalized_excerpt string")
    got = {r.edit_brief: r.output_text for r in generate.run_edits(chunks, Edit(), _echo).collect()}
    assert set(got) == set(BRIEFS) and all(t.startswith(f"{BRIEFS[b]} / {FORWARD}") for b, t in got.items())
    got = {r.edit_brief: r.output_text for r in generate.run_edits(chunks, Edit(), _echo, prompt="Do: {instruction}\n{input_text}", system="You edit {video_id}.").collect()}
    assert all(t.startswith(f"You edit v. / Do: {BRIEFS[b]}\n{FORWARD}") for b, t in got.items())


def test_templates_and_bounds_of_settings(tmp_path):
    import json

    from glosswright.plans.config import Evaluate, Filter, Normalize, PromptTemplate
    from glosswright.plans.stages import Services, with_templates

    path = tmp_path / "t.json"
    path.write_text(json.dumps({"name": "n", "system_prompt": "s", "user_prompt_template": "u {title}"}))
    services = with_templates(Services(), talk=PromptTemplate.load(path))
    assert (services.talk_system, services.talk_prompt, services.edit_prompt) == ("s", "u {title}", "{input_text}")
    path.write_text(json.dumps({"name": "n", "system_prompt": "s"}))
    with pytest.raises(ValueError):
        PromptTemplate.load(path)
    wrong = [lambda: Normalize(chunk_target_chars=199), lambda: Filter(min_words=-1), lambda: Filter(normalize_min_token_ratio=0.0), lambda: Filter(language_allowlist=()), lambda: Talk(target_tokens_per_assistant_turn=0), lambda: Edit(tighten_target_ratio=0), lambda: Evaluate(num_generation_samples=-1)]
    for make in wrong:
        with pytest.raises(ValueError):
            make()


def test_metadata_has_sixteen_fields(spark):
    df = spark.createDataFrame([("v", 1)], "video_id string, chunk_index bigint").withColumn("normalized_excerpt_path", F.lit("p"))
    m = df.select(generate.metadata("g", "1", "t", df.columns).alias("m")).first().m
    assert len(m) == 16 and m.source_excerpt_path == m.normalized_excerpt_path == "p" and m.raw_excerpt_sha256 is None
