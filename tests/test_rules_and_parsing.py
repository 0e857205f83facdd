import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from glosswright.functions import hashing, parsing
from glosswright.operators import generate, rules
from glosswright.plans.config import Edit, Filter, Settings, Talk

GOOD = dict(language="en", token_count=120, word_count=100, quality_score=0.2, normalize_token_ratio=0.7, normalize_length_ratio=1.35, normalize_similarity=0.65)


def cascade(spark, cfg, *changes):
    rows = [GOOD | c for c in changes]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "language string, token_count bigint, word_count bigint, quality_score double, normalize_token_ratio double, normalize_length_ratio double, normalize_similarity double")
    return [r.reason for r in rules.decide(df, rules.quality_rules(cfg)).collect()]


def test_cascade_reasons_in_order(spark):
    got = cascade(spark, Filter(), {}, {"language": "xx", "token_count": 1}, {"token_count": 119, "word_count": 1}, {"word_count": 99}, {"quality_score": 0.19}, {"normalize_token_ratio": 0.69}, {"normalize_token_ratio": 1.36}, {"normalize_length_ratio": 0.69}, {"normalize_length_ratio": 1.36}, {"normalize_similarity": 0.64})
    assert got == [None, "language", "min_tokens", "min_words", "quality", "normalize_token_ratio_low", "normalize_token_ratio_high", "normalize_length_ratio_low", "normalize_length_ratio_high", "normalize_similarity"]
    off = dataclasses.replace(Filter(), normalize_min_token_ratio=None, normalize_max_token_ratio=None, normalize_min_length_ratio=None, normalize_max_length_ratio=None, normalize_min_similarity=None)
    assert cascade(spark, off, {"normalize_token_ratio": 9.0}, {"normalize_length_ratio": 0.0}, {"normalize_similarity": 0.0}) == [None] * 3


def test_required_fails_on_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    with pytest.raises(Exception, match="x is missing"):
        df.select(rules.required("x", "profile")).collect()


def test_edit_gates_at_their_bounds(spark):
    cases = [
        ("cleanup_filler", 0.45, 1.0, 0, None), ("cleanup_filler", 0.44, 1.0, 0, "cleanup_similarity_too_low"), ("cleanup_filler", 0.996, 1.0, 0, "cleanup_similarity_too_high"),
        ("tighten_60_percent", 0.5, 0.84, 0, None), ("tighten_60_percent", 0.5, 0.86, 0, "tighten_ratio_out_of_range"), ("expand_with_examples", 0.5, 1.05, 10, None), ("expand_with_examples", 0.5, 1.04, 0, "expand_ratio_out_of_range"),
        ("expand_with_examples", 0.5, 2.0, 11, "expand_new_named_entities"), ("convert_to_script", 0.5, 0.6, 0, None), ("convert_to_script", 0.49, 1.0, 0, "script_similarity_too_low"), ("convert_to_script", 0.1, 1.7, 0, "script_ratio_out_of_range"), ("other", 0.0, 9.0, 99, None),
    ]
    df = spark.createDataFrame(cases, "edit_brief string, copy_similarity_to_input double, output_to_input_token_ratio double, new_named_entities int, want string")
    assert all(r.reason == r.want for r in generate.edit_decisions(df, Edit()).collect())
    lost = spark.createDataFrame([("cleanup_filler", None, 1.0, 0), (None, 0.5, 1.0, 0)], "edit_brief string, copy_similarity_to_input double, output_to_input_token_ratio double, new_named_entities int")
    assert generate.edit_decisions(lost, Edit()).count() == 0 and {r.reason for r in generate.unfit(lost).collect()} == {"missing_quality_metrics", "missing_metadata"}


def test_talk_gates(spark):
    chat = [("user", "q"), ("assistant", "Completely different content here?")]
    df = spark.createDataFrame([("v", 0, "some words of the source", chat), ("v", 1, "some words of the source", [("user", "q"), ("assistant", "some words of the source")]), ("v", 2, "some words", [("user", "q"), ("assistant", "other things entirely")])], "video_id string, chunk_index bigint, source_text string, messages array<struct<role:string,content:string>>")
    got = [r.reason for r in generate.talk_decisions(df, Talk(clarifying_question_probability=1.0)).orderBy("chunk_index").collect()]
    assert got == [None, "copy_similarity", "missing_clarifying_question"]


def test_routes(spark):
    df = spark.createDataFrame([("https://x/shorts/1", None, None, True), ("u", 60.0, "is_live", True), ("u", 61.0, "WAS_LIVE", True), ("u", 0.0, None, False), (None, None, None, True)], "url string, duration double, live_status string, media boolean")
    c = F.col
    got = [r[0] for r in df.select(rules.download_route(c("url"), c("duration"), F.lit(None).cast("boolean"), c("live_status"), c("media"), False, False)).collect()]
    assert got == ["short_excluded", "short_excluded", "live_excluded", "failed", "ready"]


def test_between_and_chat(spark):
    texts = ["x <<A>> body <<B>> <<A>>two<<B>>", "none", "<<A>> no end", "<<A>>  <<B>>", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r.b) for r in df.select(parsing.between(F.col("t"), "<<A>>", "<<B>>").alias("b")).collect()]
    assert got == [("body", None), (None, "missing_start"), (None, "missing_end"), (None, "empty"), (None, "missing_start")]
    m = lambda *x: json.dumps({"messages": [{"role": r, "content": c} for r, c in x]})
    cases = [(m(("user", "q"), ("assistant", " a ")), None), ("{", "bad_json"), ("[1]", "not_an_object"), ("{}", "missing_messages"), (m(("user", "q")), "wrong_count"), (m(("assistant", "q"), ("user", "a")), "wrong_role"), (m(("user", "q"), ("assistant", " ")), "blank_content")]
    df = spark.createDataFrame(cases, "p string, want string")
    for r in df.select("want", parsing.chat_messages(F.col("p"), 1).alias("c")).collect():
        assert r.c.error == r.want


def test_values_ids_and_prompts(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("2f",)], "v string")
    assert [r[0] for r in df.select(parsing.lenient_double(F.col("v"))).collect()] == [1.5, None, None, None]
    with pytest.raises(Exception, match="n is not an integer: x"):
        df.where("v = 'x'").select(parsing.strict_int(F.col("v"), "n")).collect()
    one = spark.range(1)
    assert one.select(parsing.fill("a {x} {{b}} {y}", x=F.lit(1), y=F.lit(None).cast("string"))).first()[0] == "a 1 {b} "
    assert one.select(parsing.video_id_of_url(F.lit("https://e.x/watch?v=abcdefghijk&t=1"))).first()[0] == "abcdefghijk"
    assert one.select(parsing.paragraphs(F.lit(" a \n\n\n b\n \nc "))).first()[0] == ["a", "b", "c"]


def test_hashes(spark):
    one = spark.range(1)
    import hashlib

    want = hashlib.sha256(b'{"a":null,"b":"x"}').hexdigest()
    assert one.select(hashing.record_hash(b=F.lit("x"), a=F.lit(None).cast("string"))).first()[0] == want == hashing.plain_hash({"b": "x", "a": None})
    assert one.select(hashing.chosen(0, k=F.lit(1))).first()[0] is False and one.select(hashing.chosen(1, k=F.lit(1))).first()[0] is True
    share = spark.range(4000).select(hashing.chosen(0.4, k=F.col("id")).cast("int").alias("c")).agg(F.avg("c")).first()[0]
    assert abs(share - 0.4) < 0.03


def test_settings_are_strict(tmp_path):
    for bad in ({"filter": {"dedup_threshold": 2}}, {"filter": {"oops": 1}}, {"oops": {}}, {"normalize": {"chunk_target_chars": 9, "chunk_hard_max_chars": 5}}, {"edit": {"briefs": ["x"]}}):
        with pytest.raises(ValueError):
            Settings.from_dict(bad)
    f = tmp_path / "s.json"
    f.write_text(json.dumps({"filter": {"min_words": 7}}))
    s = Settings.load(f)
    assert s.filter.min_words == 7 and s.fingerprint() != Settings().fingerprint() and s.fingerprint(f) != s.fingerprint()
    assert Settings().edit.generation_settings().keys().isdisjoint(Settings().edit.gate_settings())
