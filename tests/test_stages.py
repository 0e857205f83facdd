import json
import random

import pytest
from pyspark.sql import functions as F

from glosswright.__main__ import main
from glosswright.plans.config import Settings
from glosswright.plans.pipeline import Manifest, Run, run_stages
from glosswright.plans.stages import Services

MARKED = {"normalize": "NORMALIZED_TRANSCRIPT", "edit": "EDIT_OUTPUT", "talk": "TALK_CHAT"}


def normalizer(system, user):
    if "broken" in user:
        return "no marks"
    return f"<<<NORMALIZED_TRANSCRIPT_START>>>\n{user.replace('um ', '')}\n<<<NORMALIZED_TRANSCRIPT_END>>>"


def editor(system, user):
    assert system  # the instruction of the brief
    return f"<<<EDIT_OUTPUT_START>>>\n{' '.join(user.split()[: 60 * len(user.split()) // 100])}\n<<<EDIT_OUTPUT_END>>>"


def talker(system, user):
    turns = [{"role": "user" if i % 2 == 0 else "assistant", "content": f"Would you like entirely unrelated matter {i}?"} for i in range(6)]
    return f"<<<TALK_CHAT_START>>>\n{json.dumps({'messages': turns})}\n<<<TALK_CHAT_END>>>"


TRAINED = []
SERVICES = Services(normalize=lambda: normalizer, edit=lambda: editor, talk=lambda: talker, train=lambda *f: TRAINED.append(("train", *f)), evaluate=lambda *f: TRAINED.append(("evaluate", *f)))


def words(seed, n=160):
    rng = random.Random(seed)
    names = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(2)) for _ in range(n)]
    return " ".join(f"the {w} and" + " um" * (i == 0) if i % 4 == 0 else w + ("." if i % 9 == 8 else "") for i, w in enumerate(names))


def test_pipeline_end_to_end(spark, tmp_path):
    texts = {"a": words(1), "b": words(2), "copy": words(1), "few": "too short", "bad": words(3) + " broken", "empty": "", "short": words(4)}
    (tmp_path / "t").mkdir()
    for v, t in texts.items():
        (tmp_path / "t" / f"{v}.json").write_text(json.dumps({"language": "en", "segments": [{"start": 0, "end": 1, "text": t}]}))
    catalog = [{"id": v, "title": v, "webpage_url": "https://x/shorts/1" if v == "short" else f"https://x/{v}", "duration": 100.0} for v in texts]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, catalog)))
    (tmp_path / "s.json").write_text(json.dumps({"edit": {"briefs": ["tighten_60_percent"]}, "train": {"eval_split_ratio": 0.5}}))
    TRAINED.clear()
    args = ["run", str(tmp_path / "runs"), "--settings", str(tmp_path / "s.json"), "--catalog", str(tmp_path / "c.jsonl"), "--transcripts", str(tmp_path / "t"), "--services", f"{__name__}:SERVICES"]
    assert main(args) == 0
    record = Run.find(tmp_path / "runs")
    assert record["status"] == "completed" and [x[0] for x in TRAINED] == ["train", "evaluate"]
    home = tmp_path / "runs" / record["run_id"]
    manifest = Manifest(spark, str(home / "manifest"))
    ended = {n: {r.item_id: (r.status, r.reason) for r in manifest.stage(n).collect()} for n in ("download", "transcribe", "normalize", "analyze", "filter", "generate")}
    assert ended["download"]["short"] == ("skipped", "short_excluded") and ended["normalize"]["bad"] == ("failed", "llm_or_parse_error")
    assert ended["normalize"]["empty"] == ("skipped", "empty_transcript") and set(ended["analyze"]) == {"a", "b", "copy", "few"}
    assert ended["filter"] == {"a": ("success", None), "b": ("success", None), "copy": ("skipped", "dedup:a"), "few": ("skipped", "language")}
    assert ended["generate"] == {"a": ("success", None), "b": ("success", None)}
    stages = home / "stages"
    clean = {r.video_id: r for r in spark.read.parquet(str(stages / "normalize" / "texts")).collect()}
    assert " um " in texts["a"] and " um " not in clean["a"].normalized_text and 0.65 < clean["a"].char_similarity < 1
    assert {r.video_id for r in spark.read.parquet(str(stages / "filter" / "kept")).collect()} == {"a", "b"}
    made = spark.read.parquet(str(stages / "generate" / "examples"))
    assert {(r.video_id, r.generator, r.status) for r in made.collect()} == {(v, g, "accepted") for v in "ab" for g in ("editorial_rewrite", "talk_as_creator")}
    sides = [{r.video_id for r in spark.read.json(str(stages / "train" / n)).collect()} for n in ("train", "eval")]
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]
    prompts = spark.read.json(str(stages / "evaluate" / "prompts")).collect()
    assert {r.video_id for r in prompts} == sides[1] and all(r.expected for r in prompts)
    # again: only what failed is asked, nothing is trained twice
    assert main([*args, "--run-id", record["run_id"]]) == 0
    assert len(TRAINED) == 2 and spark.read.parquet(str(stages / "generate" / "examples")).count() == made.count()
    assert manifest.rows().where("stage = 'normalize'").groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1").first().item_id == "bad"


def test_a_missing_service_is_named(spark, tmp_path):
    run = Run.create(tmp_path / "runs", Settings())
    with pytest.raises(RuntimeError, match="no function given for download"):
        run_stages(spark, run, Manifest(spark, str(tmp_path / "manifest")), {})
