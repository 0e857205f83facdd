import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from glosswright import external
from glosswright.operators import generate, rules, tables
from glosswright.plans.config import Edit, Settings
from glosswright.plans.pipeline import Manifest, Run, run_stages
from glosswright.sources import readers, writers
from glosswright.streaming.incremental import profile_stream


def test_held_out_groups(spark):
    for n, share, want in ((1, 0.5, 0), (2, 0.01, 1), (100, 0.1, 10), (100, 0.0, 0), (3, 0.99, 2), (5000, 0.37, 1850)):
        rows = spark.range(n).select(F.concat(F.lit("v"), "id").alias("k")).unionByName(spark.range(n).select(F.concat(F.lit("v"), "id").alias("k")))
        got = [r.k for r in tables.held_out_groups(rows, "k", share, 7).collect()]
        assert len(got) == len(set(got)) == want, (n, share)


def test_latest_unique_and_lookups(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), (" ", 4, "w"), (None, 5, "w")], "k string, pos int, v string")
    assert {(r.k, r.v) for r in tables.latest(rows, "k", F.col("pos")).collect()} == {("a", "z"), ("b", "y")}
    assert [(r.k, r.v, r.first_position) for r in tables.unique_sources(rows, "k", "pos").orderBy("first_position").collect()] == [("a", "z", 1), ("b", "y", 2)]
    with pytest.raises(Exception, match="no download row for"):
        tables.assemble(rows.select(F.col("k").alias("video_id")).where("k = 'a'"), {"download": rows.select(F.col("k").alias("video_id"), "v").where("k = 'b'")}, strict=True).collect()


def test_rotation_sample_status(spark):
    assert spark.range(3).select(tables.rotated(["a", "b", "c"], F.col("id"), 4).alias("r")).collect()[2].r == ["c", "a", "b", "c"]
    rows = spark.range(100).select(F.col("id").alias("k"))
    assert tables.sample(rows, 5, 1, "k").collect() == tables.sample(rows.repartition(7), 5, 1, "k").collect()
    u = spark.createDataFrame([("r1", "a", "completed"), ("r1", "b", "completed"), ("r2", "a", "completed"), ("r3", "a", "failed"), ("r3", "b", "completed")], "run_id string, stage string, status string")
    assert {r.run_id: r.status for r in tables.run_status(u, ["a", "b"]).collect()} == {"r1": "completed", "r2": "running", "r3": "failed"}


def test_json_lines_round_trip(spark, tmp_path):
    lines = ['{"id": "a", "n": 1}', "", "{bad", "[1]", '{"id": "b", "n": "no number"}', '  {"n": 3}  ', '"text"']
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    got = [(r.id, r.n) for r in readers.read_json_lines(spark, str(tmp_path / "x.jsonl"), "id string, n bigint").collect()]
    assert got == [("a", 1), ("b", None), (None, 3)]
    assert readers.read_json_lines(spark, str(tmp_path / "none"), "id string").count() == 0
    writers.write_json_lines(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == {"a": 1, "b": None}
    writers.write_json(tmp_path / "m" / "x.json", {"b": 1, "a": "é"})
    assert readers.read_json(tmp_path / "m" / "x.json", None) == {"a": "é", "b": 1} and readers.read_json(tmp_path / "q", 5) == 5


def test_transcript_choice(spark):
    rows = [("a", 0, True, "en"), ("a", 1, False, "fr"), ("a", 2, False, "en"), ("b", 0, True, "en"), ("c", 0, False, "de"), ("c", 1, True, "en"), ("d", 0, True, "fr")]
    df = spark.createDataFrame(rows, "video_id string, position int, is_generated boolean, language string")
    pick = lambda **k: {r.video_id: (r.position, r.filtered) for r in readers.choose_transcript(df, ["en"], **k).collect()}
    assert pick(manual_only=True, allow_auto=False) == {"a": (2, False), "c": (0, True)}
    assert pick(manual_only=False, allow_auto=True) == {"a": (2, False), "b": (0, False), "c": (1, False), "d": (0, True)}


def test_transcript_reader(spark):
    docs = ['{"segments": [{"start": "1.5", "end": "x", "text": " hi "}, {"text": " "}]}', '{"segments": [], "text": "one\\n\\ntwo"}', "{}"]
    df = spark.createDataFrame([(d,) for d in docs], "c string")
    got = [[tuple(s) for s in r.s] for r in df.select(readers.transcript_segments(F.col("c")).alias("s")).collect()]
    assert got == [[(1.5, None, "hi")], [(None, None, "one"), (None, None, "two")], []]


def test_model_calls_retry_and_report(spark):
    df = spark.createDataFrame([("fine",), ("fail",), (None,)], "p string").withColumn("s", F.lit("sys"))

    def build():
        calls = {}

        def ask(system, user):
            calls[user] = calls.get(user, 0) + 1
            if user == "fail" or (user == "fine" and calls[user] < 2):
                raise ValueError("no")
            return [{"text": user}, "!"]

        return ask

    got = {r.p: (r.answer, r.error) for r in external.complete(df, "s", "p", build, retries=2, wait=0.0).collect()}
    assert got == {"fine": ("fine!", None), "fail": (None, "ValueError"), None: ("!", None)}


def test_edits_run_end_to_end(spark):
    long = " ".join(f"word{i}" for i in range(130))
    chunks = spark.createDataFrame([("v", 0, long), ("v", 1, "short"), ("v", 2, None)], "video_id string, chunk_index bigint, normalized_excerpt string")
    got = generate.run_edits(chunks, Edit()).collect()
    assert [(r.chunk_index, r.edit_brief, r.reason) for r in got] == [(0, "cleanup_filler", "cleanup_similarity_too_high")]
    assert {r.chunk_index for r in generate.too_short(chunks, 120).collect()} == {1, 2}
    broken = generate.run_edits(chunks, Edit(), lambda: lambda s, u: "no marks").collect()
    assert [r.reason for r in broken] == ["llm_or_parse_error"]


def test_stages_and_manifest(spark, tmp_path):
    manifest, run = Manifest(spark, str(tmp_path / "manifest")), Run.create(tmp_path / "runs", Settings.from_dict({"train": {"enabled": False}}))
    items = spark.createDataFrame([("a", "h1"), ("b", "h2")], "item_id string, input_hash string")
    seen = []

    def stage(sp, r, m):
        todo = m.misses("filter", items)
        seen.append(sorted(x.item_id for x in todo.collect()))
        m.mark("filter", todo.select("item_id", F.when(F.col("item_id") == "b", "failed").otherwise("success").alias("status"), "input_hash", F.lit(None).cast("string").alias("reason")))

    with pytest.raises(RuntimeError, match="1 of 2 items failed"):
        run_stages(spark, run, manifest, {"filter": stage}, ("train", "filter"))
    assert run.status == {"train": "completed", "filter": "failed"} and run.overall() == "failed"
    with pytest.raises(RuntimeError):
        run_stages(spark, run, manifest, {"filter": stage}, ("filter",))
    assert seen == [["a", "b"], ["b"]]  # what succeeded is not done again
    assert json.loads((tmp_path / "runs" / run.run_id / "run.json").read_text())["status"] == "failed"


def test_circuit(spark):
    r = spark.createDataFrame([(0, 0), (10, 2), (10, 3)], "total bigint, failed bigint")
    assert [x.broken for x in rules.breaks_circuit(r, 0.2).collect()] == [False, False, True]


def test_stream_profiles_each_content_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    manifest = Manifest(spark, str(tmp_path / "manifest"))
    for rows in ([(1, "One text here."), (2, None)], [(1, "One text here."), (3, "Another text.")]):
        spark.createDataFrame(rows, "doc_id bigint, text string").write.mode("append").parquet(src)
        profile_stream(spark, src, "doc_id bigint, text string", out, manifest, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r.item_id for r in spark.read.parquet(out).collect()) == ["1", "3"]


def test_checkpoint_folder_is_the_sessions(spark):
    from glosswright.runtime import cut

    assert cut(spark.range(5)).count() == 5 and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    assert isinstance(dt.datetime.now(), dt.datetime)


def test_runs_are_found_and_resumed(tmp_path, capsys):
    from glosswright.__main__ import main

    settings = Settings()
    assert Run.find(tmp_path) is None and main(["status", str(tmp_path)]) == 1
    first = Run.create(tmp_path, settings)
    first.status["download"] = "failed"
    first.save()
    assert Run.resolve(tmp_path, settings).run_id == first.run_id and Run.resolve(tmp_path, settings).status == {"download": "failed"}
    other = Run.resolve(tmp_path, Settings.from_dict({"filter": {"min_words": 5}}))
    assert other.run_id != first.run_id and Run.resolve(tmp_path, settings, other.run_id).run_id == other.run_id
    assert main(["status", str(tmp_path)]) == 0 and main(["list"]) == 0 and "op_o8_held_out" in capsys.readouterr().out


def test_recognition_catalog_and_evaluation(spark, tmp_path):
    def load():
        def recognise(path):
            if path == "bad":
                raise OSError("no")
            return "en", [(0.0, 1.0, " hi "), (1.0, 2.0, " ")]

        return recognise

    media = spark.createDataFrame([("a", "good"), ("b", "bad"), ("c", None)], "video_id string, media_path string")
    got = {r.video_id: (r.language, r.segments and [tuple(s) for s in r.segments], r.error) for r in external.transcribe(media, "media_path", load).collect()}
    assert got == {"a": ("en", [(0.0, 1.0, "hi")], None), "b": (None, None, "OSError"), "c": (None, None, "no media")}
    (tmp_path / "c.jsonl").write_text('{"id": "x", "title": "t", "duration": 3}\n{"id": " "}\nbad')
    assert [(r.id, r.duration) for r in readers.read_catalog(spark, str(tmp_path / "c.jsonl")).collect()] == [("x", 3.0)]
    rows = spark.createDataFrame([(i, f"v{i % 3}", [("user", "q"), ("assistant", f"a{i}")]) for i in range(9)], "entry_id int, video_id string, messages array<struct<role:string,content:string>>")
    held = spark.createDataFrame([("v1",)], "video_id string")
    p = generate.evaluation_prompts(rows, held, "video_id", 2, 1, "entry_id").collect()
    assert len(p) == 2 and all(r.video_id == "v1" and r.expected == f"a{r.entry_id}" and [m.role for m in r.prompt] == ["user"] for r in p)
    assert rows.where("entry_id = 0").select(generate.training_text(F.col("messages"))).first()[0] == "[user] q\n[assistant] a0</s>"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(f"v{i:03}", "kept" if i % 3 else "dropped", i) for i in range(90)], "video_id string, status string, n int").repartition(5)
    writers.write_sorted(rows, str(tmp_path / "sorted"), "video_id")
    assert [r.video_id for r in spark.read.parquet(str(tmp_path / "sorted")).orderBy("video_id").collect()] == [f"v{i:03}" for i in range(90)]
    writers.write_decisions(rows, str(tmp_path / "d"))
    assert [spark.read.parquet(str(tmp_path / "d" / k)).count() for k in ("decisions", "kept", "dropped")] == [90, 60, 30]
    writers.write_json_lines(rows, str(tmp_path / "lines"), partition_by=["status"])
    writers.write_json_lines(rows, str(tmp_path / "lines"), append=True, partition_by=["status"])
    assert spark.read.json(str(tmp_path / "lines")).count() == 180
    for name, size in (("a.wav", 5), ("a.mp4", 9), ("b.wav", 0)):
        (tmp_path / "media" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "media" / name).write_bytes(b"x" * size)
    media = readers.largest_media(spark, str(tmp_path / "media"))
    assert [(r.video_id, r.media_path.rsplit("/", 1)[1], r.media_size_bytes) for r in media.collect()] == [("a", "a.mp4", 9)]
    have = spark.createDataFrame([("a", None), ("c", "mine")], "video_id string, media_path string")
    assert {r.video_id: r.media_path and r.media_path.rsplit("/", 1)[-1] for r in readers.with_media(have, media).collect()} == {"a": "a.mp4", "c": "mine"}


def test_metric_rows_and_addresses(spark):
    rows = spark.createDataFrame([("a", "t", "ready", (1,), None), ("b", "t", "skipped", None, "short_excluded"), ("c", "t", "ready", None, None)], "video_id string, title string, status string, metrics struct<n:int>, skip_reason string")
    assert [r.metrics for r in writers.metric_rows(rows).orderBy("video_id").collect()] == ['{"n":1}', '{"skip_reason":"short_excluded"}', None]
    lines = spark.createDataFrame([(" u1 ",), ("# no",), ("",), ("u2",)], "value string")
    assert [r.url for r in readers.address_lines(lines).collect()] == ["u1", "u2"]
