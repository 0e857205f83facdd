import random

from pyspark.sql import functions as F

from glosswright.operators import sequences


def walk(sizes, target, hard):
    """Plain restatement of the greedy rule without overlap."""
    out, chunk, chars, taken = [], 0, 0, 0
    for n in sizes:
        grown = chars + n + (1 if chars else 0)
        if n and taken and (chars >= target or grown > hard):
            chunk, chars, taken = chunk + 1, n, 0
        elif n:
            chars = grown
        taken += 1
        out.append(chunk)
    return out


def test_fold_equals_the_walk_and_the_plan(spark):
    rng = random.Random(1)
    cases = [["x" * rng.choice([0, 0, 1, 5, 9, 30]) for _ in range(rng.randint(0, 25))] for _ in range(60)] + [["y" * 100], ["a" * 10, "b" * 9], [" ", "", "c"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, t array<string>")
    for r in df.select("id", sequences.chunk_numbers(F.col("t"), 20, 30).alias("c")).collect():
        sizes = [len(t.strip()) for t in cases[r.id]]
        assert r.c == walk(sizes, 20, 30)
        spans = sequences.plan_chunks(sizes, 20, 30, 0)
        assert [k for k, (a, b) in enumerate(spans) for _ in range(a, b + 1)] == r.c


def test_overlap_makes_progress_and_loses_nothing(spark):
    rng = random.Random(2)
    for _ in range(100):
        sizes = [rng.randint(0, 15) for _ in range(rng.randint(1, 30))]
        spans = sequences.plan_chunks(sizes, 20, 30, rng.choice([0, 5, 12, 40]))
        assert spans[0][0] == 0 and spans[-1][1] == len(sizes) - 1
        assert all(c > a and c <= b + 1 for (a, b), (c, _) in zip(spans, spans[1:]))
    seg = [(0.0, 1.0, "aaa"), (None, None, " "), (2.0, None, "bbb"), (3.0, 4.0, "ccc")]
    df = spark.createDataFrame([(seg,), ([],), (None,)], "s array<struct<start:double,end:double,text:string>>")
    rows = [r.c for r in df.select(sequences.chunker(5, 7, 0)("s").alias("c")).collect()]
    assert [tuple(x) for x in rows[0]] == [(0, 0, 2, 0.0, 1.0, "aaa bbb"), (1, 3, 3, 3.0, 4.0, "ccc")] and rows[1] == rows[2] == []


def test_boundary_repeats(spark):
    w = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    cases = [("a\nb\nc", "b\nc\nd", "d"), ("a\nb", "b", ""), ("", " x ", "x"), ("x", "", ""), (w(0, 30), w(19, 40), w(30, 40)), (w(0, 30), w(20, 40), w(20, 40)), ("z " + w(0, 80), w(0, 80) + " q", "q"), (w(0, 90), w(5, 95), w(5, 95)), ("no", "match", "match")]
    df = spark.createDataFrame(cases, "p string, c string, want string")
    for r in df.select("*", sequences.trim_repeat(F.col("p"), F.col("c")).alias("got")).collect():
        assert r.got == r.want, (r.p, r.c)


def test_merge_and_turns(spark):
    one = spark.range(1)
    merged = one.select(sequences.merge_chunks(F.array(F.lit("a\nb"), F.lit(" "), F.lit("b\nc"), F.lit("c"), F.lit("d")))).first()[0]
    assert merged == "a\nb\n\nc\n\nd"
    assert one.select(sequences.merge_chunks(F.array().cast("array<string>"))).first()[0] == ""
    m = spark.createDataFrame([([("user", "q"), ("assistant", "a"), ("assistant", "b")],), ([("user", "q")],)], "m array<struct<role:string,content:string>>")
    assert [tuple(r) for r in m.select(sequences.assistant_text(F.col("m")), sequences.expected_answer(F.col("m"))).collect()] == [("a\n\nb", "b"), ("", None)]
    assert one.select(sequences.mean_length(F.array(F.lit("ab"), F.lit("abcd")))).first()[0] == 3.0
