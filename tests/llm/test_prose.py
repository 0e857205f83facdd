import random

import numpy as np

from glosswright.llm import prose

WORDS = "the old house near the river was quiet and a man with a dog walked over the bridge to his garden while it rained".split()


def prose_text(rng):
    return " ".join(" ".join(rng.choice(WORDS) for _ in range(rng.randint(8, 16))).capitalize() + "." for _ in range(rng.randint(3, 9)))


def test_kinds(spark):
    rng = random.Random(4)
    rows = [("v", i, prose_text(rng)) for i in range(200)]
    table = "| a | b | c |\n" + "\n".join(f"| x{i} | {i} | {i * 2} |" for i in range(9))
    csv = "\n".join(f"name{i};{i};{i + 5};12/0{i}" for i in range(9))
    items = "\n".join(f"- {rng.choice(WORDS)} {rng.choice(WORDS)}" for _ in range(14))
    junk = " ".join("".join(rng.choice("#%&!?*+~") for _ in range(12)) for _ in range(30))
    noise = " ".join("".join(rng.choice("qwzxkjp") for _ in range(8)) for _ in range(40))
    mixed = prose_text(rng) + "\n\n- hat\n- dog\n- river\n\n" + prose_text(rng)
    special = {300: (table, "table"), 301: (csv, "table"), 302: (items, "list"), 303: (junk, "junk"), 304: (noise, "junk"), 305: (mixed, None), 306: (prose_text(rng).lower().replace(".", ""), None), 307: ("", None), 308: ("House.", None), 309: ("A" * 900, "junk")}
    rows += [("v", k, t) for k, (t, _) in special.items()] + [("v", 310, None), ("v", 300, table)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "video_id string, chunk_index bigint, t string, distance double")
    measured = prose.measure(df, ["video_id", "chunk_index"], "t")
    scored = {r.chunk_index: r for r in prose.score(measured, prose.fit(measured)).withColumn("kind", prose.kind()).collect()}
    assert len(scored) == 210 and 310 not in scored
    assert {k: scored[k].kind for k in special} == {k: kind for k, (_, kind) in special.items()}
    assert sum(scored[i].kind is not None for i in range(200)) == 0
    r = scored[300]
    assert abs(sum(r.contributions.asDict().values()) - r.distance) < 1e-6 * r.distance


def test_contributions_are_the_quadratic_form():
    mean, inverse = np.zeros(len(prose.NAMES)), np.eye(len(prose.NAMES))
    assert len(prose._contributions(mean, inverse)) == len(prose.NAMES)


def test_empty_table(spark):
    df = spark.createDataFrame([], "video_id string, chunk_index bigint, t string")
    measured = prose.measure(df, ["video_id", "chunk_index"], "t")
    assert prose.fit(measured) == {} and prose.score(measured, {}).count() == 0
