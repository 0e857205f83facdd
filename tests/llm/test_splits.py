import random

from pyspark.sql import functions as F

from glosswright.llm import splits


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    groups = {}
    for x in list(parent):
        groups.setdefault(find(x), set()).add(x)
    return {x: min(g) for g in groups.values() for x in g}


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randint(0, 80):03}", f"n{rng.randint(0, 80):03}") for _ in range(60)]
    edges += [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)]  # a long path
    edges += [("hub", f"h{i:03}") for i in range(200)]  # a hub
    df = spark.createDataFrame(edges, "u string, v string")
    got = {r.node: r.component for r in splits.components(df).collect()}
    want = brute([e for e in edges if e[0] != e[1]])
    assert got == want
    assert splits.components(df.limit(0)).count() == 0


def test_records_sharing_any_entity_share_a_split(spark):
    rows = [(1, ["a"]), (2, ["a", "b"]), (3, ["b"]), (4, None), (5, [None]), (6, ["c"]), (6, ["c"]), (7, ["c", "d"])]
    df = spark.createDataFrame([(r, e, "x") for r, e in rows], "rec int, ents array<string>, component string")
    got = {r.rec: r.component for r in splits.group_components(df, "rec", "ents").collect()}
    assert len(got) == 7 and got[1] == got[2] == got[3] and got[6] == got[7] and len({got[1], got[4], got[5], got[6]}) == 4
    many = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("component"))
    share = {r.split: r.n / 20000 for r in splits.assign(many, [("train", 0.8), ("validation", 0.1), ("test", 0.1)]).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["test"] - 0.1) < 0.01


def test_video_key_forms(spark):
    forms = [("ExklsEpxyxw", "ExklsEpxyxw"), (' "JIBAT-G1LCe"\n', "JIBAT-G1LCe"), ("yt:ZWIQ6nPmjeP", "ZWIQ6nPmjeP"), ("https://vid.example/watch?t=3s&v=iPBpDTaydcc", "iPBpDTaydcc"), ("https://v.example/S2AgBbsFXTe?si=a", "S2AgBbsFXTe"), ("unknown", "IXU0u96zStk"), ("", "IXU0u96zStk"), (None, "IXU0u96zStk")]
    df = spark.createDataFrame([((f, "normalize/chunks/IXU0u96zStk/chunk_1.txt"), w) for f, w in forms], "metadata struct<video_id:string,source_excerpt_path:string>, want string")
    assert all(r.got == r.want for r in df.select("want", splits.video_key(F.col("metadata")).alias("got")).collect())


def test_broken_groups(spark):
    e = spark.createDataFrame([(1, "train"), (2, "test"), (3, None), (4, "train"), (5, "train"), (5, "train")], "entry_id int, prev string")
    c = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "b")], "entry_id int, component string")
    assert {r.entry_id for r in splits.broken_groups(e, "entry_id", c, "prev").collect()} == {1, 2, 3}


def test_entries_of_one_video_meet_through_their_keys(spark):
    a, b = "IXU0u96zStk", "ZWIQ6nPmjeP"
    rows = [(1, a, None), (2, f"https://vid.example/watch?v={a}", f"x/chunks/{a}/1.txt"), (3, None, f"x/chunks/{a}/2.txt"), (4, "unknown", f"x/chunks/{b}/1.txt"), (5, f"yt:{b}", f"x/chunks/{a}/3.txt"), (6, "unknown", None), (7, "unknown", f"x/chunks/{a}/1.txt"), (8, None, None)]
    df = spark.createDataFrame([(i, (v, p)) for i, v, p in rows], "entry_id int, metadata struct<video_id:string,source_excerpt_path:string>")
    keyed = df.select("entry_id", splits.entities(F.col("metadata")).alias("entities"))
    assert keyed.where(F.size("entities") > 1).count() == 6  # these give the edges of the stars
    got = {r.entry_id: r.component for r in splits.group_components(keyed, "entry_id", "entities").collect()}
    assert got == {1: f"video:{a}", 2: f"video:{a}", 3: f"video:{a}", 7: f"video:{a}", 4: f"video:{b}", 5: f"video:{b}", 6: "row:6", 8: "row:8"}
