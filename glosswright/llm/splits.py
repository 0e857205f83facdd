"""Problem 4: splits that keep records of one entity together.

Records that share any entity form a component; the component's identifier, hashed, falls
into a range of the unit interval that belongs to one split. Defined results: a record
without any entity is a component of its own; repeated records count once; empty tables
give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswright.runtime import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least node of u's neighbourhood, u included."""
    both = edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are all linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of the edges (u, v); component is the least node.

    Alternating large-star and small-star: O(log² n) rounds of aggregations and equi-joins.
    A hub is never gathered: its minimum combines before the shuffle and its edges are
    joined as rows, which adaptive execution can split. Each round ends in a checkpoint.
    """
    current = cut(edges.select("u", "v").where("u is not null and v is not null and u <> v").distinct())
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    signature = None
    for _ in range(rounds):
        current = cut(_small_star(_large_star(current)))
        # a star forest is a fixed point; two 64-bit sums and the count tell whether edges changed
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if seen == signature:
            break
        signature = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def group_components(records: DataFrame, record: str, entities: str) -> DataFrame:
    """(record, component) with *entities* an array column of each record's entity keys.

    Records and entities form a bipartite graph whose record nodes are contracted: a
    record's first entity is linked to its others, which leaves the components unchanged
    and keeps records with one entity, usually nearly all, out of the iteration.
    """
    keys = records.groupBy(record).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.coalesce(entities, F.array()), lambda x: x.isNotNull()))))).alias("__keys"))
    keys = keys.select(record, "__keys", F.get("__keys", F.lit(0)).alias("__first"))
    edges = keys.where(F.size("__keys") > 1).select(F.col("__first").alias("u"), F.explode(F.slice("__keys", 2, 1 << 30)).alias("v"))
    found = components(edges)
    alone = F.concat(F.lit("row:"), F.col(record).cast("string"))
    joined = keys.join(found.withColumnRenamed("node", "__first"), "__first", "left")
    return joined.select(record, F.coalesce("component", "__first", alone).alias("component"))


def assign(components_of: DataFrame, targets: list[tuple[str, float]]) -> DataFrame:
    """Adds ``split``: the component's hash as a number in [0, 1) against cumulated shares, by split name."""
    if not targets:
        return components_of.withColumn("split", F.lit(None).cast("string"))
    point = F.conv(F.substring(F.sha2("component", 256), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    total, bounds = sum(s for _, s in targets), []
    for name, share in sorted(targets):
        bounds.append((name, (bounds[-1][1] if bounds else 0.0) + share))
    rule = reduce(lambda case, b: case.when(point * total < b[1], b[0]), bounds[:-1], F.when(F.lit(False), ""))
    return components_of.withColumn("split", rule.otherwise(bounds[-1][0]))


def broken_groups(records: DataFrame, record: str, component: DataFrame, previous: str) -> DataFrame:
    """Records of every component whose non-null *previous* splits differ."""
    last = records.groupBy(record).agg(F.min(previous).alias("lo"), F.max(previous).alias("hi"))
    rows = last.join(component, record)
    broken = rows.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    return rows.select(record, "component").join(broken.select("component"), "component", "left_semi").select(record)


#: An id of 11 characters alone or as the last part or a parameter of a reference.
VIDEO_ID = r"(?:^|[=/:])([A-Za-z0-9_-]{11})(?:$|[?&#/])"


def _told(metadata: Column) -> Column:
    """The video that metadata.video_id names in any of its forms, else null."""
    plain = F.regexp_replace(metadata["video_id"], r"^[\s\"']+|[\s\"']+$", "")
    by_parameter = F.regexp_extract(plain, r"[?&]v=([A-Za-z0-9_-]{11})(?:$|[&#])", 1)
    by_id = F.regexp_extract(plain, VIDEO_ID, 1)
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (by_parameter, by_id)])


def video_key(metadata: Column) -> Column:
    """The video meant by metadata.video_id in any of its forms; else by the path of its excerpt; else null."""
    by_path = F.regexp_extract(metadata["source_excerpt_path"], r"(?:^|/)chunks/([A-Za-z0-9_-]{11})/", 1)
    return F.coalesce(_told(metadata), F.nullif(by_path, F.lit("")))


def entities(metadata: Column) -> Column:
    """All keys of an entry whose video can be told: the video, the form in which it is written, the folder of its excerpt; else an empty array.

    A form counts only where it tells the video itself, a folder only where it is of the video meant. The video's key sorts first, so it names the component.
    """
    video = video_key(metadata)
    written = F.when(_told(metadata).isNotNull(), metadata["video_id"])
    folder = F.regexp_extract(metadata["source_excerpt_path"], r"^(.*(?:^|/)chunks/[A-Za-z0-9_-]{11}/)", 1)
    keys = F.array(F.concat(F.lit("video:"), video), F.concat(F.lit("written:"), written), F.when(F.contains(folder, F.concat(F.lit("chunks/"), video, F.lit("/"))), F.concat(F.lit("within:"), folder)))
    return F.when(video.isNotNull(), F.filter(keys, lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>"))
