"""Keyed joins, latest rows, roll-ups, samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from glosswright.functions.hashing import unit_interval


def latest(rows: DataFrame, key: str, position: Column) -> DataFrame:
    """The last row of each non-blank key, by one aggregation (no sort of a key's rows)."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    kept = rows.where(F.coalesce(F.trim(F.col(key)) != "", F.lit(False)))
    return kept.groupBy(key).agg(F.max_by(whole, position).alias("__row")).select("__row.*")


def unique_sources(rows: DataFrame, key: str, position: str) -> DataFrame:
    """O2: last row of each id, in the order in which ids first came (column ``first_position``)."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    kept = rows.where(F.coalesce(F.trim(F.col(key)) != "", F.lit(False)))
    return kept.groupBy(key).agg(F.max_by(whole, position).alias("__row"), F.min(position).alias("first_position")).select("__row.*", "first_position")


def assemble(base: DataFrame, stages: dict[str, DataFrame], key: str = "video_id", strict: bool = False) -> DataFrame:
    """Base rows with each stage's columns as a struct; strict fails the query where a stage lacks a row."""
    out = base
    for name, rows in stages.items():
        part = rows.select(key, F.struct(*[F.col(c) for c in rows.columns if c != key]).alias(name))
        out = out.join(part, key, "left")
        if strict:
            out = out.withColumn(name, F.coalesce(name, F.raise_error(F.concat(F.lit(f"no {name} row for "), F.col(key)))))
    return out


def with_upstream(rows: DataFrame, upstream: DataFrame, key: str, has: str) -> DataFrame:
    """Left lookup; rows without upstream data become failed, others keep status ready."""
    joined = rows.join(upstream, key, "left")
    return joined.withColumn("status", F.when(F.col(has).isNull(), "failed").otherwise("ready"))


def cache_hits(items: DataFrame, manifest: DataFrame) -> DataFrame:
    """Items (item_id, input_hash) that were done or skipped with the same hash."""
    done = manifest.where(F.col("status").isin("success", "skipped")).select("item_id", "input_hash")
    return items.join(done, ["item_id", "input_hash"], "left_semi")


def cache_misses(items: DataFrame, manifest: DataFrame) -> DataFrame:
    """The others; failed items are always tried again."""
    done = manifest.where(F.col("status").isin("success", "skipped")).select("item_id", "input_hash")
    return items.join(done, ["item_id", "input_hash"], "left_anti")


def two_level_cache(items: DataFrame, candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """``reuse`` is all where generation and gate hash are known, candidates where only the first is, else none."""
    made = candidates.select("item_id", "generation_hash").distinct().withColumn("made", F.lit(True))
    judged = decisions.select("item_id", "generation_hash", "gate_hash").distinct().withColumn("judged", F.lit(True))
    out = items.join(made, ["item_id", "generation_hash"], "left").join(judged, ["item_id", "generation_hash", "gate_hash"], "left")
    return out.withColumn("reuse", F.when(F.col("judged"), "all").when(F.col("made"), "candidates").otherwise("none")).drop("made", "judged")


def lookup(key: Column, table: dict[str, str]) -> Column:
    """A few fixed rows as a literal map; unknown keys give null."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair]), key)


def membership(rows: DataFrame, ids: DataFrame, key: str, inside: bool) -> DataFrame:
    """Rows whose key is (or is not) among the ids; the planner picks the join by size."""
    return rows.join(ids.select(key).distinct(), key, "left_semi" if inside else "left_anti")


def stage_report(rows: DataFrame, done: Sequence[str] = ("success", "ready"), *keys: str) -> DataFrame:
    """A1, A2: totals by outcome; done names the statuses that count as success."""
    s = F.col("status")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_if(s.isin(*done)).alias("success"), F.count_if(s == "failed").alias("failed"), F.count_if(s == "skipped").alias("skipped")
    )


def summary(decisions: DataFrame, key: str, averages: Sequence[str]) -> DataFrame:
    """A3, A4: per item attempted, kept, dropped, means over the kept (0.0 without any) and a status."""
    kept = F.col("reason").isNull()
    out = decisions.groupBy(key).agg(
        F.count("*").alias("attempted"), F.count_if(kept).alias("entries"), F.count_if(~kept).alias("dropped"),
        *[F.coalesce(F.avg(F.when(kept, F.col(c))), F.lit(0.0)).alias(f"{c}_avg") for c in averages],
    )
    return out.withColumn("status", F.when(F.col("entries") > 0, "ready").otherwise("skipped")).withColumn("skip_reason", F.when(F.col("entries") == 0, "no_valid_examples"))


def group_key(video_id: Column, blank_too: bool) -> Column:
    """A9: 'unknown' for a missing id, and for a blank one where asked."""
    return F.coalesce(F.when((video_id != "") | F.lit(not blank_too), video_id), F.lit("unknown"))


def run_status(updates: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Failed if any stage failed, completed if all did complete, else running."""
    done = F.count_distinct(F.when((F.col("status") == "completed") & F.col("stage").isin(*stages), F.col("stage")))
    out = updates.groupBy("run_id").agg(F.bool_or(F.col("status") == "failed").alias("bad"), done.alias("n"))
    return out.select("run_id", F.when(F.col("bad"), "failed").when(F.col("n") == len(stages), "completed").otherwise("running").alias("status"))


def resumable(runs: DataFrame, config_hash: str) -> DataFrame:
    """O3: the newest run of these settings that has not ended."""
    return runs.where((F.col("config_hash") == config_hash) & F.col("status").isin("running", "failed")).orderBy(F.col("updated_at").desc(), F.col("run_id").desc()).limit(1)


def latest_run(runs: DataFrame) -> DataFrame:
    """O4."""
    return runs.orderBy(F.col("updated_at").desc(), F.col("run_id").desc()).limit(1)


def sample(rows: DataFrame, n: int, seed: int, *key: str) -> DataFrame:
    """N rows by hash of seed and key: the same rows whatever the partitioning."""
    return rows.orderBy(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]), 256), *key).limit(n)


def rotated(options: Sequence[str], chunk_index: Column, per_chunk: int) -> Column:
    """per_chunk options from chunk_index on, round and round."""
    listed = F.array(*[F.lit(o) for o in options])
    return F.transform(F.sequence(F.lit(0), F.lit(per_chunk - 1)), lambda k: F.get(listed, F.pmod(chunk_index + k, F.lit(len(options))).cast("int")))


def held_out_groups(rows: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """The groups for evaluation: the int(n * share) first by hash, one at least where share > 0 and n > 1.

    The ids are ranked by a hash of 64 bits, so the cut is found by counting ids per leading
    bits of the hash and sorting only within the slice that holds it: no global sort, no
    single-partition window.
    """
    ids = rows.select(key).distinct().withColumn("h", F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key)), 256))
    slices = ids.groupBy(F.substring("h", 1, 3).alias("slice")).agg(F.count("*").alias("n")).orderBy("slice").collect()  # at most 4096 rows
    total = sum(r.n for r in slices)
    wanted = int(total * share)
    if share > 0 and total > 1 and wanted == 0:
        wanted = 1
    if wanted >= total and total:
        wanted = total - 1 if total > 1 else 0
    before, at = 0, None
    for r in slices:
        if before + r.n > wanted:
            at = r["slice"]
            break
        before += r.n
    if wanted == 0:
        return ids.where(F.lit(False)).select(key)
    if at is None:
        return ids.select(key)
    part = F.substring("h", 1, 3)
    edge = ids.where(part == at).orderBy("h", key).limit(wanted - before)
    return ids.where(part < at).select(key).unionByName(edge.select(key))


def coin(seed: int, *key: Column) -> Column:
    """A number in [0, 1] by hash of seed and key."""
    return unit_interval(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]), 256))


def merged_counts(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """U4: sums of the counts of both by key."""
    return left.unionByName(right).groupBy(*keys).agg(F.sum("n").alias("n"))
