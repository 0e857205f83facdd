"""Near-duplicates: MinHash over word sets, exact candidate bands, keep-first resolution.

The reference order decides: walking the items by id as strings, an item is dropped if an
item kept before it is similar enough. That is the lexicographically first maximal
independent set, not connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.functions.text import WORD
from glosswright.runtime import cut, if_small, spread

PRIME = (1 << 31) - 1


def permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of x -> (a x + b) mod PRIME from a multiplicative generator (48271, modulo PRIME)."""
    values, x = [], 1
    for _ in range(2 * k):
        x = x * 48271 % PRIME
        values.append(x)
    return np.array(values[:k], dtype=np.int64), np.array(values[k:], dtype=np.int64)


def signatures(documents: DataFrame, id_col: str, text_col: str, k: int = 128, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, signature): k minima over the hashes of the lower-cased word set; PRIME where there is no word.

    One narrow pass in vectorised batches: nothing is exploded or shuffled. Values are under
    2**31, so they are kept in 32 bits.
    """
    data = spread(documents.select(F.col(id_col), *keep, F.col(text_col).alias("__text")))
    names = [id_col, *keep, "signature"]
    schema = T.StructType([*data.schema.fields[:-1], T.StructField("signature", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, (a, b), known = regex.compile(WORD).findall, permutations(k), {}

        def token(w: str) -> int:
            h = known.get(w)
            if h is None:
                h = int(hashlib.sha1(w.encode("utf-8", "replace")).hexdigest()[:8], 16) % PRIME
                if len(known) < 500_000:
                    known[w] = h
            return h

        for batch in batches:
            out = np.full((batch.num_rows, k), PRIME, dtype=np.int64)
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                hashes = np.array([token(w) for w in {w.lower() for w in find(text or "")}], dtype=np.int64)
                for part in range(0, len(hashes), 4096):  # bounds the product of a very long text
                    np.minimum(out[i], ((hashes[part : part + 4096, None] * a + b) % PRIME).min(0), out=out[i])
            ends = pa.array(np.arange(0, (batch.num_rows + 1) * k, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(out.ravel().astype(np.int32)))], names=names)

    return data.mapInArrow(run, schema)


def matches_needed(k: int, threshold: float) -> int:
    """Least number of equal places m with m / k >= threshold in floating point."""
    return next(m for m in range(k + 2) if m / k >= threshold or m > k)


def similar_pairs(signed: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b): keys of different signatures that agree in enough places, a < b. signed: key, signature.

    If m of k places must agree, at most k - m differ, so of k - m + 1 bands one agrees
    wholly: candidates come from equi-joins on bands and none is lost. Rows of one key are
    one signature, however many there are, and count once. Only hashes of bands are
    shuffled; whole signatures are read again for the keys of candidates alone.
    """
    m = matches_needed(k, threshold)
    bands = k - m + 1
    if bands > k:
        raise ValueError("every pair would be a candidate")
    edges = [k * i // bands for i in range(bands + 1)]
    # the low bit of every place: rows that differ in more than k - m of these bits differ in more places
    bits = [F.aggregate(F.slice("signature", i + 1, 64), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x.bitwiseAND(F.lit(1)).cast("bigint"))).alias(f"s{i // 64}") for i in range(0, k, 64)]
    sketch = [f"s{i // 64}" for i in range(0, k, 64)]
    pieces = F.array(*[F.struct(F.lit(i).cast("short").alias("band"), F.xxhash64(F.slice("signature", a + 1, b - a)).alias("h")) for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    banded = signed.select("key", F.explode(pieces).alias("x")).select("key", "x.*").groupBy("band", "h").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    # a bucket of one signature gives no pair; only the rows of the others are joined
    busy = cut(banded.where("low <> high").select("band", "h"))
    rows = signed.select("key", *bits, F.explode(pieces).alias("x")).select("key", *sketch, "x.*").join(if_small(busy), ["band", "h"], "left_semi").distinct()
    near = sum((F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) for c in sketch), F.lit(0)) <= k - m
    found = cut(_meet(rows, ["band", "h"], near).distinct())
    wanted = if_small(found.select(F.col("a").alias("key")).unionByName(found.select(F.col("b").alias("key"))).distinct())
    whole = cut(signed.select("key", "signature").join(wanted, "key", "left_semi").groupBy("key").agg(F.first("signature").alias("s")))
    equal = F.aggregate(F.zip_with("s", "t", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, e: n + e)
    left, right = whole.select(F.col("key").alias("a"), "s"), whole.select(F.col("key").alias("b"), F.col("s").alias("t"))
    return found.join(left, "a").join(right, "b").where(equal >= m).select("a", "b")


#: Round from which chains are decided along their length.
CHAINS = 3


def _meet(rows: DataFrame, bucket: list[str], near: Column) -> DataFrame:
    """(a, b): the pairs of each bucket that are near by their sketches."""
    return rows.alias("l").join(rows.alias("r"), bucket).where(F.col("l.key") < F.col("r.key")).where(near).select(F.col("l.key").alias("a"), F.col("r.key").alias("b"))


def _along_chains(open_pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """(rank): nodes that are kept because they lie an even number of steps from a head, each step to a node's only earlier neighbour.

    Pointers are doubled, so a chain of n nodes takes O(log n) joins.
    """
    only = open_pairs.groupBy(F.col("hi").alias("x")).agg(F.count("*").alias("n"), F.min("lo").alias("p")).where("n = 1").select("x", "p", F.lit(1).alias("odd"))
    jump = cut(only)
    while True:
        ahead = jump.select(F.col("x").alias("p"), F.col("p").alias("q"), F.col("odd").alias("more"))
        further = cut(jump.join(ahead, "p", "left").select("x", F.coalesce("q", "p").alias("p"), F.col("odd").bitwiseXOR(F.coalesce("more", F.lit(0))).alias("odd"), F.col("q").isNotNull().alias("moved")))
        jump = further.drop("moved")
        if further.where("moved").isEmpty():
            break
    return jump.where("odd = 0").join(heads.select(F.col("rank").alias("p")), "p", "left_semi").select(F.col("x").alias("rank"))


def keep_first(pairs: DataFrame) -> DataFrame:
    """(rank, duplicate_of): duplicate_of is null for a kept node. Nodes without any pair are not listed.

    Rounds: a node without an undecided earlier neighbour is kept, and its later neighbours
    are dropped. From round CHAINS on, nodes with a single earlier neighbour are decided along
    their whole chain at once, so that a chain of near-copies takes O(log n) joins.
    """
    every = cut(pairs.select("lo", "hi").distinct())
    open_pairs, kept, dropped, rounds = every, None, None, 0
    while not open_pairs.isEmpty():
        rounds += 1
        nodes = open_pairs.select(F.col("lo").alias("rank")).unionByName(open_pairs.select(F.col("hi").alias("rank"))).distinct()
        now_kept = cut(nodes.join(open_pairs.select(F.col("hi").alias("rank")).distinct(), "rank", "left_anti"))
        if rounds >= CHAINS:
            now_kept = cut(now_kept.unionByName(_along_chains(open_pairs, now_kept)).distinct())
        now_dropped = cut(open_pairs.join(now_kept.withColumnRenamed("rank", "lo"), "lo", "left_semi").select(F.col("hi").alias("rank")).distinct())
        kept = now_kept if kept is None else kept.unionByName(now_kept)
        dropped = now_dropped if dropped is None else dropped.unionByName(now_dropped)
        decided = now_kept.unionByName(now_dropped)
        left = open_pairs
        for side in ("lo", "hi"):
            left = left.join(decided.withColumnRenamed("rank", side), side, "left_anti")
        # a node whose earlier neighbours were all dropped has no pair left and is kept
        still = left.select(F.col("lo").alias("rank")).unionByName(left.select(F.col("hi").alias("rank"))).distinct()
        freed = nodes.join(decided, "rank", "left_anti").join(still, "rank", "left_anti")
        kept = cut(kept.unionByName(freed))
        dropped = cut(dropped)
        open_pairs = cut(left.select("lo", "hi"))
    if kept is None:
        return every.select(F.col("lo").alias("rank"), F.col("hi").alias("duplicate_of"))
    first = every.join(kept.withColumnRenamed("rank", "lo"), "lo", "left_semi").join(dropped.withColumnRenamed("rank", "hi"), "hi", "left_semi")
    return first.groupBy(F.col("hi").alias("rank")).agg(F.min("lo").alias("duplicate_of")).unionByName(kept.withColumn("duplicate_of", F.lit(None).cast(kept.schema["rank"].dataType)))


def near_duplicates(signed: DataFrame, id_col: str, k: int = 128, threshold: float = 0.85) -> DataFrame:
    """(id, duplicate_of) for every row of (id, signature); duplicate_of is the first kept similar id or null.

    Rows with equal signatures form a class that stands or falls with its first member, so
    copies, however many, never meet in pairs. A class is named by 128 bits of hash. The
    rows are read several times: give signatures that are cut or stored.
    """
    rank = F.col(id_col).cast("string")
    key = F.struct(F.xxhash64("signature").alias("x"), F.xxhash64(F.reverse("signature")).alias("y"))
    signed = signed.select(F.col(id_col), key.alias("key"), "signature")
    first = cut(signed.groupBy("key").agg(F.min(rank).alias("first")))
    pairs = similar_pairs(signed, k, threshold)
    names = lambda end: first.select(F.col("key").alias(end), F.col("first").alias(f"{end}_first"))
    named = pairs.join(names("a"), "a").join(names("b"), "b").select(F.least("a_first", "b_first").alias("lo"), F.greatest("a_first", "b_first").alias("hi"))
    decided = keep_first(named)
    out = signed.select(id_col, "key").join(first, "key").join(decided, F.col("first") == F.col("rank"), "left")
    return out.select(id_col, F.coalesce("duplicate_of", F.when(rank != F.col("first"), F.col("first"))).alias("duplicate_of"))
