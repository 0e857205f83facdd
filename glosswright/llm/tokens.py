"""Problem 7 (token budgets) and problem 8 (encoding of the corpus).

Defined results: null and empty texts have 0 tokens and an empty id list; a row given
several times counts once; a video of analyze_metrics without any excerpt has 0 tokens,
so every positive stored count of it is reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.llm import bpe, lang
from glosswright.runtime import cut, if_small, spread


#: Characters that the pre-token pattern treats as white space.
SPACES = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = bpe.DEFAULT_RANKS) -> DataFrame:
    """(id, ids): token ids of every text by the linear-time backtracking encoder.

    One narrow pass: only the two columns are read, nothing is shuffled, and the id lists
    of a batch are built as one flat Arrow array.
    """
    data = spread(df.select(F.col(id_col), F.col(text_col).alias("__text")))
    schema = T.StructType([data.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, split = bpe.backtrack_encoder(ranks).units.__getitem__, bpe.UNIT.findall
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                flat, ends = [], [0]
                for text in part.column(1).to_pylist():
                    if text:
                        flat.extend(chain.from_iterable(map(units, split(text))))
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(np.array(ends, dtype=np.int32)), pa.array(np.array(flat, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[schema[0].name, "ids"])

    return data.mapInArrow(run, schema)


def _chunk_counts(chunks: DataFrame, group: str, index: str, text: str, joint: str, ranks: str) -> DataFrame:
    """Per row of non-null text: tokens alone, tokens with *joint* before it, whether its ends are ragged, language hits."""
    data = spread(chunks.select(F.col(group).alias("g"), F.col(index).alias("i"), F.col(text).alias("t")).where("t is not null"))
    counts = ["alone", "joined", *[f"hits_{c}" for c in lang.ORDER]]
    schema = T.StructType([data.schema["g"], data.schema["i"], *[T.StructField(c, T.LongType()) for c in counts], T.StructField("ragged", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, split, owners = bpe.heap_encoder(ranks).counts.__getitem__, bpe.UNIT.findall, {}
        for batch in batches:
            out: list[list] = [[] for _ in range(len(counts) + 1)]
            for t in batch.column(2).to_pylist():
                units = split(t)
                ragged = not t or t[0] in SPACES or t[-1] in SPACES
                sizes = list(map(count, units))
                found = dict.fromkeys(lang.ORDER, 0)
                for u in units:
                    owner = owners.get(u, "")
                    if owner == "":
                        owner = lang.OWNER.get(u.strip(" \t\r\n.,;:!?\"()").lower())
                        if len(owners) < bpe.CACHE_ENTRIES:
                            owners[u] = owner
                    if owner:
                        found[owner] += 1
                whole = sum(sizes)
                after = whole if ragged else whole - sizes[0] + count(joint + units[0])
                for column, value in zip(out, (whole, after, *found.values(), ragged)):
                    column.append(value)
            arrays = [pa.array(v, type=pa.int64()) for v in out[:-1]] + [pa.array(out[-1], type=pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=schema.names)

    return data.mapInArrow(run, schema)


def _ragged_counts(rows: DataFrame, joint: str, ranks: str) -> DataFrame:
    """(g, tokens) of texts with white space at their ends: rows g, i, t come sorted and are
    counted as one stream per group that holds a single unfinished unit, never a whole group."""
    schema = T.StructType([rows.schema["g"], T.StructField("exact", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, split = bpe.heap_encoder(ranks).counts.__getitem__, bpe.UNIT.findall
        group, index, tail, total, done = None, None, "", 0, []
        for batch in batches:
            for g, i, t in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group:
                    if group is not None:
                        done.append((group, total + sum(map(count, split(tail)))))
                    group, tail, total = g, t, 0
                elif i == index:
                    continue  # the same record again
                else:
                    tail += joint + t
                index = i
                units = split(tail)
                keep = 1 if units and units[-1].strip(SPACES) == "" else 0
                total += sum(map(count, units[: len(units) - keep]))
                tail = units[-1] if keep else ""
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], type=batch.schema[0].type), pa.array([d[1] for d in done], type=pa.int64())], names=schema.names)
                done = []
        if group is not None:
            yield pa.RecordBatch.from_arrays([pa.array([group]), pa.array([total + sum(map(count, split(tail)))], type=pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def text_tokens(chunks: DataFrame, group: str, index: str, text: str, joint: str = "\n\n", ranks: str = bpe.DEFAULT_RANKS) -> DataFrame:
    """(group, tokens, hits_*): exact tokens of each group's texts by *index*, joined by *joint*.

    The joined text is never built. A pre-token cannot span a change from other characters
    to white space, so texts with clean ends add up: counts alone for the first, counts with
    the joint before them for the rest. Sums combine before the shuffle and no text is
    shuffled. Only groups with white space at the end of some text take a second way, a
    stream in order of *index*.
    """
    rows = _chunk_counts(chunks, group, index, text, joint, ranks)
    hit_names = [f"hits_{c}" for c in lang.ORDER]
    once = rows.groupBy("g", "i").agg(F.first(F.struct("alone", "joined", "ragged", *hit_names)).alias("p"))
    sums = once.groupBy("g").agg(
        (F.sum("p.joined") - F.coalesce(F.min_by(F.col("p.joined") - F.col("p.alone"), F.col("i")), F.lit(0))).alias("sum_tokens"),
        F.max("p.ragged").alias("ragged"), *[F.sum(f"p.{h}").alias(h) for h in hit_names],
    )
    sums = cut(sums)  # a row per group, read twice
    hard = if_small(sums.where("ragged").select("g"))
    source = chunks.select(F.col(group).alias("g"), F.col(index).alias("i"), F.col(text).alias("t")).where("t is not null")
    stream = source.join(hard, "g", "left_semi").repartition("g").sortWithinPartitions("g", "i")
    exact = _ragged_counts(stream, joint, ranks)
    return sums.join(exact, "g", "left").select(F.col("g").alias(group), F.coalesce("exact", "sum_tokens").alias("tokens"), *hit_names)


def untrusted_counts(metrics: DataFrame, tokens: DataFrame, factor: int = 3) -> DataFrame:
    """Rows of *metrics* (video_id, token_count) whose stored count is null, not positive, or off by more than *factor*."""
    true = F.coalesce(F.col("tokens"), F.lit(0))
    stored = F.col("token_count")
    wrong = stored.isNull() | (stored <= 0) | (stored > factor * true) | (stored * factor < true)
    return metrics.select("video_id", "token_count").join(tokens.select("video_id", "tokens"), "video_id", "left").where(wrong)


def video_languages(hit_prefix: str = "hits_") -> Column:
    """Language with the most function words of a row; null without hits."""
    best = F.greatest(*[F.struct(F.col(f"{hit_prefix}{c}").alias("n"), F.lit(c).alias("c")) for c in lang.ORDER])
    return F.when(best.n > 0, best.c)
