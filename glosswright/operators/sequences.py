"""Order-dependent operators on segments and chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from glosswright.functions.text import let

SEGMENT = "struct<start:double,end:double,text:string>"
CHUNK = "array<struct<chunk_index:bigint,start_segment_index:bigint,end_segment_index:bigint,start_time:double,end_time:double,text:string>>"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def chunk_numbers(texts: Column, target: int, hard_max: int) -> Column:
    """Q1 without overlap: the chunk number of each segment, by one fold.

    A segment joins the chunk unless the chunk has reached the target or would pass the
    hard limit; the first segment of a chunk is taken whole. Blank segments never close one.
    """
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("chunk"), F.lit(0).alias("chars"), F.lit(0).alias("taken"))

    sizes = F.transform(texts, lambda t: F.length(strip(F.coalesce(t, F.lit("")))))  # once each, not at every use in the fold

    def step(acc: Column, size: Column) -> Column:
        grown = acc["chars"] + size + F.when(acc["chars"] > 0, 1).otherwise(0)
        close = (size > 0) & (acc["taken"] > 0) & ((acc["chars"] >= target) | (grown > hard_max))
        number = acc["chunk"] + F.when(close, 1).otherwise(0)
        return F.struct(
            F.concat(acc["out"], F.array(number)).alias("out"), number.alias("chunk"),
            F.when(close, size).when(size > 0, grown).otherwise(acc["chars"]).alias("chars"), F.when(close, 1).otherwise(acc["taken"] + 1).alias("taken"),
        )

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def plan_chunks(sizes: list[int], target: int, hard_max: int, overlap: int) -> list[tuple[int, int]]:
    """Q1 and Q2: (first, last) segment of every chunk, given the trimmed lengths."""
    if target <= 0 or hard_max < target or overlap < 0:
        raise ValueError("need 0 < target <= hard_max and overlap >= 0")
    out, first, n = [], 0, len(sizes)
    while first < n:
        chars, after = 0, first
        while after < n:
            grown = chars + sizes[after] + (1 if chars and sizes[after] else 0)
            if after > first and sizes[after] and (chars >= target or grown > hard_max):
                break
            chars, after = grown, after + 1
        out.append((first, after - 1))
        if after >= n:
            break
        back, again = after, 0
        while overlap and back > first and again < overlap:
            back -= 1
            again += sizes[back] + 1
        first = back if back > first else first + 1
    return out


def chunker(target: int, hard_max: int, overlap: int):
    """A vectorised function: array of segments -> array of chunks, with overlap."""

    @F.pandas_udf(CHUNK)
    def chunks(segments: pd.Series) -> pd.Series:
        out = []
        for rows in segments:
            rows = [] if rows is None else list(rows)
            texts = [(r["text"] or "").strip() for r in rows]
            made = []
            for a, b in plan_chunks([len(t) for t in texts], target, hard_max, overlap):
                text = " ".join(t for t in texts[a : b + 1] if t)
                if text:
                    times = [r["start"] for r in rows[a : b + 1] if r["start"] is not None], [r["end"] for r in rows[a : b + 1] if r["end"] is not None]
                    made.append((len(made), a, b, times[0][0] if times[0] else None, times[1][-1] if times[1] else None, text))
            out.append([dict(zip(("chunk_index", "start_segment_index", "end_segment_index", "start_time", "end_time", "text"), m)) for m in made])
        return pd.Series(out)

    return chunks


def ordered_text(position: Column, text: Column, joint: str = " ") -> Column:
    """The group's texts in order, blanks left out."""
    rows = F.array_sort(F.collect_list(F.struct(position.alias("p"), F.trim(text).alias("t"))))
    return F.array_join(F.filter(F.transform(rows, lambda r: r["t"]), lambda t: t != ""), joint)


def first_start(position: Column, start: Column) -> Column:
    """A10: start of the first segment that has one."""
    return F.min_by(start, F.when(start.isNotNull(), position))


def last_end(position: Column, end: Column) -> Column:
    """A10: end of the last segment that has one."""
    return F.max_by(end, F.when(end.isNotNull(), position))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\r\n|[\n\r]"), strip), lambda x: x != "")


def _spaced(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def _longest_shared(left: Column, right: Column, longest: Column, shortest: int) -> Column:
    """Largest n with shortest <= n <= longest whose last n of left are the first n of right, else 0."""
    top = F.least(F.size(left), F.size(right), longest)
    sizes = F.when(top >= shortest, F.sequence(F.lit(shortest), top)).otherwise(F.array().cast("array<int>"))
    # the cheap test first: the last word of left stands at place n of right
    fits = F.filter(sizes, lambda n: (F.get(right, n - 1) == F.element_at(left, -1)) & (F.slice(left, -n, n) == F.slice(right, F.lit(1), n)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def trim_repeat(previous: Column, current: Column) -> Column:
    """Q3: *current* without what repeats the end of *previous*: up to 3 lines, else 11 to 80 words."""
    from_place = lambda items, n, joint: F.array_join(F.slice(items, n + 1, F.greatest(F.size(items), F.lit(1))), joint)

    def by_words(w: Column) -> Column:
        return let(_longest_shared(w["a"], w["b"], F.lit(80), 11), lambda m: F.when(m > 0, from_place(w["b"], m, " ")).otherwise(strip(current)))

    def by_lines(v: Column) -> Column:
        words = F.struct(_spaced(previous).alias("a"), _spaced(current).alias("b"))
        return let(_longest_shared(v["a"], v["b"], F.lit(3), 1), lambda n: F.when(n > 0, from_place(v["b"], n, "\n")).otherwise(let(words, by_words)))

    lines = F.struct(_lines(previous).alias("a"), _lines(current).alias("b"))
    return F.when(strip(previous) == "", strip(current)).when(strip(current) == "", F.lit("")).otherwise(let(lines, by_lines))


def merge_chunks(texts: Column) -> Column:
    """Q4: chunks in order, each trimmed against the one that was kept before it, joined by blank lines."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("last"))

    def step(acc: Column, text: Column) -> Column:
        def keep(fresh: Column) -> Column:
            more = F.struct(F.concat(acc["out"], F.array(fresh)).alias("out"), fresh.alias("last"))
            return F.when(fresh == "", acc).otherwise(more)

        return let(trim_repeat(acc["last"], F.coalesce(text, F.lit(""))), keep)

    return F.aggregate(texts, start, step, lambda acc: F.array_join(acc["out"], "\n\n"))


def assistant_text(messages: Column) -> Column:
    """Q5: the assistant's turns, one per line pair."""
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == "assistant"), lambda m: m["content"]), "\n\n")


def expected_answer(messages: Column) -> Column:
    """Q5: the last assistant turn, null without one."""
    return F.get(F.reverse(F.filter(messages, lambda m: m["role"] == "assistant")), F.lit(0))["content"]


def mean_length(texts: Column) -> Column:
    """0.0 for no segments."""
    total = F.aggregate(texts, F.lit(0).cast("bigint"), lambda n, t: n + F.length(F.coalesce(t, F.lit(""))))
    return F.when(F.size(texts) == 0, F.lit(0.0)).otherwise(total / F.size(texts))
