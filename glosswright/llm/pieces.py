"""Problem 5: cut oversized items at natural boundaries, with overlap.

A separator hierarchy is applied recursively: segments, paragraphs, sentences, words,
characters. A span longer than the limit is cut by the next separator only. The spans are
then packed greedily; each piece after the first starts a fixed number of characters
before the end of the one before it.

Defined results: null texts and texts within the limit are no items; lengths are code
points; where the segments given do not make up the text (stale bounds, gaps), the whole
text counts as one segment; a repeated item counts once; a limit must exceed the overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT, OVERLAP = 1200, 120
#: Items over more indexes are looked up by blocks of segments, not index by index.
WIDE, BLOCK = 100_000, 4_096
LEVELS = ("segment", "paragraph", "sentence", "word", "none")
#: Where a span of each level may be cut: the cut is the end of the match.
SEPARATORS = {"paragraph": re.compile(r"\n\s*\n\s*"), "sentence": re.compile(r"[.!?…]\s+"), "word": re.compile(r"\s+")}
PIECE = T.StructType([T.StructField("piece_index", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("boundary", T.StringType()), T.StructField("text", T.StringType())])
#: White space as Python's str.strip sees it, for the JVM's regular expressions.
BLANKS = r"[\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _spans(text: str, start: int, end: int, levels: tuple[str, ...], limit: int) -> list[tuple[int, int, str]]:
    """Spans (start, end, level that cut it) of at most *limit* characters, white space at the end not counted.

    levels[0] made this span; the rest are the separators still to be tried.
    """
    if len(text[start:end].rstrip()) <= limit:
        return [(start, end, levels[0])]
    below = levels[1:]
    if below[0] == "none":
        return [(i, min(i + limit, end), "none") for i in range(start, end, limit)]
    cuts = [m.end() for m in SEPARATORS[below[0]].finditer(text, start, end)]
    bounds = [start, *[c for c in cuts if start < c < end], end]
    return [s for a, b in zip(bounds, bounds[1:]) for s in _spans(text, a, b, below, limit)]


def _segments(text: str, lengths: list[int] | None) -> list[tuple[int, int]]:
    """Spans of the segments, each with the space that follows it."""
    if not lengths or sum(lengths) + len(lengths) - 1 != len(text):
        return [(0, len(text))]
    out, at = [], 0
    for n in lengths:
        out.append((at, min(at + n + 1, len(text))))
        at += n + 1
    return out


def boundary_needed(text: str, lengths: list[int] | None, limit: int = LIMIT) -> str:
    """First of segment, sentence, word that alone makes every span fit, else none."""
    levels = tuple(x for x in LEVELS if x != "paragraph")  # a paragraph may end inside a sentence
    return max((s[2] for a, b in _segments(text, lengths) for s in _spans(text, a, b, levels, limit)), key=LEVELS.index)


def cut_text(text: str, lengths: list[int] | None = None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """Pieces (start, end, boundary at the end) that cover *text*; neighbours share *overlap* characters."""
    if limit <= overlap or overlap < 0:
        raise ValueError("limit must exceed overlap")
    if len(text) <= limit:
        return [(0, len(text), "segment")]
    # natural places to end a piece, each with the level that made it
    marks: list[tuple[int, str]] = []
    for a, b in _segments(text, lengths):
        inner = _spans(text, a, b, LEVELS, limit - overlap)
        marks += [(e, level) for _, e, level in inner[:-1]] + [(b, "segment")]
    pieces, start, k = [], 0, 0
    while True:
        reach, best = start + limit, None
        if len(text) <= reach:
            return [*pieces, (start, len(text), "segment")]
        while k < len(marks) and marks[k][0] <= reach:
            best = marks[k]
            k += 1
        floor = start + (overlap if pieces else 0)
        if best is None or best[0] <= floor:
            best = (reach, "none")
        end = best[0]
        pieces.append((start, end, best[1]))
        start = end - overlap


def _wide(items: DataFrame, lengths: DataFrame) -> DataFrame:
    """(video_id, chunk_index, segment_index, n) of items that span many indexes: by the blocks of segments that exist.

    Where the blocks that lie wholly inside hold more characters than the text, the bounds
    cannot be right and nothing is given, so an item never collects much more than its text.
    """
    numbered = lengths.withColumn("b", F.floor(F.col("segment_index") / BLOCK))
    a, z = F.floor(F.col("start_segment_index") / BLOCK), F.floor(F.col("end_segment_index") / BLOCK)
    keys = items.select("video_id", "chunk_index", "start_segment_index", "end_segment_index", F.length("text").alias("size"))
    spans = keys.join(numbered.groupBy("video_id", "b").agg(F.sum("n").alias("chars")), "video_id").where(F.col("b").between(a, z))
    inside = F.sum(F.when((F.col("b") > a) & (F.col("b") < z), F.col("chars")).otherwise(0))
    fit = spans.groupBy("video_id", "chunk_index").agg(inside.alias("inside"), F.first("size").alias("size")).where("inside <= size").select("video_id", "chunk_index")
    some = spans.join(fit, ["video_id", "chunk_index"], "left_semi").drop("chars", "size")
    return some.join(numbered, ["video_id", "b"]).where(F.col("segment_index").between(F.col("start_segment_index"), F.col("end_segment_index"))).select("video_id", "chunk_index", "segment_index", "n")


def oversized(items: DataFrame, segments: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(video_id, chunk_index, text, lengths): items over *limit* with the lengths of their non-blank segments.

    Only the lengths of segments are shuffled, never their texts, and only the items over
    the limit are expanded to the segment numbers they span, for an equi-join.
    """
    big = items.where(F.length("text") > limit).groupBy("video_id", "chunk_index").agg(F.first(F.struct("text", "start_segment_index", "end_segment_index")).alias("i"))
    big = big.select("video_id", "chunk_index", "i.*")
    ok = F.col("start_segment_index") <= F.col("end_segment_index")
    near = F.col("end_segment_index") - F.col("start_segment_index") <= WIDE
    want = big.where(ok & near).select("video_id", "chunk_index", F.explode(F.sequence("start_segment_index", "end_segment_index")).alias("segment_index"))
    stripped = F.regexp_replace("text", f"^{BLANKS}+|{BLANKS}+$", "")
    lengths = segments.select("video_id", "segment_index", F.length(stripped).alias("n")).where("n > 0").groupBy("video_id", "segment_index").agg(F.max("n").alias("n"))
    found = want.join(lengths, ["video_id", "segment_index"])
    if not items.where(ok & ~near).isEmpty():
        found = found.unionByName(_wide(big.where(ok & ~near), lengths).select(*found.columns))
    listed = found.groupBy("video_id", "chunk_index").agg(F.array_sort(F.collect_list(F.struct("segment_index", "n"))).alias("s"))
    return big.join(listed, ["video_id", "chunk_index"], "left").select("video_id", "chunk_index", "text", F.col("s.n").alias("lengths"))


def cut_items(big: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """One row per item: keys, ``needed`` boundary and the array ``pieces``."""
    piece = T.StructType([f for f in PIECE if with_text or f.name != "text"])
    schema = T.StructType([big.schema["video_id"], big.schema["chunk_index"], T.StructField("needed", T.StringType()), T.StructField("pieces", T.ArrayType(piece))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(schema["pieces"].dataType)
        for batch in batches:
            needed, pieces = [], []
            for text, lengths in zip(batch.column("text").to_pylist(), batch.column("lengths").to_pylist()):
                needed.append(boundary_needed(text, lengths, limit))
                cuts = enumerate(cut_text(text, lengths, limit, overlap))
                pieces.append([{"piece_index": i, "start": a, "end": b, "boundary": at} | ({"text": text[a:b]} if with_text else {}) for i, (a, b, at) in cuts])
            yield pa.RecordBatch.from_arrays([batch.column("video_id"), batch.column("chunk_index"), pa.array(needed), pa.array(pieces, type=kind)], names=schema.names)

    return big.mapInArrow(run, schema)
