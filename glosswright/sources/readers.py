"""Sources: address lists, JSON lines, catalogs, transcripts and chunk records."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from glosswright.functions.parsing import lenient_double, paragraphs


def address_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed lines without blanks and # comments."""
    line = F.trim(F.col(column))
    return lines.select(line.alias("url")).where((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def read_addresses(spark: SparkSession, source_type: str, source: str) -> DataFrame:
    """A url_file is read; any other source is one address."""
    if source_type == "url_file":
        return address_lines(spark.read.text(source))
    return spark.createDataFrame([(source,)], "url string")


#: A source entry as a staged catalog gives it.
CATALOG = "id string, title string, webpage_url string, duration double, is_live boolean, live_status string, description string, channel string, channel_id string, upload_date string"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Entries collected elsewhere, staged as JSON lines; entries without an id are dropped."""
    return read_json_lines(spark, path, CATALOG).where(F.trim("id") != "")


def flatten_playlists(info: DataFrame, entries: str = "entries") -> DataFrame:
    """S3: entries of entries, one extra level deep; null entries are dropped, an entry without a list is a leaf."""
    outer = info.select(F.explode(entries).alias("e")).where("e is not null")
    nested = F.col(f"e.{entries}")
    inner = outer.select(F.explode(F.when(nested.isNull(), F.array(F.struct(F.col("e.id").alias("id"), F.col("e.title").alias("title")))).otherwise(nested)).alias("x"))
    return inner.where("x is not null").select("x.*")


def choose_transcript(candidates: DataFrame, allowed: list[str], manual_only: bool, allow_auto: bool) -> DataFrame:
    """The best transcript of each video: manual and allowed, then any manual, then allowed, then any.

    candidates: video_id, position, is_generated, language and more. A chosen transcript
    outside the allowed languages is marked filtered.
    """
    inside = F.col("language").isin(*allowed)
    rank = F.when(~F.col("is_generated") & inside, 1)
    if manual_only:
        rank = rank.when(~F.col("is_generated"), 2)
    if allow_auto:
        rank = rank.when(inside, 3).otherwise(4)
    ranked = candidates.withColumn("priority", rank).where("priority is not null")
    whole = F.struct(*[F.col(c) for c in ranked.columns])
    best = ranked.groupBy("video_id").agg(F.min_by(whole, F.struct("priority", "position")).alias("r")).select("r.*")
    return best.withColumn("filtered", F.col("language").isNotNull() & ~F.col("language").isin(*allowed))


def json_objects(lines: DataFrame, schema: str | T.StructType, column: str = "value") -> DataFrame:
    """Object lines as rows; blank lines, broken JSON and other values are skipped, mistyped fields stay null."""
    parsed = F.try_parse_json(column)
    rows = lines.where(parsed.isNotNull()).where(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")))
    return rows.select(F.from_json(column, schema).alias("r")).select("r.*")


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A missing file is an empty table."""
    if not re.match(r"\w+:/", path) and not Path(path).exists():
        return spark.createDataFrame([], schema)
    return json_objects(spark.read.text(path), schema)


def read_json(path: str | Path, default: object) -> object:
    """A JSON file on the driver, or the default."""
    p = Path(path)
    return json.loads(p.read_text("utf-8")) if p.exists() else default


def transcript_segments(content: Column) -> Column:
    """Segments of a transcript in JSON, else its text as paragraphs; blanks and non-objects are skipped."""
    schema = "struct<segments:array<struct<start:string,end:string,text:string>>,text:string>"
    parsed = F.from_json(content, schema)
    real = F.filter(parsed["segments"], lambda s: F.coalesce(F.trim(s["text"]) != "", F.lit(False)))
    timed = F.transform(real, lambda s: F.struct(lenient_double(s["start"]).alias("start"), lenient_double(s["end"]).alias("end"), F.trim(s["text"]).alias("text")))
    none = F.lit(None).cast("double")
    plain = F.transform(paragraphs(F.coalesce(parsed["text"], F.lit(""))), lambda p: F.struct(none.alias("start"), none.alias("end"), p.alias("text")))
    return F.when(F.coalesce(F.size(timed), F.lit(0)) > 0, timed).otherwise(plain)


def chunk_records(chunks: DataFrame) -> DataFrame:
    """Adds ``error``, null for usable chunks: whole numbers, an excerpt, a hash that fits it."""
    whole = [F.col(c).try_cast("bigint") for c in ("chunk_index", "segment_start_idx", "segment_end_idx")]
    problem = (
        F.when(whole[0].isNull() | whole[1].isNull() | whole[2].isNull(), "bad_index").when(whole[1] > whole[2], "bad_range")
        .when(F.col("normalized_excerpt_path").isNull() | (F.trim("normalized_excerpt_path") == ""), "missing_path")
        .when(F.col("normalized_excerpt").isNull() | (F.trim("normalized_excerpt") == ""), "missing_excerpt")
        .when(F.col("normalized_excerpt_sha256").isNull(), "missing_hash").when(F.col("normalized_excerpt_sha256") != F.sha2("normalized_excerpt", 256), "hash_differs")
    )
    return chunks.withColumn("error", problem)


def largest_media(spark: SparkSession, folder: str) -> DataFrame:
    """Per file stem the largest file of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1)
    return files.where("length > 0").groupBy(stem.alias("video_id")).agg(F.max_by("path", F.struct("length", "path")).alias("media_path"), F.max("length").alias("media_size_bytes"))


def with_media(rows: DataFrame, media: DataFrame) -> DataFrame:
    """Media that is there already stands before freshly fetched media."""
    return rows.join(media.withColumnRenamed("media_path", "fetched"), "video_id", "left").withColumn("media_path", F.coalesce("media_path", "fetched")).drop("fetched")


def numbered_lines(lines: DataFrame, key: str, order: Column) -> DataFrame:
    """Position of each row within its key."""
    return lines.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(order)))
