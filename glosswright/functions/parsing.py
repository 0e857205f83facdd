"""Parsing of model answers, identifiers and loosely typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:string>>"
#: The marks between which answers stand.
MARKS = {
    "normalize": ("<<<NORMALIZED_TRANSCRIPT_START>>>", "<<<NORMALIZED_TRANSCRIPT_END>>>"),
    "talk": ("<<<TALK_CHAT_START>>>", "<<<TALK_CHAT_END>>>"),
    "edit": ("<<<EDIT_OUTPUT_START>>>", "<<<EDIT_OUTPUT_END>>>"),
}
#: Meta text that a clean transcript must not hold.
BANNED = ("here is the cleaned transcript", "here’s the cleaned transcript", "cleaned transcript:", "---", "note:")


def between(text: Column, start: str, end: str) -> Column:
    """struct<value, error>; the text after the first start mark up to the next end mark, trimmed."""
    head = F.locate(start, text)
    rest = F.substring(text, head + F.lit(len(start)), F.length(text))
    tail = F.locate(end, rest)
    body = F.regexp_replace(F.substring(rest, F.lit(1), tail - 1), r"^\s+|\s+$", "")
    error = F.when(text.isNull() | (head == 0), "missing_start").when(tail == 0, "missing_end").when(body == "", "empty")
    return F.struct(F.when(error.isNull(), body).alias("value"), error.alias("error"))


def banned_phrase(text: Column) -> Column:
    """The first banned phrase that the text holds in any case, else null."""
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for p in BANNED])


def chat_messages(payload: Column, turn_pairs: int) -> Column:
    """struct<messages, error> of a JSON object with turn_pairs alternating user and assistant turns."""
    variant = F.try_parse_json(payload)
    is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
    listed = F.try_variant_get(variant, "$.messages", "array<variant>")
    raw = F.from_json(payload, f"struct<messages:{MESSAGES}>")["messages"]
    clean = F.transform(raw, lambda m: F.struct(F.trim(F.coalesce(m["role"], F.lit(""))).alias("role"), F.trim(F.coalesce(m["content"], F.lit(""))).alias("content")))
    at = F.transform(clean, lambda m, i: F.struct(m["role"].alias("role"), m["content"].alias("content"), i.alias("i")))
    wrong_role = F.exists(at, lambda m: m["role"] != F.when(m["i"] % 2 == 0, "user").otherwise("assistant"))
    blank = F.exists(at, lambda m: m["content"] == "")
    error = (
        F.when(variant.isNull(), "bad_json").when(~is_object, "not_an_object").when(listed.isNull(), "missing_messages")
        .when(F.size(listed) != 2 * turn_pairs, "wrong_count").when(F.exists(raw, lambda m: m.isNull()), "message_not_an_object").when(wrong_role, "wrong_role").when(blank, "blank_content")
    )
    return F.struct(F.when(error.isNull(), clean).alias("messages"), error.alias("error"))


def fill(template: str, **values: Column) -> Column:
    """A prompt template with {names} filled in; doubled braces stand for single ones."""
    parts, rest = [], template
    while rest:
        at = min((i for i in (rest.find("{"), rest.find("}")) if i >= 0), default=-1)
        if at < 0:
            parts.append(F.lit(rest))
            break
        if rest[at : at + 2] in ("{{", "}}"):
            parts.append(F.lit(rest[: at + 1]))
            rest = rest[at + 2 :]
            continue
        close = rest.find("}", at)
        if rest[at] == "}" or close < 0:
            raise ValueError("single brace in template")
        parts += [F.lit(rest[:at]), F.coalesce(values[rest[at + 1 : close]].cast("string"), F.lit(""))]
        rest = rest[close + 1 :]
    return F.concat(*parts) if parts else F.lit("")


def lenient_double(value: Column) -> Column:
    """Null where the value is no number. (1_000 is no number here; Java's suffixes d and f are cut off.)"""
    return F.when(~value.cast("string").rlike(r"[dDfF]\s*$"), value.try_cast("double"))


def strict_int(value: Column, field: str) -> Column:
    """Fails the query where the value is null or no whole number."""
    number = value.try_cast("bigint")
    return F.coalesce(number, F.raise_error(F.concat(F.lit(f"{field} is not an integer: "), F.coalesce(value.cast("string"), F.lit("null")))).cast("bigint"))


def paragraphs(text: Column) -> Column:
    """Parts between blank lines, trimmed, blanks dropped."""
    parts = F.split(text, r"\n\s*\n+")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")


#: Where the 11 characters of a video id stand in an address, in order of preference.
VIDEO_ID_IN_URL = (r"(?:v=|/)([0-9A-Za-z_-]{11})(?:[&?]|$)", r"youtu\.be/([0-9A-Za-z_-]{11})", r"embed/([0-9A-Za-z_-]{11})")


def video_id_of_url(url: Column) -> Column:
    """Null where no pattern fits."""
    return F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in VIDEO_ID_IN_URL])


def transcript(source: Column, language: Column, segments: Column) -> Column:
    """A transcript as one struct; its text is that of its segments, one line each."""
    spoken = F.filter(F.transform(segments, lambda s: F.trim(s["text"])), lambda t: t != "")
    return F.struct(source.alias("source"), language.alias("language"), segments.alias("segments"), F.array_join(spoken, "\n").alias("text"))


def stage_entry(status: Column, metrics: Column) -> Column:
    """What a profile keeps of a stage; fails the query where the metrics are missing."""
    return F.struct(F.coalesce(status, F.lit("unknown")).alias("status"), F.when(metrics.isNull(), F.raise_error(F.lit("stage without metrics"))).otherwise(metrics).alias("metrics"))


def metrics_or_reason(status: Column, metrics: Column, reason: Column) -> Column:
    """K5: metrics as JSON; a row without any gives its reason."""
    return F.coalesce(F.to_json(metrics), F.when(status.isin("skipped", "failed"), F.to_json(F.struct(reason.alias("skip_reason")))))
