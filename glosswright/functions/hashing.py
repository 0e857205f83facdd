"""Hashes, stable fingerprints of records and deterministic sampling (H1 to H6)."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_hash(text: Column) -> Column:
    """H1."""
    return F.sha2(text, 256)


def file_hash(path: str | Path) -> str:
    """H1 for a file, read in blocks."""
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def record_json(**fields: Column) -> Column:
    """Compact JSON of the fields in order of their names, nulls included."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def record_hash(**fields: Column) -> Column:
    """H2: fingerprint of a record. Engines print floats differently: hash strings, integers and booleans."""
    return F.sha2(record_json(**fields), 256)


def plain_hash(value: object) -> str:
    """H2 on the driver, for settings."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str).encode()).hexdigest()


def unit_interval(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1]."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


def chosen(probability: float, **key: Column) -> Column:
    """H3: the same coin for the same key everywhere; never at 0 and always at 1."""
    if probability <= 0:
        return F.lit(False)
    if probability >= 1:
        return F.lit(True)
    return unit_interval(record_hash(**key)) < probability


def input_hash(settings: object, version: str, **fields: Column) -> Column:
    """H4: what a stage's result for an item depends on: its inputs, the stage's version and settings."""
    return record_hash(settings=F.lit(plain_hash(settings)), version=F.lit(version), **fields)
