"""Sinks (K1 to K9): JSON lines, sorted rows, metric projections and small driver files."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswright.functions.parsing import metrics_or_reason


def write_json_lines(rows: DataFrame, path: str, append: bool = False, partition_by: list[str] | None = None) -> None:
    """K1, K2, K7: nulls are written, so that every line has every field."""
    writer = rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_sorted(rows: DataFrame, path: str, *keys: str) -> None:
    """K4: files in order of the keys: ranges by key, sorted within."""
    rows.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def metric_rows(rows: DataFrame) -> DataFrame:
    """K5: video_id, title, status, metrics; rows without metrics give their reason."""
    reason = F.coalesce("skip_reason", "error") if "error" in rows.columns else F.col("skip_reason")
    return rows.select("video_id", "title", "status", metrics_or_reason(F.col("status"), F.col("metrics"), reason).alias("metrics"))


def write_decisions(decisions: DataFrame, folder: str) -> None:
    """K6: decisions once, then kept and dropped from what was written, so that nothing is computed three times."""
    decisions.write.mode("overwrite").parquet(f"{folder}/decisions")
    written = decisions.sparkSession.read.parquet(f"{folder}/decisions")
    for status in ("kept", "dropped"):
        written.where(F.col("status") == status).write.mode("overwrite").parquet(f"{folder}/{status}")


def write_json(path: str | Path, value: object) -> None:
    """K3, K8, K9: a small JSON file, sorted keys, replaced in one step."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True)
        os.replace(name, target)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise
