"""Stages over a manifest table (C1 to C8, P15, P16, K8): run what changed, record how it ended."""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswright.operators import tables
from glosswright.plans.config import STAGES, Settings
from glosswright.plans.stages import Services, stage_functions
from glosswright.sources.writers import write_json

MANIFEST = "stage string, item_id string, status string, input_hash string, updated_at timestamp, reason string"
log = logging.getLogger("glosswright")


@dataclass
class Manifest:
    """A keyed table of outcomes, appended once per stage; the newest row of an item counts."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        if "://" not in self.path and not Path(self.path).exists():
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self.path)

    def stage(self, name: str) -> DataFrame:
        return tables.latest(self.rows().where(F.col("stage") == name), "item_id", F.col("updated_at"))

    def misses(self, name: str, items: DataFrame) -> DataFrame:
        return tables.cache_misses(items, self.stage(name))

    def mark(self, name: str, outcomes: DataFrame) -> None:
        """outcomes: item_id, status, input_hash, reason."""
        rows = outcomes.select(F.lit(name).alias("stage"), "item_id", "status", "input_hash", F.current_timestamp().alias("updated_at"), "reason")
        rows.write.mode("append").parquet(self.path)

    def report(self, name: str) -> DataFrame:
        return tables.stage_report(self.stage(name))


@dataclass
class Run:
    """Folders and status of one run."""

    root: Path
    run_id: str
    settings: Settings
    status: dict[str, str] = field(default_factory=dict)

    @classmethod
    def create(cls, root: str | Path, settings: Settings) -> Run:
        now = dt.datetime.now(dt.timezone.utc)
        run_id, base = now.strftime("%Y%m%d_%H%M%S"), Path(root)
        while (base / run_id).exists():
            now += dt.timedelta(seconds=1)
            run_id = now.strftime("%Y%m%d_%H%M%S")
        run = cls(base, run_id, settings)
        run.save("running")
        return run

    @classmethod
    def find(cls, root: str | Path, settings: Settings | None = None) -> dict | None:
        """The newest run's record; with settings the newest of these that has not completed."""
        found = [json.loads(p.read_text("utf-8")) for p in Path(root).glob("*/run.json")]
        if settings is not None:
            found = [r for r in found if r["config_hash"] == settings.fingerprint() and r["status"] in ("running", "failed")]
        return max(found, key=lambda r: (r["updated_at"], r["run_id"]), default=None)

    @classmethod
    def resolve(cls, root: str | Path, settings: Settings, run_id: str | None = None) -> Run:
        """The named run, else one to resume, else a new one."""
        if run_id is not None:
            record = json.loads((Path(root) / run_id / "run.json").read_text("utf-8"))
        else:
            record = cls.find(root, settings)
        return cls(Path(root), record["run_id"], settings, record["stage_status"]) if record else cls.create(root, settings)

    def stage_folder(self, stage: str) -> str:
        return str(self.root / self.run_id / "stages" / stage)

    def overall(self) -> str:
        if "failed" in self.status.values():
            return "failed"
        return "completed" if all(self.status.get(s) == "completed" for s in STAGES) else "running"

    def save(self, status: str | None = None) -> None:
        stamp = dt.datetime.now(dt.timezone.utc).isoformat()
        write_json(self.root / self.run_id / "run.json", {"run_id": self.run_id, "updated_at": stamp, "status": status or self.overall(), "config_hash": self.settings.fingerprint(), "stage_status": self.status})


Stage = Callable[[SparkSession, Run, Manifest], None]


def run_stages(spark: SparkSession, run: Run, manifest: Manifest, stages: dict[str, Stage] | None = None, names: tuple[str, ...] = STAGES, services: Services | None = None) -> dict[str, dict]:
    """C4: the named stages in order, those of plans/stages unless given. A disabled stage completes with nothing; a stage that fails,
    or fails for too many items, ends the run (P15, P16)."""
    reports: dict[str, dict] = {}
    stages = {**stage_functions(services), **(stages or {})}
    for name in names:
        if not run.settings.enabled(name):
            run.status[name], reports[name] = "completed", {"total": 0, "success": 0, "failed": 0, "skipped": 0}
            continue
        run.status[name] = "running"
        run.save()
        try:
            stages[name](spark, run, manifest)
            r = manifest.report(name).first()
            reports[name] = r.asDict()
            rate = r.failed / r.total if r.total else 0.0
            if rate > run.settings.pipeline.max_failure_rate or (r.failed and not run.settings.pipeline.continue_on_error):
                raise RuntimeError(f"stage {name}: {r.failed} of {r.total} items failed")
        except Exception:
            run.status[name] = "failed"
            run.save()
            raise
        run.status[name] = "completed"
        log.info("stage %s: %s", name, reports[name])
        run.save()
    return reports
