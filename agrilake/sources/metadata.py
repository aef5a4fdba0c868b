"""Run metadata: append-only logs; the latest entry of a pipeline is its state."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrilake.operators.silver import latest_per_key
from agrilake.schemas import DATASET_METRICS, INGESTED_FILES, PIPELINE_STATE, RUN_LOG, STEP_PROGRESS
from agrilake.sources.landed import FILE
from agrilake.sources.reading import read_or_none

_STATE_KEY = ["pipeline_name", "source"]
RECENT_RUNS = 5


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class PipelineState:
    pipeline_name: str
    source: str
    last_successful_execution: str | None = None
    last_ingested_date: str | None = None
    records_processed: int = 0
    status: str = "never_run"
    execution_time: float = 0.0


class MetadataStore:
    """Every write appends one line, so a crash can lose an entry but never an earlier one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _append(self, log: str, schema: T.StructType, entry: dict[str, Any]) -> None:
        row = [entry.get(name) for name in schema.fieldNames()]
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(f"{self.root}/{log}")

    def _read(self, log: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{log}"
        found = read_or_none(lambda: self.spark.read.schema(schema).json(path))
        return self.spark.createDataFrame([], schema) if found is None else found

    def states(self) -> DataFrame:
        """Latest state of every pipeline."""
        log = self._read("pipeline_state", PIPELINE_STATE)
        return latest_per_key(log, _STATE_KEY, [F.col("saved_at").desc_nulls_last()]).orderBy(*_STATE_KEY)

    def load(self, pipeline_name: str, source: str) -> PipelineState:
        mine = (F.col("pipeline_name") == pipeline_name) & (F.col("source") == source)
        found = self._read("pipeline_state", PIPELINE_STATE).where(mine).orderBy(F.desc("saved_at")).limit(1).collect()
        if not found:
            return PipelineState(pipeline_name, source)
        values = found[0].asDict()
        values.pop("saved_at")
        return PipelineState(**{name: value for name, value in values.items() if value is not None})

    def save(self, state: PipelineState) -> None:
        self._append("pipeline_state", PIPELINE_STATE, {**state.__dict__, "saved_at": _now()})

    def record_success(
        self, pipeline_name: str, source: str, last_ingested: dt.date, records: int, seconds: float
    ) -> None:
        now, day = _now().isoformat(), last_ingested.isoformat()
        self.save(PipelineState(pipeline_name, source, now, day, records, "success", seconds))

    def new_files(self, pipeline_name: str, landed: DataFrame) -> DataFrame:
        """Landed files that the pipeline isn't done with, and ``through``, the last day already taken from them.

        A file that is delivered again under its name, at another time or of another size, is new.
        """
        log = self._read("ingested_files", INGESTED_FILES).where(F.col("pipeline_name") == pipeline_name)
        latest = latest_per_key(log, FILE, [F.col("saved_at").desc_nulls_last()]).select(*FILE, "done", "through")
        return landed.join(latest, FILE, "left").where(~F.coalesce("done", F.lit(False))).select(*FILE, "through")

    def append_files(self, pipeline_name: str, files: DataFrame) -> None:
        """Notes for each file whether the pipeline is done with it, and the last day taken from it."""
        stamps = [F.lit(pipeline_name).alias("pipeline_name"), F.lit(_now()).alias("saved_at")]
        files.select(*FILE, "done", "through", *stamps).write.mode("append").json(f"{self.root}/ingested_files")

    def pending(self, step: str, items: DataFrame) -> tuple[list[tuple[str, int]], bool]:
        """The (item, written_at) the step isn't done with as they are now, and whether it broke in one of them."""
        log = self._read("step_progress", STEP_PROGRESS).where(F.col("step") == step)
        latest = latest_per_key(log, ["item"], [F.col("saved_at").desc_nulls_last()])
        notes = latest.select("item", "status", F.col("written_at").alias("noted_at"))
        done = F.coalesce((F.col("status") == "done") & (F.col("noted_at") == F.col("written_at")), F.lit(False))
        # runs or months written since the step's last time
        waiting = items.join(notes, "item", "left").where(~done).collect()
        return sorted((r["item"], r["written_at"]) for r in waiting), any(r["status"] == "started" for r in waiting)

    def note(self, step: str, items: list[tuple[str, int]], status: str) -> None:
        """The step's ``status`` with these (item, written_at)."""
        now = _now()
        entries = [(step, item, status, written_at, now) for item, written_at in items]
        notes = self.spark.createDataFrame(entries, STEP_PROGRESS).coalesce(1)
        notes.write.mode("append").json(f"{self.root}/step_progress")

    def append_run(self, execution_id: str, **figures: Any) -> None:
        self._append("runs", RUN_LOG, {"pipeline_execution_id": execution_id, **figures})

    def append_dataset_metric(
        self, execution_id: str, dataset: str, layer: str, records: int, status: str = "success", **extra: Any
    ) -> None:
        entry = {
            "pipeline_execution_id": execution_id,
            "dataset": dataset,
            "layer": layer,
            "records": records,
            "status": status,
            "measured_at": _now().isoformat(),
            "extra": {name: str(value) for name, value in extra.items()},
        }
        self._append("dataset_metrics", DATASET_METRICS, entry)

    def dataset_metrics(self) -> DataFrame:
        return self._read("dataset_metrics", DATASET_METRICS)

    def recent_runs(self, k: int = RECENT_RUNS) -> DataFrame:
        """The last k runs, oldest of them first."""
        newest = [F.col("finished_at").desc_nulls_last(), F.desc("pipeline_execution_id")]
        last = self._read("runs", RUN_LOG).orderBy(*newest).limit(k)
        return last.orderBy(F.col("finished_at").asc_nulls_first(), "pipeline_execution_id")

    def status(self) -> dict[str, Any]:
        """State of every pipeline and the last runs, for display."""
        pipelines = [row.asDict() for row in self.states().collect()]
        runs = [row.asDict() for row in self.recent_runs().collect()]
        return {
            "pipelines": pipelines,
            "recent_runs": runs,
            "pipeline_count": len(pipelines),
            "recent_run_count": len(runs),
        }
