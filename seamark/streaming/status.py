"""What streaming queries are doing, as rows and as a file that a health check reads.

A listener on the driver keeps one row for each query: its state, its last batch and that batch's numbers, sums since
it started, and the counters that its plan observes. Each change is written to ``path``, a JSON file of the driver's machine,
under another name first, so a reader never meets half of it.
"""

from __future__ import annotations

import json
import os
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, id string, state string, batch long, started_ms long, at_ms long, rows long, rows_total long, rows_per_second double, batch_ms long, error string, observed map<string,string>"


class StatusListener(StreamingQueryListener):
    def __init__(self, path: str):
        self.path, self.queries, self.lock = path, {}, threading.Lock()

    def change(self, key: str, **values) -> None:
        with self.lock:
            row = self.queries.setdefault(key, {"query": None, "id": key, "state": "running", "batch": None, "started_ms": now_ms(), "rows": 0, "rows_total": 0, "rows_per_second": 0.0, "batch_ms": 0, "error": None, "observed": {}})
            row |= values | {"at_ms": now_ms(), "rows_total": row["rows_total"] + values.get("rows", 0)}
            with open(f"{self.path}.part", "w") as file:
                json.dump({"queries": list(self.queries.values())}, file)
            os.replace(f"{self.path}.part", self.path)

    def onQueryStarted(self, event) -> None:  # noqa: N802  Spark's names
        self.change(str(event.id), query=event.name, state="running", started_ms=now_ms(), error=None)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        told = event.progress
        observed = {f"{name}.{field}": str(value) for name, row in (told.observedMetrics or {}).items() for field, value in row.asDict().items()}
        rate = told.processedRowsPerSecond
        self.change(str(told.id), query=told.name, batch=told.batchId, rows=told.numInputRows, rows_per_second=rate if rate == rate else 0.0, batch_ms=int(told.durationMs.get("triggerExecution", 0)), observed=observed)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.change(str(event.id))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.change(str(event.id), state="failed" if event.exception else "ended", error=event.exception)

    def rows(self, spark: SparkSession) -> DataFrame:
        with self.lock:
            return spark.createDataFrame([{**row} for row in self.queries.values()], SCHEMA)


def now_ms() -> int:
    return int(time.time() * 1000)


def problems(path: str, stale_ms: int, at_ms: int | None = None) -> list[str]:
    """Why the queries that the file tells of aren't healthy; empty if they are."""
    at_ms = now_ms() if at_ms is None else at_ms
    try:
        with open(path) as file:
            queries = json.load(file)["queries"]
    except (OSError, ValueError, KeyError) as error:
        return [f"no status: {error}"]
    found = [] if queries else ["no query has started"]
    for q in queries:
        name = q["query"] or q["id"]
        if q["state"] == "failed":
            found.append(f"{name} failed: {q['error'] or ''}"[:500])
        elif q["state"] == "running" and at_ms - q["at_ms"] > stale_ms:
            found.append(f"{name} has told nothing for {(at_ms - q['at_ms']) // 1000} s")
    return found
