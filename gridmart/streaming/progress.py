"""What streams report of themselves, as a table (T6): freshness without reading the data again."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.quality import freshness
from ..sources.sinks import exists

LOADS = "loads"
SCHEMA = (
    "stream string, name string, batch long, at timestamp, rows long, dropped long, "
    "max_loaded_at timestamp_ntz, max_event_at timestamp_ntz"
)


def observed(rows: DataFrame, loaded_at: str = "_loaded_at", event_at: str = "event_timestamp") -> DataFrame:
    """The same rows; each micro-batch reports the newest load and event time among them."""
    newest = F.max(loaded_at).cast("string").alias("max_loaded_at")
    return rows.observe(LOADS, newest, F.max(event_at).cast("string").alias("max_event_at"))


class ProgressLog(StreamingQueryListener):
    """Writes a small JSON file per micro-batch of every query of the session, named after stream and
    batch, so that a repeated batch replaces its own. Register it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended = threading.Condition()
        self.runs: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(LOADS)
        row = {
            "stream": str(progress.id),
            "name": progress.name,
            "batch": progress.batchId,
            "at": progress.timestamp,
            "rows": progress.numInputRows,
            "dropped": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
            "max_loaded_at": found and found["max_loaded_at"],
            "max_event_at": found and found["max_event_at"],
        }
        self._write(f"{self.path}/{progress.id}-{progress.batchId}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.runs.add(str(event.runId))
            self.ended.notify_all()

    def wait_for(self, query, seconds: float = 60) -> bool:
        """Until all that ``query``, which has ended, reported is written."""
        with self.ended:
            return self.ended.wait_for(lambda: str(query.runId) in self.runs, seconds)

    def _write(self, path: str, text: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row per micro-batch; empty before the first."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def stream_freshness(progress: DataFrame, source: str, as_of: Column) -> DataFrame:
    """Age of the newest load that a stream has worked off, against the source's limits."""
    return freshness(progress, source, as_of, "max_loaded_at")
