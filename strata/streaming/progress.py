"""Progress documents for batch consumers of a table's increments.

Structured Streaming keeps its own progress in ``checkpointLocation``; these documents serve
the batch jobs.  One document per run, never rewritten:

    <root>/<consumer>/runs/<k>.json
      # fixed values: the keys of the document
      {"consumer", "run", "sources": {name: {"table_name", "path", "last_processed_commit"}},
       "inserted_time"}

Progress is keyed by (consumer, source), so two consumers of one table never share it, and a
job writes its document only *after* its sink commit: a failure in between re-reads the same
increment, and the keyed upsert behind it makes that harmless.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from strata.sources.fs import Fs


class Progress:
    def __init__(self, spark: SparkSession, root: str, consumer: str):
        self.fs = Fs(spark)
        self.consumer = consumer
        self.dir = f"{root.rstrip('/')}/{consumer}"

    def _runs(self) -> list[int]:
        return sorted(int(n[:-5]) for n, *_ in self.fs.children(f"{self.dir}/runs")
                      if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> dict | None:
        """The latest document, or None when the consumer never ran (or was reset)."""
        runs = self._runs()
        if not runs:
            return None
        return json.loads(self.fs.read_text(f"{self.dir}/runs/{runs[-1]}.json"))

    def last_processed(self, source: str) -> int | None:
        doc = self.read()
        if not doc or source not in doc["sources"]:
            return None
        return doc["sources"][source]["last_processed_commit"]

    def next_run(self) -> int:
        runs = self._runs()
        return runs[-1] + 1 if runs else 0

    def generation(self) -> int:
        """How often this consumer was reset; part of every tag, so that a run after a reset is
        never taken for a retry of an old one."""
        txt = self.fs.read_text(f"{self.dir}/generation")
        return int(txt) if txt else 0

    def write(self, sources: dict[str, dict]) -> dict:
        """Persist progress; ``sources`` maps a source name to its table name, path and commit."""
        run = self.next_run()
        doc = {
            "consumer": self.consumer,
            "run": run,
            "sources": sources,
            "inserted_time": datetime.now(timezone.utc).isoformat(),
        }
        self.fs.write_text(f"{self.dir}/runs/{run}.json", json.dumps(doc))
        return doc

    def reset(self) -> None:
        """Forget all progress: the next run reprocesses from the beginning."""
        following = self.generation() + 1
        self.fs.delete(f"{self.dir}/runs")
        self.fs.delete(f"{self.dir}/pending")
        self.fs.write_text(f"{self.dir}/generation", str(following))
