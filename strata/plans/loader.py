"""Declarative source loader: ``[{table_name, path, type: FULL | INC}]`` -> named views.

FULL  the table's snapshot
INC   rows changed since this consumer's last processed commit (first run: everything)

INC progress is *not* advanced here: call ``Loaded.commit()`` after the sink write, so a
failure in between re-reads the same increment instead of losing it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.sources.table import KeyedTable, open_table
from strata.streaming.progress import Progress

# The load types of a loader entry.
TYPES = ("FULL", "INC")


@dataclass
class Loaded:
    views: dict[str, DataFrame]
    progress: Progress | None = None
    pending: dict[str, dict] = field(default_factory=dict)
    tables: list[tuple[KeyedTable, int]] = field(default_factory=list)

    def commit(self) -> dict | None:
        """Record the INC sources as processed up to the commit each one was read at."""
        if self.progress is None or not self.pending:
            return None
        doc = self.progress.write(self.pending)
        for table, done in self.tables:
            table.passed(f"{self.progress.dir}", done)
        return doc


def load_sources(spark: SparkSession, sources: list[dict], progress_root: str | None = None,
                 consumer: str = "loader") -> Loaded:
    for s in sources:
        if s.get("type") not in TYPES:
            raise ValueError(f"unknown load type {s.get('type')!r} for {s.get('table_name')!r}; expected {TYPES}")
    progress = Progress(spark, progress_root, consumer) if progress_root else None
    views: dict[str, DataFrame] = {}
    pending: dict[str, dict] = {}
    tables: list[tuple[KeyedTable, int]] = []
    for s in sources:
        name, path = s["table_name"], s["path"]
        table = open_table(spark, path)
        if s["type"] == "FULL":
            df = table.snapshot()
        else:
            if progress is None:
                raise ValueError("INC sources need a progress_root")
            last = table.last_commit()
            since = progress.last_processed(name)
            if since is None:
                # a first read is the snapshot: complete even where old log commits are gone
                df = table.snapshot()
            elif last is None or last <= since:
                df = table.snapshot().limit(0)
            else:
                df = table.increment(since, until=last)
            if last is not None:
                done = last if since is None else max(last, since)
                pending[name] = {"table_name": name, "path": path, "last_processed_commit": done}
                tables.append((table, done))
        df.createOrReplaceTempView(name)
        views[name] = df
    return Loaded(views, progress, pending, tables)
