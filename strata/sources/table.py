"""A keyed table on plain parquet: an append-only commit log plus folded base versions.

Layout under ``spec.path``::

    log/commit=<n>/[<partition cols>=...]/part-*.parquet    rows written by commit n
    packs/_pack=c<a>-<b>/part-*.parquet                     rows of the small commits a to b, in few files
    base/_v=<n>/_bucket=<b>/[<partition cols>=...]/...        current rows, by hash of the key
    _meta/commits/<n>.<method>.<tag hash>                    commit n is visible (written last)
    _meta/bases/<n>                                          base n: which version holds each bucket
    _meta/fields/<n>                                         columns of the files of base n, in their order
    _meta/packs/<a>-<b>-<n>                                  the pack of commits a to b was complete at commit n
    _meta/tags/<consumer hash>                               last commit of a tagged writer
    _meta/consumers/<consumer hash>                          how far a reader has read the log
    _meta/schema.json, _meta/spec.json, _meta/expired

Readers only see commits whose marker exists.  A batch that failed before its marker leaves a
``commit=<n>`` directory that the next commit overwrites.  A retry carries the same tag, which
is found among the markers (or, for older commits, in the writer's tag file) and does nothing.
Nothing is overwritten while the same plan reads it: a fold always goes to a *new* version.

copy-on-write  every commit folds the buckets that its keys fall in into ``base/_v=<n>``; the
               other buckets stay where they are
merge-on-read  every write method only appends to the log; reads fold ``base ∪ log tail``, and
               a base is written every ``compact_every`` commits.  Both give the same rows.

event-time tables keep tombstones: a delete takes part in the choice of the winner with its own time
               (or, without one, the time of the row it removes), so that a late row older than the
               delete does not revive the key.  In a base they lie beside the rows, in buckets
               ``-1 - b``, which readers of rows never open.

Old bases and log commits are removed after each commit, once it is visible: the newest
``keep_versions`` bases stay, and log commits stay while they are among the newest
``keep_commits``, are not folded yet, or a registered reader has not passed them.
"""

from __future__ import annotations

import bisect
import contextlib
import dataclasses
import hashlib
import json
import math
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, LongType, StructField, StructType

from strata.operators import merge, versions
from strata.sources.fs import Fs
from strata.spec import CLUSTER_SMALL_BYTES, CLUSTER_TARGET_BYTES, COMMIT, DELETED, METHODS, TableSpec

BUCKET = "_bucket"
VERSION = "_v"
PACK = "_pack"
_RESERVED = (COMMIT, DELETED, BUCKET, VERSION, PACK)
_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}
# lossless casts accepted on write: stored type <- incoming types
_WIDENS = {"smallint": ("tinyint",), "int": ("tinyint", "smallint"), "bigint": ("tinyint", "smallint", "int"),
           "double": ("float", "int", "smallint", "tinyint"), "timestamp_ntz": ("date",), "string": ("void",)}
# types whose exact bounds stand in parquet footers, as Spark's aggregate push-down takes them; floating-point
# bounds are missing there when a file holds NaN
_FOOTER_BOUNDS = ("boolean", "tinyint", "smallint", "int", "bigint", "date")
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Fixed value: rows that one task sorts when it rewrites files, as bytes in memory
SORT_BYTES = 512 * 1024 * 1024


MERGE = "merge"  # an upsert that removes other keys in the same commit
# how the rows of a write method lie in the log
_LOGGED = {"insert_if_absent": "insert", "bulk_insert": "insert", MERGE: "upsert"}


def _home(bucket: int) -> int:
    """The bucket of a base directory; tombstones of bucket b lie in ``-1 - b``."""
    return bucket if bucket >= 0 else -1 - bucket


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()[:16]


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: exact for text and binary, fixed for the rest."""
    fixed, texts = 0, []
    for name, t in df.dtypes:
        if t in ("string", "binary"):
            texts.append(F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)).cast("long"))
        elif t.startswith(("array", "map", "struct")):
            texts.append(F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)).cast("long"))
        else:
            fixed += _WIDTH.get(t, 8)
    total = F.lit(fixed).cast("long")
    for t in texts:
        total = total + t
    return total


def _sort_bytes(df: DataFrame) -> Column:
    """Bytes of a row in a sort: words for the fields and the null bits, the pointers that are sorted, texts at their
    length."""
    n = len(df.columns)
    texts = df.select(*[f"`{name}`" for name, t in df.dtypes if t in ("string", "binary") or t.startswith(("array", "map", "struct"))])
    return F.lit(8 * n + 8 * math.ceil(n / 64) + 40 + 7 * len(texts.columns)).cast("long") + _row_bytes(texts)


class KeyedTable:
    def __init__(self, spark: SparkSession, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.fs = Fs(spark)
        self.root = spec.path.rstrip("/")
        self.log_dir = f"{self.root}/log"
        self.pack_dir = f"{self.root}/packs"
        self.base_dir = f"{self.root}/base"
        self.meta = f"{self.root}/_meta"

    # ------------------------------------------------------------------ metadata (driver, tiny)
    def _markers(self) -> dict[int, tuple[str, str]]:
        """commit -> (method, tag hash), ascending; one listing."""
        out = {}
        for name, *_ in self.fs.children(f"{self.meta}/commits"):
            parts = name.split(".")
            if len(parts) == 3 and parts[0].isdigit():
                out[int(parts[0])] = (parts[1], parts[2])
        return dict(sorted(out.items()))

    def commits(self) -> list[int]:
        """Visible commits whose markers are kept, ascending."""
        return list(self._markers())

    def log_methods(self, since: int | None = None, until: int | None = None, markers=None) -> dict[int, str]:
        """Visible commits in (since, until] that wrote rows into the log, with their method."""
        markers = self._markers() if markers is None else markers
        expired = self.expired_before()
        return {c: m for c, (m, _) in markers.items()
                if m != "cluster" and (expired is None or c > expired) and (since is None or c > since) and (until is None or c <= until)}

    def log_commits(self) -> list[int]:
        return list(self.log_methods())

    def base_versions(self, markers=None) -> list[int]:
        """Complete bases of visible commits, ascending."""
        markers = self._markers() if markers is None else markers
        if not markers:
            return []
        last = max(markers)
        return sorted(int(n) for n, *_ in self.fs.children(f"{self.meta}/bases") if n.isdigit() and int(n) <= last)

    def _all_packs(self) -> dict[tuple[int, int], int]:
        """(first, last) commit of every complete pack -> the commit it was made at; a wider one comes
        before those it replaced."""
        names = [name.split("-") for name, *_ in self.fs.children(f"{self.meta}/packs")]
        found = {(int(x[0]), int(x[1])): int(x[2]) for x in names if len(x) == 3 and all(map(str.isdigit, x))}
        return dict(sorted(found.items(), key=lambda p: (p[0][0], -p[0][1])))

    def packs(self) -> list[tuple[int, int]]:
        """(first, last) commit of the packs that readers use, ascending and apart."""
        out: list[tuple[int, int]] = []
        for first, last in self._all_packs():
            if not out or first > out[-1][1]:
                out.append((first, last))
        return out

    def _pack_path(self, pack: tuple[int, int]) -> str:
        return f"{self.pack_dir}/{PACK}=c{pack[0]}-{pack[1]}"

    def _placed(self, commits) -> tuple[list[int], list[tuple[int, int]]]:
        """Where log commits lie: those with a directory of their own, and the packs that hold the others."""
        packs = self.packs()
        used, loose = {}, []
        for c in commits:
            at = bisect.bisect_right(packs, (c, math.inf)) - 1
            if at >= 0 and c <= packs[at][1]:
                used[packs[at]] = True
            else:
                loose.append(c)
        return loose, list(used)

    def last_commit(self) -> int | None:
        markers = self._markers()
        return max(markers) if markers else None

    def expired_before(self) -> int | None:
        txt = self.fs.read_text(f"{self.meta}/expired")
        return int(txt) if txt else None

    def schema(self) -> StructType | None:
        txt = self.fs.read_text(f"{self.meta}/schema.json")
        return StructType.fromJson(json.loads(txt)) if txt else None

    def exists(self) -> bool:
        return self.last_commit() is not None

    def _save_schema(self, incoming: StructType) -> StructType:
        current = self.schema()
        fields = list(current.fields) if current else []
        names = {f.name for f in fields}
        for f in incoming.fields:
            if f.name not in names:
                fields.append(StructField(f.name, f.dataType, True))
                names.add(f.name)
        for extra in (StructField(COMMIT, LongType(), True), StructField(DELETED, BooleanType(), True)):
            if extra.name not in names:
                fields.append(extra)
                names.add(extra.name)
        merged = StructType(fields)
        if current is None or merged != current:
            self.fs.write_text(f"{self.meta}/schema.json", merged.json())
        return merged

    def _aligned(self, batch: DataFrame) -> DataFrame:
        """The batch in the table's types; anything but a lossless widening is refused before
        a file is written."""
        clash = [c for c in _RESERVED if c in batch.columns]
        if clash:
            raise ValueError(f"column(s) {clash} are reserved by the table; rename or drop them")
        stored: dict[str, DataType] = {f.name: f.dataType for f in (self.schema() or StructType()).fields}
        columns = []
        for f in batch.schema.fields:
            want, have = stored.get(f.name, f.dataType).simpleString(), f.dataType.simpleString()
            if want != have and have not in _WIDENS.get(want, ()):
                raise ValueError(f"column {f.name!r} of {self.spec.name!r} is {want}, the batch has {have}")
            columns.append(F.col(f"`{f.name}`").cast(stored[f.name]).alias(f.name) if want != have else F.col(f"`{f.name}`"))
        return batch.select(*columns)

    # ------------------------------------------------------------------ reads
    def _empty(self) -> DataFrame:
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"table {self.spec.name!r} at {self.root} has no commits")
        return self.spark.createDataFrame([], schema)

    def _read(self, base_path: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema()).option("basePath", base_path).parquet(*paths)

    def log(self, since: int | None = None, until: int | None = None, markers=None) -> DataFrame:
        """Rows of the visible log commits in (since, until]; pruned to those directories."""
        expired = self.expired_before()
        if since is not None and expired is not None and since < expired:
            raise ValueError(f"log commits <= {expired} of {self.spec.name!r} were expired; "
                             f"a reader at {since} must restart from the snapshot")
        cs = self.log_methods(since, until, markers)
        if not cs:
            return self._empty()
        df = self._rows_of(list(cs))
        if since is not None:
            df = df.where(F.col(COMMIT) > F.lit(since))
        if until is not None:
            df = df.where(F.col(COMMIT) <= F.lit(until))
        return df

    def _rows_of(self, commits: list[int], place: str | None = None) -> DataFrame:
        """Rows of all log commits between the first and the last one given.  ``place``: a column that
        numbers the rows of every file, from a start by its path."""
        loose, packs = self._placed(commits)
        also = [(F.crc32("_metadata.file_path") + F.col("_metadata.row_index")).alias(place)] if place else []
        df = self._read(self.log_dir, [f"{self.log_dir}/commit={c}" for c in loose]).select("*", *also) if loose else None
        if packs:
            # a pack is in the order of its commits, so the range prunes inside its files
            packed = self._read(self.pack_dir, [self._pack_path(p) for p in packs]).select("*", *also).drop(PACK)
            packed = packed.where(F.col(COMMIT).between(min(commits), max(commits)))
            df = packed if df is None else df.unionByName(packed)
        return df

    def _manifest(self, version: int) -> dict[int, int]:
        """bucket -> version directory that holds its rows."""
        return {int(b): v for b, v in json.loads(self.fs.read_text(f"{self.meta}/bases/{version}")).items()}

    def base(self, version: int | None = None, buckets=None, markers=None, gone: bool = False) -> DataFrame | None:
        """Rows of a base (the newest), of some buckets only if asked; None without a base.
        ``gone``: with its tombstones (event-time tables)."""
        vs = self.base_versions(markers)
        if version is None:
            if not vs:
                return None
            version = vs[-1]
        elif version not in vs:
            raise ValueError(f"base version {version} of {self.spec.name!r} is not available")
        dirs = [f"{self.base_dir}/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(self._manifest(version).items())
                if (gone or b >= 0) and (buckets is None or _home(b) in buckets)]
        if not dirs:
            return self._empty()
        return self._read(self.base_dir, dirs).drop(VERSION, BUCKET)

    def _current(self, markers=None, as_of: int | None = None) -> DataFrame:
        """Current rows, with the commit column and no deleted keys."""
        return self._live(self._state(markers, as_of))

    def _state(self, markers=None, as_of: int | None = None, gone: bool = False) -> DataFrame:
        """Rows after commit ``as_of`` (the last one): the newest base up to it and the log after that base.
        ``gone``: with the tombstones that an event-time table keeps."""
        markers = self._markers() if markers is None else markers
        if not markers:
            return self._empty()
        vs = [v for v in self.base_versions(markers) if as_of is None or v <= as_of]
        m = vs[-1] if vs else None
        tail = self.log_methods(since=m, until=as_of, markers=markers)
        # tombstones of the base decide only against rows that come after it
        gone = self._timed and (gone or bool(tail))
        base = self.base(m, markers=markers, gone=gone) if m is not None else None
        if not tail:
            return base if base is not None else self._empty()
        return self._folded(base, self.log(since=m, until=as_of, markers=markers), tail)

    @property
    def _timed(self) -> bool:
        return self.spec.ordering == "event_time"

    def _folded(self, base: DataFrame | None, tail: DataFrame, methods: dict[int, str]) -> DataFrame:
        spec = self.spec
        methods = {c: _LOGGED.get(m, m) for c, m in methods.items()}
        return merge.fold_tail(base, tail, methods, spec.merge_keys, spec.precombine, spec.ordering, spec.partition_by,
                               unique=not self._holds_duplicates())

    def _holds_duplicates(self) -> bool:
        """Whether rows were ever written without looking at their keys."""
        return self.fs.exists(f"{self.meta}/duplicates")

    @staticmethod
    def _live(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(DELETED).isNull() | ~F.col(DELETED)) if DELETED in rows.columns else rows

    def snapshot(self, as_of: int | None = None) -> DataFrame:
        """Every current row (``select *`` of the table), with its commit stamp; ``as_of``: the rows as
        they were after that commit, as far back as retention reaches."""
        if as_of is None:
            return self._current().drop(DELETED)
        markers = self._markers()
        if not markers or as_of > max(markers) or as_of < 0:
            raise ValueError(f"{self.spec.name!r} has no commit {as_of}; its last one is {max(markers) if markers else None}")
        vs = [v for v in self.base_versions(markers) if v <= as_of]
        expired = self.expired_before()
        if expired is not None and (not vs or vs[-1] < min(expired, as_of)):
            raise ValueError(f"commit {as_of} of {self.spec.name!r} is beyond retention (log expired up to {expired}); "
                             f"bases kept: {self.base_versions(markers)}")
        return self._current(markers, as_of).drop(DELETED)

    def increment(self, since: int, until: int | None = None, with_deletes: bool = False) -> DataFrame:
        """Keys changed in commits (since, until], each at its latest version; rows of insert
        commits are all kept.  ``with_deletes`` adds the keys deleted in the range, marked in
        ``_is_deleted``."""
        spec = self.spec
        markers = self._markers()
        expired = self.expired_before()
        if expired is not None and since < expired:
            raise ValueError(f"log of {spec.name!r} was expired past {since}; restart from the snapshot")
        changed = self.log(since=since, until=until, markers=markers)
        methods = self.log_methods(since, until, markers)
        if spec.ordering == "arrival":
            out = self._folded(None, changed, methods) if methods else changed
            return out if with_deletes else self._live(out).drop(DELETED)
        # event_time: the newest base at or before ``until`` already holds the winner of every key up
        # to its commit.  Its rows in range stand unless the log after it has their key; the keys of
        # that log are settled against the base rows of the same keys.
        vs = [v for v in self.base_versions(markers) if until is None or v <= until]
        if not vs and expired is not None:
            raise ValueError(f"no base of {spec.name!r} reaches back to {until} and its log was expired up to {expired}")
        base = self.base(vs[-1], markers=markers, gone=True) if vs else None
        after = self.log_methods(since=vs[-1] if vs else None, until=until, markers=markers)
        in_range = F.col(COMMIT) > F.lit(since)
        if until is not None:
            in_range = in_range & (F.col(COMMIT) <= F.lit(until))
        if not after:
            out = base.where(in_range)
        else:
            tail = self.log(since=vs[-1] if vs else None, until=until, markers=markers)
            met = None
            if base is not None:
                met = merge.semi_join_keys(base, tail, spec.merge_keys, "left_semi")
            out = self._folded(met, tail, after).where(in_range)
            if base is not None and vs[-1] > since:
                out = merge.semi_join_keys(base.where(in_range), tail, spec.merge_keys, "left_anti").unionByName(out, allowMissingColumns=True)
        return out if with_deletes else self._live(out).drop(DELETED)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """Change rows of commits (since, until]: the keys, ``change`` (insert, update or delete) and the images
        ``before`` (as of ``since``) and ``after`` of the row (structs, null where there is none).

        Only the keys of the increment are looked up in the older state, which must be within retention."""
        if self._holds_duplicates():
            raise ValueError(f"{self.spec.name!r} holds rows written without looking at their keys: a key has no single image")
        keys = self.spec.merge_keys
        changed = self.increment(since, until, with_deletes=True)
        images = [c for c in changed.columns if c != DELETED]
        older = self._typed_nulls(merge.semi_join_keys(self.snapshot(as_of=since), changed, keys, "left_semi"), images)
        gone = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in changed.columns else F.lit(False)
        after = changed.select(*[F.col(k).alias(f"__new{i}") for i, k in enumerate(keys)],
                               F.when(~gone, F.struct(*images)).alias("after"))
        before = older.select(*[F.col(k).alias(f"__old{i}") for i, k in enumerate(keys)], F.struct(*images).alias("before"))
        cond = None
        for i in range(len(keys)):
            c = F.col(f"__new{i}").eqNullSafe(F.col(f"__old{i}"))
            cond = c if cond is None else cond & c
        change = F.when(F.col("after").isNull(), "delete").when(F.col("before").isNull(), "insert").otherwise("update")
        return (after.join(before, cond, "left").where("before IS NOT NULL OR after IS NOT NULL")
                .select(*[F.col(f"__new{i}").alias(k) for i, k in enumerate(keys)], change.alias("change"), "before", "after"))

    def history(self, keep: int) -> DataFrame:
        """Log rows of the newest ``keep`` commits of every key."""
        return versions.retain_versions(self.log().drop(DELETED), self.spec.merge_keys, keep)

    # ------------------------------------------------------------------ writes
    def _claim(self, tag: str | None, markers: dict | None = None) -> tuple[int, bool]:
        """(commit id, already visible).  A retry with the same tag gets the same commit."""
        markers = self._markers() if markers is None else markers
        if tag is not None:
            mine = _digest(tag)
            for n, (_, seen) in markers.items():
                if seen == mine:
                    return n, True
            kept = self.fs.read_text(self._tag_file(tag))
            if kept:
                n, seen = json.loads(kept)
                if seen == tag:
                    return n, True
        return (max(markers) + 1 if markers else 0), False

    def _tag_file(self, tag: str) -> str:
        return f"{self.meta}/tags/{_digest(tag.rpartition('#')[0])}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.merge_keys]), F.lit(self.spec.buckets)).cast("int")

    @contextlib.contextmanager
    def _sized_writes(self):
        """Shuffle partitions that are written become at least the small-file limit."""
        conf = self.spark.conf
        before = conf.get(_ADVISORY)
        try:
            conf.set(_ADVISORY, str(self.spec.small_file_bytes))
            yield
        finally:
            conf.set(_ADVISORY, before)

    def _write_rows(self, df: DataFrame, path: str, parts: list[str], row_bytes: float, sort_by=()) -> None:
        spec = self.spec
        if parts and not sort_by:
            # rows of one directory go to few tasks (few files); AQE splits a directory that
            # holds a large share of the rows across tasks and merges small ones
            df = df.hint("rebalance", *parts)
        if sort_by:
            df = df.sortWithinPartitions(*parts, *[c for c in sort_by if c not in parts])
        writer = (df.write.mode("overwrite")
                  .option("compression", spec.compression)
                  .option("maxRecordsPerFile", max(1, int(spec.max_file_bytes / max(1.0, row_bytes)))))
        if parts:
            writer = writer.partitionBy(*parts)
        with self._sized_writes():
            writer.parquet(path)

    def get_or_insert(self, batch: DataFrame, tag: str | None = None) -> DataFrame:
        """The row that holds for every key of the batch: the stored one, or else the batch's, which is
        stored by this call.  The answer is read as of the commit made, so later writes do not change it
        while that commit is retained."""
        keys = self.spec.merge_keys
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            made = self.write(batch, "insert_if_absent", tag=tag, cached=True)
        finally:
            batch.unpersist()
        now = made if made is not None else self.last_commit()
        if now is None:  # an empty batch on an empty table
            return self._aligned(batch).limit(0).withColumn(COMMIT, F.lit(None).cast("bigint"))
        return merge.semi_join_keys(self.snapshot(as_of=now), batch, keys, "left_semi")

    def _deletion(self, batch: DataFrame, markers: dict) -> DataFrame:
        """The keys a delete removes, with their partition and time where the table needs them.

        Columns that the batch does not bring come from the stored rows of its keys: on a table of
        partition scope a key without partition goes from every partition, on an event-time table
        a delete without a time takes the time of the row it removes."""
        spec = self.spec
        lacking = [k for k in spec.keys if k not in batch.columns]
        if lacking:
            raise ValueError(f"a delete on {spec.name!r} needs the key column(s) {lacking}")
        need = list(dict.fromkeys([*spec.merge_keys, *([spec.precombine] if self._timed else [])]))
        brought = [c for c in need if c in batch.columns]
        if len(brought) == len(need):
            return batch.select(*need)
        if not markers:
            return self._typed_nulls(batch.select(*brought), need).limit(0)
        by = [k for k in spec.merge_keys if k in brought]
        stored = self._current(markers)
        if spec.precombine in brought and self._timed:
            named = batch.select(*[F.col(k).alias(f"__at_{i}") for i, k in enumerate(by)], F.col(spec.precombine).alias("__time"))
            cond = None
            for i, k in enumerate(by):
                c = stored[k].eqNullSafe(F.col(f"__at_{i}"))
                cond = c if cond is None else cond & c
            return stored.drop(spec.precombine).join(named, cond).withColumn(spec.precombine, F.col("__time")).select(*need)
        return merge.semi_join_keys(stored, batch, by, "left_semi").select(*need)

    def _typed_nulls(self, df: DataFrame, columns: list[str]) -> DataFrame:
        known = {f.name: f.dataType for f in (self.schema() or StructType()).fields}
        return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(known.get(c, "string")).alias(c) for c in columns])

    def write(self, batch: DataFrame, method: str = "upsert", sql_transformer: str | None = None,
              tag: str | None = None, cached: bool = False, doomed: DataFrame | None = None) -> int | None:
        """Commit ``batch`` with the given write operation; returns the commit id, or None when
        the batch is empty (nothing is written).  ``tag`` is ``<writer>#<batch>``; ``cached``: the
        caller already keeps what the batch is made of.  ``doomed`` (upserts): keys that go with the
        same commit, so that readers never see the new rows without the removals."""
        method = (method or "upsert").lower()
        if method not in METHODS:
            raise ValueError(f"unknown write method {method!r}; expected one of {METHODS}")
        if sql_transformer:
            session = batch.sparkSession
            batch.createOrReplaceTempView("temp")
            batch = session.sql(sql_transformer)
        spec = self.spec
        markers = self._markers()
        n, done = self._claim(tag, markers)
        if done:
            return n
        if method == "delete":
            batch = self._deletion(batch, markers)
        batch = self._aligned(batch)
        if doomed is not None:
            if method != "upsert":
                raise ValueError("only an upsert can remove other keys in the same commit")
            method = MERGE
            # a key that the batch brings is not removed
            doomed = merge.semi_join_keys(self._aligned(self._deletion(doomed, markers)), batch, spec.merge_keys, "left_anti")
            doomed = doomed.persist(StorageLevel.MEMORY_AND_DISK)
            batch = batch.withColumn(DELETED, F.lit(None).cast("boolean")).unionByName(
                doomed.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
        if method == "insert_if_absent":
            batch = merge.precombine(batch, spec.merge_keys, spec.precombine)
            if markers:
                batch = merge.semi_join_keys(batch, self._current(markers), spec.merge_keys, "left_anti")
        # the size probe, the log write and the fold all read the batch: compute it once
        if not cached:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one pass fills the cache and tells size, width and the buckets of the keys (at most ``buckets``)
            count, width, touched = batch.agg(F.count(F.lit(1)), F.avg(_row_bytes(batch)), F.collect_set(self._bucket())).first()
            if not count:
                return None
            self._commit_rows(batch, method, n, tag, markers, float(width), set(touched))
        finally:
            if not cached:
                batch.unpersist()
            if doomed is not None:
                doomed.unpersist()
        self._tidy()
        if spec.catalog_table and self.base_versions():
            self.register()
        return n

    def _commit_rows(self, batch: DataFrame, method: str, n: int, tag: str | None, markers: dict, row_bytes: float, touched: set) -> None:
        spec = self.spec
        self._save_spec()
        stamped = batch.withColumn(COMMIT, F.lit(n).cast("bigint"))
        stored = _LOGGED.get(method, method)
        rows = stamped
        if stored == "upsert":
            rows = merge.precombine(stamped, spec.merge_keys, spec.precombine)
        elif method == "delete":
            rows = merge.tombstones(stamped, spec.merge_keys, spec.precombine if self._timed else None)
            # a key-only delete does not know the row's partition: default partition
            parts = [p for p in spec.partition_by if p not in rows.columns]
            rows = self._typed_nulls(rows, [*rows.columns, *parts]).withColumn(COMMIT, F.lit(n).cast("bigint"))
        if method not in ("upsert", "delete", MERGE, "insert_if_absent") and not self._holds_duplicates():
            self.fs.write_text(f"{self.meta}/duplicates", method)
        self._save_schema(stamped.schema)
        self._write_rows(rows.drop(COMMIT), f"{self.log_dir}/commit={n}", list(spec.partition_by), row_bytes)
        if spec.table_type == "cow" or (self._timed and stored not in ("upsert", "delete")):
            # read back what was written: one row per key already, no second shuffle of the batch
            rows = self._read(self.log_dir, [f"{self.log_dir}/commit={n}"])
            self._fold_commit(rows, stored, n, markers, row_bytes, touched)
        self._mark(n, method, tag)

    def _fold_commit(self, rows: DataFrame, method: str, n: int, markers: dict, row_bytes: float, touched: set) -> None:
        """Base n: the buckets of this commit's keys are folded, the others stay where they are."""
        vs = self.base_versions(markers)
        current_base = bool(vs) and not self.log_methods(since=vs[-1], markers=markers)
        if not markers:
            folded, held = rows, {}
        elif current_base and method != "insert_overwrite":
            manifest = self._manifest(vs[-1])
            held = {b: v for b, v in manifest.items() if _home(b) not in touched}
            base = self.base(vs[-1], touched, markers, gone=self._timed) if touched & {_home(b) for b in manifest} else None
            folded = self._apply(base, rows, method)
        else:
            state = self._state(markers, gone=True)
            folded, held = self._apply(state if self._timed else self._live(state), rows, method), {}
        self._write_base(folded, n, row_bytes, held)

    def _apply(self, base: DataFrame | None, rows: DataFrame, method: str) -> DataFrame:
        spec = self.spec
        if self._timed and method == "delete":
            method = "upsert"  # tombstones compete by their time
        return merge.apply_write(base, rows, method, spec.merge_keys, spec.precombine, spec.ordering, spec.partition_by,
                                 unique=not self._holds_duplicates(), settled=True)

    def _mark(self, n: int, method: str, tag: str | None) -> None:
        stamp = datetime.now(timezone.utc).isoformat()
        self.fs.write_text(f"{self.meta}/commits/{n}.{method}.{_digest(tag) if tag else '-'}", json.dumps({"commit": n, "method": method, "time": stamp}))
        if tag is not None:
            self.fs.write_text(self._tag_file(tag), json.dumps([n, tag]))

    def _save_spec(self) -> None:
        path = f"{self.meta}/spec.json"
        if not self.fs.exists(path):
            self.fs.write_text(path, json.dumps(dataclasses.asdict(self.spec)))

    def _write_base(self, rows: DataFrame, n: int, row_bytes: float, held: dict[int, int] | None = None, sort_by=()) -> None:
        """Rows of the folded buckets to ``base/_v=<n>``, then the manifest of base n.  Tombstones go
        to buckets of their own on event-time tables and are dropped on others."""
        fields = self._base_fields()
        path = f"{self.base_dir}/{VERSION}={n}"
        parts = [BUCKET, *self.spec.partition_by]
        bucket = self._bucket()
        if self._timed:
            rows = self._typed_nulls(rows, fields).withColumn(BUCKET, F.when(F.col(DELETED), F.lit(-1) - bucket).otherwise(bucket))
        else:
            rows = self._typed_nulls(self._live(rows), fields).withColumn(BUCKET, bucket)
        self._write_rows(rows, path, parts, row_bytes, sort_by)
        self.fs.write_text(f"{self.meta}/fields/{n}", json.dumps([f for f in fields if f not in parts]))
        made = {int(name.split("=")[1]): n for name, is_dir, *_ in self.fs.children(path) if is_dir and name.startswith(f"{BUCKET}=")}
        self.fs.write_text(f"{self.meta}/bases/{n}", json.dumps({str(b): v for b, v in {**(held or {}), **made}.items()}))

    # ------------------------------------------------------------------ maintenance
    def passed(self, consumer: str, commit: int) -> None:
        """A reader of the log says how far it has read: later commits are kept for it."""
        self.fs.write_text(f"{self.meta}/consumers/{_digest(consumer)}", json.dumps([consumer, commit]))

    def forget(self, consumer: str) -> None:
        """The reader starts again from the snapshot; nothing is kept for it."""
        self.fs.delete(f"{self.meta}/consumers/{_digest(consumer)}")

    def _tidy(self) -> None:
        """After a commit is visible: compaction, old bases, spent log commits and markers."""
        spec = self.spec
        markers = self._markers()
        vs = self.base_versions(markers)
        if spec.table_type == "mor" and len(self.log_methods(since=vs[-1] if vs else None, markers=markers)) >= spec.compact_every:
            self.compact()
            vs = self.base_versions(markers)
        if vs:
            self._clean_bases(vs)
        reach = min([vs[-1] if vs else -1, max(markers) - spec.keep_commits,
                     *(json.loads(self.fs.read_text(f"{self.meta}/consumers/{name}"))[1] for name, *_ in self.fs.children(f"{self.meta}/consumers")
                       if not name.startswith("."))])
        expired = self.expired_before()
        if reach >= 0 and (expired is None or reach > expired) and reach >= min(markers):
            self.expire_log(reach)
            markers = self._markers()
        if len(self._placed(self.log_methods(markers=markers))[0]) >= spec.pack_every:
            self.pack()
        self._clean_packs(max(markers))

    def _clean_bases(self, vs: list[int]) -> None:
        """Keep the newest ``keep_versions`` bases of visible commits and the buckets they hold."""
        old, kept = vs[:-self.spec.keep_versions], vs[-self.spec.keep_versions:]
        if not old:
            return
        used = {(b, v) for m in kept for b, v in self._manifest(m).items()}
        for m in old:
            spent = {(b, v) for b, v in self._manifest(m).items()} - used
            self.fs.delete(f"{self.meta}/bases/{m}")
            for b, v in spent:
                self.fs.delete(f"{self.base_dir}/{VERSION}={v}/{BUCKET}={b}")
            for v in {v for _, v in spent} - {v for _, v in used}:
                self.fs.delete(f"{self.base_dir}/{VERSION}={v}")
                self.fs.delete(f"{self.meta}/fields/{v}")

    def pack(self) -> int:
        """Write the small files of the log together, across commits; returns how many packs were made.

        Consecutive commits and earlier packs that are smaller than ``small_file_bytes`` are joined until
        they reach it, one file each, or as many as hold ``SORT_BYTES`` of its rows in memory: a task
        sorts one file, and rows that compress well would not fit it.  The rows keep their commit, so increments, expiry and retries see
        no change.  A pack still below the floor is joined again with later commits: at most about the
        floor is rewritten per ``pack_every`` commits.  The replaced directories stay for ``keep_versions``
        more commits, for the plans that have listed them."""
        made = 0
        while groups := self._small_runs():
            home = {c: group for group, commits in groups.items() for c in commits}
            rows = self._rows_of(list(home), place="__at")
            # one row per commit to pack: bounded by the log that is kept
            held = dict(rows.where(F.col(COMMIT).isin(list(home))).groupBy(COMMIT).agg(F.sum(_sort_bytes(rows))).collect())
            parts, tasks = {}, 0  # group -> its first task and the number of them
            for group, commits in groups.items():
                parts[group] = (tasks, max(1, math.ceil(sum(held.get(c, 0) for c in commits) / SORT_BYTES)))
                tasks += parts[group][1]
            names = self.spark.createDataFrame([(c, f"c{g[0]}-{g[1]}", *parts[g]) for c, g in home.items()],
                                               f"__c long, {PACK} string, __first long, __parts long")
            rows = rows.join(F.broadcast(names), F.col(COMMIT) == F.col("__c")).drop("__c")
            for group in groups:  # what a failed attempt left; nobody reads a pack without its marker
                self.fs.delete(self._pack_path(group))
            rows = rows.repartitionById(tasks, (F.col("__first") + F.pmod("__at", "__parts")).cast("int"))
            rows = rows.select(*[f.name for f in self.schema().fields], PACK)
            (rows.sortWithinPartitions(PACK, COMMIT).write.mode("append")
             .option("compression", self.spec.compression).partitionBy(PACK).parquet(self.pack_dir))
            now = self.last_commit()
            for a, b in groups:
                self.fs.write_text(f"{self.meta}/packs/{a}-{b}-{now}", "")
            made += len(groups)
        return made

    def _small_runs(self) -> dict[tuple[int, int], list[int]]:
        """Runs of small neighbours in the log, at least two each: (first, last) -> its commits."""
        floor = self.spec.small_file_bytes
        cs = self.log_commits()
        loose, packs = self._placed(cs)
        units = [(c, c, f"{self.log_dir}/commit={c}") for c in loose] + [(a, b, self._pack_path((a, b))) for a, b in packs]
        runs, run, size = [], [], 0
        for a, b, path in sorted(units):
            held = sum(length for _, length in self._files(path))
            if held < floor:
                run.append((a, b))
                size += held
            if held >= floor or size >= floor:
                runs.append(run)
                run, size = [], 0
        spans = [(r[0][0], r[-1][1]) for r in [*runs, run] if len(r) > 1]
        return {(a, b): [c for c in cs if a <= c <= b] for a, b in spans}

    def _clean_packs(self, newest: int) -> None:
        """Remove what packs replaced ``keep_versions`` commits ago: commit directories and narrower packs."""
        known = self._all_packs()
        if not known:
            return
        settled = [p for p in self.packs() if newest - known[p] >= self.spec.keep_versions]
        for a, b in settled:
            for p, made in known.items():
                if p != (a, b) and a <= p[0] and p[1] <= b:
                    self._drop_pack(p, made)
        for name, *_ in self.fs.children(self.log_dir):
            number = name.partition("=")[2]
            if number.isdigit() and any(a <= int(number) <= b for a, b in settled):
                self.fs.delete(f"{self.log_dir}/{name}")

    def _drop_pack(self, pack: tuple[int, int], made: int) -> None:
        self.fs.delete(f"{self.meta}/packs/{pack[0]}-{pack[1]}-{made}")
        self.fs.delete(self._pack_path(pack))

    def _tail_extent(self, tail: DataFrame) -> tuple[set[int], float]:
        """Buckets that a log tail touches (at most ``buckets``) and its mean row width."""
        touched, width = tail.agg(F.collect_set(self._bucket()), F.avg(_row_bytes(tail))).first()
        return set(touched), float(width or 1.0)

    def compact(self) -> int | None:
        """Fold the log into a base at the last commit (merge-on-read -> copy-on-write view).

        Only buckets that the log tail touches are read and written anew; the manifest keeps
        pointing at the old directories of the others."""
        markers = self._markers()
        if not markers:
            return None
        last = max(markers)
        vs = self.base_versions(markers)
        if vs and vs[-1] == last:
            return last
        since = vs[-1] if vs else None
        methods = self.log_methods(since=since, markers=markers)
        if vs and not methods:
            return vs[-1]
        tail = self.log(since=since, markers=markers)
        touched, width = self._tail_extent(tail)
        if not vs or "insert_overwrite" in methods.values():  # an overwritten partition lies in every bucket
            self._write_base(self._state(markers, gone=True), last, width)
            return last
        manifest = self._manifest(since)
        held = {b: v for b, v in manifest.items() if _home(b) not in touched}
        base = self.base(since, touched, markers, gone=self._timed) if len(held) < len(manifest) else None
        self._write_base(self._folded(base, tail, methods), last, width, held)
        return last

    def cluster(self, columns=None, target_bytes: int | None = None, small_bytes: int | None = None) -> int | None:
        """Rewrite rows range-partitioned and sorted by ``columns`` (within bucket and partition) as a new
        commit that adds nothing to the log, so readers see no old rows again.

        A range holds at most ``target_bytes`` of the files read and, unpacked, about ``SORT_BYTES``: what a task sorts
        does not grow with the table.  Rows alike in ``columns`` are ranged by their keys.

        Incremental: a bucket is finished when an earlier call wrote it with the same columns and nothing was
        folded into it since, or when it holds one file at least, none below ``small_bytes``; finished buckets keep
        their files.  Returns None when all are finished."""
        cols = list(columns or self.spec.cluster_by)
        if not cols:
            raise ValueError("clustering needs columns")
        markers = self._markers()
        if not markers:
            return None
        self.compact()  # a log tail is folded first, bucket by bucket
        vs = self.base_versions(markers)
        manifest = self._manifest(vs[-1])
        sorted_by = {int(name): json.loads(self.fs.read_text(f"{self.meta}/clusters/{name}")) for name, *_ in self.fs.children(f"{self.meta}/clusters")
                     if name.isdigit()}
        limit = CLUSTER_SMALL_BYTES if small_bytes is None else small_bytes
        sizes = {b: [length for _, length in self._files(f"{self.base_dir}/{VERSION}={v}/{BUCKET}={b}")] for b, v in manifest.items()}
        open_ = {b for b, v in manifest.items() if b >= 0 and sorted_by.get(v) != cols and min(sizes[b], default=limit) < limit}
        if not open_:
            return None
        rows = self.base(vs[-1], open_, markers, gone=self._timed)
        n = max(markers) + 1
        held_bytes, width = rows.agg(F.sum(_sort_bytes(rows)), F.avg(_row_bytes(rows))).first()
        n_ranges = max(1, math.ceil(sum(sum(sizes[b]) for b in open_) / (target_bytes or CLUSTER_TARGET_BYTES)), math.ceil((held_bytes or 0) / SORT_BYTES))
        by = dict.fromkeys([*self.spec.partition_by, *cols, *self.spec.merge_keys])
        ranged = rows.repartitionByRange(n_ranges, self._bucket(), *[F.col(c) for c in by])
        held = {b: v for b, v in manifest.items() if _home(b) not in open_}
        self._write_base(ranged, n, float(width or 1.0), held, sort_by=cols)
        self.fs.write_text(f"{self.meta}/clusters/{n}", json.dumps(cols))
        self._mark(n, "cluster", None)
        self._tidy()
        return n

    def _files(self, path: str) -> list[tuple[str, int]]:
        """Data files below a directory with their sizes."""
        out = []
        for name, is_dir, length, _ in self.fs.children(path):
            if is_dir:
                out += self._files(f"{path}/{name}")
            elif not name.startswith(("_", ".")):
                out.append((f"{path}/{name}", length))
        return out

    def expire_log(self, upto: int) -> None:
        """Remove log commits and markers <= ``upto`` that a base already covers.  Readers behind
        ``upto`` must restart from the snapshot."""
        markers = self._markers()
        vs = self.base_versions(markers)
        if not vs or upto > vs[-1]:
            raise ValueError("only commits folded into a base can be expired")
        self.fs.write_text(f"{self.meta}/expired", str(upto))
        newest = max(markers)
        for c, (method, seen) in markers.items():
            if c <= upto:
                self.fs.delete(f"{self.log_dir}/commit={c}")
                if c != newest:  # the newest marker carries the commit counter
                    self.fs.delete(f"{self.meta}/commits/{c}.{method}.{seen}")
        for pack, made in reversed(self._all_packs().items()):  # narrower ones first: a replaced pack never comes back into use
            if pack[1] <= upto:
                self._drop_pack(pack, made)

    def column_stats(self, columns=None) -> DataFrame:
        """Per data directory (bucket and partition) of the current rows and column: ``num_rows, min, max,
        nulls`` (as text).  Without a base the log's directories are described.

        Counts, and the bounds of whole numbers, dates and flags without nulls, come from the parquet footers: Spark's
        aggregate push-down of the V2 source, so no data page is read.  Other columns are read, alone: footers
        keep no exact bounds of texts, timestamps and NaN, none where a file holds nulls only, and the push-down finds
        a column by its place, so one that is new or stands behind nested ones is no safe choice (``_in_footers``).
        Columns default to keys, precombine and clustering columns."""
        spec = self.spec
        cols = list(columns or dict.fromkeys([*spec.keys, *([spec.precombine] if spec.precombine else []), *spec.cluster_by]))
        vs = self.base_versions()
        if vs:
            places = [(self.base_dir, [VERSION, BUCKET, *spec.partition_by],
                       [f"{self.base_dir}/{VERSION}={v}/{BUCKET}={b}" for b, v in sorted(self._manifest(vs[-1]).items()) if b >= 0])]
        else:
            loose, packs = self._placed(self.log_methods())
            places = [(self.log_dir, [COMMIT, *spec.partition_by], [f"{self.log_dir}/commit={c}" for c in loose]),
                      (self.pack_dir, [PACK], [self._pack_path(p) for p in packs])]
        places = [p for p in places if p[2]]
        if not places:
            return self.spark.createDataFrame([], "directory string, num_rows long, column string, min string, max string, nulls long")
        own = self.spark.newSession()  # its own settings: other reads of the caller's session stay as they are
        own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        types = {f.name: f.dataType.simpleString() for f in self.schema().fields}
        out = None
        for root, parts, dirs in places:
            fields = self._base_fields() if vs else [f.name for f in self.schema().fields]
            schema = StructType([f for f in self.schema().fields if f.name in cols or (f.name in fields and f.name not in parts)])
            by_footer, by_page = (s.read.schema(schema).option("basePath", root).parquet(*dirs) for s in (own, self.spark))
            held = [p for p in parts if p in by_page.columns]
            where = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for p in held])
            footer = []
            if vs:
                used = {v for b, v in self._manifest(vs[-1]).items() if b >= 0}
                footer = self._in_footers(by_footer, [c for c in cols if types[c] in _FOOTER_BOUNDS and c not in parts], used)
            for rows, group in ((by_footer, footer), (by_page, [c for c in cols if c not in footer])):
                if not group:
                    continue
                stats = rows.groupBy(*held).agg(F.count(F.lit(1)).alias("num_rows"), *[
                    f(c).alias(f"{n}{i}") for i, c in enumerate(group) for f, n in ((F.min, "_min"), (F.max, "_max"), (F.count, "_known"))])
                each = F.explode(F.array(*[
                    F.struct(F.lit(c).alias("column"), F.col(f"_min{i}").cast("string").alias("min"), F.col(f"_max{i}").cast("string").alias("max"),
                             (F.col("num_rows") - F.col(f"_known{i}")).alias("nulls")) for i, c in enumerate(group)]))
                part = stats.select(where.alias("directory"), "num_rows", each.alias("s")).select("directory", "num_rows", "s.*")
                out = part if out is None else out.unionByName(part)
        return out

    def _base_fields(self) -> list[str]:
        """Columns of base files: those of the table, the mark of tombstones on event-time tables only."""
        return [f.name for f in self.schema().fields if f.name != DELETED or self._timed]

    def _in_footers(self, rows: DataFrame, columns: list[str], used: set[int]) -> list[str]:
        """Those of ``columns`` whose bounds the footers of all base files give.

        A column must stand at the same place in the files of every version as in the schema read, before any
        nested column (which has several places), and must hold no null; the last is seen by one
        count over the footers."""
        mine = [f for f in self.schema().fields if f.name in self._base_fields() and f.name not in self.spec.partition_by]
        flat = []
        for f in mine:
            if f.dataType.simpleString().startswith(("array", "map", "struct", "variant")):
                break
            flat.append(f.name)
        place = {c: i for i, c in enumerate(flat)}
        for v in used:
            text = self.fs.read_text(f"{self.meta}/fields/{v}")
            known = json.loads(text) if text else []
            place = {c: i for c, i in place.items() if known[i:i + 1] == [c]}
        columns = [c for c in columns if c in place]
        if not columns:
            return []
        total, *filled = rows.agg(F.count(F.lit(1)), *[F.count(c) for c in columns]).first()
        return [c for c, n in zip(columns, filled) if n == total]

    def register(self, name: str | None = None) -> str:
        """Catalog table over the newest base (``database.table``); its partitions are the table's
        directories, at their own locations: the bucket (an extra column) and the partition columns.

        A table that exists is altered, never dropped: new columns are added, then partitions are added, moved to
        their new directory or (if they are vacated) removed.  A merge-on-read table shows the state
        of its last compaction; without a base this call makes one."""
        name = name or self.spec.catalog_table or self.spec.name
        if not self.base_versions():
            self.compact()
        spark = self.spark
        if "." in name:
            db = name.split(".")[0]
            if not spark.catalog.databaseExists(db):
                # next to the table, not in the driver's working directory
                db_path = self.fs.qualify(f"{self.root}/../_catalog/{db}.db")
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{db_path}'")
        parts = [BUCKET, *self.spec.partition_by]
        fields = [f for f in self.schema().fields if f.name != DELETED]
        rows = [f for f in fields if f.name not in parts]
        home = f"{self.fs.qualify(self.base_dir)}/_none"
        column = lambda f: f"`{f.name}` {'int' if f.name == BUCKET else f.dataType.simpleString()}"
        if not spark.catalog.tableExists(name):
            ordered = rows + [StructField(BUCKET, LongType())] + [f for p in parts for f in fields if f.name == p]
            spark.sql(f"CREATE TABLE {name} ({', '.join(map(column, ordered))}) USING parquet "
                      f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION '{home}'")
        else:
            place = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Location", "")
            if place.rstrip("/") != home:
                raise ValueError(f"catalog table {name!r} belongs to another table at {place}")
            known = set(spark.table(name).columns)
            fresh = [f for f in rows if f.name not in known]
            if fresh:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(map(column, fresh))})")
        wanted: dict[str, str] = {}
        for b, v in sorted(self._manifest(self.base_versions()[-1]).items()):
            if b < 0:  # tombstones
                continue
            for path, values in self._leaves(f"{self.base_dir}/{VERSION}={v}/{BUCKET}={b}", {BUCKET: str(b)}, list(self.spec.partition_by)):
                clause = ", ".join(f"`{k}`=" + ("null" if x is None else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'") for k, x in values.items())
                wanted[clause] = self.fs.qualify(path)
        # what the catalog holds: the clauses and places of the last registration under this name
        noted = f"{self.meta}/catalog/{_digest(name)}"
        text = self.fs.read_text(noted)
        held = json.loads(text) if text else {}
        if held and spark.sql(f"SHOW PARTITIONS {name}").isEmpty():
            held = {}  # made anew outside
        added = [c for c in wanted if c not in held]
        for i in range(0, len(added), 200):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({c}) LOCATION '{wanted[c]}'" for c in added[i:i + 200]))
        for c in wanted:
            if c in held and held[c] != wanted[c]:
                spark.sql(f"ALTER TABLE {name} PARTITION ({c}) SET LOCATION '{wanted[c]}'")
        vacated = [c for c in held if c not in wanted]
        for i in range(0, len(vacated), 200):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({c})" for c in vacated[i:i + 200]))
        self.fs.write_text(noted, json.dumps(wanted))
        spark.catalog.refreshTable(name)
        return name

    def _leaves(self, path: str, values: dict, parts: list[str]) -> list[tuple[str, dict]]:
        """Partition directories below ``path`` with their values."""
        if not parts:
            return [(path, values)]
        out = []
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        for name, is_dir, *_ in self.fs.children(path):
            column, _, raw = name.partition("=")
            if is_dir and column == parts[0]:
                value = None if raw == "__HIVE_DEFAULT_PARTITION__" else str(unescape(raw))
                out += self._leaves(f"{path}/{name}", {**values, column: value}, parts[1:])
        return out


def open_table(spark: SparkSession, path: str, **overrides) -> KeyedTable:
    """A table by its path alone: the spec is read from ``_meta/spec.json``."""
    txt = Fs(spark).read_text(f"{path.rstrip('/')}/_meta/spec.json")
    if txt is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    doc = json.loads(txt)
    doc.update(overrides)
    doc["path"] = path
    return KeyedTable(spark, TableSpec(**doc))
