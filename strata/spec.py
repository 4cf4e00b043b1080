"""Table specification: what a keyed table is, independent of where rows live."""

from __future__ import annotations

from dataclasses import dataclass, field

from strata.functions.scalar import key_list

COMMIT = "commit"
DELETED = "_is_deleted"

SCOPES = ("global", "partition")
ORDERINGS = ("arrival", "event_time")
TABLE_TYPES = ("cow", "mor")
METHODS = ("upsert", "insert", "bulk_insert", "insert_if_absent", "insert_overwrite", "delete")

# File sizing and retention defaults of the source pipeline.
MAX_FILE_BYTES = 512 * 1024 * 1024
SMALL_FILE_BYTES = 104857600
CLUSTER_TARGET_BYTES = 1073741824
CLUSTER_SMALL_BYTES = 600 * 1024 * 1024
KEEP_VERSIONS = 3


def as_bool(value) -> bool:
    """Flag parsing of the source jobs: True, "True" and "true" are on, anything else off."""
    return value is True or value in ("True", "true")


_TYPE_ALIASES = {
    "copy_on_write": "cow",
    "cow": "cow",
    "merge_on_read": "mor",
    "mor": "mor",
}
_SCOPE_ALIASES = {"bloom": "partition", "global_bloom": "global", "global": "global", "partition": "partition"}


@dataclass(frozen=True)
class TableSpec:
    """A keyed table.

    keys        record key columns; a comma-separated string is accepted ("orderid,customer_id")
    precombine  column whose greatest value wins among rows of one key (None: arrival only)
    partition_by  hive-style partition columns
    scope       "global": a key is unique in the table (a row moves when its partition changes);
                "partition": a key is unique within its partition (partition columns join the key)
    ordering    "arrival": the newest commit wins; "event_time": the greatest precombine wins,
                even against rows stored by earlier commits
    table_type  "cow": every commit folds the buckets it touches into a new base version;
                "mor": commits only append to the log, folded on read and by compaction
    buckets     hash buckets of the base; about table bytes / 10 GB, so that a commit rewrites
                little and a bucket still fills whole files.  Fixed for a table's life.
    compact_every  merge-on-read: log commits after which a base is written
    pack_every     log commits with files of their own after which small ones are packed together
    keep_commits   newest log commits that stay readable as increments even for unknown readers
    """

    name: str
    path: str
    keys: tuple[str, ...]
    precombine: str | None = None
    partition_by: tuple[str, ...] = ()
    scope: str = "global"
    ordering: str = "arrival"
    table_type: str = "cow"
    keep_versions: int = KEEP_VERSIONS
    max_file_bytes: int = MAX_FILE_BYTES
    small_file_bytes: int = SMALL_FILE_BYTES
    compression: str = "snappy"
    catalog_table: str | None = None
    cluster_by: tuple[str, ...] = field(default=())
    buckets: int = 4
    compact_every: int = 10
    keep_commits: int = 20
    pack_every: int = 20

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(key_list(self.keys)))
        object.__setattr__(self, "partition_by", tuple(key_list(self.partition_by)))
        object.__setattr__(self, "cluster_by", tuple(key_list(self.cluster_by)))
        scope = _SCOPE_ALIASES.get(str(self.scope).lower())
        ttype = _TYPE_ALIASES.get(str(self.table_type).lower())
        if not self.keys:
            raise ValueError("a keyed table needs at least one record key")
        if scope is None:
            raise ValueError(f"unknown key scope {self.scope!r}; expected one of {SCOPES}")
        if ttype is None:
            raise ValueError(f"unknown table type {self.table_type!r}; expected one of {TABLE_TYPES}")
        if self.ordering not in ORDERINGS:
            raise ValueError(f"unknown ordering {self.ordering!r}; expected one of {ORDERINGS}")
        if self.ordering == "event_time" and not self.precombine:
            raise ValueError("event_time ordering needs a precombine column")
        if min(self.keep_versions, self.buckets, self.compact_every, self.keep_commits, self.pack_every) < 1:
            raise ValueError("keep_versions, buckets, compact_every, keep_commits and pack_every must be >= 1")
        object.__setattr__(self, "scope", scope)
        object.__setattr__(self, "table_type", ttype)

    @property
    def merge_keys(self) -> list[str]:
        """Columns that identify one current row."""
        if self.scope == "partition":
            return [*self.keys, *[p for p in self.partition_by if p not in self.keys]]
        return list(self.keys)
