"""Small metadata operations through the cluster's Hadoop FileSystem (HDFS, S3A, local, ...).

Only directory listings and tiny marker files go through here; all row data is read and
written by Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Fs:
    def __init__(self, spark: SparkSession):
        sc = spark.sparkContext
        self._jvm = sc._jvm
        self._conf = sc._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, jpath):
        return jpath.getFileSystem(self._conf)

    def exists(self, p: str) -> bool:
        jp = self._path(p)
        return bool(self._fs(jp).exists(jp))

    def children(self, p: str) -> list[tuple[str, bool, int, int]]:
        """(name, is_dir, length, modification_time) of the entries under ``p``; [] if missing."""
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return []
        return [(st.getPath().getName(), bool(st.isDirectory()), int(st.getLen()), int(st.getModificationTime()))
                for st in fs.listStatus(jp)]

    def write_text(self, p: str, text: str) -> None:
        jp = self._path(p)
        out = self._fs(jp).create(jp, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, p: str) -> str | None:
        jp = self._path(p)
        fs = self._fs(jp)
        if not fs.exists(jp):
            return None
        stream = fs.open(jp)
        try:
            return str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def delete(self, p: str) -> bool:
        jp = self._path(p)
        return bool(self._fs(jp).delete(jp, True))

    def size(self, p: str) -> int:
        jp = self._path(p)
        fs = self._fs(jp)
        return int(fs.getContentSummary(jp).getLength()) if fs.exists(jp) else 0

    def qualify(self, p: str) -> str:
        jp = self._path(p)
        return str(self._fs(jp).makeQualified(jp).toString())
