"""Small file-system helpers over Hadoop's FileSystem API (local, HDFS, object stores).

Only control files (manifests) and directory listings go through here; data is
always read and written by Spark itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class HadoopFS:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._cache: dict = {}

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        # one FileSystem per scheme and authority (e.g. per bucket)
        root = "/".join(p.split("/", 3)[:3]) if "://" in p else ""
        fs = self._cache.get(root)
        if fs is None:
            fs = self._cache[root] = self._path(p).getFileSystem(self._conf)
        return fs

    def exists(self, p: str) -> bool:
        return bool(self._fs(p).exists(self._path(p)))

    def mkdirs(self, p: str) -> None:
        self._fs(p).mkdirs(self._path(p))

    def list_names(self, p: str, dirs_only: bool = False) -> list[str]:
        if not self.exists(p):
            return []
        out = []
        for st in self._fs(p).listStatus(self._path(p)):
            if dirs_only and not st.isDirectory():
                continue
            out.append(st.getPath().getName())
        return sorted(out)

    def read_text(self, p: str) -> str:
        fs = self._fs(p)
        stream = fs.open(self._path(p))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            while True:
                line = reader.readLine()
                if line is None:
                    break
                lines.append(line)
            return "\n".join(lines)
        finally:
            stream.close()

    def write_text_atomic(self, p: str, text: str) -> None:
        """Write ``text`` to a hidden temp file, then rename it to ``p``.

        Rename fails if ``p`` already exists, so two writers cannot both publish the
        same manifest sequence number.
        """
        parent = p.rsplit("/", 1)[0]
        tmp = f"{parent}/.tmp-{uuid.uuid4().hex}"
        fs = self._fs(p)
        out = fs.create(self._path(tmp), False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if not fs.rename(self._path(tmp), self._path(p)):
            fs.delete(self._path(tmp), False)
            raise RuntimeError(f"could not publish {p}: it exists (concurrent writer?)")

    def delete(self, p: str, recursive: bool = True) -> None:
        if self.exists(p):
            self._fs(p).delete(self._path(p), recursive)

    def size_bytes(self, p: str) -> int:
        if not self.exists(p):
            return 0
        return int(self._fs(p).getContentSummary(self._path(p)).getLength())

    def files(self, p: str) -> list[tuple[str, int]]:
        """(path below ``p``, bytes) of the data files under ``p``: one listing, however deep."""
        if not self.exists(p):
            return []
        it, out = self._fs(p).listFiles(self._path(p), True), []
        while it.hasNext():
            st = it.next()
            parts = st.getPath().toUri().getPath().rstrip("/").split("/")
            parts = parts[len(self._path(p).toUri().getPath().rstrip("/").split("/")):]
            if not parts[-1].startswith(("_", ".")):
                out.append(("/".join(parts), int(st.getLen())))
        return out

    def file_count(self, p: str) -> int:
        if not self.exists(p):
            return 0
        return int(self._fs(p).getContentSummary(self._path(p)).getFileCount())
