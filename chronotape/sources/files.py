"""Small-file access through Hadoop's file system API, so any Spark-readable path works."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


class Folder:
    """One directory on whatever file system its path names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = str(root).rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, relative: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}" if relative else self.root)

    @property
    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def at(self, relative: str) -> str:
        return f"{self.root}/{relative}"

    def exists(self, relative: str = "") -> bool:
        return self._fs.exists(self._path(relative))

    def rename(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target} under {self.root}")

    def remove(self, relative: str) -> None:
        self._fs.delete(self._path(relative), True)

    def names(self, suffix: str) -> list[str]:
        """File names directly inside the folder, sorted."""
        if not self.exists():
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path()) if s.isFile()]
        return sorted(n for n in found if n.endswith(suffix))

    def write_text(self, relative: str, text: str) -> None:
        stream = self._fs.create(self._path(relative), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def read_text(self, relative: str) -> str:
        rows = self.spark.read.text(self.at(relative), wholetext=True).collect()  # one small document
        return rows[0][0]


def work_folder(spark: SparkSession, purpose: str) -> Folder:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting falls back to a temporary directory; a cluster must
    name a folder that every executor can reach.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="spark-")
    return Folder(spark, f"{shared.rstrip('/')}/chronotape/{purpose}-{uuid.uuid4().hex}")
