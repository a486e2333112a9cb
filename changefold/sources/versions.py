"""Numbered output folders ``cf_version=N`` that count once their job has committed.

Spark writes ``_SUCCESS`` as the last act of a write job, so a folder without it is an attempt
that died; the next attempt takes the same number and overwrites it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F


PREFIX = "cf_version="
#: Codec of the Parquet files of layers that keep every event.
CODEC = "zstd"


def _path_fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def ensure_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _path_fs(spark, path)
    fs.mkdirs(folder)


def has_entries(spark: SparkSession, path: str) -> bool:
    folder, fs = _path_fs(spark, path)
    return fs.exists(folder) and len(fs.listStatus(folder)) > 0


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _path_fs(spark, path)
    fs.delete(folder, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder."""
    folder, fs = _path_fs(spark, path)
    return fs.getContentSummary(folder).getLength()


class VersionedDir:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, version: int) -> str:
        return f"{self.root}/{PREFIX}{version}"

    def _fs(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        Path, fs = self._fs()
        if not fs.exists(Path(self.root)):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(Path(self.root)))
        return sorted(int(n.removeprefix(PREFIX)) for n in names if n.startswith(PREFIX))

    def committed(self) -> list[int]:
        Path, fs = self._fs()
        return [v for v in self._numbers() if fs.exists(Path(f"{self.path(v)}/_SUCCESS"))]

    def latest(self) -> int | None:
        Path, fs = self._fs()
        for version in reversed(self._numbers()):
            if fs.exists(Path(f"{self.path(version)}/_SUCCESS")):
                return version
        return None

    def parts(self, version: int) -> list[str]:
        """Names of the folders inside a version; none where a commit had nothing to write."""
        Path, fs = self._fs()
        if not fs.exists(Path(self.path(version))):
            return []
        return [s.getPath().getName() for s in fs.listStatus(Path(self.path(version))) if s.isDirectory()]

    def write_note(self, version: int, text: str) -> None:
        """Commit a one-line text as a version."""
        line = self.spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))
        line.write.mode("overwrite").text(self.path(version))

    def read_note(self, version: int) -> str:
        return self.spark.read.text(self.path(version)).first().value

    def read_notes(self) -> list[str]:
        """All notes in order of their versions, read by one job."""
        paths = [self.path(v) for v in self.committed()]
        if not paths:
            return []
        rows = self.spark.read.text(paths).select(F.regexp_extract("_metadata.file_path", f"{PREFIX}([0-9]+)", 1).cast("long").alias("v"), "value")
        return [r.value for r in sorted(rows.collect(), key=lambda r: r.v)]

    def remove(self, version: int, part: str = "") -> None:
        """Delete a superseded version, or one folder of it."""
        Path, fs = self._fs()
        fs.delete(Path(f"{self.path(version)}/{part}".rstrip("/")), True)
