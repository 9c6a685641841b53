"""Small files and whole folders on whatever file system a path names, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """What the run state and the snapshots need of a file system: local, HDFS or an object store."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._open(path)
        return fs.exists(where)

    def read(self, path: str) -> str:
        fs, where = self._open(path)
        stream = fs.open(where)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def read_bytes(self, path: str) -> bytes:
        fs, where = self._open(path)
        stream = fs.open(where)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def parts(self, path: str) -> list[str]:
        """The data files of a written folder, in order; a file is its own only part."""
        fs, where = self._open(path)
        if fs.getFileStatus(where).isFile():
            return [path]
        return [f"{path.rstrip('/')}/{n}" for n in self.names(path) if n.startswith("part-")]

    def write(self, path: str, text: str) -> None:
        """Write a small file beside and move it in place, so that it is never there in part."""
        fs, where = self._open(path)
        beside = self.jvm.org.apache.hadoop.fs.Path(f"{path}.new")
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs.delete(where, False)
        if not fs.rename(beside, where):
            raise OSError(f"cannot write {path}")

    def delete(self, path: str) -> None:
        """Delete a file, or a folder with all it holds; nothing where there is none."""
        fs, where = self._open(path)
        fs.delete(where, True)

    def names(self, path: str) -> list[str]:
        """What lies in a folder; nothing where there is none."""
        fs, where = self._open(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []

    def copy(self, source: str, target: str) -> None:
        from_fs, from_path = self._open(source)
        to_fs, to_path = self._open(target)
        to_fs.mkdirs(to_path.getParent())
        if not self.jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, from_path, to_fs, to_path, False, self.conf):
            raise OSError(f"cannot copy {source}")
