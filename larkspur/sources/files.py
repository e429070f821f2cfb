"""Folders and small files on any store that Hadoop's file systems reach, a local disk too."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The store of a session. Paths are as Spark takes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder."""
        at, fs = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(at) if x.isDirectory()) if fs.exists(at) else []

    def files(self, path: str) -> list[tuple[str, int]]:
        """(path below it, bytes) of all files under a folder; none where there is none. As many as tasks wrote, not as many as rows."""
        at, fs = self._at(path)
        if not fs.exists(at):
            return []
        root, out, found = fs.makeQualified(at).toUri().getPath().rstrip("/"), [], fs.listFiles(at, True)
        while found.hasNext():
            x = found.next()
            out.append((x.getPath().toUri().getPath()[len(root) + 1 :], x.getLen()))
        return sorted(out)

    def bytes(self, path: str) -> int:
        return sum(n for _, n in self.files(path))

    def read(self, path: str) -> str | None:
        at, fs = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a text where the old one was; what reads it sees either of them whole."""
        at, fs = self._at(path)
        part = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.part")
        fs.mkdirs(at.getParent())
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs.delete(at, False)
        if not fs.rename(part, at):
            raise OSError(f"cannot put {path}")

    def copy(self, source: str, target: str) -> None:
        (a, a_fs), (b, b_fs) = self._at(source), self._at(target)
        self.jvm.org.apache.hadoop.fs.FileUtil.copy(a_fs, a, b_fs, b, False, True, self.conf)

    def remove(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)
