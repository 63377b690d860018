"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self._fs = self.path(self.root).getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"
        if self._local:  # without hidden checksum files
            self._fs = self._jvm.org.apache.hadoop.fs.FileSystem.getLocal(self._conf).getRaw()

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: under a temporary name beside the root first, then renamed over what is there, which is never deleted before."""
        temporary = self.path(f"{self.root}.tmp-{uuid.uuid4().hex}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.mkdirs(self.path(name).getParent())
        self._swap(temporary, self.path(name))

    def create(self, name: str, text: str) -> bool:
        """Makes a file that is not there yet; of several that try at once, one does. It needs a file system whose create is exclusive, as HDFS and local ones have."""
        path = self.path(name)
        self._fs.mkdirs(path.getParent())
        if self._local:
            try:
                out = os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(out, "wb") as f:
                f.write(text.encode())
            return True
        try:
            out = self._fs.create(path, False)
        except Exception:
            if self.exists(name):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def modified(self, name: str) -> float | None:
        """Seconds since 1970 by the file system's clock; None where nothing is."""
        path = self.path(name)
        return self._fs.getFileStatus(path).getModificationTime() / 1000 if self._fs.exists(path) else None

    def touch(self, name: str) -> float:
        """Writes what the file holds once more, so that its time is the file system's own; that time."""
        held = self.read(name) if self.exists(name) else ""
        out = self._fs.create(self.path(name), True)
        out.write(bytearray(held.encode()))
        out.close()
        return self.modified(name)

    def _swap(self, temporary, final) -> None:
        if self._local:  # a rename there replaces a file at once
            if not self._fs.rename(temporary, final):
                raise OSError(f"could not write {final}")
            return
        hadoop = self._jvm.org.apache.hadoop.fs
        options = self._gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        hadoop.FileContext.getFileContext(final.toUri(), self._conf).rename(temporary, final, options)

    def move(self, a: str, b: str) -> None:
        """Also from another file system, whose file is then copied."""
        a, b = self.path(a), self.path(b)
        self._fs.mkdirs(b.getParent())
        other = a.getFileSystem(self._conf)
        if other.getUri().toString() == self._fs.getUri().toString():
            if not self._fs.rename(a, b):
                raise OSError(f"could not move {a}")
        elif not self._jvm.org.apache.hadoop.fs.FileUtil.copy(other, a, self._fs, b, True, self._conf):
            raise OSError(f"could not copy {a}")

    def seal(self, folder: str) -> None:
        """Nobody writes to the folder any more."""
        permission = self._jvm.org.apache.hadoop.fs.permission.FsPermission
        for name in self.walk(folder):
            self._fs.setPermission(self.path(f"{folder}/{name}"), permission("444"))
        for name in sorted({"", *(x.rpartition("/")[0] for x in self.walk(folder)), *(x.partition("/")[0] for x in self.walk(folder) if "/" in x)}):
            self._fs.setPermission(self.path(f"{folder}/{name}".rstrip("/")), permission("555"))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def walk(self, folder: str) -> list[str]:
        """Paths of all files under folder, relative to it."""
        base, out = self.path(folder), []
        if self.exists(folder):
            found = self._fs.listFiles(base, True)
            start = len(str(self._fs.makeQualified(base).toUri().getPath())) + 1
            while found.hasNext():
                out.append(str(found.next().getPath().toUri().getPath())[start:])
        return sorted(out)

    def sha256(self, name: str) -> str:
        """Of a file's bytes; of a folder, of its files' names and hashes. Read as a stream by the driver."""
        path = self.path(name)
        if not self._fs.exists(path):
            raise FileNotFoundError(name)
        digest = self._jvm.org.apache.commons.codec.digest.DigestUtils
        if self._fs.getFileStatus(path).isFile():
            stream = self._fs.open(path)
            try:
                return digest.sha256Hex(stream)
            finally:
                stream.close()
        return digest.sha256Hex("".join(f"{f}\t{self.sha256(f'{name}/{f}')}\n" for f in self.walk(name) if not f.rpartition("/")[2].startswith(("_", "."))))
