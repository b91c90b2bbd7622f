"""File access through Spark's Hadoop file systems, so every store that Spark reads works here too."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def at(self, path: str):
        p = self.path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p)

    def is_dir(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def glob(self, pattern: str) -> list[str]:
        fs, p = self.at(pattern)
        return [x.getPath().toString() for x in fs.globStatus(p) or []]

    def read(self, path: str) -> bytes:
        fs, p = self.at(path)
        stream = fs.open(p)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        fs, p = self.at(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def rename(self, a: str, b: str) -> None:
        fs, p = self.at(a)
        fs.mkdirs(self.path(b).getParent())
        if not fs.rename(p, self.path(b)):
            raise OSError(f"cannot rename {a} to {b}")

    def qualified(self, path: str) -> str:
        fs, p = self.at(path)
        return fs.makeQualified(p).toString()

    def uri(self, path: str) -> str:
        """As Spark names the file in _metadata.file_path."""
        fs, p = self.at(path)
        return fs.makeQualified(p).toUri().toString()


    def uris(self, paths: list[str], encoded: bool = True) -> list[str]:
        """uri (else qualified) of many paths: the file system is asked once for each scheme and authority, and for names
        that a URI would change."""
        roots: dict[str, str] = {}
        out = []
        for path in paths:
            m = PLAIN.fullmatch(path)
            if not m or "/." in path:
                out.append(self.uri(path) if encoded else self.qualified(path))
                continue
            if m[1] not in roots:
                roots[m[1]] = self.uri(f"{m[1]}/x")[:-2]
            out.append(roots[m[1]] + m[2])
        return out


class WorkerFiles:
    """The reading half of Files where there is no JVM: table functions run in workers. Arrow's file systems open the paths."""

    @staticmethod
    def at(path: str):
        from pyarrow import fs

        if not re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
            return fs.LocalFileSystem(), path
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))

    def kind(self, path: str):
        store, p = self.at(path)
        return store.get_file_info(p).type.name

    def exists(self, path: str) -> bool:
        return self.kind(path) != "NotFound"

    def is_dir(self, path: str) -> bool:
        return self.kind(path) == "Directory"

    def glob(self, pattern: str) -> list[str]:
        """Names that match in one folder; only the last part of a pattern holds asterisks."""
        from pyarrow import fs

        folder, _, last = pattern.rpartition("/")
        store, p = self.at(folder)
        wanted = re.compile(".*".join(map(re.escape, last.split("*"))), re.DOTALL)
        return [f"{folder}/{x.base_name}" for x in store.get_file_info(fs.FileSelector(p)) if wanted.fullmatch(x.base_name)]

    def read(self, path: str) -> bytes:
        store, p = self.at(path)
        with store.open_input_stream(p, compression=None) as stream:
            return stream.read()


#: Scheme and authority, and a path of characters that stand for themselves in a URI.
PLAIN = re.compile(r"((?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?)((?:/[A-Za-z0-9_.=+@,~-]+)+)")


def literal(path: str) -> str:
    """A path as Spark's readers must get it, which take it for a pattern."""
    return re.sub(r"([\\{\[*?])", r"\\\1", path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the session's checkpoints. Where the session names none, a local master gets a temporary one."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master or ""):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lakelens-")
    return f"{root}/{name}-{uuid.uuid4().hex}"
