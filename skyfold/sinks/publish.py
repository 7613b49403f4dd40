"""Tables are computed aside and moved into place once they are complete.

Moves are renames inside one file system, so a failed computation leaves the published tables as they were. What remains is the
window between two renames: a reader may then meet one table of a set new and another old, or for a moment neither; if a rename
itself fails, those done are undone.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The few file system calls that publishing needs, on whatever store a path names."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def rename(self, source: str, target: str) -> None:
        fs, p = self._at(target)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._path(source), p):
            raise OSError(f"cannot move {source} to {target}")

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def names(self, path: str) -> list[str]:
        """Names of what lies in a folder; none where there is no folder."""
        fs, p = self._at(path)
        return [e.getPath().getName() for e in fs.listStatus(p)] if fs.exists(p) else []

    def length_and_time(self, path: str) -> tuple[int, int]:
        """Bytes of a file, or of all in a folder, and the latest change of any of them in milliseconds."""
        fs, p = self._at(path)
        status = fs.getFileStatus(p)
        if not status.isDirectory():
            return status.getLen(), status.getModificationTime()
        inner = [self.length_and_time(f"{path.rstrip('/')}/{n}") for n in self.names(path)]
        return sum(n for n, _ in inner), max([t for _, t in inner], default=0)

    def text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        fs, p = self._at(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_to_new(self, source: str, target: str) -> bool:
        """Rename a file to a name that must be free; says whether it was."""
        hadoop = self._spark._jvm.org.apache.hadoop.fs
        _, p = self._at(target)
        plain = self._spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            hadoop.FileContext.getFileContext(p.toUri(), self._conf).rename(self._path(source), p, plain)
        except Py4JJavaError as failure:
            if "FileAlreadyExists" in failure.java_exception.getClass().getName():
                return False
            raise
        return True

    def years(self, root: str) -> dict[int, int]:
        """Bytes of each year directory under ``root``, from the listing of directories alone."""
        fs, p = self._at(root)
        if not fs.exists(p):
            return {}
        found = {}
        for entry in fs.listStatus(p):
            m = re.fullmatch(r"year=(\d+)", entry.getPath().getName())
            if m and entry.isDirectory():
                found[int(m.group(1))] = fs.getContentSummary(entry.getPath()).getLength()
        return found


def aside(path: str) -> str:
    """A sibling of ``path`` for a table that is not complete yet."""
    return f"{path.rstrip('/')}__new-{uuid.uuid4().hex}"


def swap(spark: SparkSession, moves: Iterable[tuple[str | None, str]]) -> None:
    """Put each new folder in place of the published one; ``None`` only takes the published one away."""
    files, done = Files(spark), []
    try:
        for new, current in moves:
            old = f"{current.rstrip('/')}__old-{uuid.uuid4().hex}" if files.exists(current) else None
            if old:
                files.rename(current, old)
            done.append((new, current, old))
            if new:
                files.rename(new, current)
    except Exception:
        for new, current, old in reversed(done):
            if new and files.exists(current) and not files.exists(new):
                files.rename(current, new)
            if old and not files.exists(current):
                files.rename(old, current)
        raise
    for _, _, old in done:
        if old:
            files.delete(old)


def year_moves(spark: SparkSession, new: str, current: str, years: Iterable[int]) -> list[tuple[str | None, str]]:
    """Moves that replace ``years`` of a table by year; a year that ``new`` does not hold goes."""
    held = Files(spark).years(new)
    return [(f"{new}/year={y}" if y in held else None, f"{current}/year={y}") for y in years]
