"""Sets of tables that a reader sees change all at once.

Folders of a set at ``base`` are written once and never replaced:

    base/_versions/00000007.json             what version 7 holds: of each table its schema and the folder of each part
    base/<table>/year=2021/v=00000005-…      a year of a table by year, as version 5 left it
    base/<table>/v=00000007-…                a table in one piece

Publishing moves complete folders to names that nobody reads yet and then puts the next numbered file into ``_versions`` by one
rename that refuses to overwrite. Before it readers see the old version, after it the new one, whole in both cases; a driver lost at any
step leaves the old version. Of two writers that started from the same version the second is refused. A version that changes some
years names the other years' old folders, so nothing is copied.

A reader resolves the newest file once and reads what it names. The ``KEPT`` newest versions stay on disk for readers at work; older
folders go at the next publication, with those that lost writers left behind.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyfold.sinks.publish import Files

VERSIONS = "_versions"
#: Newest versions that stay readable: the published one and the one before it.
KEPT = 2
_VERSION_COLUMN = "v"


class ConcurrentPublication(RuntimeError):
    """Another writer has published since this one began."""


@dataclass(frozen=True)
class Part:
    """A table of one version: its schema and the folder names of its years, or of the whole under ``None``."""

    schema: str
    folders: dict[int | None, str]


@dataclass(frozen=True)
class Snapshot:
    """One version of a set. What it reads stays the same whatever is published later."""

    spark: SparkSession
    base: str
    number: int = 0
    tables: dict[str, Part] = field(default_factory=dict)

    def paths(self, name: str) -> list[str]:
        return [folder(self.base, name, year, v) for year, v in sorted(self.tables[name].folders.items(), key=str)]

    def read(self, name: str) -> DataFrame:
        """A table of this version; tables by year have a column ``year``. One scan, however many versions its years are from."""
        if name not in self.tables:
            raise ValueError(f"{self.base} holds no table {name!r}")
        schema = StructType.fromJson(json.loads(self.tables[name].schema))
        if not (paths := self.paths(name)):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.base}/{name}").parquet(*paths)
        return found.select(*[f"`{c}`" for c in schema.names])


def folder(base: str, name: str, year: int | None, version: str) -> str:
    return f"{base}/{name}/{'' if year is None else f'year={year}/'}{_VERSION_COLUMN}={version}"


def current(spark: SparkSession, base: str) -> Snapshot:
    """The newest version of the set at ``base``; an empty one of number 0 where nothing is published."""
    files, base = Files(spark), base.rstrip("/")
    if not (numbers := _numbers(files, base)):
        return Snapshot(spark, base)
    return _load(spark, files, base, numbers[-1])


def _numbers(files: Files, base: str) -> list[int]:
    found = (re.fullmatch(r"(\d{8})\.json", n) for n in files.names(f"{base}/{VERSIONS}"))
    return sorted(int(m.group(1)) for m in found if m)


def _file(base: str, number: int) -> str:
    return f"{base}/{VERSIONS}/{number:08d}.json"


def _load(spark: SparkSession, files: Files, base: str, number: int) -> Snapshot:
    held = json.loads(files.text(_file(base, number)))
    tables = {
        name: Part(t["schema"], {None if y == "" else int(y): v for y, v in t["folders"].items()}) for name, t in held["tables"].items()
    }
    return Snapshot(spark, base, number, tables)


@dataclass(frozen=True)
class Staged:
    """A table written aside at ``path``. ``years`` are those that it replaces: all if ``None``; a table in one piece has no years."""

    path: str
    schema: StructType
    by_year: bool = True
    years: Iterable[int] | None = None


def publish(began: Snapshot, staged: dict[str, Staged], keep: int = KEPT) -> Snapshot:
    """Publish the next version after ``began``: the staged tables, and all else as it was.

    A year that a staged table replaces but does not hold is gone in the new version.
    """
    spark, base = began.spark, began.base
    files, number = Files(spark), began.number + 1
    version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
    tables = dict(began.tables)
    for name, new in staged.items():
        if not new.by_year:
            files.rename(new.path, folder(base, name, None, version))
            tables[name] = Part(new.schema.json(), {None: version})
            continue
        held = files.years(new.path)
        before = tables[name].folders if name in tables and new.years is not None else {}
        replaced = set(held if new.years is None else new.years)
        if not set(held) <= replaced:
            raise ValueError(f"{new.path} holds years beyond {sorted(replaced)}")
        for year in held:
            files.rename(f"{new.path}/year={year}", folder(base, name, year, version))
        kept = {y: v for y, v in before.items() if y not in replaced}
        tables[name] = Part(new.schema.json(), kept | dict.fromkeys(held, version))
    text = {n: {"schema": t.schema, "folders": {"" if y is None else str(y): v for y, v in t.folders.items()}} for n, t in tables.items()}
    aside = f"{base}/{VERSIONS}/.new-{uuid.uuid4().hex}"
    files.write_text(aside, json.dumps({"tables": text}, indent=1))
    if not files.rename_to_new(aside, _file(base, number)):
        files.delete(aside)
        raise ConcurrentPublication(f"version {number} of {base} is published already")
    published = Snapshot(spark, base, number, tables)
    expire(spark, base, keep)
    return published


def expire(spark: SparkSession, base: str, keep: int = KEPT) -> None:
    """Remove all but the ``keep`` newest versions, and folders of writers that never published.

    A folder carries the number that its version was to have. Numbers above the newest belong to writers at work and stay.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    files = Files(spark)
    numbers = _numbers(files, base)
    kept = [_load(spark, files, base, n) for n in numbers[-keep:]]
    for n in numbers[:-keep]:
        files.delete(_file(base, n))
    if not kept:
        return
    used = {p for s in kept for name in s.tables for p in s.paths(name)}
    names = {name for s in kept for name in s.tables}
    for name in names:
        for entry in files.names(f"{base}/{name}"):
            within = [f"{entry}/{v}" for v in files.names(f"{base}/{name}/{entry}")] if entry.startswith("year=") else [entry]
            for path in within:
                found = re.search(rf"{_VERSION_COLUMN}=(\d+)-\w+$", path)
                if found and int(found.group(1)) <= kept[-1].number and f"{base}/{name}/{path}" not in used:
                    files.delete(f"{base}/{name}/{path}")
