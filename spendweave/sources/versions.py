"""Published tables in versions that are switched at once.

Every run writes its tables into folders of its own, ``<folder>/<table>/run=<id>/...``. At the end it
adds a small numbered manifest that names, for each table, the schema and the parts that make it up.
The highest number is the current version: a run that fails leaves no trace for readers, and one that
commits switches all tables in one step. Readers resolve a manifest once and stay on it, so they never
see tables of two states. A run may take over parts of the version before it, whose files stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendweave.sources import files

MANIFESTS = "versions"


@dataclass(frozen=True)
class Table:
    """What a manifest says of a table: its schema, partition columns, and parts below the table's folder.

    ``whole`` has the runs all of whose parts are among them, which are read as one folder.
    """

    schema: T.StructType
    by: tuple[str, ...]
    parts: tuple[str, ...]
    whole: tuple[str, ...] = ()

    def folders(self) -> list[str]:
        return [*self.whole, *[p for p in self.parts if p.split("/")[0] not in self.whole]]


@dataclass(frozen=True)
class Version:
    """All tables of one state; reading it never looks at other states."""

    spark: SparkSession
    folder: str
    number: int
    tables: dict[str, Table]

    def read(self, name: str, run: str | None = None) -> DataFrame:
        """A table, or what one run wrote of it, with its partition columns, by which Spark prunes files."""
        table = self.tables[name]
        folders = [run] if run else table.folders()
        if not table.parts or run and not any(p.split("/")[0] == run for p in table.parts):
            return self.spark.createDataFrame([], table.schema)
        schema = T.StructType([*table.schema.fields, T.StructField("run", T.StringType())])
        root = f"{self.folder}/{name}"
        stored = self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p}" for p in folders])
        return stored.select(*table.schema.names)

    def paths(self) -> set[str]:
        """The folders of all parts of all tables."""
        return {f"{self.folder}/{name}/{part}" for name, table in self.tables.items() for part in table.parts}


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Versions that can be read, oldest first."""
    found = files.names(spark, f"{folder}/{MANIFESTS}")
    return [int(name.removesuffix(".json")) for name in found if name.endswith(".json") and not name.startswith(".")]


def _manifest(folder: str, number: int) -> str:
    return f"{folder}/{MANIFESTS}/{number:010d}.json"


def version(spark: SparkSession, folder: str, number: int | None = None) -> Version:
    """One version, by default the current one."""
    if number is None:
        known = numbers(spark, folder)
        if not known:
            raise FileNotFoundError(f"nothing is published in {folder}")
        number = known[-1]
    told = json.loads(files.read_text(spark, _manifest(folder, number)))
    tables = {
        name: Table(T.StructType.fromJson(t["schema"]), tuple(t["by"]), tuple(t["parts"]), tuple(t["whole"]))
        for name, t in told.items()
    }
    return Version(spark, folder, number, tables)


@dataclass
class Draft:
    """A version in the making. Nothing of it can be seen before ``commit``."""

    spark: SparkSession
    folder: str
    base: Version | None = None
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, Table] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, by: Sequence[str] = (), keep: Callable[[str], bool] | None = None) -> DataFrame:
        """Write a table and return what this run wrote of it.

        With ``keep``, parts of the base version for which it is true stay part of the table.
        """
        own = f"run={self.run}"
        df.write.partitionBy(*by).parquet(f"{self.folder}/{name}/{own}")
        written = [f"{own}/{leaf}" for leaf in files.leaves(self.spark, f"{self.folder}/{name}/{own}", len(by))] if by else [own]
        base = self.base.tables[name] if keep and self.base else Table(T.StructType(), (), ())
        kept = [part for part in base.parts if keep(part)]
        lost = {part.split("/")[0] for part in base.parts if part not in kept}
        whole = [own] * bool(written) + [run for run in base.whole if run not in lost]
        # as read back: partition columns last, everything nullable
        names = [c for c in df.columns if c not in by] + list(by)
        schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in names])
        self.tables[name] = Table(schema, tuple(by), (*kept, *written), tuple(whole))
        return self.read(name, own)

    def read(self, name: str, run: str | None = None) -> DataFrame:
        return Version(self.spark, self.folder, 0, self.tables).read(name, run)

    def commit(self) -> Version:
        """Make this version the current one. Fails, and changes nothing, if another run was faster.

        The number is the next one after the base, so a run that rests on an overtaken version does not win.
        """
        number = self.base.number + 1 if self.base else 1
        told = {
            name: {"schema": t.schema.jsonValue(), "by": t.by, "parts": t.parts, "whole": t.whole}
            for name, t in self.tables.items()
        }
        try:
            files.write_new(self.spark, _manifest(self.folder, number), json.dumps(told))
        except FileExistsError as error:
            raise RuntimeError(f"{self.folder} was published by another run meanwhile; run again") from error
        return Version(self.spark, self.folder, number, dict(self.tables))


def draft(spark: SparkSession, folder: str) -> Draft:
    """A new version on top of the current one, if there is one."""
    return Draft(spark, folder, version(spark, folder) if numbers(spark, folder) else None)


def drop_versions(spark: SparkSession, folder: str, keep: int = 1) -> list[int]:
    """Drop all but the last ``keep`` versions; return their numbers.

    Manifests go first, so that no reader resolves a version whose files are going. Parts that a kept
    version still names stay.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    known = numbers(spark, folder)
    old, kept = known[:-keep], known[-keep:]
    live = set().union(*[version(spark, folder, n).paths() for n in kept])
    for n in old:
        gone = version(spark, folder, n).paths() - live
        files.delete(spark, _manifest(folder, n))
        for path in sorted(gone):
            files.delete(spark, path)
    return old
