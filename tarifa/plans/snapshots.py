"""The versions of a lake: an append-only list of snapshots, each naming the folders of both raw entities and of all tables.

Data is written into folders of its own run, which nobody reads until a snapshot names them. A snapshot is one small file,
written aside and then renamed to its number, without replacing: what a load or a build wrote becomes visible as a whole, and of
two runs that started from the same snapshot the second one fails. Readers of an older snapshot are not disturbed before
``clean`` removes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Parts = dict[str, dict[str, str]]


class SnapshotConflict(RuntimeError):
    """Another run has made a snapshot since this one started; its data stays unseen."""


@dataclass(frozen=True)
class Snapshot:
    """Folders, relative to the lake. ``raw`` and ``tables`` map a relation and a part of it (a year, or ``all``) to a folder;
    ``keys`` tells what a part of a table was derived from."""

    number: int = 0
    raw: Parts = field(default_factory=dict)
    tables: Parts = field(default_factory=dict)
    keys: dict[str, str] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {path for parts in (self.raw, self.tables) for of in parts.values() for path in of.values()}

    def years(self, entity: str) -> list[int]:
        return sorted(int(year) for year in self.raw.get(entity, {}))

    def with_raw(self, written: Parts) -> Snapshot:
        """The snapshot after some years of both entities were replaced."""
        names = {*self.raw, *written}
        return replace(self, raw={name: {**self.raw.get(name, {}), **written.get(name, {})} for name in names})


class SnapshotLog:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.folder}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        return [int(name[:-5]) for name in self._names("snapshots") if name.endswith(".json")]

    def read(self, number: int | None = None) -> Snapshot:
        """A snapshot, the latest by default; an empty one where there is none yet."""
        known = self.numbers()
        if not known:
            return Snapshot()
        path = f"{self.folder}/snapshots/{known[-1] if number is None else number:010d}.json"
        return Snapshot(**json.loads(self.spark.read.text(path, wholetext=True).first()[0]))

    def new_run(self, base: Snapshot) -> str:
        """A folder, relative to the lake, for what a run that starts from a snapshot writes."""
        return f"data/{base.number + 1:010d}-{uuid.uuid4().hex}"

    def commit(self, snapshot: Snapshot) -> Snapshot:
        """Make what the snapshot names visible as the successor of the one it was made from."""
        after = replace(snapshot, number=snapshot.number + 1)
        aside = self._path(f"{self.folder}/aside/{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(json.dumps(asdict(after), sort_keys=True).encode())
        stream.close()
        target = self._path(f"{self.folder}/snapshots/{after.number:010d}.json")
        self._fs.mkdirs(target.getParent())
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(target), how)
        except Py4JJavaError as error:
            self._fs.delete(aside, False)
            if self._fs.exists(target):
                raise SnapshotConflict(f"snapshot {after.number} exists already") from error
            raise
        return after

    def clean(self, keep: int) -> list[str]:
        """Remove all but the last snapshots, and the run folders that no kept one names; returns the folders removed.

        A folder of a run that may still be going on is left: its number is that of a snapshot yet to come.
        """
        known = self.numbers()
        kept = [self.read(number) for number in known[-keep:]]
        for number in known[:-keep]:
            self._fs.delete(self._path(f"{self.folder}/snapshots/{number:010d}.json"), False)
        used = {"/".join(path.split("/")[:2]) for snapshot in kept for path in snapshot.folders()}
        unused = [name for name in self._names("data") if f"data/{name}" not in used and int(name[:10]) <= max(known, default=0)]
        for name in unused:
            self._fs.delete(self._path(f"{self.folder}/data/{name}"), True)
        return [f"data/{name}" for name in unused]

    def frame(self, parts: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
        """The rows of all parts of a relation; only their folders are listed."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        paths = [f"{self.folder}/{parts[name]}" for name in sorted(parts)]
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def partitions(self, folder: str, column: str = "annee") -> dict[str, str]:
        """Value and folder of each partition below a folder of the lake, from its listing."""
        names = [name for name in self._names(folder) if name.startswith(f"{column}=")]
        return {name.split("=", 1)[1]: f"{folder}/{name}" for name in names}
