"""Several tables published at once: folders per version, and a commit written last.

Data is only ever added, in folders named after the version that wrote them. A
commit is a small file that lists, for every table, the folders it consists of and
its schema; it gets its name by one rename, once all data is there. Readers take
the latest commit and see all its tables or, before it, none of them. A run that
dies leaves folders that no commit names.

A table may consist of folders of several versions, so a run that changes one
month writes that month alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.sources.tables import join_path, write_table

COMMITS = "commits"
# The innermost folder of every part; the name is no column of the tables.
VERSION = "published_version"


class ConflictError(RuntimeError):
    """Another run has published in the meantime."""


@dataclass(frozen=True)
class Published:
    """One commit: for every table its schema and its folders, by partition."""

    number: int = 0
    tables: Mapping[str, Mapping] = field(default_factory=dict)

    def parts(self, name: str) -> dict[str, list[str]]:
        """Partition (``column=value/…``, empty for none) to the folders that hold it."""
        return {p: list(f) for p, f in self.tables[name]["parts"].items()} if name in self.tables else {}


class Store:
    """The published tables below one folder, which every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def current(self) -> Published:
        """The latest commit; one without tables if there is none."""
        folder = join_path(self.root, COMMITS)
        numbers = [int(n.split(".")[0]) for n in self._names(folder) if n.endswith(".json")]
        return self.at(max(numbers)) if numbers else Published()

    def at(self, number: int) -> Published:
        path = join_path(self.root, COMMITS, f"{number:012d}.json")
        text = "\n".join(r.value for r in self.spark.read.text(path).collect())
        return Published(number, json.loads(text)["tables"])

    def read(self, name: str, published: Published | None = None) -> DataFrame:
        """A table of the latest commit, or of the one given."""
        published = self.current() if published is None else published
        if name not in published.tables:
            raise KeyError(f"no published table {name} below {self.root}")
        schema = T.StructType.fromJson(published.tables[name]["schema"])
        paths = [f for folders in published.parts(name).values() for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        base = join_path(self.root, name)
        full = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        reader = self.spark.read.option("basePath", base).schema(full)
        return reader.parquet(*[join_path(base, p) for p in paths]).select(*schema.names)

    def _folders(self, base: str, depth: int, version: str) -> list[str]:
        """The folders of a version, relative to their table's."""
        pattern = join_path(base, *["*"] * depth, f"{VERSION}={version}")
        found = self._fs.globStatus(self._path(pattern)) or []
        return ["/".join(str(s.getPath()).rsplit("/", depth + 1)[1:]) for s in found]


class Publication:
    """Tables on their way; nothing is seen of them before ``commit``.

    What is not written or kept explicitly stays as the commit before had it.
    """

    def __init__(self, store: Store):
        self.store, self.base = store, store.current()
        self.version = uuid.uuid4().hex
        self.tables = {n: {"schema": t["schema"], "parts": dict(t["parts"])} for n, t in self.base.tables.items()}

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        lookup_by: Sequence[str] = (),
        keep: Callable[[str], bool] | None = None,
        add: bool = False,
        last: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> list[str]:
        """Writes ``last`` of ``df`` as (part of) the table; returns the partitions it has rows of.

        ``last`` is applied once the rows are dealt out to their partitions, so columns
        that it adds are not shuffled. It keeps the partition columns as they are.

        Without ``keep`` the table is replaced. With it, the partitions that it
        accepts stay as they are, and all others are replaced by what ``df``
        holds. With ``add``, the rows join those of the table.
        """
        folder = join_path(self.store.root, name)
        if partition_by:
            tagged = lambda dealt: last(dealt).withColumn(VERSION, F.lit(self.version))
            write_table(df, folder, partition_by, lookup_by, append=True, last=tagged, folders=[VERSION])
        else:
            # Written to its folder directly, an empty table is there, too.
            write_table(last(df), join_path(folder, f"{VERSION}={self.version}"), (), lookup_by)
        new = {}
        for path in self.store._folders(folder, len(partition_by), self.version):
            new[path.rpartition("/")[0]] = [path]
        old = self.base.parts(name)
        if add:
            for part, folders in old.items():
                new[part] = [*folders, *new.get(part, [])]
        elif keep is not None:
            new = {**{p: f for p, f in old.items() if keep(p)}, **{p: f for p, f in new.items() if not keep(p)}}
        self.tables[name] = {"schema": last(df).schema.jsonValue(), "parts": new}
        return sorted(new)

    def commit(self) -> Published:
        """Makes all that was written the current state, in one step.

        If another run has committed since this one began, it is an error and
        nothing changes.
        """
        store, number = self.store, self.base.number + 1
        folder = join_path(store.root, COMMITS)
        draft = store._path(join_path(folder, f".{self.version}"))
        final = store._path(join_path(folder, f"{number:012d}.json"))
        store._fs.mkdirs(store._path(folder))
        out = store._fs.create(draft, True)
        out.write(bytearray(json.dumps({"tables": self.tables}).encode()))
        out.close()
        if store._fs.exists(final) or not store._fs.rename(draft, final):
            store._fs.delete(draft, False)
            raise ConflictError(f"commit {number} below {store.root} is another run's")
        return Published(number, self.tables)


def remove_unpublished(store: Store, keep: int = 1) -> int:
    """Deletes commits before the last ``keep``, and folders that none of these names.

    Returns the number of folders deleted. Run it while no other run publishes.
    """
    current = store.current()
    kept = [store.at(n) for n in range(max(1, current.number - keep + 1), current.number + 1)]
    named = {(n, f) for c in kept for n in c.tables for folders in c.parts(n).values() for f in folders}
    gone = 0
    for name in current.tables:
        base = join_path(store.root, name)
        depths = {f.count("/") for n, f in named if n == name} or {0}
        for depth in depths:
            for path in store._folders(base, depth, "*"):
                if (name, path) not in named:
                    store._fs.delete(store._path(join_path(base, path)), True)
                    gone += 1
    folder = join_path(store.root, COMMITS)
    for file in store._names(folder):
        if file.endswith(".json") and int(file.split(".")[0]) <= current.number - keep:
            store._fs.delete(store._path(join_path(folder, file)), False)
    return gone
