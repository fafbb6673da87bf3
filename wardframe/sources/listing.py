"""Files of a folder, listed by tasks."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.session import scratch_path


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark would read it by."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString()


def _children(batches):
    from urllib.parse import quote

    from pyarrow import fs

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            if uri.startswith("file:"):
                store, place = fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
            else:
                store, place = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
            # Names that Spark's readers pass over: marks of writers, and hidden files.
            inside = [
                f
                for f in store.get_file_info(fs.FileSelector(place))
                if not f.base_name.startswith(".") and (f.base_name[0] != "_" or "=" in f.base_name)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{uri.rstrip('/')}/{f.base_name}" for f in inside], pa.string()),
                    pa.array([f.type == fs.FileType.Directory for f in inside], pa.bool_()),
                    pa.array([f.size for f in inside], pa.int64()),
                ],
                names=["path", "is_folder", "n_bytes"],
            )


def name_pattern(glob: str) -> str:
    """A glob on file names, with ``*``, ``?``, ``[...]`` and ``{a,b}``, as a regular expression."""
    parts, depth = [], 0
    for token in re.findall(r"\[[^\]]+\]|\\.|.", glob):
        if token == "{":
            depth += 1
            parts.append("(?:")
        elif depth and token in ",}":
            depth -= token == "}"
            parts.append("|" if token == "," else ")")
        elif token[0] == "[" and len(token) > 1:
            negated = token[1] in "!^"
            inner = token[1 + negated : -1].replace("\\", "\\\\")
            parts.append(f"[{'^' if negated else ''}{inner}]")
        else:
            parts.append({"*": ".*", "?": "."}.get(token) or re.escape(token.lstrip("\\") or token))
    return f"^{''.join(parts)}$"


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Rows (path, n_bytes) of all files below ``folder`` whose name fits ``pattern``, empty ones too.

    One job per level of the tree: each task lists some folders, and what it finds
    is written to the shared scratch folder. The driver sees neither files nor
    folders. The store has to be one that workers open through ``pyarrow.fs``.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, found = spark.createDataFrame([(qualified(spark, folder),)], "path string"), []
    while True:
        path = scratch_path(spark, "listing")
        children = level.repartition(tasks, "path").mapInArrow(
            _children, "path string, is_folder boolean, n_bytes long"
        )
        children.write.parquet(path)
        below = spark.read.parquet(path)
        found.append(below.filter("NOT is_folder").select("path", "n_bytes"))
        level = below.filter("is_folder").select("path")
        if level.isEmpty():
            break
    name = F.element_at(F.split("path", "/"), -1)
    return reduce(DataFrame.unionByName, found).filter(name.rlike(name_pattern(pattern)))
