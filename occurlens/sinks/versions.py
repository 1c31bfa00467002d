"""Versioned tables behind one pointer.

Every run writes new folders; nothing that readers use is written in place. A
*manifest* names the folders that make up a state (the raw and clean folder of every year, the
table of ingested files, the KPI tables). Manifest n is the file ``manifests/<n>.json``; the highest number
is the current state. A commit puts the number after the one its run started from, and only if
no file has it yet: of two runs that started from the same state one commits, the other gets
``CommitConflict`` and publishes nothing. A run that fails before its commit leaves the
current state as it was; a rollback commits an earlier manifest again. Only a missing path
counts as "nothing stored"; any other read error is raised.

The put is a rename that does not overwrite: atomic on HDFS and the like. An object store whose
rename is a copy needs its own put-if-absent there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class CommitConflict(RuntimeError):
    """Another run committed after this one had read its state."""


@dataclass(frozen=True)
class Manifest:
    """Folders of one state. ``raw`` and ``clean`` map a year (None: rows without one) to its
    folder; ``sizes`` has how many years each folder holds, so a folder none of whose years was
    replaced is read without a year filter; ``files`` is the table of ingested files; ``seq`` is
    the number it was read under."""

    raw: dict[int | None, str] = field(default_factory=dict)
    clean: dict[int | None, str] = field(default_factory=dict)
    kpis: str | None = None
    clean_rows: int = 0
    files: str | None = None
    sizes: dict[str, int] = field(default_factory=dict)
    seq: int = field(default=0, compare=False)

    def to_json(self) -> str:
        return json.dumps({"raw": [[y, p] for y, p in self.raw.items()], "kpis": self.kpis, "clean_rows": self.clean_rows,
                           "clean": [[y, p] for y, p in self.clean.items()], "files": self.files,
                           "sizes": {p: self.sizes[p] for p in {*self.raw.values(), *self.clean.values()} if p in self.sizes}})

    @staticmethod
    def from_json(text: str, seq: int = 0) -> Manifest:
        d = json.loads(text)
        return Manifest(dict(map(tuple, d["raw"])), dict(map(tuple, d["clean"])), d["kpis"], d["clean_rows"], d["files"],
                        d["sizes"], seq)

    def with_(self, **changes) -> Manifest:
        return replace(self, **changes)


def is_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_if_present(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The Parquet table at ``path``, or None when the path does not exist."""
    if not _exists(spark, path):
        return None
    return spark.read.schema(schema).parquet(path)


def new_folder(root: str, kind: str) -> str:
    return f"{root}/{kind}/v-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------------------
# The manifest folder: a few small files, read and put through Hadoop's file system API
# ---------------------------------------------------------------------------

def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root}/manifests"
    if not _exists(spark, folder):
        return []
    names = [f.getPath().getName() for f in _file_system(spark, folder).listStatus(_path(spark, folder))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _name(root: str, seq: int) -> str:
    return f"{root}/manifests/{seq:012d}.json"


def _read(spark: SparkSession, root: str, seq: int) -> Manifest:
    file = _name(root, seq)
    stream = _file_system(spark, file).open(_path(spark, file))
    try:
        return Manifest.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"), seq)
    finally:
        stream.close()


def _put_if_absent(spark: SparkSession, file: str, text: str) -> bool:
    """Write a file whole under a hidden name, then rename it unless the name is taken."""
    jvm = spark._jvm
    hidden = f"{file.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    stream = _file_system(spark, file).create(_path(spark, hidden), False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, file).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, hidden), _path(spark, file), options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        _file_system(spark, file).delete(_path(spark, hidden), False)
        return False


def history(spark: SparkSession, root: str) -> list[tuple[int, Manifest]]:
    """Committed manifests, oldest first (one short file per run)."""
    return [(n, _read(spark, root, n)) for n in _numbers(spark, root)]


def current(spark: SparkSession, root: str) -> Manifest:
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else Manifest()


def commit(spark: SparkSession, root: str, manifest: Manifest) -> int:
    """Make ``manifest`` the current state, if the state it was derived from (``seq``) still
    is; one file, one atomic put."""
    numbers = _numbers(spark, root)
    seq = manifest.seq + 1
    if (numbers and numbers[-1] > manifest.seq) or not _put_if_absent(spark, _name(root, seq), manifest.to_json()):
        raise CommitConflict(f"state {manifest.seq} of {root} is no longer the current one")
    return seq


def rollback(spark: SparkSession, root: str, steps: int = 1) -> Manifest:
    """Commit the state ``steps`` commits ago again."""
    log = history(spark, root)
    if len(log) <= steps:
        raise ValueError(f"no state {steps} commits back ({len(log)} committed)")
    old = log[-1 - steps][1].with_(seq=log[-1][0])
    commit(spark, root, old)
    return old


def partition_values(df: DataFrame, column: str) -> set[str]:
    """Values of a partition column among the table's files: a listing, no job."""
    mark = f"/{column}="
    return {p.split(mark, 1)[1].split("/", 1)[0] for p in df.inputFiles() if mark in p}
