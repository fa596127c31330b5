"""Replacing slices of several tables as one step, which a dying job leaves either undone or to be finished.

A commit works in two steps. First the new content of every slice is staged in a folder of its own beside the tables,
while the stored tables stay as they are, so the new content may be worked out from them. Then a record that names all
staged slices is written, and each slice folder is renamed into its place. A job that dies before the record has
changed nothing: its folder is swept away. One that dies after it is finished by whoever opens the warehouse next:
renaming goes on with the slices that are still staged. Parents and children of one request thus always belong together.

One job at a time writes to a warehouse; several commits of one job may be open side by side as long as no two of them
stage the same table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.session import file_system, remove

FOLDER = "_commits"
RECORD = "RECORD"
_RENAMES = 16  # made side by side

# Characters that a partition folder's name writes as %XX.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(c) for c in range(32)}


@dataclass
class Part:
    """Slices staged for one table: where they go, where they lie, how deep, and which slices are emptied."""

    target: str
    staged: str
    depth: int
    emptied: list[str]


class Commit:
    """Staged slices of one or several folders under a warehouse's root."""

    def __init__(self, spark: SparkSession, root: str, number: str | None = None):
        self.spark = spark
        self.root = root
        self.folder = f"{root}/{FOLDER}/{number or uuid.uuid4().hex}"
        self.parts: list[Part] = []

    def stage(self, target: str, rows: DataFrame, by: Sequence[str], order: Sequence[str], emptied: Iterable[str] = ()) -> Part:
        """``rows`` become the whole content of the slices they fall into; ``emptied`` slices lose theirs.

        What is emptied may still be told to the part returned, until the commit is published. ``target`` is the table's folder below the root. The rows are rebalanced by slice: AQE joins small slices into
        one file each and splits a slice that is too large for one task.
        """
        if any(part.target == target for part in self.parts):
            raise ValueError(f"{target} is staged already")
        staged = f"{self.folder}/{len(self.parts)}"
        (
            rows.hint("rebalance", *[F.col(c) for c in by])
            .sortWithinPartitions(*by, *order)
            .write.partitionBy(*by)
            .parquet(staged)
        )
        self.parts.append(Part(target, staged, len(by), sorted(set(emptied))))
        return self.parts[-1]

    def publish(self) -> None:
        """Records what is staged, then puts it in its place."""
        if self.parts:
            _write(self.spark, f"{self.folder}/{RECORD}", json.dumps([asdict(part) for part in self.parts]))
            finish(self.spark, self.root, self.folder, self.parts)
        self.undo()

    def undo(self) -> None:
        """Sweeps away what is left of the commit's folder."""
        remove(self.spark, self.folder)

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, kind, error, trace) -> None:
        # After the record nothing is undone: what a failing rename leaves is finished by recovery.
        if kind is None:
            self.publish()
        elif not _exists(self.spark, f"{self.folder}/{RECORD}"):
            self.undo()


def finish(spark: SparkSession, root: str, folder: str, parts: Sequence[Part]) -> None:
    """Renames every slice that is still staged and removes the emptied ones. Can be done again at any point."""
    with ThreadPoolExecutor(_RENAMES) as pool:
        for part in parts:
            below = _movable(spark, part.staged, f"{root}/{part.target}", part.depth)
            list(pool.map(lambda leaf, p=part: _put(spark, f"{p.staged}/{leaf}", f"{root}/{p.target}/{leaf}"), below))
            list(pool.map(lambda leaf, p=part: remove(spark, f"{root}/{p.target}/{leaf}"), part.emptied))


def _movable(spark: SparkSession, staged: str, target: str, depth: int) -> list[str]:
    """The staged folders to rename, relative to ``staged``: where nothing is stored below a name yet, all of it at once."""
    moved, walked = [], [""]
    for level in range(1, depth + 1):
        below = []
        for above in walked:
            stored = set(folder_names(spark, f"{target}{above}")) if level < depth else None
            for name in folder_names(spark, f"{staged}{above}"):
                (moved if stored is None or name not in stored else below).append(f"{above}/{name}")
        walked = below
    return [leaf.lstrip("/") for leaf in moved]


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finishes the recorded commits of jobs that died and sweeps away the others. Returns the finished ones' folders."""
    finished = []
    for name in folder_names(spark, f"{root}/{FOLDER}"):
        folder = f"{root}/{FOLDER}/{name}"
        if _exists(spark, f"{folder}/{RECORD}"):
            parts = [Part(**part) for part in json.loads(_read(spark, f"{folder}/{RECORD}"))]
            finish(spark, root, folder, parts)
            finished.append(folder)
        remove(spark, folder)
    return finished


def slice_folder(columns: Sequence[str], row) -> str:
    """The folder of a slice below its table, as Spark names it."""
    return "/".join(f"{c}={_folder_name(row[c])}" for c in columns)


def _folder_name(value) -> str:
    """What a slice's value is called in its folder; Spark has a name of its own for NULL."""
    return "__HIVE_DEFAULT_PARTITION__" if value is None else "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def _put(spark: SparkSession, source: str, target: str) -> None:
    fs, to = file_system(spark, target)
    _, at = file_system(spark, source)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"could not rename {source} to {target}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return []
    return [status.getPath().getName() for status in fs.listStatus(where) if status.isDirectory()]


def leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The folders ``depth`` levels below ``path``, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{above}/{name}" for above in found for name in folder_names(spark, f"{path}{above}")]
    return [leaf.lstrip("/") for leaf in found if leaf]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def _write(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file whole: it has its name only once it is complete."""
    fs, draft = file_system(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, file_system(spark, path)[1]):
        raise OSError(f"could not write {path}")


def _read(spark: SparkSession, path: str) -> str:
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
