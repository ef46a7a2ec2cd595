"""Versions of a stored table: folders of data, and commits that name the one to read.

A table's folder holds ``_versions/{number}-{id}``, each written once and never changed, and
``_commits/{number}.json``. The commit of the highest number is the table; a folder that no commit
names does not exist for readers. So a write that fails leaves the table as it was, and readers that
have started keep their version, as the one before the last is kept.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from patronage.session import file_system

VERSIONS, COMMITS = "_versions", "_commits"
_COMMIT = re.compile(r"(\d{12})\.json")


class ConcurrentWrite(RuntimeError):
    """Another writer has committed the version that this one was to be."""


@dataclass(frozen=True)
class Commit:
    """What a commit says: the version's folder, its rows, its schema, and the run that wrote it."""

    number: int
    folder: str
    rows: int
    schema: str
    run: str | None = None


def _names(spark: SparkSession, folder: str) -> list[str]:
    system, path = file_system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(path)] if system.isDirectory(path) else []


def is_versioned(spark: SparkSession, table: str) -> bool:
    system, path = file_system(spark, f"{table}/{VERSIONS}")
    # Asked of the table first: a path below a single file is an error in some stores.
    return system.isDirectory(path.getParent()) and system.isDirectory(path)


def commits(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the table's commits, in order."""
    return sorted(int(found[1]) for name in _names(spark, f"{table}/{COMMITS}") if (found := _COMMIT.fullmatch(name)))


def read_commit(spark: SparkSession, table: str, number: int) -> Commit:
    system, path = file_system(spark, f"{table}/{COMMITS}/{number:012d}.json")
    stream = system.open(path)
    try:
        return Commit(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def current(spark: SparkSession, table: str) -> Commit | None:
    """The commit that readers follow; None for a table without versions, or none of them committed."""
    numbers = commits(spark, table) if is_versioned(spark, table) else []
    return read_commit(spark, table, numbers[-1]) if numbers else None


def new_version(spark: SparkSession, table: str) -> tuple[int, str]:
    """Number of the version to write, and the name of its unused folder."""
    number = max(commits(spark, table), default=0) + 1
    return number, f"{number:012d}-{uuid.uuid4().hex}"


def folder_of(table: str, folder: str) -> str:
    return f"{table}/{VERSIONS}/{folder}"


def commit(spark: SparkSession, table: str, made: Commit) -> None:
    """Make a version the table's current one, in one step that readers see wholly or not at all."""
    final = f"{table}/{COMMITS}/{made.number:012d}.json"
    system, target = file_system(spark, final)
    _, draft = file_system(spark, f"{table}/{COMMITS}/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(json.dumps(asdict(made)).encode()))
    stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise ConcurrentWrite(f"{table}: version {made.number} has been committed by another writer")


def remove_old(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Remove what is older than the last ``keep`` commits, with what failed writes left there.

    Folders of versions still to be committed have higher numbers and stay.
    """
    numbers = commits(spark, table)
    if not numbers:
        return
    oldest = numbers[-keep:][0]
    kept = {read_commit(spark, table, number).folder for number in numbers[-keep:]}
    stale = [f"{VERSIONS}/{name}" for name in _names(spark, f"{table}/{VERSIONS}") if name not in kept and int(name[:12]) <= oldest]
    stale += [f"{COMMITS}/{number:012d}.json" for number in numbers[:-keep]]
    # Data of a table from before it had versions.
    stale += [name for name in _names(spark, table) if name not in (VERSIONS, COMMITS)]
    for name in stale:
        system, path = file_system(spark, f"{table}/{name}")
        system.delete(path, True)
