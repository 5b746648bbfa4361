"""Replacing folders of a table so that an interruption loses nothing.

New rows are written aside, into a hidden folder of the table that readers skip.
Once they are complete, a plan (one small JSON file: which folder goes where) is
put in place by a rename, and then carried out by renames of folders:

    target            -> .publish-<id>/old/<n>      (if there is one)
    .publish-<id>/new -> target

The plan is deleted last.  A job that dies before its plan is in place has changed
nothing: the next writer of the same target drops its leftovers.  One that dies
later is finished by the next writer of the table, whatever its target: a step
whose source is gone has been done.  `recover` does both; every writer calls it
first, and so may a reader's job.

Writers of different targets of a table may run at a time, writers of one target may
not, as with the engine's own overwrite.  A folder is missing for readers between
two renames, but never lost.  Renames of folders must be atomic (HDFS, local and
shared file systems).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

PREFIX, PLAN = ".publish-", "plan.json"


def fs_and_path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def rename(fs, source, target) -> None:
    """Rename a folder, or raise: the file system itself only says no.  A source that is
    gone has been renamed by another writer that finishes the same plan."""
    if not fs.rename(source, target) and fs.exists(source):
        raise OSError(f"could not rename {source} to {target}")


def _scope(target: str) -> str:
    return f"{PREFIX}{hashlib.sha256(target.encode()).hexdigest()[:12]}-"


@contextmanager
def aside(spark: SparkSession, table: str, target: str = ""):
    """A hidden folder of `table` to write into what shall be published as `target` (empty: several
    partitions); it is dropped if the writer fails before publishing."""
    home = f"{table}/{_scope(target)}{uuid.uuid4().hex[:12]}"
    try:
        yield f"{home}/new"
    except BaseException:
        fs, path = fs_and_path(spark, home)
        if not fs.exists(_path(spark, home, PLAN)):
            fs.delete(path, True)
        raise


def leaves(spark: SparkSession, folder: str, depth: int) -> dict[str, str]:
    """Partition folders `depth` levels below `folder`: relative path -> full path."""
    fs, root = fs_and_path(spark, folder)
    found = [("", root)]
    for _ in range(depth):
        found = [(f"{rel}/{s.getPath().getName()}".lstrip("/"), s.getPath()) for rel, at in found
                 for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
    return {rel: at.toString() for rel, at in found}


def replace(spark: SparkSession, table: str, moves: dict[str, str | None]) -> None:
    """Publish complete folders: each target (relative to `table`) gets the folder
    it is given, all of one hidden folder; a target given None is removed."""
    homes = {f[f.index(f"/{PREFIX}") + 1:].split("/")[0] for f in moves.values() if f}
    if len(homes) > 1:
        raise ValueError("all new folders must have been written aside together")
    fs, _ = fs_and_path(spark, table)
    home = f"{table}/{homes.pop() if homes else _scope('') + uuid.uuid4().hex[:12]}"
    steps = [[target, f[f.index(f"/{PREFIX}") + 1:].split("/", 1)[1] if f else None] for target, f in moves.items()]
    draft, plan = _path(spark, home, f".{PLAN}"), _path(spark, home, PLAN)
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(steps).encode()))
    finally:
        out.close()
    rename(fs, draft, plan)
    _carry_out(spark, table, home, steps)


def _carry_out(spark: SparkSession, table: str, home: str, steps) -> None:
    fs, _ = fs_and_path(spark, home)
    fs.mkdirs(_path(spark, home, "old"))
    for n, (target, new) in enumerate(steps):
        old, goal = _path(spark, home, "old", str(n)), _path(spark, table, target)
        source = _path(spark, home, new) if new else None
        if (source is None or fs.exists(source)) and fs.exists(goal) and not fs.exists(old):
            rename(fs, goal, old)
        if source is not None and fs.exists(source):
            fs.mkdirs(goal.getParent())
            rename(fs, source, goal)
    # the plan goes with the folder; what is left of an interrupted delete has no plan and is dropped later
    fs.delete(_path(spark, home, PLAN), False)
    fs.delete(_path(spark, home), True)


def recover(spark: SparkSession, table: str, target: str | None = None) -> list[str]:
    """Finish interrupted publishes of `table` and drop what was written aside for
    `target` (by default for any: no writer may be at work then) and never
    published; returns what was done ("finished ..." or "dropped ...")."""
    fs, root = fs_and_path(spark, table)
    if not fs.exists(root):
        return []
    done = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith(PREFIX)):
            continue
        home = f"{table}/{name}"
        plan = _path(spark, home, PLAN)
        if fs.exists(plan):
            text = fs.open(plan)
            try:
                steps = json.loads(bytes(text.readAllBytes()))
            finally:
                text.close()
            _carry_out(spark, table, home, steps)
            done.append(f"finished {name}")
        elif target is None or name.startswith(_scope(target)):
            fs.delete(_path(spark, home), True)
            done.append(f"dropped {name}")
    return done
