"""Publishing: a table is written beside its place and moved there by renames.

Beside the table ``<parent>/<name>`` lies the work folder ``<parent>/_publish-<name>``:

1. ``incoming`` receives the new files; readers still see the old table;
2. ``record`` is written when they are complete and every gate has passed: it names
   what is to be replaced. From here on the publication is decided;
3. the folders of ``incoming`` are renamed into place, one by one or all at once;
4. the work folder goes.

Whatever interrupts this, :func:`recover` brings the table to one of two states:
without a record nothing has happened, with one the remaining renames are done.
Every writer calls it first. A table has one writer at a time. Folder names, never
rows, pass through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from agroweather.session import file_exists, remove_folder

REPLACE_TABLE = "table"
REPLACE_PARTITIONS = "partitions"


class PublishError(RuntimeError):
    """A folder could not be moved into its place."""


def work_folder(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_publish-{name}"


def incoming(path: str) -> str:
    """Where the next content of the table is to be written."""
    return f"{work_folder(path)}/incoming"


def _record(path: str) -> str:
    return f"{work_folder(path)}/record"


def _replaced(path: str) -> str:
    return f"{work_folder(path)}/replaced"


def _target(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders directly under a table, in order."""
    target, files = _target(spark, path)
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target) if status.isDirectory())
    return sorted(name for name in names if "=" in name)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the parent is made, a folder in the way is an error."""
    to, files = _target(spark, target)
    files.mkdirs(to.getParent())
    if not files.rename(_target(spark, source)[0], to):
        raise PublishError(f"cannot move {source} to {target}")


def discard(spark: SparkSession, path: str) -> None:
    """Forget what was written but is not to be published."""
    remove_folder(spark, work_folder(path))


def decide(spark: SparkSession, path: str, replace: str, drop: Sequence[str] = ()) -> None:
    """Write the record: the content of ``incoming`` is complete and replaces the table's.

    ``replace="partitions"`` replaces the partitions found in ``incoming`` and
    deletes those named in ``drop``; the others stay.
    """
    text = json.dumps({"replace": replace, "drop": sorted(drop)})
    draft, files = _target(spark, f"{_record(path)}.draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{_record(path)}.draft", _record(path))


def _decided(spark: SparkSession, path: str) -> dict | None:
    if not file_exists(spark, _record(path)):
        return None
    target, files = _target(spark, _record(path))
    stream = files.open(target)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return json.loads(text)


def install(spark: SparkSession, path: str) -> None:
    """Do what is left of a decided publication. Each step may be repeated."""
    todo = _decided(spark, path)
    new = incoming(path)
    if todo["replace"] == REPLACE_TABLE:
        if file_exists(spark, new):
            if file_exists(spark, path):
                move(spark, path, _replaced(path))
            move(spark, new, path)
    else:
        names = partition_folders(spark, new)
        for name in names:
            remove_folder(spark, f"{path}/{name}")
            move(spark, f"{new}/{name}", f"{path}/{name}")
        for name in todo["drop"]:
            remove_folder(spark, f"{path}/{name}")
    discard(spark, path)


def publish(spark: SparkSession, path: str, replace: str = REPLACE_TABLE, drop: Sequence[str] = ()) -> None:
    """Put what was written to ``incoming`` in place of the table or of its partitions."""
    fresh = set(partition_folders(spark, incoming(path)))
    decide(spark, path, replace, [name for name in drop if name not in fresh])
    install(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a decided publication, discard an undecided one; whether one was finished."""
    if not file_exists(spark, work_folder(path)):
        return False
    if _decided(spark, path) is None:
        discard(spark, path)
        return False
    install(spark, path)
    return True
