"""Two-phase publish of a folder: write beside, then switch by rename.

The rows are written to a new hidden folder next to the target. Only when that is complete the
served folder is renamed away and the new one takes its name, so a job that fails while it
computes or writes leaves the old rows as they were. If it ends between the two renames,
the next ``publish`` or ``recover`` puts the old folder back. Hidden names begin with an underscore and
have no equals sign, so no reader takes them for rows or partitions.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from clickmart.session import delete_dir, dir_exists, rename_dir


def _aside(path: str) -> str:
    """Where the old folder waits during a switch."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_old-{hashlib.sha256(name.encode()).hexdigest()[:16]}"


def recover(spark: SparkSession, path: str) -> None:
    """Finish a switch that was cut off: the old folder comes back if there is no new one."""
    old = _aside(path)
    if dir_exists(spark, old):
        if dir_exists(spark, path):
            delete_dir(spark, old)
        else:
            rename_dir(spark, old, path)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the folder ``path`` by what ``write`` puts into the folder that it is given."""
    path = path.rstrip("/")
    recover(spark, path)
    staged = f"{path.rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex[:16]}"
    try:
        write(staged)
        if dir_exists(spark, path):
            rename_dir(spark, path, _aside(path))
        rename_dir(spark, staged, path)
    except BaseException:
        delete_dir(spark, staged)
        recover(spark, path)
        raise
    recover(spark, path)
