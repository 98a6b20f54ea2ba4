"""Whole-table replacement that readers never see half done.

A table is a folder of version folders. A new version is written in full beside the old one, then an
empty pointer file with its name appears: one file-system operation. Readers take the version of the
highest pointer, so they meet the old table or the new one, whatever happens to the writer. Version
folders older than the last ``keep`` are deleted after the switch; a plan that began on an old version
can finish meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from paylake.operators.scratch import file_system

POINTERS = "_current"
KEEP = 2


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = file_system(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def _number(name: str) -> int:
    return int(name[1:].split("-")[0])


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that readers see; None before the first one."""
    pointers = _names(spark, f"{path}/{POINTERS}")
    return f"{path}/{pointers[-1]}" if pointers else None


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEEP) -> str:
    """Have ``write`` fill a folder, make it the table, and return it."""
    pointers = _names(spark, f"{path}/{POINTERS}")
    name = f"v{_number(pointers[-1]) + 1 if pointers else 1:09d}-{uuid.uuid4().hex[:8]}"
    write(f"{path}/{name}")
    fs, pointer = file_system(spark, f"{path}/{POINTERS}/{name}")
    fs.mkdirs(pointer.getParent())
    if not fs.createNewFile(pointer):
        raise FileExistsError(str(pointer))
    expire(spark, path, keep)
    return f"{path}/{name}"


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete versions below the last ``keep``, and what broken writers left below them.

    Pointers go before folders, so no pointer ever names a folder that is gone.
    """
    pointers = _names(spark, f"{path}/{POINTERS}")
    if len(pointers) <= keep:
        return
    oldest = _number(pointers[-keep])
    for folder in (f"{path}/{POINTERS}", path):
        for name in _names(spark, folder):
            if name.startswith("v") and "-" in name and _number(name) < oldest:
                fs, where = file_system(spark, f"{folder}/{name}")
                fs.delete(where, True)
