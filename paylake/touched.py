"""Which days of staging each mart has not seen yet.

Before staging is written, the days that are going to change are noted for every mart, as empty files
named by day. A mart that has taken a note into account deletes it. So a day may be noted in vain,
when a write is stopped, but none is ever missed, and marts may be built at different times.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from paylake.operators.scratch import file_system

ALL = "all"


@dataclass(frozen=True)
class Notes:
    """Open notes of a mart; ``days`` is None where the whole mart has to be built."""

    files: tuple[str, ...]
    days: tuple[dt.date, ...] | None


@dataclass(frozen=True)
class Touched:
    spark: SparkSession
    root: str

    def _folder(self, mart: str) -> str:
        return f"{self.root}/touched/{mart}"

    def note(self, marts: Iterable[str], days: Iterable[dt.date] | None) -> None:
        """Note days for each mart; None means that everything may have changed."""
        names = [ALL] if days is None else sorted(map(str, days))
        for mart in marts:
            for name in names:
                fs, where = file_system(self.spark, f"{self._folder(mart)}/{name}.{uuid.uuid4().hex[:8]}")
                fs.mkdirs(where.getParent())
                fs.createNewFile(where)

    def open_notes(self, mart: str) -> Notes:
        """A mart for which nothing was ever noted has to be built in full."""
        fs, where = file_system(self.spark, self._folder(mart))
        if not fs.exists(where):
            return Notes((), None)
        files = tuple(sorted(f.getPath().getName() for f in fs.listStatus(where)))
        names = {f.split(".")[0] for f in files}
        return Notes(files, None if ALL in names else tuple(sorted(map(dt.date.fromisoformat, names))))

    def done(self, mart: str, notes: Notes) -> None:
        """The mart holds what these notes tell; the folder stays, so the next build knows that it may go on."""
        fs, folder = file_system(self.spark, self._folder(mart))
        fs.mkdirs(folder)
        for name in notes.files:
            fs.delete(file_system(self.spark, f"{self._folder(mart)}/{name}")[1], False)
