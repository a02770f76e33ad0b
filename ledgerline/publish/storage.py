"""Listing, touching and removing files: what Spark's readers and writers have no call for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Storage:
    """The file system that a path names, through Hadoop's interface to it."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _place(self, path: str):
        place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def list(self, folder: str) -> list[tuple[str, float]]:
        """Paths in a folder with the time of their last change in seconds; nothing if it is not there."""
        place, system = self._place(folder)
        if not system.exists(place):
            return []
        try:
            found = system.listStatus(place)
        except Exception:
            # Removed between the two calls.
            if not system.exists(place):
                return []
            raise
        return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in found]

    def delete(self, paths: list[str]) -> None:
        for path in paths:
            place, system = self._place(path)
            system.delete(place, True)

    def touch(self, path: str) -> None:
        """Write a file anew, empty. Not every store can set a time on one that is there."""
        place, system = self._place(path)
        system.create(place, True).close()

    def now(self, folder: str) -> float:
        """The time by the clock that stamps files in a folder."""
        path = f"{folder}/.clock-{uuid.uuid4().hex}"
        self.touch(path)
        place, system = self._place(path)
        changed = system.getFileStatus(place).getModificationTime() / 1000
        system.delete(place, False)
        return changed
