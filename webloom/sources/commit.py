"""Outputs that appear whole or not at all: written beside the target, then moved there by renaming one folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class Place:
    """A path with the file system it is on."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.at = self._path(self.path)
        self.system = self.at.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.system.exists(self.at)

    def names(self) -> list[str]:
        return [x.getPath().getName() for x in self.system.listStatus(self.at)] if self.exists() else []

    def delete(self, name: str = "") -> None:
        self.system.delete(self._path(f"{self.path}/{name}") if name else self.at, True)

    def move(self, source: str, name: str = "") -> None:
        """Renames source to this path, or to a name below it; raises where the file system refuses."""
        target = self._path(f"{self.path}/{name}") if name else self.at
        self.system.mkdirs(target.getParent())
        if not self.system.rename(self._path(source), target):
            raise OSError(f"{source} can't be renamed to {target}")


@contextmanager
def staged_run(spark: SparkSession, target: str, overwrite: bool) -> Iterator[str]:
    """A folder to write into, which becomes a run of target's by one rename if the block ends without an error.

    Readers skip it before, as its name starts with an underscore; after an error it goes. overwrite: what target held
    goes once the run is there, so a job that fails, at whatever point, has taken nothing away. Between rename and
    deletion both are there; the next overwrite deletes what a driver lost at that point has left.
    """
    place, run = Place(spark, target), uuid.uuid4().hex
    staging = f"{place.path}/_staging-{run}"
    try:
        yield staging
        old = [n for n in place.names() if n != f"_staging-{run}"] if overwrite else []
        place.move(staging, f"run-{run}")
        for name in old:
            place.delete(name)
    finally:
        place.delete(f"_staging-{run}")


@contextmanager
def swapped(spark: SparkSession, target: str) -> Iterator[str]:
    """A folder to write into, which takes target's place if the block ends without an error; target is whole till then.

    The old folder stands aside, as target._old-*, between the two renames.
    """
    place, run = Place(spark, target), uuid.uuid4().hex
    staging, aside = f"{place.path}._new-{run}", f"{place.path}._old-{run}"
    try:
        yield staging
        if not Place(spark, staging).exists():
            place.system.mkdirs(Place(spark, staging).at)
        had = place.exists()
        if had:
            Place(spark, aside).move(place.path)
        place.move(staging)
        if had:
            Place(spark, aside).delete()
    finally:
        Place(spark, staging).delete()
