"""Stored steps of a flow: resumed where a run broke off, or replaced by a table of the user's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Steps:
    """Step tables of one flow in ``folder``, a place that all machines share.

    A step is written as Parquet under its name; the marker that Spark leaves when a write is
    complete tells that it can be read again, and a step without it is computed and written
    anew. ``given`` replaces steps by tables: they are neither computed nor stored. A stored
    step is not compared with the inputs, so a flow over other inputs needs another folder.
    Without ``folder`` steps stay parts of one plan.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, given: dict[str, DataFrame] | None = None):
        self.spark, self.folder, self.given = spark, folder and folder.rstrip("/"), dict(given or {})
        self.names: list[str] = []

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of step ``name``: given, stored, or made by ``make`` and stored."""
        if name in self.names:
            raise ValueError(f"step {name} is there twice")
        self.names.append(name)
        if name in self.given:
            return self.given[name]
        if self.folder is None:
            return make()
        if not self.stored(name):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def finish(self) -> None:
        """To be called after the last step: given tables that no step took are mistakes."""
        unknown = sorted(set(self.given) - set(self.names))
        if unknown:
            raise ValueError(f"no such steps: {', '.join(unknown)}; there are {', '.join(self.names)}")

    def stored(self, name: str) -> bool:
        files, path = self._path(f"{name}/_SUCCESS")
        return files.exists(path)

    def drop(self, *names: str) -> None:
        """Deletes stored steps, all of this flow's without ``names``; they are computed again when next asked for."""
        for name in names or self.names if self.folder else ():
            files, path = self._path(name)
            files.delete(path, True)

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path
