"""Folders of any file system that Spark reaches: names only, no file is opened."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

#: Readers skip folders whose names begin with an underscore and hold no ``=``.
HIDDEN = "_expired-"


class Folders:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._settings = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self._path(path)
        return path.getFileSystem(self._settings), path

    def under(self, path: str) -> Iterator[tuple[str, str]]:
        """(path, name) of the folders directly under ``path``, hidden ones left out; none if it does not exist."""
        return ((folder, name) for folder, name in self._listed(path) if not name.startswith(("_", ".")))

    def _listed(self, path: str) -> Iterator[tuple[str, str]]:
        system, path = self._at(path)
        if not system.exists(path):
            return
        entries = system.listStatusIterator(path)  # page by page
        while entries.hasNext():
            entry = entries.next()
            if entry.isDirectory():
                yield entry.getPath().toString(), entry.getPath().getName()

    def hide(self, folder: str) -> None:
        """Renames a folder so that readers skip it; one of an earlier run under that name goes first."""
        system, path = self._at(folder)
        hidden = self._path(path.getParent(), HIDDEN + path.getName().replace("=", "-"))
        system.delete(hidden, True)
        if not system.rename(path, hidden) and system.exists(path):
            raise RuntimeError(f"{folder} cannot be renamed")

    def hidden(self, path: str, enter: Callable[[str], bool]) -> Iterator[str]:
        """Folders that ``hide`` has renamed, under ``path`` and the folders whose names ``enter`` accepts."""
        for folder, name in list(self._listed(path)):
            if name.startswith(HIDDEN):
                yield folder
            elif not name.startswith(("_", ".")) and enter(name):
                yield from self.hidden(folder, enter)

    def delete(self, folder: str) -> None:
        system, path = self._at(folder)
        system.delete(path, True)
