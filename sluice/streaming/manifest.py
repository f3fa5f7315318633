"""A table of several parts whose content is swapped in one step.

A version names, for each part, the folders that hold it. Writers make new folders first and then a new version; readers
take the newest whole version, so they see the old content or the new, never both. A version is whole when Spark has
marked its write as finished. Folders that neither of the last two versions names are removed, and so is what a writer
left that ended before its version.
"""

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

KEPT = 2


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, path: str) -> list[int]:
    """Whole versions, oldest first."""
    place, system = _system(spark, f"{path}/versions/*/_SUCCESS")
    names = [status.getPath().getParent().getName() for status in system.globStatus(place) or []]
    return sorted(int(name[1:]) for name in names if name.startswith("v"))


class Version:
    """``parts``: names of parts, each with its folders below the table."""

    def __init__(self, path: str, number: int, parts: dict[str, list[str]]):
        self.path, self.number, self.parts = path, number, parts

    def folders(self, parts: Iterable[str] | None = None) -> list[str]:
        """Whole paths of the folders of some parts, or of all."""
        names = self.parts if parts is None else [p for p in parts if p in self.parts]
        return [f"{self.path}/{folder}" for name in names for folder in self.parts[name]]


def _read(spark: SparkSession, path: str, number: int) -> dict[str, list[str]]:
    rows = spark.read.schema("part string, folder string").parquet(f"{path}/versions/v{number}").collect()
    parts: dict[str, list[str]] = {}
    for row in sorted(rows):
        parts.setdefault(row["part"], []).append(row["folder"])
    return parts


def current(spark: SparkSession, path: str) -> Version:
    """The newest whole version, or an empty one. It has as many rows as the table has folders."""
    numbers = _finished(spark, path)
    if not numbers:
        return Version(path, 0, {})
    return Version(path, numbers[-1], _read(spark, path, numbers[-1]))


def new_folder() -> str:
    """Name of a folder, below the table, that no version has named yet."""
    return f"data/{uuid.uuid4().hex}"


def swap(spark: SparkSession, before: Version, parts: dict[str, list[str]], depth: int = 1) -> Version:
    """Make ``parts`` the content, in place of ``before``. One writer at a time.

    Folders of content lie ``depth`` levels below the folder ``data``.
    """
    number = before.number + 1
    rows = [(part, folder) for part, folders in parts.items() for folder in folders]
    # A version that an earlier writer began and did not finish is written over.
    spark.createDataFrame(rows, "part string, folder string").coalesce(1).write.mode("overwrite").parquet(f"{before.path}/versions/v{number}")
    sweep(spark, before.path, depth)
    return Version(before.path, number, parts)


def sweep(spark: SparkSession, path: str, depth: int = 1) -> None:
    """Remove versions but the last two, and the folders that these do not name."""
    numbers = _finished(spark, path)
    kept = numbers[-KEPT:]
    named = {folder for n in kept for folders in _read(spark, path, n).values() for folder in folders}
    place, system = _system(spark, f"{path}/data" + "/*" * depth)
    for status in system.globStatus(place) or []:
        found = status.getPath()
        if "/".join(found.toUri().getPath().split("/")[-depth - 1 :]) not in named:
            system.delete(found, True)
            parent = found.getParent()
            while parent.getName() != "data" and not system.listStatus(parent):
                system.delete(parent, False)
                parent = parent.getParent()
    for n in numbers[:-KEPT]:
        place, system = _system(spark, f"{path}/versions/v{n}")
        system.delete(place, True)
