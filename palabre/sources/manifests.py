"""Small JSON documents on a shared file system that are replaced in one step."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Versions that stay for readers that are about to open them.
KEPT_VERSIONS = 3


class ManifestConflict(RuntimeError):
    """Another writer has replaced the document since it was read."""


class Manifest:
    """A JSON document in a folder, a file for each version; the highest one counts.

    A version is written beside its place and renamed, so a reader sees all of it or the
    one before, and a writer that breaks off leaves the one before. Two writers cannot both
    follow the same version: the second one gets a ``ManifestConflict``. Files are reached
    through Hadoop's file systems, like the tables.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._root = self._hadoop.Path(path)
        self._files = self._root.getFileSystem(self._conf)

    def _file(self, name: str):
        return self._hadoop.Path(self._root, name)

    def _versions(self) -> list[int]:
        if not self._files.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> tuple[int, dict[str, Any]]:
        """The version and the document; ``(0, {})`` if there is none yet."""
        while versions := self._versions():
            try:
                stream = self._files.open(self._file(f"{versions[-1]}.json"))
            except Py4JJavaError:
                if self._versions()[-1:] == versions[-1:]:
                    raise
                continue  # it went while it was being opened: there are newer ones
            try:
                text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            return versions[-1], json.loads(text)
        return 0, {}

    def replace(self, document: dict[str, Any], after: int) -> int:
        """Make this the document, if ``after`` is still the version that counts."""
        temporary = self._file(f".{uuid.uuid4().hex}")
        out = self._files.create(temporary, True)
        out.write(json.dumps(document).encode())
        out.close()
        context = self._hadoop.FileContext.getFileContext(self._root.toUri(), self._conf)
        option = getattr(self._hadoop, "Options$Rename")
        plain = self._spark.sparkContext._gateway.new_array(option, 0)
        try:
            context.rename(
                self._files.makeQualified(temporary),
                self._files.makeQualified(self._file(f"{after + 1}.json")),
                plain,
            )
        except Py4JJavaError as error:
            self._files.delete(temporary, False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                raise ManifestConflict(f"{self._root} has a version {after + 1}") from None
            raise
        for old in self._versions():
            if old <= after + 1 - KEPT_VERSIONS:
                self._files.delete(self._file(f"{old}.json"), False)
        return after + 1


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
