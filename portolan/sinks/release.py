"""Versions of a set of tables, of which one is published at a time.

The tables of a version lie below ``<output>/versions/<version>``. A small
pointer file names the version that readers take. A run writes a version of
its own, has it checked, and switches the pointer at the very end. So a run
that fails, or is killed between two tables, changes nothing for readers, and
the tables they see always belong together. A version may read tables of
earlier ones; it names them in a file of its own, and they are kept as long as it is.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

POINTER = "CURRENT"
VERSIONS = "versions"
NEEDS = "NEEDS"
_NAME = re.compile(r"\d{8}T\d{12}-[0-9a-f]{8}")


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


class Release:
    """The versions below one output folder."""

    def __init__(self, spark: SparkSession, output: str):
        self.spark, self.output = spark, output.rstrip("/")

    def new(self) -> str:
        """A name for a new version; names sort by time."""
        return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def folder(self, version: str) -> str:
        return f"{self.output}/{VERSIONS}/{version}"

    def current(self) -> str | None:
        """The published version; None if there has been none yet."""
        text = self._read(f"{self.output}/{POINTER}")
        if text is None:
            return None
        if not _NAME.fullmatch(text):
            raise ValueError(f"{self.output}/{POINTER} names no version: {text[:100]!r}")
        return text

    def publish(self, version: str) -> None:
        """Let readers take ``version`` from now on.

        The pointer is written beside its place and renamed over it, which
        file systems do in one step. Stores without such a rename put a small
        object in one step as it is closed, so there it is overwritten.
        """
        if not _NAME.fullmatch(version):
            raise ValueError(f"no name of a version: {version!r}")
        folder, files = _path(self.spark, self.folder(version))
        if not files.exists(folder):
            raise ValueError(f"version {version} does not exist")
        jvm = self.spark.sparkContext._jvm
        pointer, _ = _path(self.spark, f"{self.output}/{POINTER}")
        beside, _ = _path(self.spark, f"{self.output}/.{POINTER}-{uuid.uuid4().hex[:8]}")
        self._write(files, beside, version)
        try:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            how = self.spark.sparkContext._gateway.new_array(rename, 1)
            how[0] = rename.OVERWRITE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), files.getConf())
            context.rename(files.makeQualified(beside), files.makeQualified(pointer), how)
        except Exception as error:  # noqa: BLE001 (py4j wraps what the JVM throws)
            if "UnsupportedFileSystemException" not in str(error) and "UnsupportedOperationException" not in str(error):
                raise
            self._write(files, pointer, version)
            files.delete(beside, False)

    @staticmethod
    def _write(files, path, text: str) -> None:
        stream = files.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _read(self, path: str) -> str | None:
        target, files = _path(self.spark, path)
        if not files.exists(target):
            return None
        stream = files.open(target)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def require(self, version: str, others: Iterable[str]) -> None:
        """Note, before ``version`` is written, the earlier ones that its readers need."""
        path, files = _path(self.spark, f"{self.folder(version)}/{NEEDS}")
        self._write(files, path, "\n".join(sorted(others)))

    def needs(self, version: str) -> set[str]:
        """The earlier versions that readers of ``version`` need."""
        return set((self._read(f"{self.folder(version)}/{NEEDS}") or "").split())

    def versions(self) -> list[str]:
        """All versions, oldest first, published or not."""
        folder, files = _path(self.spark, f"{self.output}/{VERSIONS}")
        if not files.exists(folder):
            return []
        return sorted(n for n in (s.getPath().getName() for s in files.listStatus(folder)) if _NAME.fullmatch(n))

    def discard(self, version: str) -> None:
        """Delete a version that is neither the published one nor needed by any other."""
        if version == self.current():
            raise ValueError(f"version {version} is the published one")
        by = [v for v in self.versions() if v != version and version in self.needs(v)]
        if by:
            raise ValueError(f"version {version} is needed by {', '.join(by)}")
        folder, files = _path(self.spark, self.folder(version))
        files.delete(folder, True)

    def prune(self, keep: int = 2) -> list[str]:
        """Delete versions older than the published one but for the last ``keep`` of them; gives their names.

        Versions that any remaining one needs stay, too.

        A query that reads an old version fails when it goes, so ``keep``
        should span the longest reader. Newer versions may be runs under way.
        """
        published = self.current()
        older = [v for v in self.versions() if published and v < published]
        old = older[: max(len(older) - keep, 0)]
        needed = set().union(*[self.needs(v) for v in self.versions() if v not in old])
        gone = [v for v in old if v not in needed]
        # The newest first: it may be the one that needs the others.
        for version in reversed(gone):
            self.discard(version)
        return gone
