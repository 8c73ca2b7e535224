"""Versions of an output: a numbered record, written last, names the folders that belong together."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from creditweave.fs import Folder

_VERSIONS = "_versions"


class CommitConflict(RuntimeError):
    """Another writer has taken the version."""


class VersionLog:
    """Records ``_versions/<number>.json`` under ``root``.

    A record appears whole or not at all, and no two writers get the same number, where the file system
    renames in one step and refuses a taken name (HDFS and local disks do). Elsewhere let one job write.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, root)

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names(_VERSIONS) if n.endswith(".json")]

    def latest(self) -> int:
        """Number of the newest version; 0 if there is none."""
        return max(self.versions(), default=0)

    def record(self, version: int | None = None) -> dict[str, Any]:
        number = self.latest() if version is None else version
        text = self.folder.read(self._name(number))
        if text is None:
            raise ValueError(f"{self.folder.path} has no version {number or 'yet'}")
        return json.loads(text)

    def commit(self, version: int, record: dict[str, Any]) -> None:
        if not self.folder.claim(self._name(version), json.dumps(record)):
            raise CommitConflict(f"version {version} of {self.folder.path} was written by another job")

    def drop(self, version: int) -> None:
        self.folder.delete(self._name(version))

    @staticmethod
    def _name(version: int) -> str:
        return f"{_VERSIONS}/{version:012d}.json"
