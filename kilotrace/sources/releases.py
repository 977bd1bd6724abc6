"""Staged publishing: outputs are written aside, checked as written, and shown by one small file.

A release is a folder of its own. Readers ask for the current one, which the manifest of the highest number names. A
manifest is written under another name and then renamed, so it is there whole or not at all; until then, and if a check
fails, the release before stays the one that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


class Releases:
    """The releases under one folder, which may be any that Spark's file systems reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        at = self._path(f"{self.root}/_manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _read(self, number: int) -> dict:
        text = self.spark.read.text(f"{self.root}/_manifests/{number}.json", wholetext=True).first()[0]
        return json.loads(text)

    def current(self) -> dict | None:
        """The manifest that holds: its number, the release's path and what its publisher noted; None before any."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def stage(self) -> str:
        """A new folder to write a release to."""
        return f"{self.root}/release-{uuid.uuid4().hex}"

    def publish(self, path: str, checks: list[tuple[str, Callable[[], bool]]], **notes) -> dict:
        """Makes a staged release the current one, if all checks of what was written hold; else removes it and raises.

        Of two publishers at once one fails, since a number is taken once.
        """
        failed = [name for name, check in checks if not check()]
        if failed:
            self._fs.delete(self._path(path), True)
            raise ValueError(f"not published, since these checks failed: {', '.join(failed)}")
        number = (self._numbers() or [0])[-1] + 1
        manifest = {"number": number, "path": path, **notes}
        aside, name = (self._path(f"{self.root}/_manifests/{n}") for n in (f".{uuid.uuid4().hex}", f"{number}.json"))
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        if self._fs.exists(name) or not self._fs.rename(aside, name):
            self._fs.delete(aside, False)
            raise RuntimeError(f"release {number} has been published by someone else")
        return manifest

    def prune(self, keep: int = 1) -> None:
        """Deletes releases and manifests but for the last ``keep``, and what was staged and never published."""
        numbers = self._numbers()
        stay = {self._read(n)["path"].rsplit("/", 1)[1] for n in numbers[len(numbers) - keep :]}
        for n in numbers[: len(numbers) - keep]:
            self._fs.delete(self._path(f"{self.root}/_manifests/{n}.json"), False)
        for s in self._fs.listStatus(self._path(self.root)):
            if s.getPath().getName().startswith("release-") and s.getPath().getName() not in stay:
                self._fs.delete(s.getPath(), True)
