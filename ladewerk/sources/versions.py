"""Immutable versions of data, and a log of small manifests that says which ones count.

Data is written under a name of its own and never changed. A manifest, created under the
next number and never overwritten, makes it count: a reader sees all of a published version
or nothing of it, however the job that wrote it ended.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ladewerk.sources import files


def new_version() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class ManifestLog:
    """Numbered manifests in one folder; the highest complete one is current."""

    spark: SparkSession
    path: str

    def _names(self) -> list[str]:
        return [n for n in files.child_names(self.spark, self.path) if n.endswith(".json")]

    def read(self, name: str) -> dict | None:
        """What a manifest says; None if its writer ended before it was complete."""
        text = files.read_small(self.spark, f"{self.path}/{name}")
        try:
            said = json.loads(text)
        except ValueError:
            return None
        return said if said.get("complete") else None

    def current(self) -> dict | None:
        for name in reversed(self._names()):
            said = self.read(name)
            if said is not None:
                return said
        return None

    def publish(self, change) -> dict:
        """Publish what `change` makes of the current manifest. If another writer takes the
        next number first, the change is made again on what it published."""
        while True:
            names = self._names()
            said = {**change(self.current() or {}), "complete": True}
            number = 1 + max((int(n.split(".")[0]) for n in names), default=-1)
            try:
                files.create_small(self.spark, f"{self.path}/{number:08d}.json", json.dumps(said, sort_keys=True))
            except Py4JJavaError as error:
                if not files.exists(self.spark, f"{self.path}/{number:08d}.json"):
                    raise error
                continue
            return said
