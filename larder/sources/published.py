"""Stored tables with one line of versions.

A version is a Parquet folder that counts once it stands in the log. A *base* holds a whole table, a
*delta* holds rows to be combined with the versions before it. Readers never see a half-written
version, a failed write leaves the old ones current, and a plan may read the version it replaces.
Whoever writes takes the next number, so full refreshes, appends and streams can follow each other
in any order.

The log is a folder of empty files, one for each commit, whose names say all: version, kind and the
key of the load. Every :data:`COMPACT` commits the keys go into a Parquet ledger and the files
of replaced versions are deleted, so the log is read in a bounded number of files however many loads
there were, and a load of long ago is still known.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import names, remove, touch

#: Commits after which keys are moved to the ledger.
COMPACT = 32


@dataclass(frozen=True)
class Load:
    """What tells one load from all others: who sends it, its number there, and what the number
    stood for (a source that starts again gives old numbers to new rows)."""

    source: str
    batch: int
    content: str = ""

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.source, self.batch, self.content)).encode()).hexdigest()


@dataclass(frozen=True, order=True)
class Commit:
    version: int
    base: bool
    key: str

    @property
    def name(self) -> str:
        return f"{self.version:012d}-{'base' if self.base else 'delta'}-{self.key}"

    @classmethod
    def named(cls, name: str) -> Commit:
        version, kind, key = name.split("-")
        return cls(int(version), kind == "base", key)


class PublishedTable:
    """A folder with ``version=<n>`` Parquet folders, the log of commits and the ledger of loads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log = f"{self.path}/log"

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def commits(self) -> list[Commit]:
        """Oldest first: all that may still be read, and at most :data:`COMPACT` more."""
        return sorted(map(Commit.named, names(self.spark, self._log)))

    def current_version(self) -> int | None:
        """Newest committed version."""
        return max((c.version for c in self.commits()), default=None)

    def parts(self) -> list[DataFrame]:
        """The newest base and the deltas after it."""
        commits = self.commits()
        start = max((c.version for c in commits if c.base), default=-1)
        return [self.spark.read.parquet(self._folder(c.version)) for c in commits
                if c.version >= start]

    def read(self) -> DataFrame | None:
        """A table that is only ever published whole."""
        parts = self.parts()
        return parts[0] if parts else None

    def _ledgers(self) -> list[int]:
        """Versions up to which there is a complete ledger, oldest first."""
        found = (int(name.split("=")[1]) for name in names(self.spark, self.path)
                 if name.startswith("ledger="))
        return sorted(v for v in found
                      if "_SUCCESS" in names(self.spark, f"{self.path}/ledger={v}"))

    def _known(self) -> DataFrame | None:
        ledgers = self._ledgers()
        return self.spark.read.schema("key STRING").parquet(
            f"{self.path}/ledger={ledgers[-1]}") if ledgers else None

    def has(self, load: Load) -> bool:
        """Whether a load is committed, however long ago."""
        if any(c.key == load.key for c in self.commits()):
            return True
        known = self._known()
        return known is not None and not known.filter(F.col("key") == load.key).isEmpty()

    def publish(self, rows: DataFrame, base: bool = True,
                load: Load | None = None) -> DataFrame | None:
        """Write ``rows`` as the next version and commit it. A load that is already committed is not
        written again, and gives None; one that was lost before its commit is written anew."""
        if load is not None and self.has(load):
            return None
        commits = self.commits()
        version = 1 + max((c.version for c in commits), default=-1)
        rows.write.mode("overwrite").parquet(self._folder(version))
        touch(self.spark, f"{self._log}/{Commit(version, base, load.key if load else '').name}")
        if len(commits) >= COMPACT:
            self._compact()
        return self.spark.read.parquet(self._folder(version))

    def _compact(self) -> None:
        """Write a new ledger with all keys, then delete the log's files of replaced versions. Cut
        off anywhere, every key is in the old ledger, the new one or the log."""
        commits, ledgers = self.commits(), self._ledgers()
        keys = self.spark.createDataFrame([(c.key,) for c in commits if c.key], "key STRING")
        known = self._known()
        (keys if known is None else known.unionByName(keys)).distinct().coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/ledger={commits[-1].version}")
        for c in commits:
            if c.version < self._oldest_read(commits):
                remove(self.spark, f"{self._log}/{c.name}")
        for version in ledgers[:-1]:  # a reader may still be at the last one
            remove(self.spark, f"{self.path}/ledger={version}")

    @staticmethod
    def _oldest_read(commits: list[Commit]) -> int:
        """The last base but one: a plan made before the newest base can still be read."""
        bases = [c.version for c in commits if c.base]
        return bases[-2] if len(bases) > 1 else -1

    def expire(self) -> None:
        """Delete the versions that no plan reads any more."""
        oldest = self._oldest_read(self.commits())
        for name in names(self.spark, self.path):
            if name.startswith("version=") and int(name.split("=")[1]) < oldest:
                remove(self.spark, f"{self.path}/{name}")
