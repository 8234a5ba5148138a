"""Tables dealt to hash buckets of a key, as tiers of folders.

Every batch adds a folder with one sub-folder per bucket.  When a tier holds
``TIER`` folders they are folded into one of the next tier, so a key is found
in at most ``TIER`` x log(batches) files, each row is rewritten a logarithmic
number of times, and a reader that needs some keys opens only their buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.tables.manifest import Change, Manifest, Version

TIER = 8
Fold = Callable[[DataFrame], DataFrame]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Bucketed:
    """``fold`` reduces the rows of one key to what a merged folder keeps."""

    def __init__(self, manifest: Manifest, table: str, key: str, fold: Fold, buckets: int = 16):
        self.manifest, self.table, self.key, self.fold, self._buckets = manifest, table, key, fold, buckets

    def buckets(self, version: Version) -> int:
        """The count fixed by the table's first write."""
        return version.settings.get(f"{self.table}_buckets", self._buckets)

    def used(self, rows: DataFrame, version: Version) -> list[int]:
        """Buckets of the keys in ``rows``: at most as many as there are."""
        n = self.buckets(version)
        return sorted(r["bucket"] for r in rows.select(bucket_of(self.key, n).alias("bucket")).distinct().collect())

    def read(self, version: Version, buckets: list[int] | None = None,
             entries: list[dict] | None = None) -> DataFrame | None:
        rows = self.manifest.read(version, self.table, entries, buckets)
        return None if rows is None else rows.drop("run", "batch_id")

    def write(self, change: Change, rows: DataFrame, run: int, batch_id: int, level: int = 0) -> dict:
        """A new folder of rows; not yet part of the change."""
        n = self.buckets(change.next)
        change.next.settings.setdefault(f"{self.table}_buckets", n)
        dealt = rows.withColumn("bucket", bucket_of(self.key, n)).repartition("bucket").sortWithinPartitions(
            "bucket", self.key)
        change.know(self.table, dealt)
        entry = self.manifest.write(dealt, self.table, run, batch_id, ["bucket"], level=level)
        entry["buckets"] = sorted(int(name[7:]) for name in self.manifest.files.names(entry["path"])
                                  if name.startswith("bucket="))
        return entry

    def append(self, change: Change, rows: DataFrame, run: int, batch_id: int, keep_empty: bool = True) -> list[dict]:
        """Add a batch's rows and fold full tiers; the folders added.
        ``keep_empty``: a folder without rows is one of a tier, too."""
        added = [self.write(change, rows, run, batch_id)]
        if not (added[0]["rows"] or keep_empty):
            return []
        change.add(self.table, added[0])
        level = 0
        while True:
            tier = [e for e in change.next.entries(self.table) if e.get("level", 0) == level]
            if len(tier) < TIER:
                return added
            merged = self.write(change, self.fold(self.read(change.next, entries=tier).drop("bucket")),
                                run, batch_id, level + 1)
            change.replace(self.table, tier, [merged])
            added.append(merged)
            level += 1
