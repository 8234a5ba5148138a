"""The stored event ids, and which of their files a batch has to open.

Ids lie in a bucketed table.  Beside every file (folder x bucket) there is a
Bloom filter of its ids.  A batch tests its ids against the filters of their
buckets, opens only the files that may hold one of them, and anti-joins these:
the same rows as an anti-join with the whole history, since a filter never
denies an id that is there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.tables.bucketed import Bucketed, bucket_of
from fleetline.tables.manifest import Change, Manifest, Version

BITS_PER_ID = 16
HASHES = 8                             # with 16 bits an id: one false answer in about 1,700
FILTERS = "event_id_filters"
FILTER_SCHEMA = "path string, bucket int, ids long, filter binary"


def positions(one: np.ndarray, two: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of ids (double hashing), a row each."""
    step = np.arange(HASHES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = one.astype(np.uint64)[:, None] + step * (two.astype(np.uint64)[:, None] | np.uint64(1))
    return ((mixed >> np.uint64(7)) % np.uint64(bits)).astype(np.int64)


def filter_of(one: np.ndarray, two: np.ndarray) -> bytes:
    bits = max(64, len(one) * BITS_PER_ID)
    held = np.zeros(-(-bits // 8) * 8, bool)
    held[positions(one, two, len(held)).ravel()] = True
    return np.packbits(held).tobytes()


def may_hold(held: bytes, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(held, np.uint8)).astype(bool)
    return bits[positions(one, two, len(bits))].all(axis=1)


def hashes(id_column: str = "event_id"):
    return [F.xxhash64(F.lit("a"), F.col(id_column)).alias("one"), F.xxhash64(F.lit("b"), F.col(id_column)).alias("two")]


@dataclass
class Probe:
    unseen: DataFrame
    files: int          # files of the index
    opened: int         # of these, opened for the batch


class IdIndex:
    def __init__(self, manifest: Manifest, buckets: int = 16):
        self.manifest = manifest
        self.ids = Bucketed(manifest, "event_ids", "event_id", lambda rows: rows.distinct(), buckets)

    def candidates(self, version: Version, rows: DataFrame) -> list[tuple[str, int]]:
        """(path, bucket) of the files that may hold an id of ``rows``; at most
        as many as the index has files."""
        n = self.ids.buckets(version)
        asked = rows.select(bucket_of("event_id", n).alias("bucket"), *hashes())
        def test(ids: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            one, two = ids["one"].to_numpy(np.int64), ids["two"].to_numpy(np.int64)
            hit = [bool(len(one)) and bool(may_hold(f, one, two).any()) for f in held["filter"]]
            found = held[np.array(hit, bool)] if len(held) else held
            return found[["path", "bucket"]]

        held = self.manifest.read(version, FILTERS).filter(F.col("bucket").isin(self.ids.used(rows, version)))
        found = asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(test, "path string, bucket int")
        return sorted((r["path"], r["bucket"]) for r in found.distinct().collect())

    def unseen(self, version: Version, rows: DataFrame) -> Probe:
        """``rows`` (event_id, ...) without those whose id is stored.  The
        caller passes a written table: it is read twice."""
        total = sum(len(e["buckets"]) for e in version.entries("event_ids"))
        if not total:
            return Probe(rows, 0, 0)
        files = self.candidates(version, rows)
        if not files:
            return Probe(rows, total, 0)
        stored = self.manifest.spark.read.schema("event_id string").parquet(
            *[f"{self.manifest.root}/{path}/bucket={bucket}" for path, bucket in files])
        return Probe(rows.join(stored, "event_id", "left_anti"), total, len(files))

    def append(self, change: Change, new: DataFrame, run: int, batch_id: int) -> None:
        """Add the ids of a batch with their filters; folders that a merge
        replaced take their filters with them."""
        added = self.ids.append(change, new.select("event_id"), run, batch_id)
        live = {e["path"] for e in change.next.entries("event_ids")}
        for entry in added:
            if entry["path"] in live:
                self._filter(change, entry, run, batch_id)
        self._drop_old_filters(change)

    def rewrite(self, change: Change, kept: DataFrame, run: int, batch_id: int) -> None:
        """Replace the whole index (retention: deleted ids are forgotten, so
        a later delivery of one is new)."""
        old = change.next.entries("event_ids")
        level = max((e.get("level", 0) for e in old), default=0)
        entry = self.ids.write(change, kept.select("event_id"), run, batch_id, level)
        change.replace("event_ids", old, [entry])
        self._filter(change, entry, run, batch_id)
        self._drop_old_filters(change)

    def _filter(self, change: Change, entry: dict, run: int, batch_id: int) -> None:
        rows = self.ids.read(change.next, entries=[entry]).select("bucket", *hashes())
        path = entry["path"]

        def build(ids: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"path": [path], "bucket": [int(ids["bucket"].iloc[0])], "ids": [len(ids)],
                                 "filter": [filter_of(ids["one"].to_numpy(np.int64), ids["two"].to_numpy(np.int64))]})

        built = rows.groupBy("bucket").applyInPandas(build, FILTER_SCHEMA)
        change.know(FILTERS, built)
        change.add(FILTERS, {**self.manifest.write(built, FILTERS, run, batch_id), "of": path})

    def _drop_old_filters(self, change: Change) -> None:
        live = {e["path"] for e in change.next.entries("event_ids")}
        change.next.tables[FILTERS] = [e for e in change.next.entries(FILTERS) if e["of"] in live]
