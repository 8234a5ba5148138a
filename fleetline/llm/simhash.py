"""SimHash near-dedup with BK-trees (operator 4).

Method.  A document's fingerprint has 64 bits; a bit is 1 if it is set in over
half of the XXH64 hashes (seed 42) of its word shingles.  Fingerprints that
differ in at most ``radius`` bits are linked, and linked documents form
components.

Finding the links.  Equal fingerprints are one node from the start.  The 64
bits are cut into ``radius + 2`` blocks: two fingerprints within the radius
agree in at least two whole blocks, so they meet in the shard of some pair of
blocks and their values (15 shards a node for radius 4).  A shard's
fingerprints form a BK-tree, whose children are keyed by their integer Hamming
distance to the parent; a query follows only the edges within the radius of
its own distance.  Shards of more than ``SHARD`` nodes are split in parts and
every two parts meet in a group of their own, so a tree never holds more than
a part and its task no more than two.  The trees go to the tasks with their
queries; nothing that grows with the data is broadcast.  A group reports links
that join what it has not joined yet (a spanning forest), not all pairs.

Cases.  Null or empty text, or one without words: fingerprint zero, linked
like any other.  Fewer words than a shingle: the whole sequence is the one
shingle.  Null doc_id: the row is linked like any other; it is the smallest of
its component only if no row has an id.  Repeated rows: copies.  Empty table:
empty result.  Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import materialize, packed, short_batches, unpacked
from fleetline.llm.components import smallest_ids

SHINGLE_WORDS = 4
RADIUS = 4
SHARD = 4096
SEED = 42


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    words = text.encode().lower().split() if isinstance(text, str) else []    # ASCII letters and spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())),
                    np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint_udf(shingle_words: int):
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))
    return fingerprints


class BKTree:
    """Tree over distinct fingerprints; children by distance to the parent."""

    def __init__(self, values: np.ndarray):
        self.values, self.children = values, {}
        todo = [np.arange(len(values))]
        while todo:
            root, rest = todo[-1][0], todo.pop()[1:]
            distance = np.bitwise_count(values[rest] ^ values[root])
            edges = self.children[int(root)] = []
            for d in np.unique(distance):
                below = rest[distance == d]
                edges.append((int(d), int(below[0])))
                todo.append(below)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, queries within the radius of it) for all nodes reached."""
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, asked = todo.pop()
            distance = np.bitwise_count(queries[asked] ^ self.values[node]).astype(np.int64)
            near = asked[distance <= radius]
            if len(near):
                yield node, near
            for d, child in self.children[node]:
                inside = asked[np.abs(distance - d) <= radius]
                if len(inside):
                    todo.append((child, inside))


def spanning(tree: np.ndarray, queries: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links between tree nodes and queries (None: among the tree's nodes)
    that join different components of the group."""
    own = queries is None
    asked = tree if own else queries
    label = np.arange(len(tree) if own else len(tree) + len(asked))
    shift, out = (0 if own else len(tree)), []
    for node, near in BKTree(tree).search(asked, radius):
        other = label[near + shift] != label[node]
        for q in near[other].tolist():
            if label[q + shift] != label[node]:
                out.append((tree[node], asked[q]))
                label[label == label[q + shift]] = label[node]
    return out


def shard_keys(node: Column, radius: int) -> Column:
    """One key for every pair of blocks."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    value = [F.shiftrightunsigned(node, cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))
             for i in range(blocks)]
    return F.array(*[F.struct(F.lit(n).alias("pair"), value[i].alias("x"), value[j].alias("y"))
                     for n, (i, j) in enumerate(combinations(range(blocks), 2))])


def fingerprint_links(nodes: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column ``node``) that span
    the components of the radius graph."""
    keyed = nodes.select("node", F.explode(shard_keys(F.col("node"), radius)).alias("k")).select("node", "k.*")
    key = ["pair", "x", "y"]
    sizes = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("g")).filter("g > 1")
    parts = F.ceil(F.col("g") / shard).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    members = keyed.join(sizes, key).withColumn("part", part).withColumn(
        "with", F.explode(F.sequence(F.lit(0), parts - 1)))
    group = [*key, "low", "high"]
    members = members.select(
        "node", *key, F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"),
        (F.col("with") < F.col("part")).alias("asks"))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        def groups(frame: pd.DataFrame) -> pd.DataFrame:
            starts = np.flatnonzero(np.r_[True, (frame[group].to_numpy()[1:] != frame[group].to_numpy()[:-1])
                                          .any(axis=1)])
            node, asks = frame["node"].to_numpy(np.int64).view(np.uint64), frame["asks"].to_numpy(bool)
            low, high = frame["low"].to_numpy(), frame["high"].to_numpy()
            ends, out = np.r_[starts[1:], len(frame)], []
            pairs = starts[(ends - starts == 2) & (low[starts] == high[starts])]
            near = pairs[np.bitwise_count(node[pairs] ^ node[pairs + 1]) <= radius]
            out.append(np.stack([node[near], node[near + 1]], axis=1))
            for a, b in zip(starts, ends):
                if low[a] == high[a]:
                    found = spanning(node[a:b], None, radius) if b - a > 2 else []
                else:
                    asking = asks[a:b]
                    tree, queries = node[a:b][~asking], node[a:b][asking]
                    found = spanning(tree, queries, radius) if len(tree) and len(queries) else []
                if found:
                    out.append(np.array(found, np.uint64))
            links = np.concatenate(out).view(np.int64)
            return pd.DataFrame({"u": links[:, 0], "v": links[:, 1]})

        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = (frame[group] == frame[group].iloc[-1]).all(axis=1).to_numpy()
            cut = len(frame) - int(last[::-1].argmin() if not last.all() else len(frame))
            rest = frame.iloc[cut:].reset_index(drop=True)
            if cut:
                yield groups(frame.iloc[:cut].reset_index(drop=True))
        if rest is not None:
            yield groups(rest)

    ordered = members.repartition(*group).sortWithinPartitions(*group, "asks", "node")
    return ordered.mapInPandas(link, "u long, v long")


def _linked(docs: DataFrame, shingle_words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The documents with ``_node`` and ``_rid``, and (node, component_id, root): the
    smallest node of its component."""
    short_batches(docs.sparkSession)
    rows = materialize(packed(docs).withColumn("_node", fingerprint_udf(shingle_words)(F.col("in_text")))
                       .withColumn("_rid", F.monotonically_increasing_id()), "fingerprints")
    nodes = materialize(rows.groupBy(F.col("_node").alias("node")).agg(
        F.min("in_doc_id").alias("first")), "nodes")
    named = smallest_ids(nodes, fingerprint_links(nodes, radius))
    nodes = nodes.join(named, "node", "left").select(
        "node", F.coalesce("component_id", "first").alias("component_id"),
        F.coalesce("root", "node").alias("root"))
    return rows, nodes


def link_documents(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """All rows of ``docs`` (columns ``doc_id``, ``text`` used) with
    ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows, nodes = _linked(docs, shingle_words, radius)
    return (rows.join(nodes, F.col("_node") == F.col("node"), "left")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("_node"), 16, "0")))
            .select(*unpacked(docs.columns, ["fingerprint", "component_id"])))


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component: that with the smallest doc_id (of rows that
    repeat it, one; without any id, one).  Components are told apart by their
    fingerprints, so unrelated texts under one doc_id both stay."""
    rows, nodes = _linked(docs, shingle_words, radius)
    first = F.struct(F.col("in_doc_id").isNull().alias("none"), F.col("in_doc_id").alias("id"), "_rid")
    by_node = rows.groupBy("_node").agg(F.min(first).alias("best"))
    best = (by_node.join(nodes, F.col("_node") == F.col("node")).groupBy("root")
            .agg(F.min("best").alias("best")).select(F.col("best._rid").alias("_rid")))
    return rows.join(best, "_rid", "left_semi").select(*unpacked(docs.columns, []))
