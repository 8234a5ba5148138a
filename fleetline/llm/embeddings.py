"""Embedding near-dedup by PCA-ordered tiled comparison (operator 9).

Method.  Vectors are scaled to unit length and rotated onto the eigenvectors
of their second-moment matrix, largest eigenvalue first; a rotation keeps all
cosines.  Vectors are dealt to tiles of about ``TILE`` along the leading
dimension, and all pairs of tiles are compared: products of the leading
dimensions are accumulated first, the rest is bounded by the product of the
two suffix norms (Cauchy-Schwarz), and a pair goes on to the next dimensions
only while its bound reaches the threshold.  Two unit vectors with cosine c
are sqrt(2 - 2c) apart, so two tiles farther apart than that in the leading
dimension are never compared.

Scale.  Equal vectors are one node with a count, so copies cost nothing.  The
only things sent to all tasks are the rotation (d x d) and the tile bounds.
The work is still the square of the distinct vectors over the pruning: each
tile is sent once for each tile it meets.  A task holds two tiles and a strip
of their products.  Links are counted, not listed: a task reports a count per
vector and a spanning forest.

Cases.  Null vectors, empty or zero ones, and those with null or non-finite
components link with nothing: 0 links, a component of their own.  Vectors of
different lengths are never linked; each length has its own rotation.  Equal
rows link with each other.  Null vec_id: linked like any other; ``component_id``
is null if no vector of a component has an id.  Empty table: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import materialize, packed, unpacked
from fleetline.llm.components import smallest_ids

THRESHOLD = 0.95
TILE = 4096
STRIP = 512
#: Dimensions after which the bound is tested.
STEPS = (16, 32)
DENSE = 0.02
SLACK = 1e-12


def unit(vectors) -> np.ndarray:
    x = np.array(list(vectors), np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(nodes: DataFrame, dim: int) -> np.ndarray:
    """Columns: eigenvectors of the second-moment matrix, largest first."""
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = unit(batch["vector"])
            total += x.T @ x
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pd.DataFrame({"i": i, "j": j, "v": total.ravel()})

    sums = nodes.select("vector").mapInPandas(moments, "i int, j int, v double")
    matrix = np.zeros((dim, dim))
    for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():     # dim x dim rows
        matrix[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].copy()


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple]:
    """(i, j) index arrays of the pairs with cosine >= threshold, a strip of
    ``a`` at a time; with ``same`` each pair once."""
    dim = a.shape[1]
    stops = [s for s in STEPS if s < dim] + [dim]
    tails = [(np.sqrt((a[:, s:] ** 2).sum(axis=1)), np.sqrt((b[:, s:] ** 2).sum(axis=1))) for s in stops]
    for at in range(0, len(a), STRIP):
        strip = a[at:at + STRIP]
        product = strip[:, :stops[0]] @ b[:, :stops[0]].T
        bound = product + tails[0][0][at:at + STRIP, None] * tails[0][1]
        i, j = np.nonzero(bound >= threshold - SLACK)
        if same:
            i, j = i[j > i + at], j[j > i + at]
        if len(i) > DENSE * product.size:       # a crowd: whole products are cheaper
            p = (product + strip[:, stops[0]:] @ b[:, stops[0]:].T)[i, j]
        else:
            p = product[i, j]
            for (lo, hi), (ta, tb) in zip(zip(stops, stops[1:]), tails[1:]):
                p = p + np.einsum("nd,nd->n", strip[i, lo:hi], b[j, lo:hi])
                going = p + ta[at + i] * tb[j] >= threshold - SLACK
                i, j, p = i[going], j[going], p[going]
        yield i[p >= threshold] + at, j[p >= threshold]


def join_new(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Places of pairs that join two components; ``label`` is updated."""
    out = []
    while True:
        different = np.flatnonzero(label[i] != label[j])
        if not len(different):
            return out
        codes = label[i[different]] * np.int64(len(label)) + label[j[different]]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        for k in different[np.unique(codes, return_index=True)[1]].tolist():
            x, y = root(int(label[i[k]])), root(int(label[j[k]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append(k)
        new = np.arange(len(label))
        for x in parent:
            new[x] = root(x)
        label[:] = new[label]


def compare(nodes: DataFrame, dim: int, threshold: float, tile: int) -> DataFrame:
    """(node, other, links) over materialised (node, n, vector) rows of one
    length: counts of links (``other`` null) and spanning links."""
    rotate = rotation(nodes, dim)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unit(batch["vector"]) @ rotate if len(batch) else np.zeros((0, dim))
            yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "lead": x[:, 0],
                                "x": [v.tobytes() for v in x]})

    rows = materialize(nodes.mapInPandas(project, "node long, n long, lead double, x binary"), "projected")
    tiles = max(1, math.ceil(rows.count() / tile))
    cuts = rows.agg(F.percentile_approx("lead", [k / tiles for k in range(1, tiles)] or [0.5], 100 * tiles)).first()[0]
    cuts = sorted(set(cuts)) if tiles > 1 else []
    bounds = rows.select(tile_of(F.col("lead"), cuts).alias("tile"), "lead").groupBy("tile").agg(
        F.min("lead").alias("lo"), F.max("lead").alias("hi")).collect()        # a row per tile
    reach = math.sqrt(2 - 2 * threshold) + 1e-9 if threshold < 1 else 1e-6
    meets = [(a["tile"], b["tile"]) for a in bounds for b in bounds
             if a["tile"] <= b["tile"] and b["lo"] - a["hi"] <= reach]
    partners = [(t, a, b, t == b and a != b) for a, b in meets for t in ({a, b})]
    plan = nodes.sparkSession.createDataFrame(partners, "tile int, a int, b int, second boolean")
    dealt = rows.withColumn("tile", tile_of(F.col("lead"), cuts)).join(F.broadcast(plan), "tile")

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        second = frame["second"].to_numpy(bool)
        x = np.frombuffer(b"".join(frame["x"]), np.float64).reshape(-1, dim)
        node, n = frame["node"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
        same = not second.any() and frame["a"].iloc[0] == frame["b"].iloc[0]
        left = np.flatnonzero(~second)
        right = left if same else np.flatnonzero(second)
        links, label, pairs = np.zeros(len(frame), np.int64), np.arange(len(frame)), []
        for i, j in linked_pairs(x[left], x[right], threshold, same):
            i, j = left[i], right[j]
            links += np.bincount(i, n[j], len(frame)).astype(np.int64)
            links += np.bincount(j, n[i], len(frame)).astype(np.int64)
            pairs += [(node[i[k]], node[j[k]]) for k in join_new(label, i, j)]
        has = np.flatnonzero(links)
        return pd.DataFrame({
            "node": np.concatenate([node[has], np.array([p[0] for p in pairs], np.int64)]),
            "other": pd.array([None] * len(has) + [p[1] for p in pairs], "Int64"),
            "links": np.concatenate([links[has], np.zeros(len(pairs), np.int64)])})

    return dealt.groupBy("a", "b").applyInPandas(pair, "node long, other long, links long")


def tile_of(lead, cuts: list[float]):
    if not cuts:
        return F.lit(0)
    places = F.array(*[F.lit(float(c)) for c in cuts])
    return F.size(F.filter(places, lambda c: c <= lead)).cast("int")


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """All rows of ``vectors`` (columns ``vec_id``, ``embedding`` used) with
    n_links, component_id and kept."""
    rows = packed(vectors)
    e = F.col("in_embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.coalesce(finite & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = rows.withColumn("_v", F.when(usable, F.transform(e, lambda v: v.cast("double"))))
    nodes = materialize(
        rows.filter("_v is not null").groupBy(F.col("_v").alias("vector")).agg(
            F.count(F.lit(1)).alias("n"), F.min("in_vec_id").alias("first"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = None
    for (dim,) in sorted(nodes.select(F.size("vector")).distinct().collect()):
        mine = nodes.filter(F.size("vector") == dim).select("node", "n", "vector")
        part = compare(mine, dim, threshold, tile)
        found = part if found is None else found.union(part)
    if found is None:
        found = nodes.sparkSession.createDataFrame([], "node long, other long, links long")
    found = materialize(found, "vector-links")
    links = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    named = smallest_ids(nodes, found.filter("other is not null").select(
        F.col("node").alias("u"), F.col("other").alias("v")))
    nodes = (nodes.join(links, "node", "left").join(named, "node", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"),
        F.coalesce("component_id", "first").alias("_component")))
    out = rows.join(nodes, F.col("_v") == F.col("vector"), "left")
    return (out.withColumn("n_links", F.coalesce("_links", F.lit(0)).cast("long"))
            .withColumn("component_id", F.when(F.col("_v").isNull(), F.col("in_vec_id"))
                        .otherwise(F.col("_component")).cast("long"))
            .withColumn("kept", F.coalesce(F.col("in_vec_id") == F.col("component_id"), F.lit(False)))
            .select(*unpacked(vectors.columns, ["n_links", "component_id", "kept"])))
