"""Embedding near-duplicates by dual traversal of cover trees.

Cosine ``c`` between unit vectors is distance ``sqrt(2 - 2c)``, so links are pairs within a radius.  Vectors are
compared only with vectors of the same label:

1. Equal vectors of a label become one weighted point, known by 64 bits of a hash of both (never by a vec_id).
2. A label's points are split into blocks of about ``block`` points by their nearest pivot (a bounded sample of points,
   as many of them as the label needs) and, where a pivot has more, by hash.
3. Each block builds a cover tree: nested levels whose radii halve, every node with its exact covering radius.
4. Up to ``tile`` blocks of a cell (fewer where they would hold over 32 MB) form a tile, a node above their roots with
   a covering radius of its own.  Pairs of tiles, then of blocks, that lie farther apart than both radii plus the link
   radius are dropped, on roots and radii alone.  A block travels once to each tile that holds a near block of it.
5. Near blocks are traversed together from their roots; the same bound prunes pairs of nodes, and what reaches single
   points is compared by cosine in double precision.
6. A pair of blocks returns link counts per point and a spanning forest of its links, never the links themselves.

Work is quadratic in a label only as far as the bounds fail to prune, which in many dimensions without clusters they
do: distances between unrelated vectors concentrate, and tiles of one label then all meet.

Nulls and odd inputs: a null label, a null or zero vector and one with null or non-finite components link with
nothing; vectors of different length don't either; repeated rows, and rows that share an id, count as vectors of their
own; a null id takes part in nothing and gets a null component; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventspark.llm.components import connected_components
from eventspark.llm.vectors import matrices, packed, unpacked, usable
from eventspark.session import reliable_checkpoint

_SLACK = 1e-7  # added to every bound, so rounding never prunes a link
_TILE_BYTES = 1 << 25


class Node:
    """Points within ``radius`` of the point ``center``; no children means that the node is that point alone."""

    def __init__(self, center: int, radius: float, children: list[Node]):
        self.center, self.radius, self.children = center, radius, children
        own = children or [self]
        self.centers = np.array([c.center for c in own])
        self.radii = np.array([c.radius for c in own])
        self.single = np.array([not c.children for c in own])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def build(x: np.ndarray, points: np.ndarray, reach: float = 2.0) -> Node:
    """The cover tree of ``x[points]``, whose first point is the root and lies within ``reach`` of all."""
    center = int(points[0])
    if len(points) == 1:
        return Node(center, 0.0, [])
    radius = float(distances(x[points], x[center:center + 1]).max())
    if radius < 1e-6:  # below the rounding of a distance: no further levels
        return Node(center, radius + 1e-6, [Node(int(p), 0.0, []) for p in points])
    while reach / 2 >= radius:
        reach /= 2
    reach, rest, children = reach / 2, points, []
    while len(rest):
        near = distances(x[rest], x[rest[0]:rest[0] + 1])[:, 0] <= reach
        near[0] = True
        children.append(build(x, rest[near], reach))
        rest = rest[~near]
    return Node(center, radius, children)


class Links:
    """Link counts and components of the points of one block or of two."""

    def __init__(self, weight: np.ndarray):
        self.weight, self.count, self.label = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        n = len(self.weight)
        self.count += np.bincount(i, self.weight[j], n).astype(np.int64) + np.bincount(j, self.weight[i], n).astype(np.int64)
        while True:
            a, b = self.label[i], self.label[j]
            low = np.minimum(a, b)
            if (a == b).all():
                return
            np.minimum.at(self.label, a, low)
            np.minimum.at(self.label, b, low)
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


def traverse(x: np.ndarray, y: np.ndarray, a: Node, b: Node, cosine: float, links: Links, shift: int) -> None:
    """Adds the links between the trees ``a`` over ``x`` and ``b`` over ``y`` (the same tree: ``a is b``).

    Points of ``y`` are numbered from ``shift`` in ``links``.
    """
    limit = math.sqrt(2 - 2 * cosine) + _SLACK
    stack, rows = [(a, b)], 512
    while stack:
        p, q = stack.pop()
        same = p is q
        for at in range(0, len(p.centers), rows):
            own = p.centers[at:at + rows]
            dot = x[own] @ y[q.centers].T
            near = np.sqrt(np.maximum(2 - 2 * dot, 0)) <= limit + p.radii[at:at + rows, None] + q.radii[None, :]
            if same:  # each pair of children once
                near &= np.arange(at, at + len(own))[:, None] <= np.arange(len(q.centers))[None, :]
            points = p.single[at:at + rows, None] & q.single[None, :]
            i, j = np.nonzero(near & points & (dot >= cosine))
            if same:
                i, j = i[at + i != j], j[at + i != j]
            links.add(own[i], q.centers[j] + shift)
            for i, j in zip(*np.nonzero(near & ~points), strict=True):
                c, d = (p.children or [p])[at + i], (q.children or [q])[j]
                stack.append((c, d))


def _normal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes; null for a zero vector."""
    for batch in it:
        units = []
        some = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False))
        for at, x in matrices(batch.column(2).take(pa.array(some))):
            top = np.abs(x).max(axis=1, initial=0)
            at, x = at[top > 0], x[top > 0] / top[top > 0, None]  # so that neither squares nor norms leave the range
            units.append((some[at], x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed(batch.num_rows, units)], names=["vec_id", "label", "unit"])


def _cells(pivots: list[bytes]):
    by_size: dict[int, list[np.ndarray]] = {}
    for p in pivots:
        by_size.setdefault(len(p) // 8, []).append(np.frombuffer(p))
    stacked = {d: np.stack(own) for d, own in by_size.items()}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            use, cell = batch.column(4).to_numpy(), np.zeros(batch.num_rows, np.int64)
            for rows, x in unpacked(batch.column(1)):
                own = stacked.get(x.shape[1])
                if own is not None:
                    unused = np.arange(len(own)) >= use[rows, None]
                    cell[rows] = np.where(unused, -np.inf, x @ own.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(cell, pa.int64())],
                                             names=["label", "unit", "rep", "n", "cell"])

    return run


def _blocks(block: int, tile: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        label, size, cell, salt = key
        pdf = pdf.sort_values("rep")
        x = np.frombuffer(b"".join(pdf["unit"])).reshape(len(pdf), size // 8)
        root = build(x, np.arange(len(x)))
        payload = pickle.dumps((pdf["rep"].to_numpy(), pdf["n"].to_numpy(), x, root), protocol=5)
        a_tile = max(1, min(tile, _TILE_BYTES // (block * size)))
        return pd.DataFrame({"label": [label], "size": [size], "tile": [cell << 32 | salt // a_tile],
                             "block": [cell << 32 | salt], "center": [x[root.center].tolist()], "radius": [root.radius],
                             "payload": [payload]})

    return run


def _tile_links(cosine: float):
    """Links between the blocks of two tiles or within one; a block's number is larger in the later tile."""
    limit = math.sqrt(2 - 2 * cosine) + _SLACK

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        held = [(tile, *pickle.loads(payload)) for tile, payload in zip(pdf["tile"], pdf["payload"], strict=True)]
        found = [(np.zeros(0, np.int64),) * 3]
        for at, (tile, rep, n, x, a) in enumerate(held):
            for of, (other, m, y, b) in ((of, rest) for of, *rest in held[at:]):
                if (tile, of) != (key[2], key[3]):
                    continue
                if a is b:
                    links, both = Links(n), rep
                    traverse(x, x, a, a, cosine, links, 0)
                elif np.linalg.norm(x[a.center] - y[b.center]) <= a.radius + b.radius + limit:
                    links, both = Links(np.concatenate([n, m])), np.concatenate([rep, other])
                    traverse(x, y, a, b, cosine, links, len(rep))
                else:
                    continue
                have = np.flatnonzero(links.count)
                found.append((both[have], links.count[have], both[links.label[have]]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(["rep", "links", "other"], zip(*found, strict=True), strict=True)})

    return run


def _gap(p: Column, q: Column) -> Column:
    """Distance of two array columns."""
    return F.sqrt(F.aggregate(F.zip_with(p, q, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t))


def _near_tiles(blocks: DataFrame, limit: float) -> DataFrame:
    """``(label, size, ta, tb, block)``: the blocks of each pair of tiles that lie near a block of the other tile."""
    tiles = blocks.groupBy("label", "size", "tile").agg(F.sort_array(F.collect_list(F.struct("block", "center", "radius"))).alias("own"))
    tiles = tiles.withColumn("middle", F.col("own")[0]["center"])
    tiles = tiles.withColumn("reach", F.array_max(F.transform("own", lambda b: _gap(b["center"], F.col("middle")) + b["radius"])))
    tiles = reliable_checkpoint(tiles)
    a, b = (tiles.select("label", "size", F.col("tile").alias(f"t{s}"), F.col("own").alias(f"own_{s}"),
                         F.col("middle").alias(f"middle_{s}"), F.col("reach").alias(f"reach_{s}")) for s in "ab")
    pairs = a.join(b, ["label", "size"]).filter(
        (F.col("ta") <= F.col("tb"))
        & (_gap(F.col("middle_a"), F.col("middle_b")) <= F.col("reach_a") + F.col("reach_b") + F.lit(limit)))

    def near(own: str, others: str) -> Column:
        return F.transform(F.filter(own, lambda p: F.exists(others, lambda q: _gap(p["center"], q["center"])
                                                            <= p["radius"] + q["radius"] + F.lit(limit))), lambda p: p["block"])

    return pairs.select("label", "size", "ta", "tb", F.explode(F.array_union(near("own_a", "own_b"), near("own_b", "own_a"))).alias("block"))


def near_vectors(vectors: DataFrame, cosine: float = 0.98, block: int = 4096, pivots: int = 64, tile: int = 4,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.when(usable(v) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull(), v).alias("v"))
    rows = reliable_checkpoint(rows.mapInArrow(_normal, "vec_id long, label string, unit binary"))
    points = reliable_checkpoint(rows.filter("unit IS NOT NULL").groupBy("label", "unit").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("rep", F.xxhash64("label", "unit")))
    size = reliable_checkpoint(points.groupBy(F.col("label").alias("of")).agg(
        F.least(F.ceil(F.count(F.lit(1)) / block), F.lit(pivots)).cast("int").alias("use")))
    sample = [bytes(r["unit"]) for r in points.orderBy(F.xxhash64("unit"), "unit").limit(pivots).collect()]
    celled = points.join(size, F.col("label") == F.col("of")).select("label", "unit", "rep", "n", "use")
    celled = reliable_checkpoint(celled.mapInArrow(_cells(sample), "label string, unit binary, rep long, n long, cell long"))
    held = reliable_checkpoint(celled.groupBy(F.col("label").alias("of"), F.col("cell").alias("in_cell")).agg(
        F.ceil(F.count(F.lit(1)) / block).alias("salts")))
    salted = celled.join(held, (F.col("label") == F.col("of")) & (F.col("cell") == F.col("in_cell"))).select(
        "label", F.length("unit").alias("size"), "cell", F.pmod(F.xxhash64("unit"), F.col("salts")).alias("salt"),
        "unit", "rep", "n")
    blocks = reliable_checkpoint(reliable_checkpoint(salted).groupBy("label", "size", "cell", "salt").applyInPandas(
        _blocks(block, tile),
        "label string, size int, tile long, block long, center array<double>, radius double, payload binary"))
    met = reliable_checkpoint(_near_tiles(blocks, math.sqrt(2 - 2 * cosine) + _SLACK))
    met = met.join(blocks.select("label", "size", "tile", "block", "payload"), ["label", "size", "block"])
    found = reliable_checkpoint(met.groupBy("label", "size", "ta", "tb").applyInPandas(
        _tile_links(cosine), "rep long, links long, other long"))
    counts = reliable_checkpoint(found.groupBy(F.col("rep").alias("node_")).agg(F.sum("links").alias("links")))
    parts = reliable_checkpoint(connected_components(found.select(F.col("rep").alias("u"), F.col("other").alias("v"))))
    per = reliable_checkpoint(points.join(counts, F.col("rep") == F.col("node_"), "left").drop("node_")
                              .join(parts, F.col("rep") == F.col("node"), "left").select(
        F.col("label").alias("of"), F.col("unit").alias("own"), "least",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("part")))
    smallest = per.groupBy("part").agg(F.min("least").alias("component"))
    per = reliable_checkpoint(per.join(smallest, "part").select("of", "own", "links", "component"))
    out = rows.join(per, (F.col("label") == F.col("of")) & (F.col("unit") == F.col("own")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
