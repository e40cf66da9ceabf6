"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors of one label (and one length) are linked if their cosine is `LEAST` or more, that is, if their unit vectors are
no further apart than sqrt(2 - 2 * LEAST). Equal vectors are joined first and stand as one with a weight.

The top of the tree is laid over all data: centres, a share of `CELL` rows of the largest label for each, and each vector
in the cell of its nearest one. A label uses as many of the centres as its own size asks for, so a small label is one
cell. Two linked vectors of different cells lie on different sides of the plane midway between their centres, and their
distances from it add up to no more than the threshold; so at least one of them is within half the threshold of it, and
that one visits the other's cell (if both are, the cell of the smaller number counts the pair). A vector thus meets its
own cell and the few it is near the border of, whatever the number of cells, and no table of pairs of cells is made.
Cells are cut into blocks of bounded size by a hash, so a crowded one is many tasks.

In the task a cover tree is built: nested levels, radii halving from level to level, every centre of a level also one of
the next, each point under a centre within the radius. The two trees are descended level by level together; a pair of
nodes stays only if its centres are no further apart than both actual covering radii and the threshold, and the points of
the pairs that stay at the last level are compared exactly. The centres are a bounded sample (`CENTRE_BYTES`); they decide
what is compared where, never what is found.

A task returns sums of links and one link per point to the smallest id of its group in the task, so groups of copies
do not make all their pairs as rows; the groups of all tasks are joined by `groups.components`.

Edge cases: a null label, and a vector that is null, empty, zero or holds nulls or non-finite numbers, links with
nothing; vectors of different lengths do not link; rows without id count for others but have no component of their own
and stay; rows that share an id are one node. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from hydrolens.llm.common import map_rows
from hydrolens.llm.groups import components
from hydrolens.session import stage

LEAST = 0.98
BLOCK = 1024
CELL = 512
CENTRE_BYTES = 8 << 20
FINEST = 0.05
_NO_ID = 9223372036854775807


def unit(values) -> np.ndarray | None:
    """The vector over its length in double precision, or None if it has no direction."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.asarray(values, float)
    top = np.abs(x).max() if np.isfinite(x).all() else 0.0
    if not top > 0:
        return None
    x = x / top + 0.0
    return x / np.sqrt(x @ x)


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """`vec_id`, a digest of label and vector (null if it links with nothing), `label`, the vector as `v`."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            u = unit(row["embedding"]) if row["label"] is not None else None
            key = v = None
            if u is not None:
                label, v = str(row["label"]).encode(), np.asarray(row["embedding"], float) + 0.0
                key = hashlib.blake2b(len(label).to_bytes(8, "little") + label + v.tobytes(), digest_size=16).digest()
                v = v.tolist()
            yield {"vec_id": row["vec_id"], "key": key, "label": str(row["label"]), "v": v}

    return map_rows(vectors.select("vec_id", "embedding", "label"), run, f"vec_id bigint, key binary, label string, v array<{kind}>")


def units(column: pd.Series) -> np.ndarray:
    """Unit vectors of usable vectors of one length."""
    x = np.stack(column.to_numpy()).astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest_cells(points: np.ndarray, centres: np.ndarray, least: float = LEAST) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each point's nearest centre, and the other centres whose border with it is within half the threshold."""
    half = np.sqrt(2 - 2 * least) / 2 + 1e-9
    homes, goes = np.empty(len(points), int), []
    for start in range(0, len(points), 256):
        cosines = points[start : start + 256] @ centres.T
        home = cosines.argmax(1)
        behind = cosines[np.arange(len(home)), home][:, None] - cosines
        row, other = np.nonzero(behind <= 2 * half)  # centres are at most 2 apart
        gap = np.linalg.norm(centres[home[row]] - centres[other], axis=1)
        visits = (other != home[row]) & ((gap < 1e-6) | (behind[row, other] <= half * gap))
        row, other = row[visits], other[visits]
        goes += np.split(other, np.searchsorted(row, np.arange(1, len(home))))
        homes[start : start + 256] = home
    return homes, goes


class CoverTree:
    """Nested levels over points: at each level the centres (point numbers) and every point's centre and that node's radius."""

    def __init__(self, points: np.ndarray):
        self.points, self.levels = points, []
        centres, radius = [0], 2.0
        owner = np.zeros(len(points), int)
        away = _distance(points, points[:1])[:, 0]
        while True:
            nearest, near_at = away.copy(), owner.copy()
            for p in range(len(points)):  # a point beyond the radius of all centres becomes one
                if nearest[p] > radius:
                    gap = _distance(points, points[p : p + 1])[:, 0]
                    closer = gap < nearest
                    nearest[closer], near_at[closer] = gap[closer], len(centres)
                    centres.append(p)
            away, owner = nearest, near_at
            reach = np.zeros(len(centres))
            np.maximum.at(reach, owner, away)
            self.levels.append((np.array(centres), owner, reach))
            if radius <= FINEST or len(centres) == len(points):
                return
            radius /= 2


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def dual_links(one: CoverTree, two: CoverTree, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the points of both trees whose cosine is `least` or more."""
    reach = np.sqrt(2 - 2 * least) + 1e-9
    rows, columns = np.arange(len(one.points)), np.arange(len(two.points))
    for level in range(max(len(one.levels), len(two.levels))):
        c1, o1, r1 = one.levels[min(level, len(one.levels) - 1)]
        c2, o2, r2 = two.levels[min(level, len(two.levels) - 1)]
        n1, n2 = np.unique(o1[rows]), np.unique(o2[columns])
        near = _distance(one.points[c1[n1]], two.points[c2[n2]]) <= r1[n1][:, None] + r2[n2][None, :] + reach
        rows = rows[np.isin(o1[rows], n1[near.any(1)])]
        columns = columns[np.isin(o2[columns], n2[near.any(0)])]
        if not len(rows) or not len(columns):
            break
    if not len(rows) or not len(columns):
        return np.empty(0, int), np.empty(0, int)
    near_rows, near_columns = np.searchsorted(n1, o1[rows]), np.searchsorted(n2, o2[columns])
    linked = (one.points[rows] @ two.points[columns].T >= least) & near[near_rows][:, near_columns]
    i, j = np.nonzero(linked)
    return rows[i], columns[j]


def _local_groups(size: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each point's group under the links (i, j)."""
    labels = ids.copy()
    while len(i):
        before = labels.copy()
        np.minimum.at(labels, i, labels[j])
        np.minimum.at(labels, j, labels[i])
        if np.array_equal(before, labels):
            break
    return labels


def block_links(rows: pd.DataFrame, least: float = LEAST) -> pd.DataFrame:
    """Links of a block with itself (where `a` = `b`) and with the rows of `side` 1: per point, weight of its links and local group.

    Rows have `key`, `id`, `weight`, `v`, `cell`, `home` (the own cell), `goes` (cells that a row of `cell` visits itself).
    """
    rows = rows.sort_values("id").reset_index(drop=True)
    points, ids, weights = units(rows["v"]), rows["id"].to_numpy(), rows["weight"].to_numpy()
    at1, at2 = np.nonzero(rows["side"].to_numpy() == 0)[0], np.nonzero(rows["side"].to_numpy() == 1)[0]
    i = j = np.empty(0, int)
    if len(at1):
        tree = CoverTree(points[at1])
        if rows["a"].iat[0] == rows["b"].iat[0]:
            i, j = dual_links(tree, tree, least)
            i, j = at1[i][i < j], at1[j][i < j]
        if len(at2):
            i2, j2 = dual_links(tree, CoverTree(points[at2]), least)
            i2, j2 = _counted_here(rows, at1[i2], at2[j2])
            i, j = np.concatenate([i, i2]), np.concatenate([j, j2])
    links = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
    out = pd.DataFrame({"key": rows["key"], "id": ids, "links": links.astype(np.int64), "group": _local_groups(len(ids), i, j, ids)})
    return out[out.links > 0]


def _counted_here(rows: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the pairs of a row `i` of this cell and a visitor `j` that meet in the visitor's cell, too, if that has the smaller number."""
    cell, home, goes = rows["cell"].iat[0], rows["home"].to_numpy(), rows["goes"].to_numpy()
    homes, place = np.unique(home[j], return_inverse=True)
    mine, own = np.unique(i, return_inverse=True)
    visits = np.array([np.isin(homes, goes[m]) for m in mine], bool).reshape(len(mine), len(homes)) & (homes < cell)
    keep = ~visits[own, place]
    return i[keep], j[keep]


def _dealt(placed: DataFrame) -> DataFrame:
    """A row for each block pair that a vector takes part in: in its own cell and, as a visitor, in those it goes to."""
    entries = placed.withColumn("cell", F.explode(F.expr("concat(array(home), goes)"))).withColumn("visitor", F.expr("cell <> home"))
    cell = ["kind", "cell"]
    counted = entries.groupBy(*cell).agg(F.count_if(~F.col("visitor")).alias("own"), F.count_if("visitor").alias("visitors"))
    counted = counted.where("own > 0 AND own + visitors > 1")
    # Stored, so that Spark knows its size before it chooses how to join.
    sizes = stage(counted.select(*cell, *[F.expr(f"cast(ceil({n} / {BLOCK}) AS int)").alias(n) for n in ("own", "visitors")]), "cell-sizes")
    entries = entries.join(sizes, cell).withColumn("part", F.expr("pmod(xxhash64(key), IF(visitor, visitors, own))").cast("int"))
    # Blocks of a cell meet as (a, b) with a <= b; the first block of visitors joins each block's meeting with itself.
    pairs = """IF(visitor,
        transform(sequence(0, own - 1), n -> struct(n AS a, IF(part = 0, n, own + part) AS b, 1 AS side)),
        concat(transform(sequence(part, own - 1), n -> struct(part AS a, n AS b, 0 AS side)),
               transform(filter(sequence(0, own - 1), n -> n < part), n -> struct(n AS a, part AS b, 1 AS side)),
               transform(filter(sequence(0, visitors), n -> n > 0 AND n < visitors), n -> struct(part AS a, own + n AS b, 0 AS side))))"""
    met = entries.withColumn("goes", F.expr("IF(visitor, NULL, goes)")).withColumn("pair", F.explode(F.expr(pairs)))
    return met.select(*cell, "pair.a", "pair.b", "pair.side", "home", "goes", "key", "id", "weight", "v")


def with_links(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `n_links`, `component_id` and `kept` for each row of `vectors` (`vec_id`, `embedding`, `label`)."""
    rows = stage(usable_vectors(vectors), "vectors")
    valid = rows.where("key IS NOT NULL").withColumn("dims", F.size("v"))
    classes = valid.groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("dims").alias("dims"), F.first("v").alias("v"))
    classes = classes.withColumn("id", F.coalesce("id", F.lit(_NO_ID))).withColumn("kind", F.expr("concat(dims, ':', label)")).drop("label")
    classes = stage(classes, "vector-classes")

    kinds = classes.groupBy("kind", "dims").agg(F.expr(f"ceil(count(1) / {CELL})").alias("n"))
    cells = F.expr(f"cast(least(n, greatest(1, {CENTRE_BYTES} div (8 * dims))) AS int)").alias("cells")
    kinds = stage(kinds.select("kind", "dims", cells), "vector-kinds")
    centres = {}
    for r in kinds.groupBy("dims").agg(F.max("cells").alias("n")).collect():  # one row per length
        sample = classes.where(F.col("dims") == r["dims"]).orderBy(F.xxhash64("key"), "key").limit(r["n"]).select("v").toPandas()
        found = units(sample["v"])
        centres[r["dims"]] = found[np.sort(np.unique(found, axis=0, return_index=True)[1])]

    @F.pandas_udf("struct<home: int, goes: array<int>>")
    def placing(column: pd.Series, cells: pd.Series) -> pd.DataFrame:
        homes, goes = np.zeros(len(column), int), np.empty(len(column), object)
        lengths = column.map(len).to_numpy()
        for length, count in {*zip(lengths.tolist(), cells.tolist())}:
            at = np.nonzero((lengths == length) & (cells.to_numpy() == count))[0]
            homes[at], there = nearest_cells(units(column.iloc[at]), centres[length][:count])
            for n, visits in zip(at, there):
                goes[n] = visits.tolist()
        return pd.DataFrame({"home": homes, "goes": goes})

    placed = classes.join(kinds.drop("dims"), "kind").withColumn("place", placing("v", "cells"))
    placed = stage(placed.select("kind", "key", "id", "weight", "v", "place.*"), "placed-vectors")
    found = _dealt(placed).groupBy("kind", "cell", "a", "b").applyInPandas(lambda block: block_links(block), "key binary, id bigint, links bigint, group bigint")
    found = stage(found, "vector-links")

    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("id").alias("a"), F.col("group").alias("b")).where(f"a <> b AND a <> {_NO_ID} AND b <> {_NO_ID}")
    members = components(edges).select(F.col("node").alias("id"), "component")
    whole = classes.select("key", "id", "weight").join(links, "key", "left").join(members, "id", "left")
    whole = whole.select("key", F.expr("coalesce(links, 0) + weight - 1 AS n_links"), F.expr(f"nullif(coalesce(component, id), {_NO_ID}) AS component"))
    rows = rows.select("vec_id", "key").join(whole, "key", "left")
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
