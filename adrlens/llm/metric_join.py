"""Embedding near-duplicates by an exact metric range join.

Unit vectors are points; cosine >= c means distance <= eps = sqrt(2 - 2c).  Pivots, some of the
points, cut space into cells: a point's home is the cell of its nearest pivot.  The triangle
inequality says which other cells can hold a neighbour: a point is at least
(d_j^2 - d_i^2) / (2 d(p_i, p_j)) away from everything whose home is cell j, d_i and d_j being
its distances to its own pivot and to p_j; it is copied to the cells where this is not above eps.
Of pivots that have one direction (scaled copies) only the first is used.
Then each cell is joined by itself, homes against members (homes and copies).  Inside a cell a
home meets only members whose distance to the pivot differs by at most eps.  Homes and members
of a cell are dealt into blocks of bounded size, each pair of blocks is one task.

Equal vectors are one point with a count.  A task returns sums of links per home and the local
components as one edge per point, never pairs, so dense groups do not square the output.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do rows without an id (null component, kept); vectors of different length do
not link; repeated ids are rows of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from adrlens.llm.common import written
from adrlens.llm.components import components
from adrlens.llm.vectors import matrix, usable

CELL = 16_384  # homes per cell aimed at, and rows per block
MOST_PIVOTS = 1_024
SLACK = 1e-9  # for rounding in distances; the cosine itself is compared exactly
SAME = 1e-2  # pivots closer than this are one direction: between them rounding could decide


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def assign(points: np.ndarray, pivots: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(point, cell, is home, distance to that pivot) of all homes and copies."""
    far, apart = distances(points, pivots), distances(pivots, pivots)
    home = far.argmin(1)
    own = far[np.arange(len(points)), home][:, None]
    between = apart[home]
    away = (np.square(far) - np.square(own)) / (2 * np.maximum(between, SAME))
    near = (between < SAME) | (away <= eps + SLACK)
    near[np.arange(len(points)), home] = True
    point, cell = np.nonzero(near)
    return point, cell, home[point] == cell, far[point, cell]


def distinct(pivots: list) -> list:
    """The pivots without those whose direction an earlier one has."""
    kept: list = []
    units: dict[int, list[np.ndarray]] = {}
    for pivot in pivots:
        own, seen = unit(matrix([pivot])), units.setdefault(len(pivot), [])
        if not seen or distances(own, np.concatenate(seen)).min() >= SAME:
            kept.append(pivot)
            seen.append(own)
    return kept


class Groups:
    """Components of local points, by relabelling."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.unique(ids)
        self.label = np.arange(len(self.ids))

    def join(self, ids: np.ndarray) -> None:
        labels = np.unique(self.label[np.searchsorted(self.ids, ids)])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels[1:])] = labels[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(id, smallest id of its component), without the smallest."""
        rest = np.flatnonzero(self.label != np.arange(len(self.ids)))
        return self.ids[rest], self.ids[self.label[rest]]


def join_block(home: pd.DataFrame, member: pd.DataFrame, cosine: float, eps: float,
               rows: int = 512) -> tuple[np.ndarray, Groups]:
    """Links of each home row (members count with their copies) and the local components."""
    member = member.sort_values("far", kind="stable")
    ids, weight, far = (member[c].to_numpy() for c in ("node", "n", "far"))
    points, groups = unit(matrix(member["v"])), Groups(np.concatenate([home["node"].to_numpy(), ids]))
    order = np.argsort(home["far"].to_numpy(), kind="stable")
    own, own_far, nodes = unit(matrix(home["v"])), home["far"].to_numpy(), home["node"].to_numpy()
    links = np.zeros(len(home), np.int64)
    for begin in range(0, len(order), rows):
        part = order[begin:begin + rows]
        low, high = np.searchsorted(far, (own_far[part[0]] - eps - SLACK, own_far[part[-1]] + eps + SLACK))
        for first in range(low, high, 8 * rows):
            stop = min(high, first + 8 * rows)
            near = own[part] @ points[first:stop].T >= cosine
            for row in np.flatnonzero(near.any(1)):
                hit = first + np.flatnonzero(near[row])
                hit = hit[ids[hit] != nodes[part[row]]]
                if len(hit):
                    links[part[row]] += weight[hit].sum()
                    groups.join(np.append(ids[hit], nodes[part[row]]))
    return links, groups


def near_duplicates(vectors: DataFrame, cosine: float, id_column: str = "vec_id",
                    vector_column: str = "embedding", cell: int = CELL) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    eps = math.sqrt(2 - 2 * cosine)
    fits = (usable(F.col(vector_column)) & F.exists(vector_column, lambda x: x != 0)
            & F.col(id_column).isNotNull())
    rows = written(vectors.select(F.col(id_column).cast("long").alias("id"),
                                  F.when(fits, F.col(vector_column)).alias("v")), "vectors")
    nodes = written(rows.where("v is not null").groupBy("v").agg(
        F.min("id").alias("node"), F.count("*").alias("n")), "points")
    counted = nodes.count()
    pivots = [r["v"] for r in nodes.orderBy(F.xxhash64("v")).select("v")
              .limit(min(MOST_PIVOTS, max(1, -(-counted // cell)))).collect()]
    placed = written(_placed(nodes, distinct(pivots), eps), "cells")
    key = ["dims", "cell"]
    blocks = placed.groupBy(key).agg(
        F.ceil(F.count_if("home") / cell).cast("int").alias("hs"),
        F.ceil(F.count("*") / cell).cast("int").alias("ms"))
    dealt = (placed.join(blocks, key).where("hs > 0")
             .withColumn("hb", F.pmod(F.xxhash64("node", F.lit(1)), "hs").cast("int"))
             .withColumn("mb", F.pmod(F.xxhash64("node", F.lit(2)), "ms").cast("int")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    homes = dealt.where("home").withColumn("mb", every("ms"))
    members = dealt.withColumn("hb", every("hs"))

    def join(home: pd.DataFrame, member: pd.DataFrame) -> pd.DataFrame:
        if home.empty or member.empty:
            return pd.DataFrame({"node": [], "n": [], "root": []}, dtype="int64")
        links, groups = join_block(home, member, cosine, eps)
        some = links > 0
        child, root = groups.edges()
        return pd.concat([pd.DataFrame({"node": home["node"].to_numpy()[some], "n": links[some]}),
                          pd.DataFrame({"node": child, "root": root})]).astype("Int64")

    keys = ["dims", "cell", "hb", "mb"]
    columns = [*keys, "node", "n", "v", "far"]
    members = members.select(*(F.col(c).alias(c) for c in columns))  # columns apart from those of homes
    found = written(homes.select(columns).groupBy(keys).cogroup(members.groupBy(keys))
                    .applyInPandas(join, "node long, n long, root long"), "links")
    groups = components(found.where("root is not null").select(F.col("node").alias("a"), F.col("root").alias("b")))
    info = written(nodes.join(found.where("n is not null").groupBy("node").agg(F.sum("n").alias("others")),
                              "node", "left")
                   .join(groups, "node", "left")
                   .select("v", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component", "node").alias("component_id")), "classes")
    return (rows.join(info, "v", "left")
            .select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id"))))


def _placed(nodes: DataFrame, pivots: list, eps: float) -> DataFrame:
    by_size: dict[int, list[int]] = {}
    for i, pivot in enumerate(pivots):
        by_size.setdefault(len(pivot), []).append(i)
    units = {size: (np.array(own), unit(matrix([pivots[i] for i in own]))) for size, own in by_size.items()}

    def place(frames):
        for frame in frames:
            sizes = frame["v"].map(len).to_numpy()
            for size in np.unique(sizes):
                own = frame[sizes == size].reset_index(drop=True)
                if size in units:
                    names, points = units[size]
                    point, cell, home, far = assign(unit(matrix(own["v"])), points, eps)
                    cell = names[cell]
                else:  # no pivot of this length: one cell
                    point, cell = np.arange(len(own)), np.full(len(own), -1)
                    home, far = np.ones(len(own), bool), np.zeros(len(own))
                yield own.iloc[point].assign(dims=size, cell=cell, home=home, far=far)

    vector = nodes.schema["v"].dataType.simpleString()
    return nodes.select("node", "n", "v").mapInPandas(
        place, f"node long, n long, v {vector}, dims int, cell int, home boolean, far double")
