"""Approximate nearest neighbours: a forest of random-projection trees.

Every tree splits the space at the median along the line through two random points of a sample. A
query searches all trees through one priority queue: the next node is the one with the smallest sum
of squared distances to the planes that were crossed to reach it. It takes leaves until they hold
the wanted share of all index entries; the candidates in them are ranked by exact distance.

The trees are fitted on a bounded sample; every row is indexed. Vectors travel to their leaves once
per tree. Leaves are bundled to tasks by their counted sizes, and a leaf of many rows is split over
several, which its queries all visit. The queries of a bundle are cut into blocks too, each of which
meets the bundle's rows in a task of its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.llm.sampling import hashed_sample
from fundspark.llm.vectors import best_per_query, matrix, query_vectors, valid_vectors
from fundspark.operators.lineage import materialise

TREES, LEAF, SAMPLE = 2, 96, 8_192
BUNDLE_ROWS, QUERIES = 16_384, 4_096
# A query looks at so many index entries at least; leaves of a small table are too few to choose from.
LEAST = 4_096
ROUTED = "tree int, leaf int, id long, v array<double>"
ASKED = "bundle int, id long, v array<double>, leaves array<int>"
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes in arrays; ``left`` is -1 at a leaf. Rows with ``v @ plane < cut`` go left."""

    planes: np.ndarray
    cuts: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def route(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int32)
        while True:
            open_rows = np.flatnonzero(self.left[at] >= 0)
            if not len(open_rows):
                return at
            nodes = at[open_rows]
            side = np.einsum("ij,ij->i", vectors[open_rows], self.planes[nodes]) < self.cuts[nodes]
            at[open_rows] = np.where(side, self.left[nodes], self.right[nodes])


def grow(sample: np.ndarray, rng: np.random.Generator, leaf: int) -> Tree:
    width = sample.shape[1]
    planes, cuts, left, right = [np.zeros(width)], [0.0], [-1], [-1]
    waiting = [(0, np.arange(len(sample)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf:
            continue
        for _ in range(3):
            one, two = sample[rng.choice(rows, 2, replace=False)]
            plane = one - two
            length = np.linalg.norm(plane)
            if length < 1e-12:
                plane, length = rng.normal(size=width), 1.0
            plane = plane / length
            along = sample[rows] @ plane
            cut = np.median(along)
            side = along < cut
            if side.any() and not side.all():
                break
        else:
            continue  # copies of one vector stay together
        planes[node], cuts[node] = plane, cut
        left[node], right[node] = len(planes), len(planes) + 1
        for part in (rows[side], rows[~side]):
            waiting.append((len(planes), part))
            planes.append(np.zeros(width))
            cuts.append(0.0)
            left.append(-1)
            right.append(-1)
    return Tree(np.array(planes), np.array(cuts), np.array(left, np.int32), np.array(right, np.int32))


def search(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, wanted: float):
    """``(tree, leaf)`` in the order of the shared queue, until ``wanted`` index entries are met."""
    queue = [(0.0, tree, 0) for tree in range(len(forest))]
    met = 0
    while queue and met < wanted:
        away, tree, node = heapq.heappop(queue)
        this = forest[tree]
        while this.left[node] >= 0:
            margin = float(query @ this.planes[node] - this.cuts[node])
            near, far = this.left[node], this.right[node]
            if margin >= 0:
                near, far = far, near
            heapq.heappush(queue, (away + margin * margin, tree, int(far)))
            node = int(near)
        met += sizes[tree][node]
        yield tree, node


def _route(forest: list[Tree], width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = matrix(batch["v"])
            for number, tree in enumerate(forest):
                yield batch.assign(tree=number, leaf=tree.route(vectors))[["tree", "leaf", "id", "v"]]

    return run


def _ask(forest, sizes, bundles, wanted: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for own, vector in zip(batch["id"], batch["v"], strict=True):
                visits: dict[int, list[int]] = {}
                for tree, leaf in search(forest, sizes, np.asarray(vector), wanted):
                    for bundle in bundles.get((tree, leaf), ()):
                        visits.setdefault(bundle, []).append(tree << 20 | leaf)
                rows += [(bundle, own, vector, leaves) for bundle, leaves in visits.items()]
            yield pd.DataFrame(rows, columns=["bundle", "id", "v", "leaves"])

    return run


def nearest(vectors, ids, query, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest other ids by Euclidean distance; ties to smaller ids."""
    others = np.flatnonzero(ids != own)
    if len(others) > 4 * k:
        # A quick distance with its rounding error sorts out what cannot be among the k nearest.
        quick = (vectors[others] ** 2).sum(axis=1) - 2 * (vectors[others] @ query)
        slack = 1e-9 * (np.abs(quick).max() + (query**2).sum() + 1)
        others = others[quick <= np.partition(quick, k - 1)[k - 1] + slack]
    distance = np.sqrt(((vectors[others] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[others], distance))[:k]
    return ids[others[order]], distance[order]


def _rank(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(queries) and len(rows):
            # A row that two trees put into this bundle counts once.
            vectors, ids = matrix(rows["v"]), rows["id"].to_numpy()
            place = (rows["tree"].to_numpy().astype(np.int64) << 20) | rows["leaf"].to_numpy()
            for own, query, leaves in zip(
                queries["id"], queries["v"], queries["leaves"], strict=True
            ):
                met = np.flatnonzero(np.isin(place, leaves))
                # Rows are distinct, but every tree can bring each of them.
                found, distance = nearest(vectors[met], ids[met], np.asarray(query), own, TREES * k)
                out.append((np.full(len(found), own), found, distance))
        query_id, vec_id, score = map(np.concatenate, zip(*out, strict=True))
        found = pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})
        return found.drop_duplicates()

    return run


def nearest_neighbours(
    table: DataFrame,
    *,
    k: int = 10,
    every: int = 100,
    share: float = 1.5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 17,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query row about the k nearest other rows.

    Queries are the rows whose id is divisible by ``every``; ``score`` is the Euclidean distance in
    double precision. ``share`` is the number of index entries a query looks at, in units of the
    number of rows, but ``LEAST`` at least; the index has ``TREES`` entries per row. Planes come from a
    sample of about ``SAMPLE`` rows.

    Rows with a NULL id, or a vector that is NULL, empty, zero or holds NULL or non-finite
    components, take no part; so do rows whose vector is not as long as most of the sample's. Rows
    that repeat id and vector count once, however often they stand; an id's rows are no candidates
    for its own query. With fewer than k other rows all that the search met are returned. No rows:
    an empty result.
    """
    spark = table.sparkSession
    rows = materialise(valid_vectors(table, id_col, vector_col, zero=False).distinct(), "ann-vectors")
    sample = hashed_sample(rows, ["id", "v"], SAMPLE, seed).toPandas()
    if not len(sample):
        sample = rows.limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = sample["v"].map(len)
    width = int(lengths.mode().max())
    sample = sample[lengths == width]
    sample = sample.assign(order=sample["v"].map(tuple)).sort_values(["id", "order"])
    rng = np.random.default_rng(seed)
    forest = [grow(matrix(sample["v"]), rng, LEAF) for _ in range(TREES)]
    rows = rows.where(F.size("v") == width)
    asked = query_vectors(rows, F.col("id") % every == 0)
    routed = rows.mapInPandas(_route(forest, width), ROUTED)
    # As many counts as the forest has leaves.
    is_query = F.count_if(F.col("id") % every == 0).alias("asked")
    counted = routed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("size"), is_query).collect()
    across = max(1, -(-sum(row["asked"] for row in counted if row["tree"] == 0) // QUERIES))
    sizes = [np.zeros(len(tree.left), np.int64) for tree in forest]
    bundles: dict[tuple[int, int], range] = {}
    places, bundle, load = [], 0, 0
    for row in sorted(counted):
        tree, leaf, size = row["tree"], row["leaf"], row["size"]
        sizes[tree][leaf] = size
        if load and load + size > BUNDLE_ROWS:
            bundle, load = bundle + 1, 0
        parts = -(-size // BUNDLE_ROWS)
        bundles[tree, leaf] = range(bundle, bundle + parts)
        places.append((tree, leaf, bundle, parts))
        bundle, load = bundle + parts - 1, load + size if parts == 1 else BUNDLE_ROWS
    wanted = max(share * sum(int(size.sum()) for size in sizes) / TREES, LEAST)
    visits = asked.mapInPandas(_ask(forest, sizes, bundles, wanted), ASKED)
    visits = visits.withColumn("across", F.pmod(F.xxhash64("id"), F.lit(across)).cast("int"))
    where = F.broadcast(spark.createDataFrame(places, "tree int, leaf int, first int, parts int"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = routed.join(where, ["tree", "leaf"]).withColumn("bundle", F.col("first") + part)
    block = F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across")
    dealt = dealt.select("bundle", "tree", "leaf", "id", "v", block)
    key = ["bundle", "across"]
    found = visits.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(_rank(k), FOUND)
    return best_per_query(found.distinct(), k, F.asc("score"))
