"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all trees, exact distances in the leaves."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routelens.llm.common import in_share, written

NEIGHBOURS = 10
TREES = 4
#: Vectors that the trees are fitted on, and the share of them that a leaf holds at most.
SAMPLE, LEAF_SHARE = 16_384, 1 / 128
#: Share of all vectors, counted in every tree, that a query's leaves hold before the search stops.
SEARCH_SHARE = 0.17
#: Vectors of one leaf that one task compares.
BLOCK = 20_000


@dataclass(frozen=True)
class Tree:
    """Node k sends a vector to ``children[k, 1]`` if its projection on ``normals[k]`` is over ``cuts[k]``, else to ``children[k, 0]``; leaf j is -1 - j."""

    normals: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    root: int

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        at = np.full(len(vectors), self.root, np.int64)
        inner = np.flatnonzero(at >= 0)
        while len(inner):
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) > self.cuts[node]
            at[inner] = self.children[node, side.astype(int)]
            inner = inner[at[inner] >= 0]
        return -1 - at


def fit_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """Splits the sample by projections until at most ``leaf`` vectors are together.

    A projection's direction joins two random vectors of the node, moved to the centres of their halves; it cuts midway, or at the median if that
    leaves less than 3 % on a side. Vectors that no projection tells apart stay together.
    """
    normals, cuts, children, leaves = [], [], [], 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        side = None
        if len(rows) > leaf:
            normal, cut = _projection(sample[rows], rng)
            side = sample[rows] @ normal > cut
        if side is None or side.all() or not side.any():
            leaves += 1
            return -leaves
        node = len(normals)
        normals.append(normal)
        cuts.append(cut)
        children.append([0, 0])
        children[node] = [grow(rows[~side]), grow(rows[side])]
        return node

    root = grow(np.arange(len(sample)))
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normals).reshape(-1, width), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), root)


def _projection(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    a, b = rows[rng.choice(len(rows), 2, replace=False)]
    for _ in range(6):
        near = ((rows - a) ** 2).sum(axis=1) < ((rows - b) ** 2).sum(axis=1)
        if near.all() or not near.any():
            break
        a, b = rows[near].mean(axis=0), rows[~near].mean(axis=0)
    normal = a - b
    length = np.sqrt(normal @ normal)
    normal = normal / length if length > 0 else rng.normal(size=len(a))
    projected = rows @ normal
    cut = float((a + b) @ normal / 2)
    if not 0.03 < (projected > cut).mean() < 0.97:
        cut = float(np.median(projected))
    return normal, cut


def visited_leaves(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """``(tree, leaf)`` over all trees in one queue, until they hold ``budget`` vectors.

    The order is the sum of the squared margins by which the query misses the cuts on the way to a leaf.
    """
    queue = [(0.0, t, tree.root) for t, tree in enumerate(trees)]
    heapq.heapify(queue)
    found, held = [], 0
    while queue and held < budget:
        margin, t, node = heapq.heappop(queue)
        if node < 0:
            found.append((t, -1 - node))
            held += int(sizes[t][-1 - node])
            continue
        tree = trees[t]
        offset = float(query @ tree.normals[node] - tree.cuts[node])
        near, far = tree.children[node][::-1] if offset > 0 else tree.children[node]
        heapq.heappush(queue, (margin, t, int(near)))
        heapq.heappush(queue, (margin + offset * offset, t, int(far)))
    return found


def _usable(vector: Column) -> Column:
    """Neither null nor all zero, without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    embeddings: DataFrame, queries: Column, k: int = NEIGHBOURS, trees: int = TREES, share: float = SEARCH_SHARE, seed: int = 3
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest other rows found for every row where ``queries`` holds.

    ``score`` is the Euclidean distance in double precision; equal ones go to the smaller vec_id. Vectors that are
    null or zero or hold null or non-finite components take no part, nor do rows with a null vec_id or vectors of a length
    other than the most frequent one. Rows with one vec_id twice are one candidate each. Queries of one vec_id with
    different vectors each have ranks of their own; equal ones are one query. Only the query's own row is no candidate: another row with
    its vec_id is.

    Equal vectors are one in the index, as a query and as a candidate; only their ``k + 1`` smallest ids can be
    among anyone's nearest. Every vector is in one leaf of every tree. Leaves are compared in blocks of bounded size, and only
    the best ``k + 1`` of each block leave it, so no list of candidates is ever written.
    """
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"), queries.alias("asks"))
    rows = rows.where(_usable(F.col("vector")))
    widths = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width = widths[0].w if widths else 0
    rows = rows.where(F.size("vector") == width).withColumn("key", F.unhex(F.md5(F.array_join(F.transform("vector", lambda x: (x + 0.0).cast("string")), ","))))
    rows = written(rows, "vectors")
    first = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    twin = F.row_number().over(Window.partitionBy("key", "vec_id").orderBy("place"))  # among equal rows
    ids = rows.select("key", "vec_id", first.alias("place")).where(F.col("place") <= k + 1)
    ids = written(ids.withColumn("twin", twin), "ids")
    distinct = written(rows.groupBy("key").agg(F.first("vector").alias("vector"), F.max("asks").alias("asks")), "distinct")
    n = distinct.count()
    sample = np.array([r.vector for r in distinct.where(in_share(min(1.0, SAMPLE / max(n, 1)), "key")).select("vector").collect()], np.float64).reshape(-1, max(width, 1))
    sample = sample[np.lexsort(sample.T)] if width else sample
    rng = np.random.default_rng(seed)
    forest = [fit_tree(sample, max(8, int(len(sample) * LEAF_SHARE)), rng) for _ in range(trees)]
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # its size is bounded by SAMPLE

    placed = written(_placed(distinct, shared), "leaves")
    counts = placed.groupBy("tree", "leaf").count().collect()  # at most one row for each leaf of the sample
    sizes = [np.zeros(len(tree.children) + 1, np.int64) for tree in forest]
    for row in counts:
        sizes[row.tree][row.leaf] = row["count"]
    asked = _asked(distinct.where("asks"), shared, sizes, int(share * n * trees) + k + 1)
    blocks = _blocked(placed, sizes)
    present = written(blocks.select("tree", "leaf", "block").distinct(), "blocks")
    spread = asked.join(present, ["tree", "leaf"])
    compared = spread.groupBy("tree", "leaf", "block").cogroup(blocks.groupBy("tree", "leaf", "block"))
    near = compared.applyInPandas(lambda q, v: _nearest_in_block(q, v, k + 1), "query binary, key binary, score double")
    near = near.groupBy("query", "key").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "key"))
    # Vectors as near as the last one are kept too: ids decide between them.
    rank = F.rank().over(Window.partitionBy("query").orderBy("score"))
    near = written(near.withColumns({"r": rank, "b": best}).where(F.col("r") <= k + 1).select("query", "key", "score"), "near")
    options = near.join(ids.select("key", "vec_id", "twin"), "key")
    top = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    options = options.withColumn("place", top).where(F.col("place") <= k + 1).drop("place")
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("key").alias("query")).distinct()
    pairs = asking.join(options, "query").where("NOT (query_id = vec_id AND query = key AND twin = 1)")
    order = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return pairs.select("query_id", order.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _placed(distinct: DataFrame, shared) -> DataFrame:
    def place(batches):
        for pdf in batches:
            vectors = np.stack(pdf["vector"].to_numpy()).astype(np.float64) if len(pdf) else np.empty((0, 0))
            for t, tree in enumerate(shared.value if len(pdf) else []):
                yield pdf.assign(tree=t, leaf=tree.leaves(vectors))

    return distinct.select("key", "vector").mapInPandas(place, "key binary, vector array<double>, tree int, leaf int")


def _asked(queries: DataFrame, shared, sizes: list[np.ndarray], budget: int) -> DataFrame:
    """One row for each query and leaf it visits."""

    def visit(batches):
        for pdf in batches:
            for key, vector in zip(pdf["key"], pdf["vector"], strict=True):
                leaves = visited_leaves(shared.value, sizes, np.asarray(vector), budget)
                yield pd.DataFrame(
                    {"query": [key] * len(leaves), "asked": [vector] * len(leaves), "tree": [t for t, _ in leaves], "leaf": [x for _, x in leaves]}
                )

    return queries.select("key", "vector").mapInPandas(visit, "query binary, asked array<double>, tree int, leaf int")


def _blocked(placed: DataFrame, sizes: list[np.ndarray]) -> DataFrame:
    """Leaves over ``BLOCK`` vectors are cut into blocks by the vectors' hashes."""
    large = [(f"{t}/{j}", -(-int(m) // BLOCK)) for t, of in enumerate(sizes) for j, m in enumerate(of) if m > BLOCK]
    if not large:
        return placed.withColumn("block", F.lit(0))
    cuts = F.create_map(*[F.lit(x) for pair in large for x in pair])
    number = F.coalesce(F.try_element_at(cuts, F.concat_ws("/", "tree", "leaf")), F.lit(1))
    return placed.withColumn("block", F.pmod(F.xxhash64("key"), number).cast("int"))


def _nearest_in_block(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest vectors of a block for each query in it, and those as near as the last."""
    out: dict[str, list] = {"query": [], "key": [], "score": []}
    if len(queries) and len(vectors):
        points, keys = np.stack(vectors["vector"].to_numpy()), vectors["key"].to_numpy()
        for query, asked in zip(queries["query"], queries["asked"], strict=True):
            distance = np.sqrt(((points - np.asarray(asked)) ** 2).sum(axis=1))
            last = np.partition(distance, k - 1)[k - 1] if len(distance) > k else np.inf
            near = np.flatnonzero(distance <= last)
            out["query"] += [query] * len(near)
            out["key"] += keys[near].tolist()
            out["score"] += distance[near].tolist()
    return pd.DataFrame(out)
