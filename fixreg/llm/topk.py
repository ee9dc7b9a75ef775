"""Exact top-k inner product search by dual-tree cover-tree search.

Equal vectors are stored once, with the smallest k + 1 of their ids: no other
of their rows can be among any query's best k.  All vectors are dealt into
cells around pivots (a bounded sample; they steer the work, not the result);
a cell is split into blocks of bounded size.

1. Each query meets the blocks of its own cell.  That bounds its k-th best
   score from below.
2. For a pair of a query cell and a data cell, no inner product exceeds
   ``c.d + |c| s + |d| r + r s`` (c, d the pivots, r, s the covering radii).
   The pair is dropped if that is under the worst k-th score of the query
   cell.  Queries go to the blocks of the cells that are left.

In a block, queries and data have cover trees (one for some rows each, as a
tree is built from the distances between all of them); the same bound prunes
pairs of nodes against the worst k-th score of the query node.  Blocks return
a query's best k + 1 vectors, which a partial top-k reduces before the
shuffle.  Pruning only drops pairs that cannot reach the result, so it is
exact; where the data have no structure every block is searched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hand_back, runs, written

LOW = -np.inf
TREE = 1024  # rows of a cover tree, whose building holds a table of their distances


class Node:
    """A cover-tree node: a centre, its covering radius, and what lies under it.

    ``own`` are points that are no node of their own; ``all`` are all points.
    """

    __slots__ = ("centre", "radius", "own", "kids", "all")

    def __init__(self, centre: int, radius: float, own: np.ndarray, kids: list[Node], every: np.ndarray):
        self.centre, self.radius, self.own, self.kids, self.all = centre, radius, own, kids, every


def cover_tree(x: np.ndarray, leaf: int = 8, base: int = 0) -> Node:
    """Cover tree of the rows of ``x``, numbered from ``base``: children of a
    node with covering radius r are more than r / 2 apart and cover its points
    within r / 2.  The distances between all rows are held at once."""
    square = (x * x).sum(1)
    apart = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * (x @ x.T), 0))
    return _node(apart, 0, np.arange(len(x)), leaf, base)


def _node(apart: np.ndarray, centre: int, points: np.ndarray, leaf: int, base: int) -> Node:
    # No function within cover_tree: one that names itself keeps the distances until the cyclic collector comes by.
    radius = float(apart[centre, points].max())
    if len(points) <= leaf or radius == 0:
        return Node(base + centre, radius, base + points, [], base + points)
    left, parts, singles, head = points, [], [], centre
    while len(left):
        near = apart[head, left] <= radius / 2
        part = left[near]
        if len(part) > 1:
            parts.append((head, part))
        else:
            singles.append(head)
        left = left[~near]
        if len(left):
            head = int(left[0])
    return Node(base + centre, radius, base + np.array(singles, np.int64), [_node(apart, h, p, leaf, base) for h, p in parts], base + points)


class Search:
    """The best ``k`` rows of ``data`` for each row of ``queries`` (integer-valued floats).

    Equal scores go to the smaller ``ids``; ``floor`` bounds each query's k-th
    score from below (what lies under it may be left out).
    """

    def __init__(self, queries: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
        self.q, self.d, self.ids, self.k, self.floor = queries, data, ids, k, floor.astype(np.float64).copy()
        # Scores are exact in doubles below 2^53, else in Python integers.
        top = max(np.abs(queries).max(initial=0), np.abs(data).max(initial=0))
        self.exact = float(top) * float(top) * max(1, queries.shape[1]) < 2.0**53
        self.q_norm, self.d_norm = np.linalg.norm(queries, axis=1), np.linalg.norm(data, axis=1)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_hits = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, data row, score)."""
        for j in range(0, len(self.d) if len(self.q) else 0, TREE):
            data = cover_tree(self.d[j:j + TREE], base=j)
            for i in range(0, len(self.q), TREE):
                self.visit(cover_tree(self.q[i:i + TREE], base=i), data)
        self._compress()
        return self.hits[0]

    def bound(self, a: Node, b: Node) -> float:
        inner = float(self.q[a.centre] @ self.d[b.centre])
        most = inner + self.q_norm[a.centre] * b.radius + self.d_norm[b.centre] * a.radius + a.radius * b.radius
        return most + 1e-9 * (abs(most) + self.q_norm[a.centre] * self.d_norm[b.centre]) + 1e-6

    def visit(self, a: Node, b: Node) -> None:
        if self.bound(a, b) < self.floor[a.all].min():
            return
        if not a.kids and not b.kids:
            self.compare(a.all, b.all)
        elif b.kids and (b.radius >= a.radius or not a.kids):
            if len(b.own):
                self.compare(a.all, b.own)
            for _, _, kid in sorted((-self.bound(a, kid), i, kid) for i, kid in enumerate(b.kids)):
                self.visit(a, kid)
        else:
            if len(a.own):
                self.visit(Node(a.centre, a.radius, a.own, [], a.own), b)
            for kid in a.kids:
                self.visit(kid, b)

    def compare(self, rows: np.ndarray, cols: np.ndarray) -> None:
        score = self.q[rows] @ self.d[cols].T
        low = self.floor[rows]
        if len(cols) >= self.k:
            low = np.maximum(low, np.partition(score, len(cols) - self.k, axis=1)[:, len(cols) - self.k] - (0 if self.exact else 1e-6 * np.abs(score).max()))
        r, c = np.nonzero(score >= low[:, None])
        if self.exact:
            self.floor[rows] = low
        got = score[r, c]
        self.hits.append((rows[r], cols[c], got))
        self.n_hits += len(r)
        if self.n_hits > 500_000 or len(self.hits) > 10_000:  # small parts take more than their numbers
            self._compress()

    def _compress(self) -> None:
        if not self.hits:
            self.hits = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            return
        r, c, s = (np.concatenate(x) for x in zip(*self.hits))
        if not self.exact:
            s = np.array([sum(int(u) * int(v) for u, v in zip(self.q[i], self.d[j])) for i, j in zip(r, c)], object)
            order = np.array(sorted(range(len(r)), key=lambda i: (r[i], -s[i], self.ids[c[i]])), np.int64)
        else:
            order = np.lexsort((self.ids[c], -s, r))
        r, c, s = r[order], c[order], s[order]
        first = np.concatenate(([True], r[1:] != r[:-1])) if len(r) else np.zeros(0, bool)
        place = np.arange(len(r)) - np.maximum.accumulate(np.where(first, np.arange(len(r)), 0)) if len(r) else r
        keep = place < self.k
        self.hits, self.n_hits = [(r[keep], c[keep], s[keep])], int(keep.sum())


def top_k(rows: DataFrame, k: int = 5, every: int = 50, pivots: int = 64, block: int = 1024, query_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    ``rows`` has vec_id (long) and v (array of longs).  Queries are the rows
    whose id is divisible by ``every``; candidates are all rows but the
    query's own.  Ties go to the smaller vec_id.  Rows with a null id, a null
    vector or a null component take no part; rows equal in id and vector count
    once; vectors of another length than the query's are no candidates.  An
    empty table gives no rows, other columns are not looked at.
    """
    usable = rows.select("vec_id", "v").where("vec_id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)").distinct()
    order = Window.partitionBy("v").orderBy("vec_id")
    stored = (usable.withColumn("n", F.row_number().over(order)).where(f"n <= {k + 1}")
              .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
              .select(F.col("ids")[0].alias("rep"), "ids", "v"))
    # Representatives name vectors; the rare id that several vectors share needs the vector's digest beside it.
    stored = written(stored.withColumn("tag", F.xxhash64("v")), "topk-stored")
    sample = stored.select("v").orderBy(F.xxhash64("rep", F.lit(3)), "rep", "tag").limit(pivots).collect()
    centres = [np.array(r["v"], np.float64) for r in sample]

    def deal(batches):
        for pdf in batches:
            vectors = [np.asarray(v, np.float64) for v in pdf["v"]]
            cell, far = np.full(len(vectors), -1), np.zeros(len(vectors))
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                own = [j for j, c in enumerate(centres) if len(c) == dim]
                if not own:
                    continue
                x, c = np.array([vectors[i] for i in at]).reshape(len(at), dim), np.array([centres[j] for j in own]).reshape(len(own), dim)
                d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T), 0))
                best = d.argmin(1)
                cell[at] = np.array(own)[best]
                far[at] = d[np.arange(len(at)), best] * (1 + 1e-9) + 1e-3
            yield pdf[["rep", "ids", "v", "tag"]].assign(cell=cell, far=far)

    stored = written(stored.mapInPandas(deal, "rep long, ids array<long>, v array<long>, tag long, cell int, far double"), "topk-cells")
    asked = usable.where(F.expr(f"vec_id % {every} = 0")).join(stored.select("v", "rep", "tag"), "v").select(F.col("vec_id").alias("query_id"), "rep", "tag")
    asked = written(asked, "topk-asked")
    queries = stored.join(asked.select("rep", "tag").distinct(), ["rep", "tag"], "left_semi").select("rep", "tag", "v", "cell", "far")
    # One row for each cell: as many as pivots, and one for vectors of other lengths.
    data_cells = {r["cell"]: (r["n"], r["r"]) for r in stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect()}
    blocks = {c: -(-n // block) for c, (n, _) in data_cells.items()}
    groups = max(1, -(-queries.count() // query_block))
    spark = rows.sparkSession

    def meet(pairs: list[tuple[int, int]], asking: DataFrame) -> DataFrame:
        """The best vectors of each query in the data cells it is paired with: (rep, tag, d_rep, d_tag, score)."""
        plan = spark.createDataFrame([(q, d, blocks[d]) for q, d in pairs], "cell int, to int, n int")
        size = spark.createDataFrame([(d, blocks[d]) for d in sorted({d for _, d in pairs})], "cell int, n int")
        salt = F.xxhash64("rep", "tag", F.lit(5))
        ask = (asking.join(F.broadcast(plan), "cell")  # at most (pivots + 1)^2 rows
               .select(F.col("to").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"),
                       F.pmod(salt, F.lit(groups)).cast("int").alias("group"), F.lit(True).alias("asks"), "rep", "tag", "v", "floor"))
        have = (stored.join(F.broadcast(size), "cell")
                .select("cell", F.pmod(salt, "n").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
                        F.lit(False).alias("asks"), "rep", "tag", "v", F.lit(None).cast("double").alias("floor")))
        tiles = ask.unionByName(have).repartition("cell", "block", "group").sortWithinPartitions("cell", "block", "group")

        def search(batches):
            for tile in runs(batches, ["cell", "block", "group"]):
                for _, same in tile.groupby(tile["v"].map(len)):
                    q, d = same[same["asks"]], same[~same["asks"]]
                    if not len(q) or not len(d):
                        continue
                    x, y = (np.array([np.asarray(v, np.float64) for v in s["v"]]).reshape(len(s), -1) for s in (q, d))
                    found = Search(x, y, d["rep"].to_numpy(np.int64), k + 1, q["floor"].to_numpy(np.float64))
                    r, c, s = found.run()
                    del found
                    yield pd.DataFrame({"rep": q["rep"].to_numpy()[r], "tag": q["tag"].to_numpy()[r], "d_rep": d["rep"].to_numpy()[c],
                                        "d_tag": d["tag"].to_numpy()[c], "score": [int(v) for v in s]})
                hand_back()

        return tiles.mapInPandas(search, "rep long, tag long, d_rep long, d_tag long, score long")

    best = Window.partitionBy("rep", "tag").orderBy(F.desc("score"), "d_rep", "d_tag")
    cells = sorted(data_cells)
    first = written(meet([(c, c) for c in cells], queries.withColumn("floor", F.lit(LOW)))
                    .withColumn("n", F.row_number().over(best)).where(f"n <= {k + 1}"), "topk-own")
    floors = first.where(f"n = {k + 1}").select("rep", "tag", F.col("score").cast("double").alias("floor"))
    bounded = written(queries.join(floors, ["rep", "tag"], "left").fillna(LOW, ["floor"]), "topk-floors")
    asks = {r["cell"]: (r["floor"], r["r"]) for r in bounded.groupBy("cell").agg(F.min("floor").alias("floor"), F.max("far").alias("r")).collect()}
    left = [(q, d) for q in asks for d in cells if q != d and _may_reach(q, d, asks[q], data_cells[d][1], centres)]
    found = first.drop("n")
    if left:
        found = found.unionByName(meet(left, bounded))
    found = found.withColumn("n", F.row_number().over(best)).where(f"n <= {k + 1}")
    named = found.join(stored.select(F.col("rep").alias("d_rep"), F.col("tag").alias("d_tag"), "ids"), ["d_rep", "d_tag"])
    flat = named.select("rep", "tag", "d_rep", "d_tag", "score", F.explode("ids").alias("vec_id"))
    answer = asked.join(flat, ["rep", "tag"]).where("NOT (vec_id = query_id AND d_rep = rep AND d_tag = tag)")
    rank = Window.partitionBy("query_id", "rep", "tag").orderBy(F.desc("score"), "vec_id")
    return (answer.withColumn("rank", F.row_number().over(rank)).where(f"rank <= {k}")
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _may_reach(q: int, d: int, ask: tuple[float, float], reach: float, centres: list[np.ndarray]) -> bool:
    if q < 0 or d < 0:
        return q < 0 and d < 0
    if len(centres[q]) != len(centres[d]):
        return False
    a, b, (floor, r) = centres[q], centres[d], ask
    most = float(a @ b) + np.linalg.norm(a) * reach + np.linalg.norm(b) * r + r * reach
    return most * (1 + 1e-9) + 1e-3 >= floor


def floored(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): each component x as floor(scale * x); vectors with a null or non-finite one are dropped."""
    x = F.col(column).cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    return vectors.where(F.col(column).isNotNull() & fit).select(F.col(id_column).alias("vec_id"), v.alias("v"))
