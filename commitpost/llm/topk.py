"""Exact search for the k rows with the largest inner product, by a dual tree over query and row vectors.

Components are turned into whole numbers ``floor(256 * c)``, so scores are exact. Equal vectors become one point that
keeps its k + 1 smallest ids (no query can need more of them), which also empties hot groups of copies before anything
is compared. A bounded sample of points gives a net of centres, found farthest first, so that its first centres are a
coarser net. Points are dealt to their nearest centre and from there into shards of about ``SHARD`` points, query
points likewise over the coarser net; each shard becomes a cover tree, whose nodes have a centre and a covering radius.

For nodes with centres p and q and radii r and s no score exceeds p.q + |p|s + |q|r + rs. Pairs of nodes below the
worst (k+1)th score of the query node are pruned: first query trees against centres, then against shards (joins of
short summary rows), then inside tasks, where one query tree meets a block of row trees, best bound first. The first
bounds come from the sample, whose points are candidates like all others. What is left is compared by matrix products.

Cases: a null vector, or one with a null or not finite component (``vectors.REACH`` and more count as such), takes no
part, nor does a row with a null id; vectors are compared with those of their length (up to 32,767); rows with equal
ids are rows of their own: a query leaves out itself, and gives its results once for each row with its id; empty
tables and queries without candidates give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from commitpost.plans.stage import stage

from .vectors import matrices, whole

SCALE = 256
SAMPLE = 2_048  # points that centres and first bounds are taken from
CENTRES = 256  # most centres of the net
SHARD = 2_048  # points of a tree, about
GROUP = 1_024  # points of a query tree, about
BLOCK = 64  # trees that one task searches for a query tree, about
LEAF, QUERY_LEAF, CHILDREN = 128, 16, 64
BROADCAST_ROWS = 100_000  # summaries of centres are short rows
EXACT = 2**53

Matrices = dict[int, np.ndarray]


@dataclass
class Tree:
    """Points in the order of the leaves; node 0 is the root, children of a node follow each other."""

    points: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    children: np.ndarray
    order: np.ndarray

    @property
    def norm(self) -> np.ndarray:
        return np.sqrt((self.points[self.centre] ** 2).sum(axis=1))


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def cover_tree(points: np.ndarray, leaf: int | None = None) -> Tree:
    """A node's centre is one of its points. Its children cover it at half its radius, with centres farther apart than
    that, the first of them its own; points left over after ``CHILDREN`` centres are one more child. A node is a leaf
    if it is small or if hardly any of its points lie close together."""
    leaf = leaf or LEAF
    order = np.zeros(len(points), np.int64)
    nodes: list[list] = []
    waiting = [(np.arange(len(points)), 0)]
    at = 0
    while at < len(waiting):
        index, start = waiting[at]
        away = distances(points[index], points[index[0]])
        radius = float(away.max())
        parts: list[np.ndarray] = []
        if len(index) > leaf and radius > 0:
            left, gap = index, away
            while len(left) and len(parts) < CHILDREN:
                near = gap <= radius / 2
                parts.append(left[near])
                left = left[~near]
                if len(left):
                    gap = distances(points[left], points[left[0]])
            if len(left) > len(index) * 7 // 8:
                parts = []
            elif len(left):
                parts.append(left)
        nodes.append([start, start, start + len(index), radius, len(waiting), len(parts)])
        if not parts:
            order[start : start + len(index)] = index
        for part in parts:
            waiting.append((part, start))
            start += len(part)
        at += 1
    columns = list(zip(*nodes))
    place = np.zeros(len(points), np.int64)
    place[order] = np.arange(len(points))
    centre = place[[index[0] for index, _ in waiting]]
    start, end, child, children = (np.array(columns[i], np.int64) for i in (1, 2, 4, 5))
    return Tree(points[order], centre, np.array(columns[3]), start, end, child, children, order)


TREE = "points binary, dim int, nodes binary, radius binary, ids array<bigint>, counts array<int>"
NODE_FIELDS = ("centre", "start", "end", "child", "children")


def packed(tree: Tree, ids: list[list[int]]) -> list:
    """A tree as a row; ids of a point follow each other, ``counts`` says how many."""
    nodes = np.stack([getattr(tree, f) for f in NODE_FIELDS]).astype(np.int32)
    mine = [ids[i] for i in tree.order]
    return [
        tree.points.astype(np.int32).tobytes(), tree.points.shape[1], nodes.tobytes(), tree.radius.tobytes(),
        [i for some in mine for i in some], [len(some) for some in mine],
    ]


def unpacked(row: dict) -> tuple[Tree, np.ndarray, np.ndarray]:
    """The tree, its ids, and the place where the ids of each point begin."""
    counts = np.array(row["counts"], np.int64)
    points = np.frombuffer(row["points"], np.int32).astype(np.float64).reshape(len(counts), row["dim"])
    nodes = np.frombuffer(row["nodes"], np.int32).reshape(len(NODE_FIELDS), -1).astype(np.int64)
    radius = np.frombuffer(row["radius"], np.float64)
    fields = dict(zip(NODE_FIELDS, nodes))
    tree = Tree(points=points, radius=radius, order=np.arange(len(points)), **fields)
    return tree, np.array(row["ids"], np.int64), np.concatenate([[0], np.cumsum(counts)])


def bounds(p: np.ndarray, r: np.ndarray, p_norm: np.ndarray, q: np.ndarray, s: np.ndarray, q_norm: np.ndarray) -> np.ndarray:
    """No score of points within r of p and s of q is larger (a little is added for rounding)."""
    most = (p * q).sum(axis=-1) + p_norm * s + q_norm * r + r * s
    return most + 1e-6 + np.abs(most) * 1e-9


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    most = np.abs(q).max(initial=0) * np.abs(p).max(initial=0) * max(1, q.shape[1])
    if most < EXACT:
        return (q @ p.T).astype(np.int64)
    return q.astype(np.int64) @ p.T.astype(np.int64)


class Best:
    """The ``m`` best points of each query so far, by falling score, then first id."""

    def __init__(self, queries: Tree, least: np.ndarray, m: int):
        self.queries, self.m = queries, m
        self.least = least.copy()  # a score below this cannot be among the m best
        self.query, self.score, self.first = (np.zeros(0, np.int64) for _ in range(3))
        self.ids: list[list[int]] = []
        self.note()

    def note(self) -> None:
        """The least score that any query below a node still needs."""
        edges = np.stack([self.queries.start, self.queries.end], 1).ravel()
        padded = np.append(self.least, np.inf)
        self.worst = np.minimum.reduceat(padded, edges)[::2]

    def add(self, query: np.ndarray, score: np.ndarray, first: np.ndarray, ids: list[list[int]]) -> None:
        query, score, first = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.first, first)))
        ids = self.ids + ids
        order = np.lexsort((first, -score, query))
        query, score, first = query[order], score[order], first[order]
        new = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
        kept = rank < self.m
        full = rank == self.m - 1
        self.least[query[full]] = np.maximum(self.least[query[full]], score[full])
        self.query, self.score, self.first = query[kept], score[kept], first[kept]
        self.ids = [ids[i] for i in order[kept]]
        self.note()


def descend(queries: Tree, rows: Tree, worst: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each query leaf with the row leaves that may hold a point it needs; all pairs of a level at once."""
    q_norm, p_norm = queries.norm, rows.norm
    q, p = np.zeros(1, np.int64), np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(q):
        most = bounds(
            rows.points[rows.centre[p]], rows.radius[p], p_norm[p], queries.points[queries.centre[q]], queries.radius[q], q_norm[q]
        )
        needed = most >= worst[q]
        q, p = q[needed], p[needed]
        q_leaf, p_leaf = queries.children[q] == 0, rows.children[p] == 0
        done = q_leaf & p_leaf
        leaves.append((q[done], p[done]))
        rows_next = ~p_leaf & (q_leaf | (rows.radius[p] >= queries.radius[q]))
        queries_next = ~done & ~rows_next
        times, more = rows.children[p[rows_next]], queries.children[q[queries_next]]
        q, p = (
            np.concatenate([np.repeat(q[rows_next], times), _children(queries, q[queries_next])]),
            np.concatenate([_children(rows, p[rows_next]), np.repeat(p[queries_next], more)]),
        )
    q, p = (np.concatenate(x) for x in zip(*leaves))
    order = np.argsort(q, kind="stable")
    q, p = q[order], p[order]
    edges = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(q))):
        yield int(q[a]), p[a:b]


def _children(tree: Tree, nodes: np.ndarray) -> np.ndarray:
    times = tree.children[nodes]
    ends = np.cumsum(times)
    return np.arange(int(times.sum())) + np.repeat(tree.child[nodes] - (ends - times), times)


def search_tree(best: Best, rows: Tree, ids: np.ndarray, places: np.ndarray) -> None:
    """Adds the points of a tree that belong to the best of some query."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for leaf, others in descend(best.queries, rows, best.worst):
        a, b = best.queries.start[leaf], best.queries.end[leaf]
        columns = np.concatenate([np.arange(rows.start[o], rows.end[o]) for o in others])
        scores = products(best.queries.points[a:b], rows.points[columns])
        query, column = np.nonzero(scores >= best.least[a:b, None])
        found.append((query + a, columns[column], scores[query, column]))
    if found:
        query, point, score = (np.concatenate(x) for x in zip(*found))
        listed = [ids[places[i] : places[i + 1]].tolist() for i in point]
        best.add(query, score, ids[places[point]], listed)


def farthest_first(points: np.ndarray, count: int) -> np.ndarray:
    """Centres in the order in which each is the farthest from those before it; fewer if all points are covered."""
    chosen, away = [0], distances(points, points[0])
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points, points[chosen[-1]]))
    return points[chosen]


def unpack_keys(keys: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` of packed vectors, one pair for each length."""
    values = keys.to_pylist()
    sizes = np.array([len(v) for v in values], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        data = b"".join(values[i] for i in rows)
        yield rows, np.frombuffer(data, np.int32).astype(np.float64).reshape(len(rows), size // 4)


def packed_vectors(vectors: DataFrame, wanted: Column) -> DataFrame:
    """``(vec_id, wanted, key)`` of every usable row; the key is the vector's whole numbers as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, found in matrices(batch["embedding"]):
                keys = [v.tobytes() for v in whole(found, SCALE).astype(np.int32)]
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(taken), batch["wanted"].take(taken), pa.array(keys, pa.binary())], ["vec_id", "wanted", "key"]
                )

    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.coalesce(wanted, F.lit(False)).alias("wanted"), F.col("embedding").alias("embedding")
    )
    return rows.where("vec_id is not null").mapInArrow(pack, "vec_id bigint, wanted boolean, key binary")


def distinct_points(rows: DataFrame, m: int) -> DataFrame:
    """``(key, ids, wanted)``: each vector with its m smallest ids; copies are cut before they are shuffled."""
    place = F.row_number().over(Window.partitionBy("key", "wanted").orderBy("vec_id"))
    few = rows.withColumn("place", place).where(F.col("place") <= m)
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, m)
    return few.groupBy("key").agg(ids.alias("ids"), F.max("wanted").alias("wanted"))


def trees(points: DataFrame, centres: Matrices, size: int, leaf: int, sample: Matrices, m: int) -> DataFrame:
    """Points as rows of trees, with a summary: nearest centre, distance reached from it, root and its radius, and the
    least score that some point of the tree needs as a query, as far as the sample tells."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, centre = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for rows, found in unpack_keys(batch["key"]):
                net = centres.get(found.shape[1])
                length[rows] = found.shape[1]
                if net is not None:
                    centre[rows] = ((net**2).sum(axis=1) - 2 * (found @ net.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length), pa.array(centre)], [*batch.schema.names, "dim", "centre"])

    def build(table: pa.Table) -> pa.Table:
        dim, centre, part = (table[c][0].as_py() for c in ("dim", "centre", "part"))
        keys = table["key"].combine_chunks()
        _, found = next(unpack_keys(keys))
        tree = cover_tree(found, leaf)
        net = centres.get(dim)
        middle = net[centre] if net is not None else np.zeros(dim)
        reached = float(distances(found, middle).max())
        least = float(least_scores(found, sample.get(dim), m).min())
        root = found[tree.order[tree.centre[0]]]
        row = [
            f"{dim}-{centre}-{part}", centre, middle.astype(np.int32).tobytes(), reached, root.astype(np.int32).tobytes(),
            float(tree.radius[0]), least, *packed(tree, table["ids"].to_pylist()),
        ]
        return pa.Table.from_pylist([dict(zip(schema.names, row))], schema=schema)

    schema = pa.schema([
        ("tree", pa.string()), ("centre", pa.int32()), ("middle", pa.binary()), ("reached", pa.float64()), ("root", pa.binary()),
        ("root_radius", pa.float64()), ("least", pa.float64()), ("points", pa.binary()), ("dim", pa.int32()), ("nodes", pa.binary()),
        ("radius", pa.binary()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ])
    dealt = points.select("key", "ids").mapInArrow(near, "key binary, ids array<bigint>, dim int, centre int")
    sizes = dealt.groupBy("dim", "centre").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    sizes = stage(sizes, "topk-sizes")
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    dealt = dealt.join(sizes, ["dim", "centre"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    return dealt.groupBy("dim", "centre", "part").applyInArrow(
        build, f"tree string, centre int, middle binary, reached double, root binary, root_radius double, least double, {TREE}"
    )


def least_scores(queries: np.ndarray, sample: np.ndarray | None, m: int) -> np.ndarray:
    """The m-th best score of each query among the sample's points: a bound from below on its m-th best of all."""
    if sample is None or len(sample) < m:
        return np.full(len(queries), -np.inf)
    found = np.empty(len(queries))
    for at in range(0, len(queries), GROUP):
        scores = products(queries[at : at + GROUP], sample)
        found[at : at + GROUP] = np.partition(scores, len(sample) - m, axis=1)[:, len(sample) - m]
    return found


def reachable(pairs: DataFrame, root: str, radius: str) -> DataFrame:
    """Pairs ``(tree, root, root_radius, least)`` x ``(root, radius)`` whose bound is not below what the first one needs."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = np.zeros(batch.num_rows)
            r, s = (np.asarray(batch[c]) for c in (radius, "q_radius"))
            others = batch[root]
            for rows, q in unpack_keys(batch["q_root"]):
                _, p = next(unpack_keys(others.take(pa.array(rows))))
                p_norm, q_norm = (np.sqrt((x**2).sum(axis=1)) for x in (p, q))
                most[rows] = bounds(p, r[rows], p_norm, q, s[rows], q_norm)
            kept = pa.array(most >= np.asarray(batch["least"]))
            rows = pa.RecordBatch.from_arrays([*batch.columns, pa.array(most)], [*batch.schema.names, "bound"])
            yield rows.filter(kept)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return pairs.mapInArrow(keep, f"{schema}, bound double")


def search(rows: DataFrame, sample: Matrices, m: int) -> DataFrame:
    """``(key, score, ids)`` of the best points of each query point, for each block that its tree was searched in.

    ``rows`` has, for each query tree and block, the query tree (kind 0) and then the trees to search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: Best | None = None
        for batch in batches:
            for row in batch.to_pylist():
                tree, ids, places = unpacked(row)
                if row["kind"] == 0:
                    if best is not None:
                        yield found(best)
                    best = Best(tree, least_scores(tree.points, sample.get(tree.points.shape[1]), m), m)
                else:
                    search_tree(best, tree, ids, places)
        if best is not None:
            yield found(best)

    def found(best: Best) -> pa.RecordBatch:
        packed_points = [p.tobytes() for p in best.queries.points.astype(np.int32)]
        keys = pa.array([packed_points[i] for i in best.query], pa.binary())
        return pa.RecordBatch.from_arrays(
            [keys, pa.array(best.score), pa.array(best.ids, pa.list_(pa.int64()))], ["key", "score", "ids"]
        )

    return rows.mapInArrow(run, "key binary, score bigint, ids array<bigint>")


def nearest(points: DataFrame, m: int) -> DataFrame:
    """``(key, hits)``: the m best rows ``(less, id)`` of every wanted point among all, itself included; less = -score."""
    points = stage(points, "topk-points")
    counts = points.agg(F.count(F.lit(1)).alias("n"), F.count_if("wanted").alias("wanted")).first()
    drawn = points.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).toArrow()["key"].combine_chunks()
    sample: Matrices = {found.shape[1]: found for _, found in unpack_keys(drawn)}

    def net(n: int, size: int) -> Matrices:
        return {dim: farthest_first(found, min(CENTRES, -(-n // size))) for dim, found in sample.items()}

    columns = [c.split()[0] for c in TREE.split(", ")]
    row_trees = stage(trees(points, net(counts["n"], SHARD), SHARD, LEAF, {}, m), "topk-rows")
    query_trees = stage(trees(points.where("wanted"), net(counts["wanted"], GROUP), GROUP, QUERY_LEAF, sample, m), "topk-queries")

    asking = query_trees.select(
        F.col("tree").alias("q_tree"), "dim", "least", F.col("root").alias("q_root"), F.col("root_radius").alias("q_radius")
    )
    middles = row_trees.groupBy("dim", "centre").agg(F.first("middle").alias("middle"), F.max("reached").alias("reached"))
    middles = stage(middles, "topk-centres")
    if middles.count() <= BROADCAST_ROWS:
        middles = F.broadcast(middles)
    roots = row_trees.select("tree", "dim", "centre", "root", "root_radius")
    pairs = reachable(asking.join(middles, "dim"), "middle", "reached").drop("middle", "reached", "bound")
    pairs = reachable(pairs.join(roots, ["dim", "centre"]), "root", "root_radius").select("q_tree", "tree", "bound")
    blocks = max(1, -(-row_trees.count() // BLOCK))
    pairs = stage(pairs.withColumn("block", F.pmod(F.xxhash64("tree"), F.lit(blocks))), "topk-pairs")

    to_search = pairs.join(row_trees, "tree").select(
        "q_tree", "block", F.lit(1).alias("kind"), (-F.col("bound")).alias("turn"), *columns
    )
    searching = pairs.select("q_tree", "block").distinct().join(query_trees.withColumnRenamed("tree", "q_tree"), "q_tree").select(
        "q_tree", "block", F.lit(0).alias("kind"), F.lit(0.0).alias("turn"), *columns
    )
    together = searching.unionByName(to_search).repartition("q_tree", "block").sortWithinPartitions("q_tree", "block", "kind", "turn")
    hits = search(together, sample, m)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.col("ids")[0]))
    hits = hits.withColumn("place", place).where(F.col("place") <= m)
    rows = F.flatten(F.transform(
        F.collect_list(F.struct("score", "ids")),
        lambda hit: F.transform(hit["ids"], lambda i: F.struct((-hit["score"]).alias("less"), i.alias("id"))),
    ))
    return hits.groupBy("key").agg(F.slice(F.array_sort(rows), 1, m).alias("hits"))


def self_scores(best: DataFrame) -> DataFrame:
    """Adds the score of each point with itself."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros(batch.num_rows, np.int64)
            for rows, found in unpack_keys(batch["key"]):
                own[rows] = (found.astype(np.int64) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "own"])

    return best.mapInArrow(add, "key binary, hits array<struct<less: bigint, id: bigint>>, own bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each row of ``is_query``, see the module's text."""
    points = distinct_points(packed_vectors(vectors, is_query), k + 1)
    best = self_scores(nearest(points, k + 1))
    queries = packed_vectors(vectors.where(is_query), F.lit(True)).select(F.col("vec_id").alias("query_id"), "key")
    mine = F.array_position("hits", F.struct((-F.col("own")).alias("less"), F.col("query_id").alias("id")))
    others = queries.join(best, "key").withColumn("mine", mine)
    left = F.slice(F.filter("hits", lambda _, i: i + 1 != F.col("mine")), 1, k)
    ranked = others.select("query_id", F.posexplode(left).alias("place", "hit"))
    return ranked.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.less")).alias("score")
    )
