"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

Largest inner product becomes smallest distance by one more component: the root of the
largest squared norm of all vectors less the vector's own. A tree of k-means splits is
fitted on a bounded sample (`SAMPLE` vectors, the lowest hashes of their ids); every
vector is then indexed in its leaf.

A query walks the tree best bin first: a priority queue holds the nodes seen so far by
their distance to the query, the nearest is opened next, and leaves come out in the order
in which they are to be visited. How many leaves are visited is calibrated: for `CALIBRATION` queries
(the lowest hashes) the true neighbours are found by scanning all vectors, and the visits
widen until they hold the target share of them. A query goes on beyond that until its leaves surely hold
as many other vectors as it wants, by the counted ids of each leaf.

Neighbouring leaves are dealt together, some `BLOCK_ROWS` rows at a time, and a query goes
once to each such group with the leaves it visits there. Groups that hold more rows are dealt
in blocks, and their visitors in parts, so no task holds a whole leaf, however many vectors
or copies share it. Within a block, copies of a vector are scored once.

Cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without an id; copies and ties are ordered by id; the rows of an id that
repeats are candidates each for itself, and a query never finds a row of its own id; vectors of each
dimension have a tree of their own and are searched among themselves; an empty table gives an empty
result; only the two named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourseline.sources.storage import stage

SAMPLE = 20_000
CALIBRATION = 100
LEAF_ROWS = 128  # rows that a leaf is to hold, as far as the sample allows
LEAST_OF_SAMPLE = 8  # sampled vectors below which a node is not split
BRANCHES = 8
TARGET = 0.97
BLOCK_ROWS, BLOCK_QUERIES = 4096, 512
STEPS, SEED = 8, 11


@dataclass
class Tree:
    centres: np.ndarray  # of all nodes
    children: list[list[int]]  # none: a leaf
    top: float  # the largest squared norm
    group: np.ndarray | None = None  # of each leaf, by node

    def lifted(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.top - (v * v).sum(1)))
        return np.column_stack([v, rest])

    def leaf_of(self, v: np.ndarray) -> np.ndarray:
        """The leaf that the nearest child leads to, level by level."""
        v = self.lifted(v)
        at = np.zeros(len(v), dtype=np.int64)
        active = [0] if len(v) else []
        while active:
            nodes, active = active, []
            for node in nodes:
                kids = self.children[node]
                rows = np.flatnonzero(at == node)
                if kids and len(rows):
                    at[rows] = np.array(kids)[_nearest(v[rows], self.centres[kids])]
                    active += kids
        return at

    def visits(self, query: np.ndarray, most: int | None = None, least: int = 0, held: dict[int, int] | None = None) -> list[int]:
        """Leaves, best bin first: `most` of them, and further ones until they hold at least `least` by `held` (of each leaf)."""
        q = np.append(query, 0.0)
        queue, out, so_far = [(0.0, 0)], [], 0
        while queue and (most is None or len(out) < most or so_far < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(node)
                so_far += held.get(node, 0) if held else 0
                continue
            far = ((self.centres[kids] - q) ** 2).sum(1)
            for d, kid in zip(far.tolist(), kids):
                heapq.heappush(queue, (d, kid))
        return out


def _nearest(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * v @ centres.T, axis=1)


def grow(sample: np.ndarray, top: float, leaves: int) -> Tree:
    """Split the node with the most sampled vectors by k-means until there are enough leaves."""
    rng = np.random.default_rng(SEED)
    tree = Tree(np.empty((0, 0)), [[]], top)
    v = tree.lifted(sample)
    centres = [v.mean(0)]
    open_nodes = [(-len(v), 0, np.arange(len(v)))]
    n_leaves = 1
    while open_nodes and n_leaves < leaves:
        size, node, rows = heapq.heappop(open_nodes)
        own = np.unique(v[rows], axis=0)
        k = min(BRANCHES, len(own), leaves - n_leaves + 1)
        if -size < LEAST_OF_SAMPLE or k < 2:
            continue
        found = own[rng.choice(len(own), k, replace=False)]
        for _ in range(STEPS):
            part = _nearest(v[rows], found)
            found = np.array([v[rows[part == j]].mean(0) if (part == j).any() else found[j] for j in range(k)])
        part = _nearest(v[rows], found)
        kept = [j for j in range(k) if (part == j).any()]
        if len(kept) < 2:
            continue
        for j in kept:
            tree.children[node].append(len(centres))
            tree.children.append([])
            centres.append(found[j])
            some = rows[part == j]
            heapq.heappush(open_nodes, (-len(some), len(centres) - 1, some))
        n_leaves += len(kept) - 1
    tree.centres = np.array(centres)
    return tree


def gather(tree: Tree, sample: np.ndarray, rows: int) -> None:
    """Number the groups: leaves in the order of the tree, as many as are expected to hold a block's rows together."""
    share = np.bincount(tree.leaf_of(sample), minlength=len(tree.children)) * (rows / max(1, len(sample)))
    tree.group = np.zeros(len(tree.children), dtype=np.int64)
    stack, number, held = [0], 0, 0.0
    while stack:
        node = stack.pop()
        if tree.children[node]:
            stack += tree.children[node][::-1]
            continue
        if held and held + share[node] > BLOCK_ROWS:
            number, held = number + 1, 0.0
        tree.group[node] = number
        held += share[node]


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """`id` and `v` of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = table.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def _arrow_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each worked out in the same order of additions."""
    return np.einsum("qd,nd->qn", q, v, optimize=False)


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, leaves: np.ndarray | None = None, visited: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, id, score) of the k best for each query among these rows, copies scored once. With `leaves` (of the
    rows) and `visited` (for each query), among the rows of the visited leaves."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], np.ascontiguousarray(v[order])
    leaves = leaves if leaves is None else leaves[order]
    one, copy_of = np.unique(v, axis=0, return_inverse=True)
    copy_of = copy_of.reshape(-1)
    by_copy = np.argsort(copy_of, kind="stable")
    starts = np.searchsorted(copy_of[by_copy], np.arange(len(one) + 1))
    # k + 1 of the copies are enough, the smallest ids: one of them may be the query itself.
    some = np.concatenate([by_copy[a : min(b, a + k + 1)] for a, b in zip(starts[:-1], starts[1:])])
    scores = _scores(q, np.ascontiguousarray(one))
    rows, found, values = [], [], []
    for i in range(len(q)):
        s = scores[i, copy_of[some]]
        allowed = ids[some] != q_ids[i]
        if leaves is not None:
            allowed &= np.isin(leaves[some], visited[i])
        own = np.flatnonzero(allowed)
        if len(own) > 4 * k:
            limit = np.partition(s[own], len(own) - k)[len(own) - k]
            own = own[s[own] >= limit]
        own = own[np.lexsort((ids[some][own], -s[own]))[:k]]
        rows.append(np.full(len(own), i))
        found.append(ids[some][own])
        values.append(s[own])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(values)


def _top(rows: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)


def exact(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The true neighbours of a few queries (id, v: `CALIBRATION` at most) by a scan of all rows, with their leaves."""
    few = queries.collect()
    q_ids, q = np.array([r["id"] for r in few]), np.array([r["v"] for r in few])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaves = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            i, found, s = _best(q_ids, q, ids, _arrow_matrix(batch.column(2)), k)
            leaf = dict(zip(ids.tolist(), leaves.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[i]), pa.array(found), pa.array(s), pa.array([leaf[x] for x in found.tolist()], pa.int64())],
                names=["query_id", "vec_id", "score", "leaf"],
            )

    return _top(index.select("id", "leaf", "v").mapInArrow(run, "query_id long, vec_id long, score double, leaf long"), k)


def build(vectors: DataFrame, n: int) -> tuple[Tree, DataFrame]:
    """The tree, and the stored index of every one of the `n` vectors, which have one dimension: `id`, `leaf`, `v`."""
    top = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    sample = vectors.select("v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    taken = np.array([r["v"] for r in sample])
    tree = grow(taken, top, max(1, n // LEAF_ROWS))
    gather(tree, taken, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = tree.leaf_of(_arrow_matrix(batch.column(1))) if batch.num_rows else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(leaves, pa.int64()), batch.column(1)], names=["id", "leaf", "v"])

    placed = vectors.select(F.col("id").cast("bigint").alias("id"), "v").mapInArrow(run, "id long, leaf long, v array<double>")
    return tree, stage(placed, "placed")


def search(vectors: DataFrame, is_query: Column, k: int, target: float = TARGET) -> DataFrame:
    """For each row of `vectors` (id, v) with `is_query` (a condition on id): `query_id`, `rank`, `vec_id`, `score`,
    nearest first, ties to the smaller id."""
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sizes = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked"))
    sizes = sizes.where("asked > 0").orderBy("d").collect()  # a row for each dimension
    for r in sizes:
        found = _search(vectors.where(F.size("v") == r["d"]), r["n"], is_query, k, target)
        out = found if len(sizes) == 1 else out.unionByName(found)
    return out


def _search(vectors: DataFrame, n: int, is_query: Column, k: int, target: float) -> DataFrame:
    tree, index = build(vectors, n)
    # Of each leaf the ids but one, which may be the query's own.
    held = {r["leaf"]: r["n"] - 1 for r in index.groupBy("leaf").agg(F.count_distinct("id").alias("n")).collect()}  # one line per leaf
    queries = index.where(is_query).dropDuplicates(["id", "v"])
    visits = calibrated(tree, queries, index, k, target)

    group_of = tree.group
    leaf_groups = index.sparkSession.createDataFrame([(n, int(g)) for n, g in enumerate(group_of.tolist()) if not tree.children[n]], "leaf long, group long")
    rows = index.join(F.broadcast(leaf_groups), "leaf")  # one line per leaf, of which the sample bounds the number
    # How many blocks a group's rows make, and how many parts its queries.
    blocks = rows.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, groups, leaves = [], [], []
            for n, q in enumerate(_arrow_matrix(batch.column(1))):
                seen: dict[int, list[int]] = {}
                for leaf in tree.visits(q, visits, k, held):
                    seen.setdefault(int(group_of[leaf]), []).append(leaf)
                of += [n] * len(seen)
                groups += seen
                leaves += seen.values()
            taken = batch.take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(groups, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], names=["id", "v", "group", "leaves"])

    asked = stage(queries.select("id", "v").mapInArrow(walk, "id long, v array<double>, group long, leaves array<long>"), "visits")
    askers = asked.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"))
    both = blocks.join(askers, "group")
    # A group's queries meet each block of its rows, in parts: each side is sent once to every block of the other.
    left = asked.join(F.broadcast(both), "group").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    left = left.select("group", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "v", "leaves")
    right = rows.join(F.broadcast(both), "group").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    right = right.select("group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "id", "v", "leaf")

    def meet(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids = q["id"].to_numpy()
        i, found, s = _best(ids, np.stack(q["v"].to_numpy()), v["id"].to_numpy(), np.stack(v["v"].to_numpy()), k, v["leaf"].to_numpy(), q["leaves"].tolist())
        return pd.DataFrame({"query_id": ids[i], "vec_id": found, "score": s})

    keys = ["group", "part", "block"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    return _top(met, k).select("query_id", "rank", "vec_id", "score")


def calibrated(tree: Tree, queries: DataFrame, index: DataFrame, k: int, target: float) -> int:
    """How many leaves to visit, so that a few queries find the target share of their true neighbours."""
    few = queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).select("id", "v")
    truth: dict[int, list[int]] = {}
    for r in exact(few, index, k).collect():  # at most CALIBRATION * k rows
        truth.setdefault(r["query_id"], []).append(r["leaf"])
    places = []
    for r in few.collect():
        order = {leaf: n for n, leaf in enumerate(tree.visits(np.array(r["v"])))}
        places += [order[leaf] for leaf in truth.get(r["id"], [])]
    return int(np.quantile(places, target, method="higher")) + 1 if places else 1
