"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

1. Equal vectors become one entry with their ``k + 1`` least ids: no others of them can be among the
   k nearest of any query, so a vector that a third of all rows share costs one entry.
2. ``Tree`` is fitted on a sample of at most about ``fit_rows`` entries, chosen by a hash; every entry is
   filed under one of its leaves. The tree is what is broadcast: two centres a leaf at most, and
   at most ``fit_rows / 8`` leaves.
3. ``calibrated`` compares ``trials`` entries with all others by brute force and finds how many leaves
   the traversal must visit to meet ``recall`` of their true neighbours.
4. A query goes down to the nearest centre's leaf, keeps the centres it passed in a priority queue, and
   continues from the nearest of them, until that many leaves were visited and they hold k + 1
   entries. Queries meet the entries of a leaf in one task, an over-full leaf in several (by a salt), which
   hold at most about ``full`` entries and let queries stream by. Equal queries are searched once.

Defined results: vectors that are null, zero, hold nulls or non-finite components, have a null id or not
the commonest length take no part; equal rows count once; ties go to the smaller id; with fewer candidates all are
returned; empty tables give no rows; extra columns aren't read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumq.llm import shared


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fit = F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fit)
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.filter(F.size("v") == (size[0][0] if size else 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """vec_id, v: of equal vectors the k + 1 least ids. The limit also holds before the shuffle."""
    order = Window.partitionBy("v").orderBy("vec_id")
    return rows.dropDuplicates(["vec_id", "v"]).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1).drop("at")


class Tree:
    """Centres of all nodes, the children of each, and a number for each leaf."""

    def __init__(self, sample: np.ndarray, leaves: int, branches: int = 8, seed: int = 7):
        self.centre: list[np.ndarray] = [sample.mean(0) if len(sample) else np.zeros(1)]
        self.kids: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        small = max(8, -(-len(sample) // max(1, leaves)))
        random = np.random.default_rng(seed)
        todo = [(0, sample)]
        n = 0
        while todo:
            node, own = todo.pop()
            parts = self._split(own, min(branches, -(-len(own) // small)), random) if len(own) > small else []
            if len(parts) < 2:
                self.leaf[node] = n
                n += 1
                continue
            for centre, part in parts:
                self.kids[node].append(len(self.centre))
                todo.append((len(self.centre), part))
                self.centre.append(centre)
                self.kids.append([])
                self.leaf.append(-1)
        self.leaves = n
        self.below = [np.array([self.centre[i] for i in kids]) for kids in self.kids]

    @staticmethod
    def _split(own: np.ndarray, k: int, random: np.random.Generator, rounds: int = 12) -> list[tuple[np.ndarray, np.ndarray]]:
        centre = own[random.choice(len(own), max(2, k), replace=False)]
        for _ in range(rounds):
            near = Tree.nearest(own, centre)
            centre = np.array([own[near == i].mean(0) if (near == i).any() else own[random.integers(len(own))] for i in range(len(centre))])
        near = Tree.nearest(own, centre)
        return [(centre[i], own[near == i]) for i in range(len(centre)) if (near == i).any()]

    @staticmethod
    def nearest(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        return np.argmin((centre * centre).sum(1) - 2 * rows @ centre.T, axis=1)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre at each level."""
        out = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if not self.kids[node]:
                out[own] = self.leaf[node]
                continue
            near = self.nearest(rows[own], self.below[node])
            todo += [(kid, own[near == i]) for i, kid in enumerate(self.kids[node]) if (near == i).any()]
        return out

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.kids[node]:
                far = ((self.below[node] - query) ** 2).sum(1)
                best = int(far.argmin())
                for i, kid in enumerate(self.kids[node]):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), kid))
                node = self.kids[node][best]
            yield self.leaf[node]


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def top(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the k nearest rows, ties to the smaller id."""
    far = np.sqrt(((rows - query) ** 2).sum(1))
    if len(far) > 4 * k:
        edge = np.partition(far, k - 1)[k - 1]
        near = np.flatnonzero(far <= edge)
    else:
        near = np.arange(len(far))
    near = near[np.lexsort((ids[near], far[near]))[:k]]
    return ids[near], far[near]


class Index:
    """Every entry filed under a leaf of a tree, in a table in the shared folder."""

    def __init__(self, embeddings: DataFrame, k: int = 10, recall: float = 0.97, fit_rows: int = 20_000, leaf_rows: int = 256, full: int = 20_000, trials: int = 128):
        self.k, self.full, self.recall = k, full, recall
        spark = embeddings.sparkSession
        self.rows = usable(embeddings)
        held = shared.written(entries(self.rows, k), "entries")
        n = held.count()
        share = shared.within(F.xxhash64("v", F.lit(3)), fit_rows / max(1, n))
        sample = np.array([r[0] for r in held.filter(share).select("v", "vec_id").orderBy("vec_id").limit(2 * fit_rows).select("v").collect()])
        self.tree = Tree(sample, max(1, min(n // leaf_rows, fit_rows // 8)))
        sent = spark.sparkContext.broadcast(self.tree)

        def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = sent.value.assign(matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

        self.table = shared.written(held.mapInArrow(file, "vec_id bigint, v array<double>, leaf int"), "leaves")
        shared.remove(held)
        self.counts = dict(self.table.groupBy("leaf").count().collect())  # a row for each leaf
        self.visits = self.calibrated(trials) if n else 1

    def calibrated(self, trials: int) -> int:
        """Leaves to visit so that the trial entries meet the wanted share of their true neighbours."""
        k = self.k
        picked = self.table.filter(shared.within(F.xxhash64("vec_id", F.lit(5)), 4 * trials / max(1, sum(self.counts.values()))))
        picked = picked.orderBy(F.xxhash64("vec_id", F.lit(6)), "vec_id").limit(trials).collect()
        if not picked:
            return self.tree.leaves
        ids, queries = np.array([r.vec_id for r in picked]), np.array([r.v for r in picked])
        sent = self.table.sparkSession.sparkContext.broadcast((ids, queries))

        def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, want = sent.value
            for batch in batches:
                rows, names, leaf = matrix(batch.column("v")), batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
                out: list[tuple] = []
                for i, q in enumerate(want):
                    other = np.flatnonzero(names != own[i])
                    near, far = top(rows[other], other, q, k)
                    out += zip([i] * len(near), names[near].tolist(), far.tolist(), leaf[near].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [()] * 4, (pa.int32(), pa.int64(), pa.float64(), pa.int32()), strict=True)], names=["trial", "vec_id", "far", "leaf"])

        near = self.table.mapInArrow(best, "trial int, vec_id bigint, far double, leaf int")
        order = Window.partitionBy("trial").orderBy("far", "vec_id")
        truth = near.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).groupBy("trial").agg(F.collect_list("leaf")).collect()  # k rows for each trial
        needed = []
        for i, leaves in truth:
            rank = {leaf: n for n, leaf in enumerate(self.tree.visit(queries[i]), 1)}
            needed += [rank[x] for x in leaves]
        if not needed:
            return self.tree.leaves
        return int(np.sort(needed)[min(len(needed) - 1, int(np.ceil(self.recall * len(needed))))])

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score of the nearest entries of each query (vec_id, v); its own id is left out."""
        spark, k = queries.sparkSession, self.k
        sent = spark.sparkContext.broadcast((self.tree, self.counts, self.visits))
        full = self.full

        def leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, counts, visits = sent.value
            for batch in batches:
                out: tuple[list, ...] = ([], [], [])
                for i, q in enumerate(matrix(batch.column("v"))):
                    held = 0
                    for n, leaf in enumerate(tree.visit(q), 1):
                        own = counts.get(leaf, 0)
                        for salt in range(-(-own // full)):
                            for x, y in zip(out, (i, leaf, salt), strict=True):
                                x.append(y)
                        held += own
                        if n >= visits and held > k:
                            break
                rows = pa.array(out[0], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), batch.column("vec_id").take(rows), batch.column("v").take(rows)], names=["leaf", "salt", "vec_id", "v"])

        # equal queries are one; it is named by its least id
        order = Window.partitionBy("v").orderBy("vec_id")
        queries = queries.select("vec_id", "v").distinct()
        named = queries.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
        asked = named.mapInArrow(leaves, "leaf int, salt int, vec_id bigint, v array<double>").withColumn("asks", F.lit(1))
        salts = [(leaf, -(-n // full)) for leaf, n in self.counts.items()] or [(0, 1)]
        salted = self.table.join(F.broadcast(spark.createDataFrame(salts, "leaf int, salts int")), "leaf")  # a row for each leaf
        rows = salted.select("leaf", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt"), "vec_id", "v", F.lit(0).alias("asks"))

        def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, table = None, [], None
            nearest: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of each query that this task has met the best so far

            def out() -> pa.RecordBatch:
                rows = [(q, n, f) for q, (near, far) in nearest.items() for n, f in zip(near.tolist(), far.tolist(), strict=True)]
                nearest.clear()
                return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query", "vec_id", "score"])

            for batch in batches:
                v, ids, asks = matrix(batch.column("v")), batch.column("vec_id").to_numpy(), batch.column("asks").to_numpy()
                place = batch.column("leaf").to_numpy().astype(np.int64) << 32 | batch.column("salt").to_numpy()
                cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (asks[1:] != asks[:-1])))).tolist()
                for a, b in zip(cut, [*cut[1:], len(ids)], strict=True):
                    if place[a] != now:
                        now, held, table = place[a], [], None
                    if not asks[a]:
                        held.append((v[a:b], ids[a:b]))
                        continue
                    if table is None:
                        table = tuple(np.concatenate(x) for x in zip(*held, strict=True)) if held else (v[:0], ids[:0])
                    for i in range(a, b):
                        near, far = top(table[0], table[1], v[i], k + 1)
                        if (was := nearest.get(int(ids[i]))) is not None:
                            near, far = np.concatenate((was[0], near)), np.concatenate((was[1], far))
                            best = np.lexsort((near, far))[: k + 1]
                            near, far = near[best], far[best]
                        nearest[int(ids[i])] = near, far
                if len(nearest) > 50_000:
                    yield out()
            yield out()

        met = rows.unionByName(asked).repartition("leaf", "salt").sortWithinPartitions("leaf", "salt", "asks").mapInArrow(meet, "query bigint, vec_id bigint, score double")
        best = met.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).filter(F.col("at") <= k + 1).drop("at")
        asking = queries.withColumn("query", F.first("vec_id").over(order)).select(F.col("vec_id").alias("query_id"), "query")
        found = asking.join(best, "query").filter("query_id <> vec_id")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def op9_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each vector whose id is divisible by 100."""
    index = Index(shared.table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.filter(F.col("vec_id") % 100 == 0))
