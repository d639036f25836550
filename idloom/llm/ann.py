"""Approximate nearest neighbours: a neighbour graph by NN-descent and greedy
search in it.

Vectors are scaled to length 1 and travel as four-byte floats. What is compared
is the cosine less 1, computed in double precision and kept as a four-byte
float, so that near-equal vectors are told apart by their small distances, where
the cosine itself would round to 1. All that a search ends with is measured
again in double precision on the original vectors. Equal vectors are one node: its
``results + 1`` smallest distinct ids, each with its number of rows up to
``results``, stand for all copies, as no result needs more.

* Start: in ``starts`` rounds, nodes are sorted by the signs of random
  projections and one projection, cut into blocks of fixed size, and each
  keeps its nearest within its block.
* NN-descent: each step joins, around every node, its neighbours and the nearest
  of those that have it as a neighbour, compares all pairs among them, and
  offers each pair to both ends; an end keeps its ``degree`` nearest. Only
  offers better than an end's worst neighbour travel. Steps end when few
  neighbours change, or after ``steps``.
* Search: a query starts from random nodes that all queries share and, where it
  is itself a node, from its own neighbours; the nearest ``beam`` nodes that
  were not expanded yet are expanded, until there are none.

All steps are joins over node tables with a bounded number of rows for each
node, cut by written tables.

Defined results: vectors that are null, of length zero, hold a null or a
component that is not finite, or have another number of components than most
take no part, as query or candidate; a null vec_id takes no part; rows with
one vec_id are separate candidates, so an id can be in a result more than once, and none of them is a result of its own
query; query rows with one vec_id and one vector ask once, with other vectors each for itself; with fewer than ``results`` candidates all are returned; no rows, no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """Equal-sized binary values as rows of a matrix."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, kind)[at[0] // kind().itemsize : at[-1] // kind().itemsize].reshape(-1, width)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), bad.alias("_bad"))
    ok = ok.where("vec_id is not null and vector is not null and not _bad").where(F.exists("vector", lambda x: x != 0)).drop("_bad")
    sizes = ok.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return ok.where(F.size("vector") == (sizes["n"] if sizes else 0))


class NeighbourIndex:
    def __init__(self, vectors: DataFrame, results: int = 5, degree: int = 32, beam: int = 160, steps: int = 6, starts: int = 3,
                 block: int = 256, entries: int = 16, seed: int = 7):
        self.results, self.degree, self.beam, self.block, self.entries, self.seed = results, degree, beam, block, entries, seed
        key = F.xxhash64("vector")
        # equal vectors by value; the row numbers are cut before the shuffle
        copies = vectors.groupBy("vector", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(results)).cast("int").alias("n"))
        copies = copies.withColumn("_at", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("_at") <= results + 1)
        copies = copies.groupBy("vector").agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))
        # a hash and the smallest id: unique where ids are, and the same in every run
        copies = copies.select(F.xxhash64(key, F.col("ids")[0]["vec_id"]).alias("node"), "ids", "vector")
        self.nodes = written(self._coded(copies), "vectors")
        first = self.nodes.select("code").first()
        self.width = len(first["code"]) // 4 if first else 0
        self.codes = self.nodes.select("node", "code")
        self.graph = written(self._descend(starts, steps), "neighbours") if self.width else None

    @staticmethod
    def _coded(copies: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                    x = x / np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    code = x.astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("node"), batch.column("ids"), batch.column("vector"), pa.array([r.tobytes() for r in code], pa.binary())],
                        ["node", "ids", "vector", "code"])

        return copies.mapInArrow(run, "node long, ids array<struct<vec_id:long,n:int>>, vector array<double>, code binary")

    def _nearest(self, offers: DataFrame) -> DataFrame:
        """(u, v, near): each node's ``degree`` nearest of (u, v, near)."""
        best = offers.groupBy("u", "v").agg(F.max("near").alias("near"))
        # ties fall by a hash of both ends: equally near nodes do not all keep the same neighbours
        place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("near"), F.xxhash64("u", "v"), "v"))
        return best.withColumn("_at", place).where(F.col("_at") <= self.degree).drop("_at")

    def _descend(self, starts: int, steps: int) -> DataFrame:
        graph = None
        for turn in range(starts):
            offers = self._blocks(turn)
            graph = written(self._nearest(offers if graph is None else graph.unionByName(offers)), "graph")
        for _ in range(steps):
            new = written(self._nearest(graph.unionByName(self._offers(graph))), "graph")
            total = new.count()
            kept = new.join(graph.select("u", "v"), ["u", "v"], "left_semi").count()
            graph = new
            if total - kept <= 0.02 * total:
                break
        return graph

    def _blocks(self, turn: int) -> DataFrame:
        """Offers within blocks of nodes that are near in random projections."""
        width, block, degree = self.width, self.block, self.degree
        planes = np.random.default_rng([self.seed, turn]).normal(size=(width, 9))

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    p = _unit(_matrix(batch.column("code"), np.float32, width)) @ planes
                    side = (p[:, :8] > 0) @ (1 << np.arange(8))
                    yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("code"), pa.array(side + 1 / (1 + np.exp(-p[:, 8])))], ["node", "code", "at"])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                while sum(b.num_rows for b in held) >= 2 * block:
                    table = pa.Table.from_batches(held).combine_chunks()
                    yield pairs(table.slice(0, block))
                    held = table.slice(block).to_batches()
            if sum(b.num_rows for b in held) > 1:
                yield pairs(pa.Table.from_batches(held).combine_chunks())

        def pairs(table: pa.Table) -> pa.RecordBatch:
            x = _unit(_matrix(table.column("code").combine_chunks(), np.float32, width))
            node = table.column("node").to_numpy()
            near = (x @ x.T - 1).astype(np.float32)
            np.fill_diagonal(near, -3)
            k = min(degree, len(node) - 1)
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(node, k)), pa.array(node[best].ravel()), pa.array(np.take_along_axis(near, best, 1).ravel())], ["u", "v", "near"])

        placed = self.codes.mapInArrow(project, "node long, code binary, at double")
        return placed.repartitionByRange("at").sortWithinPartitions("at", "node").select("node", "code").mapInArrow(compare, "u long, v long, near float")

    def _offers(self, graph: DataFrame) -> DataFrame:
        """Pairs around each node that are nearer than an end's worst neighbour."""
        width, degree = self.width, self.degree
        back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "near")
        place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("near"), F.xxhash64("u", "v"), "v"))
        back = back.withColumn("_at", place).where(F.col("_at") <= degree).drop("_at")
        around = graph.unionByName(back).select("u", "v").distinct()
        worst = graph.groupBy(F.col("u").alias("v")).agg(F.when(F.count(F.lit(1)) >= degree, F.min("near")).otherwise(F.lit(-3.0)).cast("float").alias("worst"))
        known = self.codes.withColumnRenamed("node", "v").join(worst, "v", "left").withColumn("worst", F.coalesce("worst", F.lit(-3.0).cast("float")))
        lists = around.join(known, "v").groupBy("u").agg(F.collect_list(F.struct("v", "worst", "code")).alias("near"))  # 2 * degree at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("near")
                ends = np.asarray(column.offsets)
                flat = column.values
                v, worst_ = flat.field("v").to_numpy(), flat.field("worst").to_numpy()
                x = _unit(_matrix(flat.field("code"), np.float32, width))
                us, vs, nears = [], [], []
                for a, b in zip(ends[:-1], ends[1:]):
                    near = (x[a:b] @ x[a:b].T - 1).astype(np.float32)
                    np.fill_diagonal(near, -3)
                    i, j = np.nonzero(near > worst_[a:b, None])
                    us.append(v[a:b][i])
                    vs.append(v[a:b][j])
                    nears.append(near[i, j])
                if us:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)), pa.array(np.concatenate(nears))], ["u", "v", "near"])

        return lists.mapInArrow(run, "u long, v long, near float")

    def search(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score) for ``queries(vec_id, vector)``."""
        empty = "query_id long, rank int, vec_id long, score double"
        spark = queries.sparkSession
        if not self.width:
            return spark.createDataFrame([], empty)
        asked = queries.select(F.struct("vec_id", F.lit(1).alias("n")).alias("id"), "vector").distinct()
        asked = written(self._coded(asked.select(F.xxhash64("vector").alias("node"), F.array("id").alias("ids"), "vector")), "queries")
        codes = asked.select(F.col("node").alias("q"), F.col("code").alias("asked")).dropDuplicates(["q"])
        mine = self.nodes.withColumn("q", F.xxhash64("vector")).join(codes.select("q"), "q", "left_semi").select("q", "node")
        entries = self.nodes.select("node").orderBy(F.xxhash64("node", F.lit(self.seed))).limit(self.entries)  # a few fixed nodes
        start = [r["node"] for r in entries.collect()]
        wanted = codes.select("q", F.explode(F.array(*[F.lit(n) for n in start])).alias("node")).unionByName(mine).distinct()
        best = spark.createDataFrame([], "q long, node long, near float, done boolean")
        visited: list[DataFrame] = []  # what was scored, never to be scored again
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("near"), "node"))
        while True:
            new = written(self._scored(wanted, codes), "scored")
            visited.append(new.select("q", "node"))
            best = best.unionByName(new).withColumn("_at", place).where(F.col("_at") <= self.beam).drop("_at")
            best = written(best, "beam")
            front = best.where("not done").select("q", "node")
            if not front.limit(1).count():
                break
            best = best.withColumn("done", F.lit(True))
            wanted = front.join(self.graph.select(F.col("u").alias("node"), "v"), "node").select("q", F.col("v").alias("node")).distinct()
            wanted = wanted.join(reduce(DataFrame.unionByName, visited), ["q", "node"], "left_anti")
        return self._measured(best.select("q", "node"), asked)

    def _scored(self, wanted: DataFrame, codes: DataFrame) -> DataFrame:
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    a = _unit(_matrix(batch.column("asked"), np.float32, width))
                    b = _unit(_matrix(batch.column("code"), np.float32, width))
                    near = (np.einsum("ij,ij->i", a, b) - 1).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(near), pa.array(np.zeros(len(near), bool))], ["q", "node", "near", "done"])

        rows = wanted.join(self.codes, "node").join(codes, "q").select("q", "node", "asked", "code")
        return rows.mapInArrow(run, "q long, node long, near float, done boolean")

    def _measured(self, found: DataFrame, asked: DataFrame) -> DataFrame:
        """The results by exact cosine: every id of the found nodes but the query's own."""
        rows = asked.select(F.col("node").alias("q"), F.col("ids")[0]["vec_id"].alias("query_id"), F.col("vector").alias("asked")).join(found, "q")
        rows = rows.join(self.nodes.select("node", "ids", "vector"), "node").select("q", "query_id", "asked", "vector", "ids")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    a = batch.column("asked").flatten().to_numpy().reshape(batch.num_rows, -1)
                    b = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
                    score = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("q", "query_id", "ids")), pa.array(score)], ["q", "query_id", "ids", "score"])

        exact = rows.mapInArrow(run, "q long, query_id long, ids array<struct<vec_id:long,n:int>>, score double")
        exact = exact.select("q", "query_id", F.inline("ids"), "score").where("vec_id <> query_id")
        exact = exact.withColumn("vec_id", F.explode(F.array_repeat("vec_id", F.col("n"))))
        rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
        return exact.withColumn("rank", rank).where(F.col("rank") <= self.results).select("query_id", "rank", "vec_id", "score")


def _unit(code: np.ndarray) -> np.ndarray:
    x = code.astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def nearest(rows: DataFrame, every: int = 50, results: int = 5, **options) -> DataFrame:
    """The ``results`` nearest rows of each row of ``rows(vec_id, embedding)``
    whose id is divisible by ``every``."""
    vectors = usable(rows)
    return NeighbourIndex(vectors, results, **options).search(vectors.where(F.col("vec_id") % every == 0))
