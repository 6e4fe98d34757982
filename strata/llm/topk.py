"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are range-partitioned by length and cut into buckets of similar
length, longest first. For a query with k-th best score t so far, a bucket of
longest vector b needs a cosine of at least t / (|q| |b|): above 1 the bucket is
skipped (length pruning); when that local threshold is high, the query's largest
coordinates rule out vectors first (coordinate pruning: for unit vectors the
cosine is at most q_f p_f + sqrt(1 - q_f**2) sqrt(1 - p_f**2)); what remains is
verified by full products. The k-th best scores among the longest candidates
(a fixed number of them) start the thresholds.

Queries are a stated set and meet all candidates block by block, each block
broadcast with a fixed size. A task returns at most k rows for a query.

Defined results: null vectors, vectors with null or non-finite components and null
ids take no part; vectors of different lengths are compared as if padded with
zeros; ties go to the smaller id; a query's own id is no candidate; candidate rows
that repeat an id each take part, a query id that repeats stands for its smallest
vector; fewer than k candidates are all returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare

BLOCK_VALUES = 1 << 20      # numbers in one broadcast block of queries
BUCKET = 2048               # vectors in a length bucket
SEEDS = 512                 # longest candidates, for the first thresholds
COORDINATES = 3             # of a query that coordinate pruning looks at
COORDINATE_FROM = 0.6       # local cosine threshold from which it pays
ROWS_A_TASK = 1 << 15
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    """The vector as array<double>, null unless every component is a finite number."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), values)


def _matrix(vectors: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        out[row, :len(vector)] = vector
    return out


class Best:
    """The k best (score, id) of every query of a block."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.row = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.id = np.zeros(0, np.int64)
        self.threshold = np.full(queries, -np.inf)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        ids = np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        first = np.searchsorted(row, np.arange(self.queries))
        rank = np.arange(len(row)) - first[row]
        last = rank == self.k - 1
        self.threshold[row[last]] = np.maximum(self.threshold[row[last]], score[last])
        keep = rank < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]


class QueryBlock:
    def __init__(self, ids: list[int], vectors: list[list[float]]):
        self.ids = np.array(ids, np.int64)
        self.width = max(map(len, vectors), default=0)
        self.vectors = _matrix(vectors, self.width)
        self.norms = np.sqrt((self.vectors ** 2).sum(1))
        unit = self.vectors / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1)[:, :COORDINATES]
        self.focus_value = np.take_along_axis(unit, self.focus, 1)

    def search(self, best: Best, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Offer one bucket to all queries; vectors have this block's width or more."""
        vectors_here = vectors[:, :self.width] if vectors.shape[1] >= self.width else np.pad(
            vectors, ((0, 0), (0, self.width - vectors.shape[1])))
        norms = np.sqrt((vectors ** 2).sum(1))
        longest = norms.max(initial=0)
        reach = self.norms * longest * (1 + _SLACK) + _SLACK
        live = np.flatnonzero(best.threshold <= reach)          # length pruning
        if not len(live) or not len(ids):
            return
        local = np.divide(best.threshold[live], reach[live])
        by_coordinate = local >= COORDINATE_FROM
        rows, scores, found = [], [], []

        def verify(queries: np.ndarray, candidates: np.ndarray | None) -> None:
            pool = vectors_here if candidates is None else vectors_here[candidates]
            names = ids if candidates is None else ids[candidates]
            product = self.vectors[queries] @ pool.T
            good = (product >= best.threshold[queries][:, None]) & (self.ids[queries][:, None] != names)
            q, c = np.nonzero(good)
            rows.append(queries[q])
            scores.append(product[q, c])
            found.append(names[c])

        plain = live[~by_coordinate]
        for at in range(0, len(plain), 512):
            verify(plain[at:at + 512], None)
        if by_coordinate.any():
            unit = (vectors_here / np.where(norms > 0, norms, 1)[:, None]).T.copy()
            rest = np.sqrt(np.maximum(0, 1 - unit ** 2))
            for q, least in zip(live[by_coordinate], local[by_coordinate]):
                # a candidate shorter than the bucket's longest needs an even larger cosine
                possible = np.ones(len(ids), bool)
                for f, value in zip(self.focus[q], self.focus_value[q]):
                    most = value * unit[f] + np.sqrt(max(0.0, 1 - value * value)) * rest[f]
                    possible &= most >= least - 1e-7
                candidates = np.flatnonzero(possible)
                if len(candidates):
                    verify(np.array([q]), candidates)
        if rows:
            best.add(np.concatenate(rows), np.concatenate(scores), np.concatenate(found))


def top_k(candidates: DataFrame, queries: DataFrame, *, id_col: str = "vec_id",
          vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank from 1, vec_id, score double) for every usable query."""
    spark = candidates.sparkSession
    prepare(spark)
    pick = lambda df: df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        usable(F.col(f"`{vector_col}`")).alias("v")).where("id is not null and v is not null")
    pool, asked = pick(candidates), pick(queries).groupBy("id").agg(F.min("v").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    size = asked.agg(F.sum(F.size("v")).alias("n")).first().n or 0
    blocks = -(-size // BLOCK_VALUES) or 1
    seeds = pool.orderBy(norm.desc(), "id").limit(SEEDS).collect()
    tasks = max(spark.sparkContext.defaultParallelism, -(-pool.count() // ROWS_A_TASK))
    ranged = pool.withColumn("n", norm).repartitionByRange(
        tasks, F.col("n").desc(), F.xxhash64("id")).sortWithinPartitions(F.col("n").desc()).select("id", "v")
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        mine = QueryBlock([r.id for r in rows], [r.v for r in rows])
        start = Best(len(rows), k)
        if seeds and rows:
            mine.search(start, np.array([r.id for r in seeds], np.int64),
                        _matrix([r.v for r in seeds], max(mine.width, *(len(r.v) for r in seeds))))
        shared = spark.sparkContext.broadcast((mine, start.threshold))

        def search(batches, shared=shared):
            block, threshold = shared.value
            best = Best(len(block.ids), k)
            best.threshold = threshold.copy()
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                lists = batch.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                values = lists.flatten().to_numpy(zero_copy_only=False)
                if len(sizes) and (sizes == sizes[0]).all():
                    matrix = values.reshape(len(sizes), sizes[0])
                else:
                    matrix = _matrix(lists.to_pylist(), int(sizes.max(initial=0)))
                for at in range(0, len(ids), BUCKET):
                    block.search(best, ids[at:at + BUCKET], matrix[at:at + BUCKET])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids[best.row], pa.int64()), pa.array(best.id, pa.int64()),
                 pa.array(best.score, pa.float64())], ["query_id", "vec_id", "score"])

        part = ranged.mapInArrow(search, "query_id long, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
