"""Vector code compression: product quantisation in integers, searched by GNAT.

Vectors are scaled to integers and cut into ``PARTS`` equal parts; each part position has a
codebook of ``ENTRIES`` entries, started from the vectors of the smallest ids and refined by
``ROUNDS`` rounds of assignment and componentwise floor of the mean.

The nearest entry is found in a geometric near-neighbour access tree over the entries:

- Up to ``SPLITS`` split points, far from each other, divide a node's entries by the
  nearest split point. For every split point and child the node stores the range of
  distances from the split point to the child's entries.
- A query measures its distance d to a split point. A child whose whole range lies further
  from d than the best distance so far cannot hold a nearer entry (triangle inequality)
  and is left out; one that could tie is not.
- Distances are rounded outwards before they rule anything out. Squared distances of
  integers decide, ties go to the lower index.

All queries of a batch walk the tree together, node by node. Codebooks (entries x length of
a vector) are the only thing sent to all tasks; sums and counts come back once per task and
entry, so no vector is shuffled.

Defined results: rows whose vector is null, or has null or non-finite components or any beyond
``LIMIT`` after scaling, take no part; shorter vectors are padded with zeros to the longest,
whose length is rounded up to a multiple of ``PARTS``; null ids come last, rows with equal ids
stand by vector; fewer rows than entries give smaller codebooks; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, prepare, small, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SPLITS = 8
LIMIT = 1 << 24             # of a scaled component: squared distances stay within 64 bits
BATCH = 4096
_SLACK = 1e-9               # far above the rounding of a square root, relative


@dataclass
class Node:
    splits: np.ndarray              # indexes of entries
    children: list                  # per split point: Node or None
    low: np.ndarray                 # split x child: distances to the child's entries,
    high: np.ndarray                # its split point included, rounded outwards


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances (rows of a) x (rows of b), exact."""
    apart = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", apart, apart)


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node | None:
    """Tree over the entries (integers, one per row) listed in ``members``."""
    members = np.arange(len(entries)) if members is None else members
    if not len(members):
        return None
    chosen = [0]
    nearest = _distances(entries[members], entries[members[:1]])[:, 0]
    while len(chosen) < min(SPLITS, len(members)):
        nearest[chosen] = -1
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(entries[members], entries[members[chosen[-1:]]])[:, 0])
    to_split = _distances(entries[members], entries[members[chosen]])
    owner = to_split.argmin(1)
    owner[chosen] = np.arange(len(chosen))
    root = np.sqrt(to_split)
    own = owner[:, None] == np.arange(len(chosen))
    low = np.stack([root[own[:, j]].min(0) for j in range(len(chosen))], 1) * (1 - _SLACK)
    high = np.stack([root[own[:, j]].max(0) for j in range(len(chosen))], 1) * (1 + _SLACK)
    rest = np.ones(len(members), bool)
    rest[chosen] = False
    children = [build(entries, members[own[:, j] & rest]) for j in range(len(chosen))]
    return Node(members[chosen], children, low, high)


class Nearest:
    """Nearest entry (lowest index of equals) of every query, with its squared distance."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.tree = entries, build(entries)
        self.measured = 0

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.zeros(len(queries), np.int64)
        stack = [(self.tree, np.arange(len(queries)))] if self.tree else []
        while stack:
            node, asked = stack.pop()
            alive = np.ones((len(asked), len(node.splits)), bool)
            for i, entry in enumerate(node.splits.tolist()):
                at = np.flatnonzero(alive[:, i])
                if not len(at):
                    continue
                rows = asked[at]
                apart = queries[rows] - self.entries[entry]
                square = np.einsum("ij,ij->i", apart, apart)
                self.measured += len(rows)
                nearer = (square < best[rows]) | ((square == best[rows]) & (entry < index[rows]))
                best[rows[nearer]], index[rows[nearer]] = square[nearer], entry
                d, reach = np.sqrt(square), np.sqrt(best[rows]) * (1 + _SLACK)
                short, long = (d * (1 - _SLACK))[:, None], (d * (1 + _SLACK))[:, None]
                out = (short - node.high[i] > reach[:, None]) | (node.low[i] - long > reach[:, None])
                out[:, i] &= node.children[i] is not None      # its split point is measured
                alive[at] &= ~out
            for j, child in enumerate(node.children):
                if child is not None and alive[:, j].any():
                    stack.append((child, asked[alive[:, j]]))
        return index, best


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of the components, null unless the vector can take part."""
    values = F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale)).cast("double")))
    plain = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < LIMIT / scale))
    return F.when(F.coalesce(plain, F.lit(False)), values)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


@dataclass
class Codebooks:
    """Entries of every part position: parts x entries x length of a part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def searchers(self) -> list[Nearest]:
        """One per part, built once in a process."""
        held = self.__dict__.get("_searchers")
        if held is None:
            held = self.__dict__["_searchers"] = [Nearest(e) for e in self.entries]
        return held

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _assigned(searchers: list[Nearest], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and squared distances, rows x parts."""
    cut = rows.reshape(len(rows), len(searchers), -1)
    index, square = np.empty(cut.shape[:2], np.int64), np.empty(cut.shape[:2], np.int64)
    for part, nearest in enumerate(searchers):
        index[:, part], square[:, part] = nearest.search(np.ascontiguousarray(cut[:, part]))
    return index, square


def _refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the floor of the mean of the parts assigned to them."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    parts, entries, length = books.entries.shape

    def sums(batches):
        mine = shared.value
        searchers = mine.searchers()
        total = np.zeros((parts * entries, length + 1), np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), mine.width)
            for at in range(0, len(rows), BATCH):
                some = rows[at:at + BATCH]
                index, _ = _assigned(searchers, some)
                cell = (index + np.arange(parts) * entries).ravel()
                order = np.argsort(cell, kind="stable")
                ends = np.flatnonzero(np.diff(cell[order], prepend=-1))
                held = np.concatenate([some.reshape(-1, length), np.ones((len(cell), 1), np.int64)], 1)[order]
                if len(ends):
                    total[cell[order][ends]] += np.add.reduceat(held, ends, axis=0)
        used = np.flatnonzero(total[:, -1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used].tolist(), pa.list_(pa.int64()))], ["cell", "total"])

    told = vectors.select("v").mapInArrow(sums, "cell long, total array<bigint>").select(
        "cell", F.posexplode("total").alias("at", "x")).groupBy("cell", "at").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    # at most parts x entries rows, each of a part's length
    held: dict[int, dict[int, int]] = {}
    for row in told.collect():
        held.setdefault(row.cell, {})[row.at] = int(row.x)
    flat = books.entries.reshape(parts * entries, length).copy()
    for cell, x in held.items():
        flat[cell] = [x[i] // x[length] for i in range(length)]
    return Codebooks(flat.reshape(parts, entries, length))


def train(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the integer vectors in columns id and v; None without any."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    length = max(1, -(-longest // parts))
    rows = np.zeros((len(first), parts * length), np.int64)
    for row, r in zip(rows, first):
        row[:len(r.v)] = r.v
    books = Codebooks(rows.reshape(len(first), parts, length).transpose(1, 0, 2).copy())
    for _ in range(rounds):
        books = _refined(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors`` (v and any other columns) without v, with code (array of entry indexes)
    and error (sum of squared distances)."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(books)
    coded = free_name("_coded", vectors)

    def run(v: pa.Array) -> pa.Array:
        index, square = _assigned(shared.value.searchers(), _matrix(v, shared.value.width))
        codes = pa.ListArray.from_arrays(
            pa.array(np.arange(0, index.size + 1, index.shape[1]), pa.int32()), pa.array(index.ravel(), pa.int32()))
        return pa.StructArray.from_arrays([codes, pa.array(square.sum(1), pa.int64())], ["code", "error"])

    run.__annotations__ = {"v": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(run, returnType="code array<int>, error bigint")
    return vectors.withColumn(coded, udf(F.col("v"))).select(
        *[f"`{c}`" for c in vectors.columns if c != "v"], F.col(f"`{coded}`.code"), F.col(f"`{coded}`.error"))


def compress(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
             ) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error, label_error) of every vector that takes part, stored, and the
    codebooks. label_error is the error summed over the rows of the label, nulls together."""
    spark = table.sparkSession
    prepare(spark)
    vectors = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                           integers(F.col(f"`{vector_col}`"), scale).alias("v")).where("v is not null")
    books = train(vectors, parts=parts, entries=entries, rounds=rounds)
    if books is None:
        return vectors.select("id", "label", F.array().cast("array<int>").alias("code"),
                              F.lit(0).cast("bigint").alias("error"),
                              F.lit(0).cast("bigint").alias("label_error")).where("false"), None
    coded = stored(encode(vectors, books), "vector-codes")
    of_label = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    label = of_label.select(F.col("label").alias("of"), "label_error")
    return coded.join(small(label), F.col("label").eqNullSafe(F.col("of"))).drop("of"), books
