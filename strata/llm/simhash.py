"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has one bit per hash bit of the text's shingles, set where more than
half of them have it. Each of the 64 positions gets a non-zero vector of r + 1
bits; each of the 2**(r+1) - 1 non-zero vectors v of that length gives a mask with
the positions whose vector has an odd inner product with v. The vectors of any r
positions leave some v orthogonal to all of them, so two fingerprints at distance
r or less agree on the mask of that v: every such pair meets in some table.

Equal fingerprints are one node. Within a bucket, a search from node to node over
what is not reached yet finds the linked groups and returns a spanning forest,
never all pairs; a bucket of more than ``BLOCK`` fingerprints is split into pairs of
blocks, which together hold every pair. Components are found over the links.

Defined results: null, empty and blank texts have fingerprint zero and link like
any other; fewer words than a shingle make one shingle; repeated rows share a
component; a component of null ids only has a null id.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, arrow_column, free_name, prepare, small, stored
from strata.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
BLOCK = 4096
_STEP = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, as signed integers."""
    size = (1 << radius + 1) - 1
    vectors = [1 + i % size for i in range(bits)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1)
             for v in range(1, size + 1)]
    return [m - (1 << bits) if m >> bits - 1 else m for m in masks]


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    words = raw.translate(_LOWER).split()
    if not words:
        return 0
    text = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, count, _STEP):
        hashes = [digest(text[ends[i - 1] if i else 0:ends[min(i + shingle, len(words)) - 1] - 1], SEED)
                  for i in range(at, min(at + _STEP, count))]
        planes = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little")
        set_bits += planes.sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * set_bits > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) if t else 0
                         for t in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return arrow_column(run, "bigint")(text.cast("string"))


def _forest(members: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is linked among the members, each node reached once."""
    links, rest = [], members
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                links.append((np.full(len(reached), node), reached))
                queue.extend(reached)
    return links


def _bucket_links(batches, radius: int):
    """Rows (unit, f) sorted by unit, as batches; yields links (a, b)."""
    def flush(units, prints):
        edge = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1], [True]]))
        sizes = np.diff(edge)
        two = edge[:-1][sizes == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= radius
        links = [(a[near], b[near])]
        for at, size in zip(edge[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            links += _forest(np.unique(prints[at:at + size]), radius)
        a = np.concatenate([x for x, _ in links]).view(np.int64)
        b = np.concatenate([x for _, x in links]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held_units, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        units = np.concatenate([held_units, batch.column(0).to_numpy(zero_copy_only=False)])
        prints = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(units):
            continue
        last = int(np.flatnonzero(units != units[-1])[-1]) + 1 if units[0] != units[-1] else 0
        held_units, held = units[last:], prints[last:]     # the last unit may go on
        if last:
            yield flush(units[:last], prints[:last])
    if len(held):
        yield flush(held_units, held)


def links(prints: DataFrame, *, radius: int = RADIUS, block: int = BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """Links (a, b) that connect the different fingerprints of column f exactly as
    all pairs within the radius do. A bucket of two is told by its least and greatest
    fingerprint; only members of larger ones are looked up."""
    keep = scratch.store if scratch else stored
    masks = covering_masks(radius)
    rows = prints.select("f", F.posexplode(F.array(
        *[F.col("f").bitwiseAND(F.lit(m).cast("bigint")) for m in masks])).alias("t", "key"))
    shared = keep(rows.groupBy("t", "key").agg(
        F.count("*").alias("n"), F.min("f").alias("a"), F.max("f").alias("b")).where("n > 1"), "simhash-buckets")
    two = shared.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    large = keep(shared.where("n > 2").select("t", "key", "n"), "simhash-large-buckets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("f"), blocks).cast("int")
    unit = rows.join(small(large), ["t", "key"]).withColumn("blocks", blocks).withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("t", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "f")
    found = unit.repartition("unit").sortWithinPartitions("unit").mapInArrow(
        lambda batches: _bucket_links(batches, radius), "a long, b long")
    return two.unionByName(found).distinct()


def _rooted(marked: DataFrame, *, radius: int, block: int) -> DataFrame:
    """f, root (the same for all fingerprints of a component) and component (its smallest
    id) for rows with id and f."""
    nodes = marked.groupBy("f").agg(F.min("id").alias("least"))
    with Scratch(marked.sparkSession) as scratch:
        group = components(links(nodes.select("f"), radius=radius, block=block, scratch=scratch))
    root = nodes.join(group, nodes.f == group.node, "left").select(
        "f", "least", F.coalesce("component", "f").alias("root"))
    named = root.groupBy("root").agg(F.min("least").alias("component"))
    return root.join(named, "root").select("f", "root", "component")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, f (signed fingerprint), component (smallest id that
    can be reached). Fingerprints are computed once and kept in the checkpoint folder."""
    prepare(docs.sparkSession)
    marked = docs.select(docs[id_col].alias("id"),
                         fingerprint_column(docs[text_col], shingle).alias("f")).checkpoint()
    return marked.join(_rooted(marked, radius=radius, block=block), "f").select("id", "f", "component")


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two hashes that tell rows of different id or text apart; nulls count as values."""
    parts = [p for c in (docs[id_col], docs[text_col]) for p in (c.isNull(), c)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(SEED), *parts)]


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null ids
    last), of those the one whose id and text hash least; columns unchanged. Rows that
    are alike in id and text are one document.

    Texts stay where they are: the keys of the rows to drop travel to them while they
    are counted to be few (beyond that, both are shuffled). Only rows that repeat id and text move."""
    prepare(docs.sparkSession)
    k1, k2, kind = free_name("_key", docs), free_name("_key2", docs), free_name("_kind", docs)
    key = _row_key(docs, id_col, text_col)
    marked = docs.select(docs[id_col].alias("id"), key[0].alias("k1"), key[1].alias("k2"),
                         fingerprint_column(docs[text_col], shingle).alias("f")).checkpoint()
    named = marked.groupBy("k1", "k2", "f", "id").agg(F.count("*").alias("n")).join(
        _rooted(marked, radius=radius, block=block).select("f", "root"), "f")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2"))
    chosen = named.groupBy("root").agg(first.alias("first"))
    # 0: a row to drop, 1: one of several that are alike
    stays = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    moved = named.join(chosen, "root").select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.when(
        ~stays, 0).when(F.col("n") > 1, 1).alias(kind)).where(F.col(f"`{kind}`").isNotNull())
    moved = stored(moved, "simhash-moved")
    told = docs.withColumns({k1: key[0], k2: key[1]}).join(small(moved), [k1, k2], "left")
    kept = told.where(F.col(f"`{kind}`").isNull())
    if not moved.where(F.col(f"`{kind}`") == 1).isEmpty():
        kept = kept.unionByName(told.where(F.col(f"`{kind}`") == 1).dropDuplicates([k1, k2]))
    return kept.drop(k1, k2, kind)
