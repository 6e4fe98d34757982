"""Substring dedup: repeated token windows, found by Rabin-Karp hashes.

Every window of ``WINDOW`` consecutive words gets a rolling hash. A word is
removed when a window that covers it also starts in a document with a smaller id;
the removed windows of a document merge into maximal intervals.

Documents are dealt to shards by a hash of id and text. A shard sends each of
its different hashes once, with the smallest id that has it, to the hash's bucket
(one Spark group per bucket, one packed row per shard and bucket). The bucket
finds the smallest id over all shards and answers with one bit per hash it got:
some other shard has a smaller id. The shard compares its own ids itself, so a
window that a third of all documents hold costs one entry per shard. Texts are
shuffled once; both uses read the same exchange.

Shards and buckets hold ``UNIT_WORDS`` words or, once that is more, the square
root of 256 times all words: packed rows then keep about 256 hashes, and their
number grows in proportion to the corpus.

Hashes have 64 bits, so n different windows hold about n * n / 2**65 false
equalities (0.0005 in 135 million windows).

Defined results: null and empty texts have no words; a null id counts as larger
than any other; equal ids never remove each other's words; repeats inside one
document stay; texts of fewer words than a window stay as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, prepare

WINDOW = 13
UNIT_WORDS = 1_000_000
_BYTES_PER_WORD = 6
_BASE = np.uint64(0x9E3779B97F4A7C15)   # odd multiplier of the rolling hash
_NO_ID = np.iinfo(np.int64).max

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))),
    T.StructField("kept", T.StringType())])


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hash_of_word = _WordHashes()


def window_hashes(words: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of all documents: hash, first word (index into the words of
    all documents) and document."""
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(_hash_of_word.__getitem__, w)), np.uint64,
                       int(counts.sum()))
    n = max(0, len(flat) - window + 1)
    rolled = np.zeros(n, np.uint64)
    for offset in range(window):
        rolled *= _BASE
        rolled += flat[offset:offset + n]
    rolled ^= rolled >> np.uint64(29)      # spread the high bits, which choose the bucket
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    ends = np.cumsum(counts)
    inside = np.ones(n, bool)
    for document in np.flatnonzero(counts):    # windows that would cross into the next document
        inside[max(0, ends[document] - window + 1):ends[document]] = False
    start = np.flatnonzero(inside)
    return rolled[start], start, np.searchsorted(ends, start, "right")


class ShardWindows:
    """The windows of one shard's documents and its different hashes in order."""

    def __init__(self, texts: pa.Array, ids: pa.Array, window: int):
        self.words = [t.split() if t else [] for t in texts.cast(pa.binary()).to_pylist()]
        own = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        hashes, self.start, document = window_hashes(self.words, window)
        self.id_of_window = own[document]
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first = np.flatnonzero(new)
        self.hashes = hashes[first]
        self.least = (np.minimum.reduceat(self.id_of_window[order], first)
                      if len(first) else np.zeros(0, np.int64))
        self.entry = np.empty(len(order), np.int64)    # of each window, into hashes
        self.entry[order] = np.cumsum(new) - 1

    def bounds(self, buckets: int) -> np.ndarray:
        """Where each bucket's hashes begin; buckets are equal ranges of hash values."""
        edges = [min(-(-(b << 64) // buckets), (1 << 64) - 1) for b in range(buckets)]
        return np.append(np.searchsorted(self.hashes, np.array(edges, np.uint64)), len(self.hashes))


def pack(values: np.ndarray) -> bytes:
    """8-byte integers by byte plane, so that shuffle compression finds the zeros."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _layout(docs: DataFrame, text: str) -> tuple[int, int]:
    size = docs.agg(F.sum(F.octet_length(docs[text].cast("string")))).first()[0] or 0
    words = size / _BYTES_PER_WORD
    units = math.ceil(words / max(UNIT_WORDS, math.sqrt(256 * words))) or 1
    return units, units


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> tuple[DataFrame, str]:
    """``docs`` with one more struct column (its name is returned): n_words,
    n_removed, removed (maximal word intervals [s, e)), kept (words left, joined
    by one space). ``id_col`` must be an integer column."""
    spark = docs.sparkSession
    prepare(spark)
    shards, buckets = _layout(docs, text_col)
    shard, name = free_name("_shard", docs), free_name("_found", docs)
    dealt = docs.withColumn(
        shard, F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(shards)).cast("int")
    ).repartition(shards, shard)

    def windows_of(table: pa.Table) -> ShardWindows:
        column = lambda c, kind: table.column(c).cast(kind).combine_chunks()
        return ShardWindows(column(text_col, pa.string()), column(id_col, pa.int64()), window)

    def send(table: pa.Table) -> pa.Table:
        mine = windows_of(table)
        at = mine.bounds(buckets)
        full = np.flatnonzero(np.diff(at))
        part = [slice(at[b], at[b + 1]) for b in full]
        return pa.table({
            "bucket": pa.array(full, pa.int32()),
            "shard": pa.repeat(table.column(shard)[0], len(full)).cast(pa.int32()),
            "hashes": pa.array([pack(np.diff(mine.hashes[p], prepend=np.uint64(0))) for p in part], pa.binary()),
            "least": pa.array([pack(mine.least[p]) for p in part], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        hashes = [np.cumsum(unpack(h, np.uint64), dtype=np.uint64) for h in table.column("hashes").to_pylist()]
        least = np.concatenate([unpack(x, np.int64) for x in table.column("least").to_pylist()])
        sizes = [len(h) for h in hashes]
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        best = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        beaten = np.empty(len(flat), bool)
        beaten[order] = best < least[order]
        ends = np.cumsum([0, *sizes])
        flags = [beaten[a:b] for a, b in zip(ends, ends[1:])]
        some = [i for i, f in enumerate(flags) if f.any()]
        return pa.table({
            "shard": table.column("shard").take(pa.array(some, pa.int64())),
            "bucket": table.column("bucket").take(pa.array(some, pa.int64())),
            "flags": pa.array([np.packbits(flags[i]).tobytes() for i in some], pa.binary())})

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        mine = windows_of(table)
        at = mine.bounds(buckets)
        beaten = np.zeros(len(mine.hashes), bool)
        for bucket, flags in zip(answers.column("bucket").to_pylist(), answers.column("flags").to_pylist()):
            size = at[bucket + 1] - at[bucket]
            beaten[at[bucket]:at[bucket + 1]] = np.unpackbits(np.frombuffer(flags, np.uint8), count=size)
        gone = beaten[mine.entry] | (mine.id_of_window > mine.least[mine.entry])
        counts = np.array([len(w) for w in mine.words], np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)])
        change = np.zeros(ends[-1] + 1, np.int32)
        np.add.at(change, mine.start[gone], 1)
        np.add.at(change, mine.start[gone] + window, -1)
        covered = np.cumsum(change[:-1]) > 0
        kept, spans, removed = [], [], []
        for words, a, b in zip(mine.words, ends, ends[1:]):
            cover = covered[a:b]
            if not cover.any():
                kept.append(b" ".join(words))
                spans.append([])
                removed.append(0)
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cover, [0]]))).tolist()
            spans.append([{"s": s, "e": e} for s, e in zip(edge[::2], edge[1::2])])
            left = [w for s, e in zip([0, *edge[1::2]], [*edge[::2], len(words)]) for w in words[s:e]]
            kept.append(b" ".join(left))
            removed.append(len(words) - len(left))
        found = pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
             pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_words", "n_removed", "removed", "kept"])
        return table.drop_columns([shard]).append_column(name, found)

    sent = dealt.groupBy(shard).applyInArrow(send, "bucket int, shard int, hashes binary, least binary")
    answers = sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        answer, "shard int, bucket int, flags binary")
    out = T.StructType([*docs.schema.fields, T.StructField(name, FOUND)])
    return dealt.groupBy(shard).cogroup(answers.groupBy("shard")).applyInArrow(finish, out), name
