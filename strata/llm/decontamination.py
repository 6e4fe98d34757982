"""Benchmark decontamination with suffix arrays over the training text.

Every batch of documents a task reads is a shard. A shard's words become
integer codes of the benchmark vocabulary (a word no benchmark item uses is
code 0, which no test suffix can match), the shard gets a suffix array, and all
test suffixes are binary-searched in it at once. The result of a search is the
longest verbatim match of the suffix and the block of array entries that share
its first window, i.e. all locations of that window in the shard.

The benchmark is read in blocks of bounded size; each block is one more pass of
the same narrow map over the documents, so nothing is shuffled however large
the benchmark is.

Defined results: a null or empty text has no words and is never contaminated;
an empty benchmark hits nothing; items without words are skipped; repeated items
with one id count once; repeated document rows each get their own result; a null
item id is reported as an empty string.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, free_name, prepare, text_of

WINDOW = 13
ITEM_BLOCK_BYTES = 8 << 20

# A-Z to a-z, every other ASCII character that is not a digit or a letter to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))

REPORT = "struct<n_words:bigint,hits:array<struct<s:int,e:int>>,items:array<string>>"
_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_ITEMS = pa.list_(pa.string())


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` sorted by the ``depth`` codes that start there
    (prefix doubling; past the end counts as 0)."""
    n = len(codes)
    rank = codes.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    span = 1
    while span < depth and n:
        ahead = np.zeros(n, np.int64)
        ahead[:-span or None] = rank[span:]
        key = rank * (int(rank.max()) + 1) + ahead
        order = np.argsort(key, kind="stable")
        step = np.empty(n, np.int64)
        step[0] = 1
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n:
            break
        span *= 2
    return order


@dataclass
class TestSuffixes:
    """The suffixes of one block of benchmark items, as codes of its vocabulary."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray    # items one after the other, each followed by a 0
    start: np.ndarray    # of every suffix that holds a whole window
    length: np.ndarray   # words up to the end of the item
    window: np.ndarray   # WINDOW, or the item's length when it is shorter
    item: np.ndarray     # index into ids
    ids: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str | None]], window: int) -> TestSuffixes:
        vocabulary: dict[bytes, int] = {}
        codes, start, length, widths, item, ids = [], [], [], [], [], []
        at, number = 0, {}
        for name, text in rows:
            words = words_of(text)
            if not words:
                continue
            index = number.setdefault(name or "", len(number))
            width = min(window, len(words))
            count = len(words) - width + 1
            start.append(np.arange(at, at + count))
            length.append(len(words) - np.arange(count))
            widths.append(np.full(count, width))
            item.append(np.full(count, index))
            codes += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words] + [0]
            at += len(words) + 1
        ids = list(number)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return cls(vocabulary, np.array(codes, np.int32), join(start), join(length),
                   join(widths), join(item), ids)


def _common(shard: np.ndarray, at: np.ndarray, test: np.ndarray, start: np.ndarray,
            limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of shard[at:] and test[start:], up to ``limit``."""
    same = np.zeros(len(at), np.int64)
    live = np.flatnonzero((at < len(shard)) & (limit > 0))
    while len(live):
        equal = shard[at[live] + same[live]] == test[start[live] + same[live]]
        live = live[equal]
        same[live] += 1
        live = live[(same[live] < limit[live]) & (at[live] + same[live] < len(shard))]
    return same


def _bound(shard, order, test, start, limit, after: bool) -> np.ndarray:
    """Binary search of every test[start:start+limit] in the suffix array: the
    first entry not below it, or (``after``) the first whose prefix is above it."""
    low = np.zeros(len(start), np.int64)
    high = np.full(len(start), len(order), np.int64)
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) // 2
        at = order[middle]
        same = _common(shard, at, test, start[live], limit[live])
        full = same >= limit[live]
        mine = np.zeros(len(live), np.int64)
        inside = at + same < len(shard)
        mine[inside] = shard[(at + same)[inside]]
        theirs = test[np.minimum(start[live] + same, len(test) - 1)]
        below = np.where(full, after, mine < theirs)
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


class Shard:
    """The documents of one batch: word codes, document bounds, suffix array."""

    def __init__(self, texts: list[str | None], tests: TestSuffixes):
        get = tests.vocabulary.get
        counts, parts = [], []
        for text in texts:
            words = words_of(text)
            counts.append(len(words))
            parts.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))   # no match crosses documents
        self.counts = np.array(counts, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts + 1)])
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        # Keep the runs of benchmark words that can hold the shortest window.
        known = np.concatenate([[0], (codes > 0).astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(known))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= (tests.window.min() if len(tests.window) else 1)
        begin, end = begin[long], end[long]
        keep = np.zeros(len(codes) + 1, np.int64)
        np.add.at(keep, begin, 1)
        np.add.at(keep, np.minimum(end + 1, len(codes)), -1)   # with the 0 that ends a run
        self.place = np.flatnonzero(np.cumsum(keep)[:-1])      # shard word of a kept code
        self.codes = codes[self.place]
        depth = int(tests.length.max()) if len(tests.length) else 1
        order = suffix_array(self.codes, depth)
        self.order = order[self.codes[order] > 0]
        self.n_words = len(codes)

    def search(self, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) array entry that shares each suffix's window."""
        args = self.codes, self.order, tests.codes, tests.start, tests.window
        return _bound(*args, False), _bound(*args, True)

    def longest(self, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
        """Longest match of each test suffix and one kept position that holds it."""
        if not len(self.order):
            none = np.zeros(len(tests.start), np.int64)
            return none, none
        at = _bound(self.codes, self.order, tests.codes, tests.start, tests.length, False)
        best = np.zeros(len(at), np.int64)
        place = np.zeros(len(at), np.int64)
        for near in (at - 1, at):
            inside = (near >= 0) & (near < len(self.order))
            position = self.order[np.clip(near, 0, len(self.order) - 1)]
            same = np.where(inside, _common(self.codes, position, tests.codes, tests.start,
                                            tests.length), 0)
            better = same > best
            best[better], place[better] = same[better], position[better]
        return best, place

    def document(self, kept: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, self.place[kept], "right") - 1


def _report(texts: list[str | None], tests: TestSuffixes) -> pa.Array:
    shard = Shard(texts, tests)
    low, high = shard.search(tests)
    found = np.flatnonzero(high > low)
    # A window that several suffixes share is one block of entries: mark it once.
    block, which = np.unique(np.stack([low[found], high[found], tests.window[found]]),
                             axis=1, return_inverse=True)
    which = which.reshape(-1)
    sizes = block[1] - block[0] if len(found) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    entry = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = shard.order[block[0][owner] + entry] if len(owner) else np.zeros(0, np.int64)
    width = block[2][owner] if len(owner) else kept
    place = shard.place[kept] if len(kept) else kept
    change = np.zeros(shard.n_words + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + width, -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change) > 0, [0]])))
    begin, end = edge[::2], edge[1::2]
    holder = np.searchsorted(shard.first, begin, "right") - 1
    spans = np.bincount(holder, minlength=len(texts))[:len(texts)]
    hits = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(spans)]), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(begin - shard.first[holder], pa.int32()),
             pa.array(end - shard.first[holder], pa.int32())], ["s", "e"]))
    # documents x windows, then x the items that hold the window, each pair once
    pairs = np.unique(shard.document(kept) * max(1, len(sizes)) + owner) if len(kept) else kept
    by_block = np.unique(np.stack([which, tests.item[found]]), axis=1)
    first = np.searchsorted(by_block[0], np.arange(len(sizes) + 1))
    document, window = np.divmod(pairs, max(1, len(sizes)))
    times = first[window + 1] - first[window] if len(pairs) else pairs
    row = np.repeat(document, times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    item = by_block[1][np.repeat(first[window], times) + nth] if len(row) else row
    pairs = np.unique(row * max(1, len(tests.ids)) + item)
    document, item = np.divmod(pairs, max(1, len(tests.ids)))
    per = np.bincount(document, minlength=len(texts))[:len(texts)]
    items = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()),
        pa.array([tests.ids[i] for i in item], pa.string()))
    return pa.StructArray.from_arrays(
        [pa.array(shard.counts, pa.int64()), hits, items], ["n_words", "hits", "items"])


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int,
                block_bytes: int = ITEM_BLOCK_BYTES):
    """The benchmark as blocks of about ``block_bytes``, one at a time on the driver."""
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"),
                             text_of(benchmark, text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    turn = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.where(turn == block).collect()
        yield TestSuffixes.of([(r.item, r.text) for r in rows], window)


def _union_words(hits: Column) -> Column:
    """Words covered by the union of [s, e) spans."""
    return F.aggregate(
        F.array_sort(hits),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], x["e"]).alias("to")),
        lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, least_share: int = 20,
                  block_bytes: int = ITEM_BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with one more struct column (its name is returned): n_words, n_hit,
    hits (word spans), n_items, items (sorted ids) and contaminated
    (some word hit, and at least one word in ``least_share``)."""
    spark = docs.sparkSession
    prepare(spark)
    parts, out = [], docs
    for tests in item_blocks(benchmark, item_col, item_text_col, window, block_bytes):
        shared = spark.sparkContext.broadcast(tests)

        def report(text: pa.Array, shared=shared) -> pa.Array:
            return _report(text.to_pylist(), shared.value)

        part = free_name("_part", out)
        out = out.withColumn(part, _one(report)(docs[text_col].cast("string")))
        parts.append(part)
    name = free_name("_contamination", out)
    hits = F.flatten(F.array(*[F.col(f"`{p}`.hits") for p in parts]))
    items = F.array_sort(F.array_distinct(F.flatten(
        F.array(*[F.col(f"`{p}`.items") for p in parts]))))
    words, hit = F.col(f"`{parts[0]}`.n_words"), _union_words(hits)
    column = F.struct(
        words.alias("n_words"), hit.alias("n_hit"), hits.alias("hits"),
        F.size(items).cast("bigint").alias("n_items"), items.alias("items"),
        ((hit > 0) & (F.lit(least_share) * hit >= words)).alias("contaminated"))
    return out.withColumn(name, column).drop(*parts), name


def _one(report):
    return arrow_column(lambda text: report(text), REPORT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated documents; columns unchanged."""
    reported, name = contamination(docs, benchmark, **options)
    return reported.where(~F.col(f"`{name}`.contaminated")).select(*[reported[f"`{c}`"] for c in docs.columns])


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", window: int = WINDOW,
                    block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """For every test suffix that matches a whole window somewhere: item, offset
    (first word of the suffix), words (longest verbatim match), doc (smallest id,
    as text, that holds it) and doc_offset. Shards report their best match of each
    suffix; Spark takes the best of these."""
    spark = docs.sparkSession
    prepare(spark)
    found = None
    for tests in item_blocks(benchmark, item_col, item_text_col, window, block_bytes):
        shared = spark.sparkContext.broadcast(tests)

        def search(batches, shared=shared):
            tests = shared.value
            zero = np.flatnonzero(tests.codes == 0)
            begin = np.concatenate([[0], zero + 1])
            offset = tests.start - begin[np.searchsorted(zero, tests.start)] if len(zero) else tests.start
            for batch in batches:
                shard = Shard(batch.column(1).to_pylist(), tests)
                best, kept = shard.longest(tests)
                good = np.flatnonzero(best >= tests.window) if len(best) else np.zeros(0, np.int64)
                document = shard.document(kept[good]) if len(good) else good
                ids = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([tests.ids[i] for i in tests.item[good]], pa.string()),
                    pa.array(offset[good], pa.int64()), pa.array(best[good], pa.int64()),
                    pa.array([ids[d] for d in document], pa.string()),
                    pa.array(shard.place[kept[good]] - shard.first[document] if len(good) else good,
                             pa.int64())], ["item", "offset", "words", "doc", "doc_offset"])

        part = docs.select(docs[id_col].cast("string").alias("d"), docs[text_col].cast("string").alias("t")) \
            .mapInArrow(search, "item string, offset long, words long, doc string, doc_offset long")
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct((-F.col("words")).alias("w"), "doc", "doc_offset")).alias("b")
    return found.groupBy("item", "offset").agg(best).select(
        "item", "offset", (-F.col("b.w")).alias("words"), "b.doc", "b.doc_offset")
