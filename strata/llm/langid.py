"""Language identification with language-bitmask n-gram filters.

The model is one bit-sliced Bloom filter: slot i holds a bitmask with one bit per
language, so looking up an n-gram (the AND of its slots) returns all languages
that contain it at once. A document's n-grams are counted per language; the count
is corrected for the filter's false positives of that language, and the language
with the largest corrected count wins. The score is its share of all corrected
counts.

Training counts n-grams per language in Spark over a bounded sample of labelled
documents (``SAMPLE_DOCS`` a language, chosen by a hash of id and text) and keeps the
``CAPACITY`` most frequent; an n-gram belongs to the languages in which its relative
frequency is at least ``LEAST_RATIO`` of its highest. All labelled languages are learned:
a slot has as many 64-bit words as their bits need.

Defined results: null texts and texts without letters are ``und`` with score 0; a
text whose n-grams are all unknown gets the most frequent language with score 0; ties
go to the language that sorts first; with nothing to learn from, every text is
``und``; repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, prepare

ORDERS = (2, 3, 4)
SAMPLE_DOCS = 4000
CAPACITY = 1 << 19
SLOTS = 1 << 22
HASHES = 2
LEAST_COUNT = 3
LEAST_RATIO = 0.2
UNKNOWN = "und"
_CHARS_AT_ONCE = 1 << 20
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: hashes of the letter n-grams (word edges count as a letter),
    the text of each, and which texts have a letter."""
    parts = [np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32) for t in texts]
    edge = np.zeros(1, np.uint32)
    points = np.concatenate([x for p in parts for x in (edge, p)] + [edge])
    owner = np.repeat(np.arange(len(texts)), [len(p) + 1 for p in parts])
    owner = np.append(owner, max(0, len(texts) - 1))
    letter = _letters()[points]
    has_letter = np.bincount(owner[letter], minlength=len(texts)) > 0
    keep = letter.copy()
    keep[:-1] |= letter[1:]           # one edge before a word ...
    keep[1:] |= letter[:-1]           # ... and one after it
    code = np.where(letter, points, 0).astype(np.uint64)[keep]
    owner, inner = owner[keep], ~letter[keep]
    found, whose = [], []
    for order in ORDERS:
        n = len(code) - order + 1
        if n <= 0:
            continue
        value = np.full(n, np.uint64(order))
        crossing = np.zeros(n, bool)
        for i in range(order):
            value = (value ^ code[i:i + n]) * _MIX[0]
            value ^= value >> np.uint64(31)
            if 0 < i < order - 1:
                crossing |= inner[i:i + n]
        if order == 2:
            crossing |= inner[:n] & inner[1:1 + n]
        good = ~crossing & (owner[:n] == owner[order - 1:])
        found.append(value[good])
        whose.append(owner[:n][good])
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(whose), has_letter


def _groups(texts: list[str]):
    """Slices of consecutive texts, of a bounded number of characters unless one
    text alone has more."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHARS_AT_ONCE:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if len(texts) > start:
        yield slice(start, len(texts))


def _slots(values: np.ndarray, slots: int):
    for i in range(HASHES):
        mixed = values * _MIX[i]
        yield ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(slots - 1)).astype(np.int64)


@dataclass
class Filter:
    languages: list[str]      # sorted
    common: int               # the most frequent language
    table: np.ndarray
    false_rate: np.ndarray    # of each language

    @classmethod
    def of(cls, languages: list[str], common: int, values: np.ndarray, masks: np.ndarray,
           slots: int = SLOTS) -> Filter:
        width = next((w for w in (8, 16, 32) if len(languages) <= w), 64)
        masks = masks if masks.ndim == 2 else masks[:, None]
        table = np.zeros((slots, masks.shape[1]), f"uint{width}")
        for at in _slots(values, slots):
            for word in range(table.shape[1]):
                np.bitwise_or.at(table[:, word], at, masks[:, word].astype(table.dtype))
        one = table.dtype.type(1)
        filled = np.array([((table[:, i // 64] >> table.dtype.type(i % 64)) & one).mean()
                           for i in range(len(languages))])
        return cls(languages, common, table, filled ** HASHES)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for part in _groups([t or "" for t in texts]):
            name, score = self._predict([t or "" for t in texts[part]])
            names += name
            scores.append(score)
        return names, np.concatenate(scores) if scores else np.zeros(0)

    def _predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        values, owner, has_letter = grams(texts)
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        first, *others = _slots(values, len(self.table))
        mask = self.table[first]
        for at in others:
            mask &= self.table[at]
        total = np.bincount(owner, minlength=n).astype(float)
        counts = []
        planes = mask.view(np.uint8).reshape(len(mask), mask.shape[1] * mask.dtype.itemsize)
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        for plane in range(-(-len(self.languages) // 8)):
            seen = np.bincount(owner * 256 + planes[:, plane], minlength=n * 256).reshape(n, 256)
            counts.append(seen @ bits)
        count = np.concatenate(counts, 1)[:, :len(self.languages)]
        right = np.maximum(0, (count - total[:, None] * self.false_rate) / (1 - np.minimum(self.false_rate, 0.99)))
        best, sums = right.argmax(1), right.sum(1)
        top = right[np.arange(n), best]
        score = np.divide(top, sums, out=np.zeros(n), where=sums > 0)
        best = np.where(sums > 0, best, self.common)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)]
        return names, np.where(has_letter, np.clip(score, 0, 1), 0.0)


def train(docs: DataFrame, may_learn: Column, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, capacity: int = CAPACITY) -> Filter:
    """Learn from rows of ``docs`` that satisfy ``may_learn`` and have a language."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.where(may_learn & docs[lang_col].isNotNull()).select(
        docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"),
        docs[lang_col].cast("string").alias("lang"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Filter.of([], 0, np.zeros(0, np.uint64), np.zeros((0, 1), np.uint64), 2)
    number = {name: i for i, name in enumerate(languages)}
    turn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20))
    share = {r["lang"]: min(1 << 20, -(-(sample_docs << 20) // r["count"])) for r in sizes}
    wanted = turn < F.element_at(F.create_map(*[F.lit(x) for p in share.items() for x in p]), F.col("lang"))
    sample = rows.where(wanted).dropDuplicates(["id", "text", "lang"])      # rows that repeat count once

    def count(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            index = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for part in _groups(texts):
                values, owner, _ = grams(texts[part])
                for lang in np.unique(index[part]):
                    mine, times = np.unique(values[index[part][owner] == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), lang, np.int32)), pa.array(mine.view(np.int64)),
                         pa.array(times.astype(np.int64))], ["lang", "gram", "n"])

    counted = sample.select("text", "lang").mapInArrow(
        count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).checkpoint()
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    total = F.element_at(F.create_map(*[F.lit(x) for p in totals.items() for x in p]), F.col("lang")) \
        if totals else F.lit(1)
    shares = counted.where(F.col("n") >= LEAST_COUNT).withColumn("p", F.col("n") / total)
    best = F.array_max("ps.p")
    kept = shares.groupBy("gram").agg(F.collect_list(F.struct("lang", "p")).alias("ps")).select(
        "gram", best.alias("top"), F.transform(
            F.filter("ps", lambda x: x["p"] >= best * LEAST_RATIO), lambda x: x["lang"]).alias("langs")
    ).orderBy(F.desc("top"), "gram").limit(capacity).select("gram", "langs").toPandas()
    masks = np.zeros((len(kept), -(-len(languages) // 64)), np.uint64)
    for row, langs in enumerate(kept["langs"]):
        for i in langs:
            masks[row, i // 64] |= np.uint64(1 << i % 64)
    return Filter.of(languages, number[sizes[0]["lang"]], kept["gram"].to_numpy(np.int64).view(np.uint64), masks)


def identify(docs: DataFrame, model: Filter, *, text_col: str = "text") -> Column:
    """Struct column (lang, score) for the texts of ``docs``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(text: pa.Array) -> pa.Array:
        names, scores = shared.value.predict(text.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return arrow_column(run, "struct<lang:string,score:double>")(docs[text_col].cast("string"))
