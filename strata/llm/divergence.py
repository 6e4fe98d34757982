"""Divergence of the sources of each language, from products of one-hot level columns.

A group is a (language, source). Each language keeps the terms that at least
``LEAST_DOCS`` of its documents hold; a term's price in a group is its smoothed share in
billionths, ``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and the divergence of p
from q is ``floor((p - q)**2 / q)``, summed over the kept terms.

- Each task counts its texts into (language, source, term) and sends the counts by
  (language, term): one shuffle brings all sources of a term together, and a frequent term
  or source costs at most one row a task.
- Terms are rows and (source, count) levels are columns of a 0/1 matrix X, level 0
  included. The product of X's transpose with X holds the joint table of every two
  sources: how many terms have count c here and d there. Each cell is priced once.
- Terms are dealt to blocks of about ``BLOCK_ENTRIES`` counts and sources to blocks of about
  ``BLOCK_SOURCES``; a task multiplies one block of terms for two blocks of sources. In it,
  terms are ordered by frequency and cut so that a product has few columns. The matrices
  hold 0 and 1 in float32 and at most ``BLOCK_ROWS`` rows, so the sums are exact integers.
- Terms that neither block of sources holds are priced from their number.

Defined results: null text, language and source are ''; every row is a document, also if
it repeats; a group without kept terms has N = 0; without kept terms (V = 0) all
divergences of pairs are 0; an empty table gives no rows. The number of rows of part
``pair`` is the square of a language's sources, which is what is asked for.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, small, stored

LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
HELD_TERMS = 300_000        # different terms a task holds before it sends their counts on
SENT_ROWS = 50_000
PIECE = 1 << 20             # bytes of a text split at once
BLOCK_ENTRIES = 200_000
BLOCK_SOURCES = 128
BLOCK_ROWS = 8192
BLOCK_COLUMNS = 512
# letters of ASCII in lower case and all bytes of other characters; the rest separates
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(raw: bytes):
    """Lists of the terms of a UTF-8 text, piece by piece."""
    at = 0
    while at < len(raw):
        piece = raw[at:at + PIECE].translate(_FOLD)
        end = len(piece)
        if at + end < len(raw):                       # the last word may go on
            end = piece.rfind(b" ") + 1
            if not end:                               # one word longer than a piece
                piece = raw[at:].translate(_FOLD)
                end = piece.find(b" ") + 1 or len(piece)
        yield piece[:end].split()
        at += end


def _count(batches):
    """(lang, source, term, n, docs) of the texts, in batches of bounded size."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for at in range(0, len(terms), SENT_ROWS):
                some = terms[at:at + SENT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([source] * len(some)),
                     pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array([n[t] for t in some], pa.int64()),
                     pa.array([docs[t] for t in some], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary())):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            different: set[bytes] = set()
            for words in words_of(text.as_py()):
                n.update(words)
                different.update(words)
            docs.update(different)
            size += len(n)
            if size > HELD_TERMS:
                yield from rows()
                size = 0
    yield from rows()


def _price(n: str, total: str, kept: str) -> Column:
    """p of a count; in decimals, since counts times 10**9 may pass 64 bits."""
    return F.expr(f"cast(1 + (cast({n} as decimal(20, 0)) + 1) * {UNIT} "
                  f"div cast({total} + {kept} as decimal(20, 0)) as bigint)")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def joint_divergence(term: np.ndarray, group: np.ndarray, level: np.ndarray, price: np.ndarray,
                     zero_price: np.ndarray) -> np.ndarray:
    """Sums over terms of the divergence of row group from column group.

    ``term`` (0 .. terms - 1, in an order that puts like levels together, sorted),
    ``group``, ``level`` (count > 0) and its ``price`` describe the entries;
    ``zero_price`` is each group's price of level 0."""
    groups = len(zero_price)
    out = np.zeros((groups, groups), np.int64)
    if not len(term):
        return out
    stack = [(0, int(term[-1]) + 1)]
    while stack:
        first, last = stack.pop()
        lo, hi = np.searchsorted(term, [first, last])
        columns, column = np.unique(group[lo:hi] * (int(level.max()) + 1) + level[lo:hi], return_inverse=True)
        if last - first > 1 and (last - first > BLOCK_ROWS or len(columns) > BLOCK_COLUMNS):
            middle = (first + last) // 2
            stack += [(first, middle), (middle, last)]
            continue
        # level 0 of a group stands before its other levels
        of_column = np.empty(len(columns), np.int64)
        of_column[column] = group[lo:hi]
        place = np.arange(len(columns)) + of_column + 1
        starts = np.searchsorted(of_column, np.arange(groups)) + np.arange(groups)
        prices = np.empty(len(columns) + groups, np.int64)
        prices[starts] = zero_price
        prices[place[column]] = price[lo:hi]
        x = np.zeros((last - first, len(prices)), np.float32)
        x[:, starts] = 1
        x[term[lo:hi] - first, starts[group[lo:hi]]] = 0
        x[term[lo:hi] - first, place[column]] = 1
        joint = np.rint(x.T @ x).astype(np.int64)
        cells = joint * _apart(prices[:, None], prices[None, :])
        out += np.add.reduceat(np.add.reduceat(cells, starts, axis=0), starts, axis=1)
    return out


def _pairs_of_block(key, entries: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, source, item, value, seen, rest, kept) for the pairs of two source blocks."""
    lang, _, a, b = (k.as_py() for k in key)
    block = dict(zip(groups.column("source").to_pylist(), zip(
        groups.column("block").to_pylist(), groups.column("p0").to_pylist(), groups.column("kept").to_pylist())))
    names = sorted(block)
    where = {name: i for i, name in enumerate(names)}
    zero = np.array([block[n][1] for n in names], np.int64)
    codes = entries.column("source").combine_chunks().dictionary_encode()
    group = np.array([where[s] for s in codes.dictionary.to_pylist()], np.int64)[
        codes.indices.to_numpy()] if len(codes) else np.zeros(0, np.int64)
    term = entries.column("term").combine_chunks().dictionary_encode()
    seen, term = len(term.dictionary), term.indices.to_numpy().astype(np.int64)
    level, price = (entries.column(c).to_numpy().astype(np.int64) for c in ("n", "p"))
    total = np.zeros(seen, np.int64)
    np.add.at(total, term, level)
    rank = np.empty(seen, np.int64)
    rank[np.argsort(total, kind="stable")] = np.arange(seen)
    order = np.argsort(rank[term], kind="stable")
    value = joint_divergence(rank[term][order], group[order], level[order], price[order], zero)
    side = np.array([block[n][0] for n in names])
    wanted = ~np.eye(len(names), dtype=bool)
    if a != b:
        wanted &= side[:, None] != side[None, :]
    g, h = np.nonzero(wanted)
    return pa.table({
        "lang": pa.array([lang] * len(g), pa.string()),
        "source": pa.array([names[i] for i in g], pa.string()),
        "item": pa.array([names[i] for i in h], pa.string()),
        "value": value[g, h], "seen": np.full(len(g), seen, np.int64),
        "rest": _apart(zero[g], zero[h]),
        "kept": pa.array([block[names[i]][2] for i in g], pa.int64())})


def _filled(docs: DataFrame, column: str) -> Column:
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def kept_terms(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, entries array of (source, n)) of the terms kept, stored."""
    parts = docs.select(_filled(docs, lang_col).alias("lang"), _filled(docs, source_col).alias("source"),
                        _filled(docs, text_col).alias("text")).mapInArrow(
        _count, "lang string, source string, term string, n long, docs long")
    return stored(parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries")).where(
        F.col("docs") >= least_docs).select("lang", "term", "entries"), "divergence-terms")


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank). Part ``pair``: the divergence of a source
    from each other source of its language; part ``term``: the ``top_terms`` terms by which
    it stands out from its language. Rank 1 has the largest value, ties by item."""
    spark = docs.sparkSession
    prepare(spark)
    kept = kept_terms(docs, text_col=text_col, lang_col=lang_col, source_col=source_col, least_docs=least_docs)
    entries = kept.select("lang", "term", F.explode("entries").alias("e")).select("lang", "term", "e.source", "e.n")
    totals = stored(entries.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("entries")),
                    "divergence-totals")
    langs = stored(kept.groupBy("lang").agg(F.count("*").alias("kept")).join(
        totals.groupBy("lang").agg(F.sum("n").alias("lang_total")), "lang"), "divergence-langs")
    groups = docs.select(_filled(docs, lang_col).alias("lang"), _filled(docs, source_col).alias("source")).distinct()
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    source_blocks = -(-most // BLOCK_SOURCES) or 1
    held = totals.agg(F.sum("entries")).first()[0] or 0
    term_blocks = -(-held // BLOCK_ENTRIES) or 1
    groups = stored(groups.join(totals.select("lang", "source", F.col("n").alias("total")), ["lang", "source"], "left")
                    .join(small(langs), "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
        "lang_total", F.pmod(F.xxhash64("source"), F.lit(source_blocks)).cast("int").alias("block")),
        "divergence-groups")
    # no term is priced where none is kept; 1 stands for any price there
    priced = groups.withColumn("p0", F.when(F.col("kept") > 0, _price("0", "total", "kept")).otherwise(1))
    counted = entries.join(small(groups), ["lang", "source"]).withColumn("p", _price("n", "total", "kept"))

    blocks = F.transform(F.sequence(F.lit(0), F.lit(source_blocks - 1)), lambda o: F.struct(
        F.least("block", o).alias("a"), F.greatest("block", o).alias("b")))
    tile = F.pmod(F.xxhash64("term"), F.lit(term_blocks)).cast("int").alias("tile")
    left = counted.select("lang", tile, F.explode(blocks).alias("ab"), "source", "term", "n", "p").select(
        "lang", "tile", "ab.*", "source", "term", "n", "p")
    right = priced.select("lang", F.explode(blocks).alias("ab"), "source", "block", "p0", "kept").select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(term_blocks - 1))).alias("tile"), "ab.*", "source", "block",
        "p0", "kept")
    on = ["lang", "tile", "a", "b"]
    pairs = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(
        _pairs_of_block, "lang string, source string, item string, value long, seen long, rest long, kept long")
    pairs = pairs.groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.first("rest").alias("rest"),
        F.first("kept").alias("kept")).select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        (F.col("value") + (F.col("kept") - F.col("seen")) * F.col("rest")).alias("value"))

    all_of = F.aggregate("entries", F.lit(0).cast("bigint"), lambda t, e: t + e["n"])
    terms = kept.select("lang", "term", all_of.alias("lang_n"), F.explode("entries").alias("e")).select(
        "lang", "term", "lang_n", "e.source", "e.n").join(small(groups), ["lang", "source"])
    terms = terms.withColumn("p", _price("n", "total", "kept")).withColumn(
        "q", _price("lang_n", "lang_total", "kept")).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
