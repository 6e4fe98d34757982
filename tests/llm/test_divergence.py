import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, p long"


def brute(rows, least=3, top=200):
    rows = [(t or "", l or "", s or "") for _, t, l, s in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        here = [(s, w) for (_, l, s), w in zip(rows, terms) if l == lang]
        docs = Counter(t for _, w in here for t in set(w))
        kept = {t for t, n in docs.items() if n >= least}
        sources = {s: Counter(t for s2, w in here if s2 == s for t in w if t in kept) for s, _ in here}
        whole = Counter(t for _, w in here for t in w if t in kept)

        def price(counts, t):
            return 1 + 10 ** 9 * (counts[t] + 1) // (sum(counts.values()) + len(kept))

        for s, mine in sources.items():
            pairs = [(o, sum((price(mine, t) - price(its, t)) ** 2 // price(its, t) for t in kept))
                     for o, its in sources.items() if o != s]
            words = [(t, (price(mine, t) - price(whole, t)) ** 2 // price(whole, t))
                     for t in kept if mine[t] and price(mine, t) > price(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", words, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r + 1) for r, (item, v) in enumerate(found[:limit])]
    return sorted(out)


def random_rows(seed, n, sources):
    rng = np.random.default_rng(seed)
    words = ["Ähre", "été", "AND", "and", "x", "I'm", "co-op", "日本", "a1b", "Zz"] + [f"w{chr(97 + i)}" for i in range(14)]
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 12))
        text = " ".join(words[int(j)] for j in np.minimum(rng.geometric(0.12, size) - 1, len(words) - 1))
        rows.append((i, text, ["en", "fr", None][int(rng.integers(3))], f"s{int(rng.integers(sources))}"))
    return rows + [(None, None, "en", "s0"), (1, "only here", "xx", None), (1, "only here", "xx", None), (2, "", "yy", "")]


def result(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string") \
        .withColumn("term", F.lit("clash")).withColumn("P", F.lit(1))
    return sorted(tuple(r) for r in divergence.audit(docs, **options).collect())


def test_equals_brute_force(spark):
    rows = random_rows(1, 90, 5)
    assert result(spark, rows) == brute(rows)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 3)
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", 20)
    rows = random_rows(2, 120, 8)
    assert result(spark, rows, top_terms=3) == brute(rows, top=3)


def test_no_kept_terms_and_empty_table(spark):
    rows = [(1, "alpha", "en", "a"), (2, "beta", "en", "b")]
    assert result(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert result(spark, []) == []


@pytest.mark.parametrize("columns,rows", [(512, 8192), (4, 8192), (512, 1), (1, 3)])
def test_products_equal_term_by_term_sums(monkeypatch, columns, rows):
    monkeypatch.setattr(divergence, "BLOCK_COLUMNS", columns)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", rows)
    rng = np.random.default_rng(3)
    counts = rng.poisson(2, (40, 4))
    counts[0] = 0, 0, 5, 900
    counts[counts.sum(1) == 0, 0] = 1
    price = 1 + 10 ** 9 * (counts + 1) // (counts.sum(0) + len(counts))
    zero = 1 + 10 ** 9 // (counts.sum(0) + len(counts))
    t, g = np.nonzero(counts)
    found = divergence.joint_divergence(t, g, counts[t, g], price[t, g], zero)
    for a in range(4):
        for b in range(4):
            assert found[a, b] == ((price[:, a] - price[:, b]) ** 2 // price[:, b]).sum()


def test_words_in_pieces(monkeypatch):
    raw = "Un été, ça va! aaaa-bbbbbbbbbbbbbbbbbbbbbbbb ÉTÉ 12 x".encode()
    whole = [w for ws in divergence.words_of(raw) for w in ws]
    for piece in range(1, 30):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert [w for ws in divergence.words_of(raw) for w in ws] == whole


def test_counts_are_sent_in_bounded_batches(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    monkeypatch.setattr(divergence, "SENT_ROWS", 2)
    texts = ["a b c d", "a a", "e f g h i", None, "a"]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 5), pa.array(["s"] * 5), pa.array([t or "" for t in texts])],
                                       ["lang", "source", "text"])
    n, docs = Counter(), Counter()
    for out in divergence._count([batch, batch]):
        assert out.num_rows <= 2
        for row in out.to_pylist():
            n[row["term"]] += row["n"]
            docs[row["term"]] += row["docs"]
    assert n["a"] == 8 and docs["a"] == 6 and n["i"] == 2
