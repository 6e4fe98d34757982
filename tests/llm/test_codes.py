import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import codes


def brute_nearest(entries, queries):
    square = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
    return square.argmin(1), square.min(1)


@pytest.mark.parametrize("seed", range(12))
def test_tree_equals_exhaustive_search(seed):
    rng = np.random.default_rng(seed)
    n, width, spread = int(rng.integers(1, 80)), int(rng.integers(1, 6)), int(rng.choice([2, 5, 300, 1 << 22]))
    entries = rng.integers(-spread, spread, (n, width))
    queries = np.concatenate([rng.integers(-spread, spread, (400, width)), entries])
    index, square = codes.Nearest(entries).search(queries)
    want = brute_nearest(entries, queries)
    assert (index == want[0]).all() and (square == want[1]).all()


def test_tree_leaves_entries_out():
    rng = np.random.default_rng(0)
    entries = rng.integers(-200, 200, (64, 4))
    tree = codes.Nearest(entries)
    tree.search(entries[rng.integers(0, 64, 2000)] + rng.integers(-6, 7, (2000, 4)))
    assert tree.measured < 0.5 * 2000 * 64


def brute(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i, v, label) for i, v, label in rows
                   if v is not None and all(x is not None and np.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, [int(np.floor(256 * x)) for x in r[1]]))
    if not kept:
        return [], ""
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts)) * parts
    x = np.zeros((len(kept), width), np.int64)
    for row, (_, v, _) in zip(x, kept):
        row[:len(v)] = np.floor(256 * np.array(v, float))
    x = x.reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            index, _ = brute_nearest(books[p], x[:, p])
            for e in range(len(books[p])):
                if (index == e).any():
                    books[p][e] = x[index == e, p].sum(0) // (index == e).sum()
    found = [brute_nearest(books[p], x[:, p]) for p in range(parts)]
    error = sum(square for _, square in found)
    by_label = {}
    for (_, _, label), e in zip(kept, error.tolist()):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{found[p][0][n]:02x}" for p in range(parts)), int(error[n]), by_label[label])
                   for n, (i, _, label) in enumerate(kept)), key=str), sha


def result(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int") \
        .withColumn("v", F.lit(1)).withColumn("code", F.lit("clash"))
    coded, books = codes.compress(table)
    return sorted(((r.id, "".join(f"{c:02x}" for c in r.code), r.error, r.label_error) for r in coded.collect()),
                  key=str), books.digest() if books else ""


def as_float32(rows):
    return [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 0.2, 32).tolist(), int(i % 3) if i % 7 else None) for i in rng.permutation(300)]
    rows += [(400 + i, rows[0][1], 1) for i in range(150)]                     # a hot vector
    rows += [(600, None, 1), (601, [float("nan")] * 32, 2), (602, [None] + [0.0] * 31, 0), (603, [float("inf")] * 32, 0)]
    rows += [(3, rng.normal(0, 1, 32).tolist(), 2), (None, rng.normal(0, 1, 32).tolist(), None)]   # an id twice, no id
    rows = as_float32(rows)
    assert result(spark, rows) == brute(rows)


def test_few_rows_short_vectors_and_empty_table(spark):
    rows = as_float32([(1, [0.5, -0.25, 3.0], 1), (2, [1.0] * 20, 1), (2, [1.0] * 20, 1), (5, [], None)])
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == ([], "")
    assert result(spark, [(1, None, 1)]) == ([], "")


def test_huge_components_take_no_part(spark):
    rows = as_float32([(1, [1e30] * 16, 1), (2, [0.5] * 16, 1)])
    assert [r[0] for r in result(spark, rows)[0]] == [2]
