"""The whole pipeline on a small table against a plain form of every stage, row by row."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import bpe, quality
from strata.llm.queries import QUALITY_FROM, quality_model, word_bpe_path

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def groups(pairs, items):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return {i: find(i) for i in items}


def without_lines(docs):
    """Cuts lines whose sets of five-character runs are alike (0.8) to an earlier one."""
    places = [(d, p, x.strip(" ")) for d, t in sorted(docs.items()) for p, x in enumerate(t.split("\n")) if x.strip(" ")]
    first = {}
    for d, p, x in places:
        first.setdefault(x, (d, p))
    sets = {x: {x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in first}
    holders, pairs = defaultdict(list), []
    for x, s in sets.items():
        shared = Counter(y for g in s for y in holders[g])
        pairs += [(x, y) for y, n in shared.items() if n >= 0.8 * (len(s) + len(sets[y]) - n)]
        for g in s:
            holders[g].append(x)
    root = groups(pairs, sets)
    keep = {}
    for x, r in root.items():
        keep[r] = min(keep.get(r, first[x]), first[x])
    cut = {(d, p) for d, p, x in places if keep[root[x]] != (d, p)}
    return {d: "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in cut) for d, t in docs.items()}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(docs):
    prints = {d: fingerprint(t) for d, t in docs.items()}
    near = [(a, b) for a, b in itertools.combinations(docs, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    root = groups(near, docs)
    least = {}
    for d, r in root.items():
        least[r] = min(least.get(r, d), d)
    return {d: t for d, t in docs.items() if least[root[d]] == d}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def uncontaminated(docs, benchmark):
    windows = set()
    for item in benchmark:
        w = words_of(item)
        if w:
            k = min(13, len(w))
            windows |= {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    widths = {len(w) for w in windows}
    out = {}
    for d, t in docs.items():
        w, hit = words_of(t), set()
        for k in widths:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
        if not hit or 20 * len(hit) < len(w):
            out[d] = t
    return out


def test_run_equals_plain_stages(spark):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = frame.collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    model = quality_model(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.score(np.array([quality.features((r.text or "").encode()) for r in rows]))
    docs = {r.doc_id: r.text or "" for r, s in zip(rows, score) if s >= QUALITY_FROM}
    assert 0 < len(docs) < len(rows)
    docs = one_of_each(without_lines(docs))
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = uncontaminated(docs, benchmark)
    assert set(got) == set(docs)
    library = Tokenizer.from_file(word_bpe_path())
    library.no_truncation()
    library.no_padding()
    for d, t in docs.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids) and np.frombuffer(bytes(got[d].ids), "<u4").tolist() == ids
        assert got[d].decoded == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("first,last", [(0x500, 0x600), (0x1C80, 0x1D00), (0x2080, 0x20A0), (0xA7B0, 0xA800), (0x10540, 0x10600),
                                        (0x10D30, 0x10F00), (0x11370, 0x113F0), (0x116C0, 0x11700), (0x11BB0, 0x11C00),
                                        (0x13440, 0x13500), (0x14380, 0x14420), (0x160F0, 0x16140), (0x16D30, 0x16EE0),
                                        (0x18CF0, 0x18E00), (0x1CCE0, 0x1CD00), (0x1E5C0, 0x1E700), (0x32390, 0x32400)])
def test_letters_that_tables_disagree_about(first, last):
    library, codec = Tokenizer.from_file(word_bpe_path()), bpe.Bpe(word_bpe_path())
    library.no_truncation()
    library.no_padding()
    texts = [f"a{chr(c)}b" for c in range(first, last)]
    for text, coded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == coded.ids


def test_line_stage_samples_no_lines(spark):
    """Lines of one template in large buckets, with copies edited wherever they differ."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    fixed, docs = [word() for _ in range(30)], {}
    for i in range(20):
        own = [word() for _ in range(6)]
        for d, words in ((2 * i, own), (2 * i + 1, [w[:3] + "-" + w[4:] for w in own])):
            docs[d] = " ".join(fixed[:10] + words[:3] + fixed[10:24] + words[3:] + fixed[24:]) + f"\n{d}"
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, frame, SF).collect()}
    assert got == without_lines(docs) and all(got[d] == str(d) for d in got if d % 2)
