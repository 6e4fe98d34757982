"""The registered queries against DuckDB, or against plain Python where SQL can't say it."""

import hashlib
import os
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from oracle_harness import compare, duck
from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES, word_bpe_path

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def by_doc(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    result = compare(spark, name, QUERIES[name], ORACLE[name], SF_DIR, duck(SF_DIR))
    assert result["status"] == "ok", result


def test_op2(spark, docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(word_bpe_path())
    got = by_doc(spark, "op2_bpe_encoding_and_decoding")
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == (
            len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded))


@pytest.mark.parametrize("text", [
    "", "<|endoftext|> hi<|startoftext|>X", "ΣΑΣ ς İI ı ﬁ Ǆ", "é ́x", "don't we'll 'S 123 ½",
    "日本語 🙂👍🏽", "a\x1cb c\x85d e　f", "\x00\x01", "ₜ₞ψ", "Kſ " * 50])
def test_bpe_equals_the_library(text):
    from strata.llm.bpe import Bpe
    from tokenizers import Tokenizer
    ours, library = Bpe(word_bpe_path()), Tokenizer.from_file(word_bpe_path())
    ids = np.frombuffer(ours.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def _shingles(line):
    return {line[i:i + 5] for i in range(max(1, len(line) - 4))}


def test_op3(spark, docs):
    """Brute force over all pairs of lines with a shingle in common."""
    first, places = {}, []
    for r in sorted(docs, key=lambda r: r.doc_id):
        for p, line in enumerate((r.text or "").split("\n")):
            if line := line.strip(" "):
                first.setdefault(line, (r.doc_id, p))
                places.append((r.doc_id, p, line))
    names = list(first)
    sets = [_shingles(x) for x in names]
    parent = list(range(len(names)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(i)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    keep = {}
    for i, name in enumerate(names):
        keep[find(i)] = min(keep.get(find(i), first[name]), first[name])
    index = {name: i for i, name in enumerate(names)}
    cut = defaultdict(list)
    for doc, p, line in places:
        if keep[find(index[line])] != (doc, p):
            cut[doc].append(p)
    got = by_doc(spark, "op3_line_dedup")
    for r in docs:
        assert got[r.doc_id].removed == ",".join(map(str, cut[r.doc_id]))
        left = [x for p, x in enumerate((r.text or "").split("\n")) if p not in cut[r.doc_id]]
        assert got[r.doc_id].kept_sha256 == sha("\n".join(left))
    assert sum(map(len, cut.values())) >= 316


def test_op5_base(spark, docs):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.IGNORECASE | re.ASCII)
    got = by_doc(spark, "op5_secret_scans")
    for r in docs:
        t = r.text or ""
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert got[r.doc_id].base_sha256 == sha(",".join(s for *_, s in sorted(spans)))


def test_secrets_are_confirmed():
    import base64
    import json

    from strata.llm.secrets import scan
    b64 = lambda b: base64.urlsafe_b64encode(b).rstrip(b"=").decode()
    header = {"alg": "HS256", "typ": "JWT"}
    token = f"{b64(json.dumps(header).encode())}.{b64(b'{}')}.{b64(b'x' * 32)}"
    key = bytes.fromhex("302e020100300506032b657004220420") + b"k" * 32
    text = base64.b64encode(key).decode()
    openssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) \
        + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"pub" * 9, b"priv" * 9))
    kinds = lambda s: [k for k, *_ in scan(s.encode())]
    assert kinds(token) == ["jwt"] and kinds(token[:-50]) == []
    assert kinds(f"é {text} ü") == ["key"] and scan(f"é {text} ü".encode())[0][1:] == (2, 2 + len(text))
    assert kinds(key.hex()) == ["hex", "key"] and kinds(key.hex()[:-2]) == ["hex"]
    assert kinds(base64.b64encode(key[:-1]).decode()) == []        # a length that does not fit
    assert kinds(base64.b64encode(openssh).decode()) == ["key"]
    assert kinds(base64.b64encode(openssh + b"\0").decode()) == []
    assert kinds(f"-----BEGIN PRIVATE KEY-----\n{text[:32]}\n{text[32:]}\n-----END PRIVATE KEY-----") == ["key"]
    assert kinds(base64.b64encode(b"here the password: hunter2hunter2 stands").decode()) == ["encoded"]
    assert kinds("x" * 60) == [] and kinds("3" * 30) == ["hex"]


def test_op7_held_out(spark, docs):
    got, lang = by_doc(spark, "op7_language_id"), {r.doc_id: r.lang for r in docs}
    held = [d for d, r in got.items() if r.held_out and lang[d]]
    assert len(got) == len(docs) and len(held) > 30
    assert sum(got[d].lang_pred == lang[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_op8(spark, docs):
    got, prints = by_doc(spark, "op8_simhash_near_dedup"), {}
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {
        d: (f"{prints[d]:016x}", find(d)) for d in prints}


def test_op9_held_out(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    got = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [r for r in labels if got[r.doc_id].held_out]
    assert len(held) > 30
    assert sum(got[r.doc_id].predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


def test_trees_are_walked_as_they_were_grown():
    from strata.llm import quality
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.98

    def walk(row):
        total = model.base
        for t in range(len(model.feature)):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            total += model.value[t, node - model.feature.shape[1]]
        return 1 / (1 + np.exp(-total))
    assert np.allclose([walk(r) for r in x[:50]], model.score(x[:50]))


def test_op10(spark):
    import html
    got = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        inside = r.html[r.html.index("<article>"):r.html.index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split())
                 for p in re.split(r"</?(?:p|h1|div|ul|li|article)\b[^>]*>", inside)]
        expected = "\n".join(p for p in parts if p)
        assert got[r.page_id].text == expected and got[r.page_id].n_chars == len(expected)


def test_crf_on_unseen_templates():
    import random

    from strata.llm import pagetext
    texts = [f"Some words, number {i}, of a longer text that goes on." for i in range(50)]
    make = lambda seed, n: [pagetext.blocks(pagetext.generated_page(r, texts)) for r in [random.Random(seed)] for _ in range(n)]
    model = pagetext.fit(make(1, 300))
    right = [int(y == b.label) for page in make(2, 100) for b, y in zip(page, model.decode(page))]
    assert sum(right) / len(right) > 0.97


def test_viterbi_is_the_best_of_all_paths():
    import itertools
    import random

    from strata.llm import pagetext
    rng = random.Random(3)
    model = pagetext.fit([pagetext.blocks(pagetext.generated_page(rng, ["some words of text here."])) for _ in range(40)], steps=15)
    page = pagetext.blocks(pagetext.generated_page(rng, ["more of it, and more."]))[:9]
    emit = []
    for path, names in pagetext.page_features(page):
        a, b = model._path(path), model._sum(names)
        emit.append((a[0] + b[0], a[1] + b[1]))
    score = lambda ys: model.start[ys[0]] + sum(e[y] for e, y in zip(emit, ys)) + sum(
        model.step[a, b] for a, b in zip(ys, ys[1:]))
    best = max(score(ys) for ys in itertools.product((0, 1), repeat=len(page)))
    assert abs(score(model.decode(page)) - best) < 1e-9
