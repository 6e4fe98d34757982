"""Training samples stay bounded whatever the ids are; models against plain counts."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, quality

WORDS = {"en": "the house and garden with flowers were there when this".split(),
         "de": "das haus und der garten mit blumen waren dort als".split(),
         "fr": "la maison et le jardin avec des fleurs étaient là".split()}


def documents(spark, n=300, ids=lambda i: i):
    rng = np.random.default_rng(0)
    rows = [(ids(i), " ".join(rng.choice(WORDS[lang], 12)), lang) for i in range(n) for lang in WORDS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i])
def test_language_sample_is_bounded(spark, ids, monkeypatch):
    """The sample's n-grams come from about as many documents as the bound says."""
    docs = documents(spark, ids=ids)
    totals = []
    of = langid.Filter.of
    monkeypatch.setattr(langid.Filter, "of", classmethod(lambda cls, *a, **k: totals.append(len(a[2])) or of(*a, **k)))
    small = langid.train(docs, F.lit(True), sample_docs=2)
    assert small.predict([" ".join(WORDS["de"])])[0] in (["de"], ["en"], ["fr"])
    model = langid.train(docs, F.lit(True), sample_docs=60)
    assert totals[0] < totals[1]
    names, _ = model.predict([" ".join(WORDS[x]) for x in WORDS])
    assert names == list(WORDS)


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i])
def test_quality_rows_are_bounded(spark, ids, monkeypatch):
    """Rows of one id do not multiply with its labels, nor pass the bound."""
    docs = documents(spark, 400, ids)
    labels = spark.createDataFrame([(ids(i), i % 2) for i in range(400)], "doc_id long, quality int")
    seen = {}
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.update(n=len(x)) or plain(x, y, trees=2))
    quality.train(docs, labels, F.lit(True), sample_rows=100)
    assert seen["n"] <= 200


def test_repeated_rows_count_once(spark, monkeypatch):
    docs = documents(spark, 5).unionByName(spark.range(3000).select(
        F.lit(3).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")))
    labels = spark.createDataFrame([(3, 1)] * 40 + [(1, 0)], "doc_id long, quality int")
    seen = {}
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.update(n=len(x)) or plain(x, y, trees=2))
    quality.train(docs, labels, F.lit(True), sample_rows=5000)
    assert seen["n"] == 7           # three texts of id 1, three of id 3 and the repeated one


def test_filter_against_sets(spark):
    """Bits of the Bloom filter against sets of n-grams, and the decision against plain counts."""
    docs = documents(spark, 40)
    model = langid.train(docs, F.lit(True))
    texts = [" ".join(WORDS[a][:4] + WORDS[b][4:]) for a in WORDS for b in WORDS]
    rows = docs.collect()
    grams = {lang: Counter() for lang in WORDS}
    for r in rows:
        values, _, _ = langid.grams([r.text])
        grams[r.lang].update(values.tolist())
    share = {lang: {g: n / sum(c.values()) for g, n in c.items() if n >= langid.LEAST_COUNT} for lang, c in grams.items()}
    best = Counter()
    for c in share.values():
        for g, p in c.items():
            best[g] = max(best[g], p)
    holds = {lang: {g for g, p in c.items() if p >= best[g] * langid.LEAST_RATIO} for lang, c in share.items()}
    names, _ = model.predict(texts)
    for text, name in zip(texts, names):
        values, _, _ = langid.grams([text])
        count = {lang: sum(g in holds[lang] for g in values.tolist()) for lang in sorted(WORDS)}
        top = max(count.values())
        # the filter may see a few n-grams that are not there, never miss one
        assert count[name] >= top - max(1, 0.02 * len(values))


def test_first_split_is_the_best_one():
    """One tree of depth one against all thresholds of all features."""
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(120, 3)), 1)
    y = (x[:, 1] + 0.3 * rng.normal(size=120) > 0.4).astype(float)
    model = quality.fit(x, y, trees=1, depth=1)
    p = 1 / (1 + math.exp(-model.base))
    gradient, hessian = p - y, np.full(len(y), p * (1 - p))

    def gain(right):
        total = 0
        for side in (right, ~right):
            if hessian[side].sum() < quality.LEAST_HESSIAN:
                return 0
            total += gradient[side].sum() ** 2 / (hessian[side].sum() + quality.RIDGE)
        return total - gradient.sum() ** 2 / (hessian.sum() + quality.RIDGE)

    edges = [np.unique(np.quantile(x[:, f], np.arange(1, quality.BINS) / quality.BINS)) for f in range(3)]
    best = max(gain(x[:, f] > t) for f in range(3) for t in edges[f])
    f, t = int(model.feature[0, 0]), float(model.threshold[0, 0])
    assert math.isclose(gain(x[:, f] > t), best) and f == 1
    for side, value in ((x[:, f] <= t, model.value[0, 0]), (x[:, f] > t, model.value[0, 1])):
        assert math.isclose(value, -quality.RATE * gradient[side].sum() / (hessian[side].sum() + quality.RIDGE))


def test_features_of_plain_texts():
    a = quality.features("Good words. Here they are!\nSecond line here.".encode())
    b = quality.features(b"")
    assert len(a) == len(b) == len(quality.FEATURES) and all(v == 0 for v in b)
