from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventloom.llm import kernels as K, quality, repetition

SF = "/root/testdata/sf0.001"

WORD = r"[^\x20\x09-\x0D]+"


def brute(text: str) -> tuple:
    w = re.findall(WORD, text)
    n = len(w)

    def cover(spans):
        on = [0] * n
        for a, b in spans:
            on[a:b] = [1] * (b - a)
        return sum(on)

    seen: dict[tuple, list[int]] = {}
    for i in range(n - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    windows = [(i, i + 5) for v in seen.values() if len(v) > 1 for i in v]
    best = [0] * n
    places: dict[str, list[int]] = {}
    for i, x in enumerate(w):
        places.setdefault(x, []).append(i)
    for own in places.values():
        for i in own:
            for j in own:
                if i < j:
                    k = 0
                    while j + k < n and w[i + k] == w[j + k]:
                        k += 1
                    best[i], best[j] = max(best[i], k), max(best[j], k)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    deep = [(i, i + b) for i, b in enumerate(best) if b >= 8]
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), cover(windows), cover(deep), max([b - a for a, b in deep], default=0)


def test_repetition_equals_brute_force(spark, docs, corpus):
    out = repetition.repetition(docs)  # replaces the clashing column n_words
    got = {r.doc_id: r for r in out.collect()}
    for i, t in corpus:
        r, want = got[i], brute(t or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[:5], i
        assert (round(r.repeat_fraction * max(1, r.n_words)), r.longest_repeat) == want[5:], i
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.kept and r.base_failed)
    assert not got[5000].kept and not got[5001].kept
    assert repetition.repetition(docs.limit(0)).count() == 0


def test_blocks_do_not_change_results(corpus):
    column = pa.array([t for _, t in corpus])
    one, many = ([repetition.measure(p, repetition.Rules()) for p in K.blocks(column, limit)] for limit in (1 << 20, 300))
    for name in one[0]:
        assert (np.concatenate([x[name] for x in one]) == np.concatenate([x[name] for x in many])).all()


def test_classifier_on_held_out_labels(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    sample = 2500
    model = quality.fit(docs, labels, sample_rows=sample)
    used = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id")
    judged = quality.classify(docs, model).join(labels.join(used, "doc_id", "left_anti"), "doc_id").toPandas()
    clean, junk, toxic = (judged[(judged.quality == q) & (judged.toxic == t)] for q, t in ((1, 0), (0, 0), (1, 1)))
    assert min(len(clean), len(junk), len(toxic)) > 80
    assert clean.kept.mean() > 0.97 and junk.kept.mean() < 0.1 and toxic.kept.mean() < 0.1


def test_classifier_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, none)
    out = quality.classify(docs.withColumn("kept", F.lit("x")), model)
    assert out.count() == docs.count() and out.schema["kept"].dataType.simpleString() == "boolean"
    unknown = spark.createDataFrame([(0, None, None), (3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs.limit(0), quality.fit(docs, unknown)).count() == 0


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    n, prior, acc = 40_000, 0.2, np.array([0.9, 0.75, 0.8, 0.97])
    truth = rng.random(n) < prior
    votes = np.stack([np.where(rng.random(n) < a, truth, ~truth) for a in acc], axis=1).astype(int)
    votes[rng.random(n) < 0.5, 3] = quality.ABSTAIN
    model = quality.expectation_maximisation(votes, np.ones(n))
    assert abs(model.prior - prior) < 0.03
    for k in range(4):
        said = model.tables[k, 1, :2].sum()
        assert abs(model.tables[k, 1, quality.BAD] / said - acc[k]) < 0.05


def test_repeated_labels_and_null_keys(spark, docs):
    """Doubled label rows change nothing; null keys and a document of key -1 don't mix."""
    labels = spark.createDataFrame([(3 * i, i % 3 > 0, i % 5 == 0) for i in range(100)], "doc_id long, q boolean, t boolean").selectExpr("doc_id", "int(q) as quality", "int(t) as toxic")
    odd = docs.unionByName(spark.createDataFrame([(None, "you idiot, you pathetic clown of a loser", "a", 1), (-1, "plain words of a plain text", "a", 1)], docs.schema))
    one, two = (quality.fit(odd, x, sample_features=50) for x in (labels, labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 0, 1)], labels.schema))))
    assert (one.junk.weights == two.junk.weights).all() and one.toxic_labellers.prior == two.toxic_labellers.prior
    assert quality.classify(odd, one).count() == odd.count()
