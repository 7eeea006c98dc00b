from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from eventloom.llm import lines, near, recompress
from eventloom.llm.components import components
from eventloom.llm.tables import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def links_brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = root(x), root(y)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df, rule):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near.jaccard_components(df, rule).collect()}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_components_equal_brute_force(docs, corpus, k, percent):
    assert found(docs, near.Jaccard(k, percent)) == links_brute(corpus, k, percent)


def test_drifting_chains(spark):
    """Texts that drift word by word: links chain, and many pairs lie near the threshold."""
    rnd, rows = random.Random(3), []
    for g in range(4):
        w = [f"w{g % 2}_{j}" for j in range(50)]
        for s in range(40):
            w = list(w)
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(4)}"
            rows.append((100 * g + s, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((4, 85), (2, 60)):
        assert found(df, near.Jaccard(k, percent)) == links_brute(rows, k, percent)


def test_near_edges(spark, docs):
    assert near.jaccard_components(docs.limit(0)).count() == 0
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (2, "a b c d e f g")]
    got = near.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1)]


def test_connected_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark)).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[95] == got[90] == 90


def repeats_brute(rows, n):
    first, words = {}, {}
    for i, t in rows:
        words[i] = re.findall(WORD, t or "")
        for j in range(len(words[i]) - n + 1):
            k = tuple(words[i][j : j + n])
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [50, 12])
def test_repeats_equal_brute_force(docs, corpus, n):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in recompress.drop_repeats(docs, n).collect()}
    want = repeats_brute(corpus, n)
    assert got == want and sum(x[1] for x in want.values()) > 500


def test_unchanged_texts_stay(docs, corpus):
    texts = dict(corpus)
    for r in recompress.drop_repeats(docs, 50).where("n_removed = 0").collect():
        assert r.text == texts[r.doc_id]
    assert recompress.drop_repeats(docs.limit(0)).count() == 0


def test_lines_equal_brute_force(spark):
    rnd = random.Random(8)
    pool = [" ".join(rnd.choice("abcdefgh") * 3 for _ in range(rnd.randrange(3, 9))) for _ in range(30)]
    rows = []
    for i in range(200):
        own = [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(6)) for _ in range(2)]
        text = "\n".join(rnd.sample(own + [rnd.choice(pool) + rnd.choice(["", " ", "\t"]) for _ in range(4)] + [""], 7))
        rows.append((i, rnd.choice(["s1", "s2", "s3", "s4", "s5", "s6", None]) if i % 3 else "hot", text))
    rows += [(900, "s1", None), (901, "s2", ""), (None, "s3", pool[0])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_lines", F.lit("clash"))
    got = {r.doc_id: r for r in lines.spread_lines(df, min_sites=5, min_words=5).collect()}
    sites, first = {}, {}
    for i, s, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(re.findall(WORD, x)) >= 5:
                key = x.strip(" \t")
                sites.setdefault(key, set()).add(s)
                first[key] = min(first.get(key, i), i)
    removed = 0
    for i, _, t in rows:
        if i is None:
            assert got[None].text == t
            continue
        keep = []
        for x in (t or "").split("\n"):
            key = x.strip(" \t")
            if len(re.findall(WORD, x)) >= 5 and len(sites[key]) >= 5 and first[key] != i:
                removed += 1
            else:
                keep.append(x)
        assert (got[i].text or "").rstrip("\n") == "\n".join(keep).rstrip("\n"), i
    assert removed > 100 and got[900].text is None
    assert lines.spread_lines(df.limit(0)).count() == 0


def test_many_sites(spark):
    """Sketches alone can't tell 1000 sites from 1005; the exact counts near the threshold do."""
    rows = [(i, f"s{i}", "a b c d e f") for i in range(1000)] + [(5000 + i, f"s{i}", "g h i j k l") for i in range(1005)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = lines.spread_lines(df, min_sites=1003).groupBy((F.col("doc_id") >= 5000).alias("second")).agg(F.sum("n_removed").alias("n")).collect()
    assert {r.second: r.n for r in got} == {False: 0, True: 1004}


def test_rows_that_share_a_key(spark):
    """Rows of one key but other texts lose only words of their own; clashing names pass through."""
    rnd = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(60))
    own = [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(n)) for n in (5, 200)]
    rows = [(1, passage, 7), (2, f"{own[1]} {passage}", 8), (2, own[0], 9), (None, own[0], 10), (None, "x", 11), (3, " ".join(f"l{k}" for k in range(40_000)), 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone long").withColumn("_doc", F.lit(0)).withColumn("_row", F.lit("r"))
    got = {r._gone: r for r in recompress.drop_repeats(df).collect()}
    assert {k: r.n_removed for k, r in got.items()} == {7: 0, 8: 60, 9: 0, 10: 0, 11: 0, 12: 0} and got[8].text == own[1] and got[9]._row == "r"
    df = df.withColumn("source", F.lit("s"))
    assert lines.spread_lines(df).count() == 6 and near.jaccard_components(df).count() == 6


def test_blocks_of_a_frequent_shingle(spark, monkeypatch):
    """Many short texts that share a shingle, paired in blocks."""
    monkeypatch.setattr(near, "BLOCK", 5)
    monkeypatch.setattr(near, "STARS", 0)
    rnd = random.Random(12)
    rows = [(i, "same four words here " + " ".join(rnd.choice("abc") for _ in range(rnd.randrange(3)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((4, 85), (2, 60)):
        assert found(df, near.Jaccard(k, percent, overlap=1)) == links_brute(rows, k, percent)


def test_lists_meet_texts_in_one_way_at_every_size(spark, docs):
    """A broadcast of the lists on small tables alone hid what the join costs on large ones."""
    for out in (lines.spread_lines(docs, min_sites=2), recompress.drop_repeats(docs.select("doc_id", "text"), window=50)):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
