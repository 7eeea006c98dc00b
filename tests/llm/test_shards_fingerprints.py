from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import fingerprint as FP, queries, shards


def test_bins_find_the_tightest_fit():
    rnd = random.Random(5)
    bins = shards.Bins([rnd.randrange(50, 200) for _ in range(40)])
    for _ in range(400):
        room, size = list(bins.room), rnd.randrange(1, 60)
        at = bins.tightest(size)
        fitting = [r for r in room if r >= size]
        assert (at is None) == (not fitting) and (at is None or room[at] == min(fitting)) and room[bins.roomiest()] == max(room)
        bins.take(bins.roomiest() if at is None else at, size)
        if len(room) < 60:
            bins.add(rnd.randrange(50, 200))


def best_fit_one_by_one(sizes, bins, capacity, more):
    """Best fit decreasing by its definition; the sizes that each bin gets."""
    room, got = [capacity] * bins, [[] for _ in range(bins)]
    for s in sorted(sizes, reverse=True):
        fitting = [i for i, r in enumerate(room) if r >= s]
        if fitting:
            at = min(fitting, key=lambda i: (room[i], i))
        elif more:
            at = len(room)
            room.append(max(capacity, s))
            got.append([])
        else:
            at = max(range(len(room)), key=lambda i: (room[i], i))
        room[at] -= s
        got[at].append(s)
    return sorted(map(sorted, got))


def test_best_fit_equals_one_by_one():
    rnd = random.Random(7)
    for case in range(60):
        sizes = [rnd.choice([0, 3, 7, 20, 21, 90, 260]) if case % 2 else rnd.randrange(60) for _ in range(rnd.randrange(1, 200))]
        more = case % 3 == 0
        bins, capacity = (0, 100) if more else (7, -(-sum(sizes) // 7))
        names, counts = np.unique(sizes, return_counts=True)
        plan, n = shards.best_fit_decreasing(names, counts, bins, capacity, more)
        got = [[] for _ in range(n)]
        for size, first, count, at in plan.tolist():
            got[at] += [size] * count
        assert sorted(map(sorted, got)) == best_fit_one_by_one(sizes, bins, capacity, more)
        for size, count in zip(names, counts, strict=True):
            own = plan[plan[:, 0] == size]
            assert own[:, 2].sum() == count and (own[:, 1] == np.cumsum(own[:, 2]) - own[:, 2]).all()
        if more:  # no two bins but one are half empty
            assert sum(sum(x) * 2 <= capacity for x in got) <= 1


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, size long, k string")


def test_groups_stay_whole_and_shards_are_even(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([20, 100, 900, 5000]), f"g{rnd.randrange(600)}") for i in range(3000)]
    out = shards.shard(table(spark, rows), "size", ["k"], ["doc_id"], n_shards=8).toPandas()
    assert len(out) == 3000 and (out.groupby("k")["shard"].nunique() == 1).all()
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() < 0.01 * sizes.mean()
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


@pytest.mark.parametrize("how", [{"n_shards": 10}, {"capacity": 30_000}])
def test_a_hot_group_stays_whole(spark, how):
    """A group larger than a shard has one of its own; the others share the rest evenly."""
    rows = [(i, 100, "hot") for i in range(1000)] + [(1000 + i, 100, f"g{i}") for i in range(2000)]
    out = shards.shard(table(spark, rows), "size", ["k"], ["doc_id"], **how).toPandas()
    assert len(out) == 3000 and (out.groupby("k")["shard"].nunique() == 1).all()
    hot = out[out["k"] == "hot"]["shard"].iloc[0]
    sizes = out[out["shard"] != hot].groupby("shard")["size"].sum()
    assert len(out[out["shard"] == hot]) == 1000 and sizes.max() - sizes.min() <= 30_000 * ("capacity" in how) + 100 and len(sizes) == (7 if "capacity" in how else 9)


def test_shard_edges(spark):
    assert shards.shard(table(spark, []), "size", ["k"], ["doc_id"], n_shards=24).count() == 0
    few = shards.shard(table(spark, [(1, 8, None), (1, 8, None), (None, 8, "")]), "size", ["k"], ["doc_id"], n_shards=24).toPandas()
    assert len(few) == 3
    odd = table(spark, [(1, None, None), (2, 5, "a")]).withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("_size", F.lit(3))
    out = shards.shard(odd, "size", ["k"], ["doc_id"], n_shards=2)
    assert out.columns == ["doc_id", "size", "k", "_row", "_size", "shard", "slot"] and out.count() == 2
    by_capacity = shards.shard(table(spark, [(i, 10, f"g{i}") for i in range(100)]), "size", ["k"], ["doc_id"], capacity=100).toPandas()
    assert by_capacity.groupby("shard")["size"].sum().tolist() == [100] * 10


def test_query_shards_equal_texts_together(spark, corpus, tmp_path):
    rows = [(i, t) for i, t in corpus] + [(9000 + i, t) for i, t in corpus[:30]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op4_best_fit_shards(spark, str(tmp_path)).toPandas()
    assert len(out) == len(rows) and set(out["shard"]) <= set(range(24)) and (out["law"] == "bytes").all()
    assert out.set_index("doc_id")["size"].to_dict() == {i: len((t or "").encode()) + 8 for i, t in rows}


def edited(a: str, b: str) -> str:
    half = len(a) // 2
    return a[: len(a) - half] + b[:half]


def test_fingerprints_against_the_next_document(spark, docs, corpus):
    got = {r.doc_id: r for r in FP.compare_with_next(docs).collect()}
    rows = sorted(corpus)
    assert len(got) == len(rows)
    for (i, a), (_, b) in zip(rows, [*rows[1:], rows[0]], strict=True):
        a, b = a or "", b or ""
        r, e = got[i], edited(a, b).encode()
        fa, fe, fb = FP.fingerprint(a.encode()), FP.fingerprint(e), FP.fingerprint(b.encode())
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(a), hashlib.sha256(e).hexdigest(), fa, fe)
        assert (r.near_edited, r.near_next) == (FP.likeness(fa, fe), FP.likeness(fa, fb))


def test_fingerprint_edges(spark):
    make = lambda rows: FP.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert make([]) == []
    one = make([(1, "alone")])
    assert len(one) == 1 and one[0].near_next == 1.0
    assert len(make([(1, "a"), (1, "a"), (1, "b"), (None, None)])) == 4


def test_likeness():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 6000).astype(np.uint8).tobytes()
    other = rng.integers(97, 123, 6000).astype(np.uint8).tobytes()
    a = FP.fingerprint(text)
    assert FP.likeness(a, a) == 1.0 and FP.likeness(a, FP.fingerprint(other)) == 0.0
    assert FP.likeness(a, FP.fingerprint(text[:3000] + b"inserted" + text[3000:])) > 0.9
    assert FP.likeness(a, FP.fingerprint(text + other)) == FP.likeness(FP.fingerprint(text + other), a) > 0.3
    assert FP.common_letters("abcde", "axcye") == 3


@pytest.mark.parametrize("n", [0, 1, 6, 7, 8, 64, 65, 5000])
def test_signatures_have_bounded_length(n):
    e, a, b = FP.fingerprint(b"z" * n).split(":")
    assert int(e) >= FP.LEAST and len(a) <= FP.MOST and len(b) <= FP.MOST


def test_gapless_ranks(spark):
    from eventloom.llm.tables import Scratch, gapless_rank

    rows = Scratch(spark).written(spark.range(500).select((F.col("id") % 3).alias("k"), "id"))
    out = gapless_rank(rows, ["k"], ["id"], "r").toPandas()
    for _, own in out.groupby("k"):
        assert sorted(own["r"]) == list(range(len(own)))


def slow_fingerprint(data: bytes) -> str:
    """Piecewise hashing by its definition: each window and each chunk hashed by itself, in Python integers."""
    mask, letters, base = 2**64 - 1, FP.ALPHABET, FP.K._BASES[0]
    value = [int(x) for x in FP.K._VALUES[0]]

    def polynomial(part: bytes) -> int:
        return sum(value[b] * pow(base, i, 2**64) for i, b in enumerate(part)) & mask

    def mix(x: int) -> int:
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor & mask
        return x ^ x >> 31

    rolls = {end: (r := polynomial(data[end - FP.WINDOW : end])) ^ r >> 32 for end in range(FP.WINDOW, len(data) + 1)}

    def cut(e: int) -> list[int]:
        ends = [end for end, r in rolls.items() if r % 2**e == 2**e - 1]
        return ends if ends and ends[-1] == len(data) else [*ends, len(data)]

    def signature(ends: list[int]) -> str:
        return "".join(letters[mix((polynomial(data[a:b]) + b - a) & mask) >> 58] for a, b in zip([0, *ends[:-1]], ends, strict=True)) if data else ""

    e = FP.LEAST
    while len(cut(e)) > FP.MOST:
        e += 1
    return f"{e}:{signature(cut(e))}:{signature(cut(e + 1))}"


def slow_likeness(a: str, b: str) -> float:
    """By the edit distance without substitutions, from its recurrence."""
    def distance(x: str, y: str) -> int:
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], last if c == d else 1 + min(row[j], row[j - 1])
        return row[-1]

    def score(x: str, y: str) -> float:
        run = min(FP.COMMON, len(x), len(y))
        shared = run and any(x[i : i + run] in y for i in range(len(x) - run + 1))
        return 1 - distance(x, y) / (len(x) + len(y)) if shared else 0.0

    if a == b:
        return 1.0
    (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
    return {0: max(score(a1, b1), score(a2, b2) if min(len(a2), len(b2)) > 1 else 0.0), 1: score(a1, b2), -1: score(a2, b1)}.get(int(p) - int(q), 0.0)


def test_fingerprints_by_definition():
    rnd = random.Random(21)
    texts = ["", "a", "short text", "xy" * 300] + [" ".join(rnd.choice(["the", "of", "naïve", "漢字", f"w{rnd.randrange(900)}"]) for _ in range(n)) for n in (5, 60, 400, 900)]
    texts += [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    marks = [FP.fingerprint(t.encode()) for t in texts]
    assert marks == [slow_fingerprint(t.encode()) for t in texts]
    for a in marks:
        for b in marks:
            assert abs(FP.likeness(a, b) - slow_likeness(a, b)) < 1e-12
