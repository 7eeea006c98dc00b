from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import align, variants
from eventloom.llm.tables import Scratch

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a\r\n b", "};\r\n  {\r", "\ra", "a \r", "x▁y", "<|endoftext|> <s></s> <0x41> <unk>", "a\x00b", "  two  spaces ", "　x \x85 y\xa0", "ﬁ １２ é é", "tab\tand\nline \n", "漢字 ß", "x" * 5000, "the the the", "the the the"]


@pytest.fixture(scope="module")
def plain():
    """Whole texts, each token by itself: bytes, ends, groups and links by definition."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = align.byte_letters()
    names = {i: t for t, i in a.get_vocab().items()}

    def piece(i: int) -> bytes:
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def of(text: str | None):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx, by = [bytes(letters[c] for c in names[i]) if names[i][0] != "<" or names[i] == "<" else names[i].encode() for i in x], [piece(i) for i in y]
        if not b"".join(bx) == b"".join(by) == (" " + text).encode():
            return None
        ex, ey = np.cumsum([len(t) for t in bx]).tolist(), np.cumsum([len(t) for t in by]).tolist()
        groups, links, p, q = [], [], 0, 0
        for end in sorted(set(ex) & set(ey)):
            i, j = ex.index(end) + 1, ey.index(end) + 1
            groups.append(",".join(map(str, x[p:i])) + "|" + ",".join(map(str, y[q:j])))
            links.append((x[i - 1], y[j - 1]))
            p, q = i, j
        return len(x), len(y), groups, links

    return of


def wanted(texts, plain):
    found = [plain(t) for t in texts]
    count = Counter(x for f in found if f for x in f[3])
    most: Counter = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    for f in found:
        if f is None:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            yield f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()


def aligned(spark, rows, schema="doc_id long, text string, n_a int, pair string"):
    got = align.align(spark.createDataFrame([(i, t, 1, "x") for i, t in rows], schema).repartition(3), A, B).toPandas()
    return {(None if np.isnan(r[0]) else int(r[0])): tuple(r[1:]) for r in got.itertuples(index=False)}, list(got.columns)


def test_alignment_equals_the_definition(spark, corpus, plain):
    rnd = random.Random(3)
    alphabet = ["a", "the", " ", "\n", "\r", "}", ";", "é", "ing", "\t", "0", "'s"]
    rows = [*corpus, *((10_000 + i, t) for i, t in enumerate(ODD)), *((20_000 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 30)))) for i in range(400))]
    got, columns = aligned(spark, rows)
    assert columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for (i, t), want in zip(rows, wanted([t for _, t in rows], plain), strict=True):
        assert got[i] == want, (i, t)


def test_alignment_of_nulls_repeats_and_nothing(spark, plain):
    rows = [(None, "one word"), (1, "one word"), (1, "one word"), (2, None)]
    got = align.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(wanted([t for _, t in rows], plain))
    assert align.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_lanes_stop_one_by_one():
    """Lanes of very different lengths, one of a single token."""
    a = [[1], [2, 3, 1], [1] * 50, [5, 5]]
    b = [[1], [3, 3], [7, 43], [10]]
    first = lambda x: np.cumsum([0, *[len(y) for y in x]])
    p, q = align.lockstep(np.array(sum(a, [])), first(a), np.array(sum(b, [])), first(b))
    assert p.tolist() == [0, 3, 10, 53, 55] and q.tolist() == [0, 2, 3, 4, 5]


def test_possible_pairs_are_bounded_by_the_vocabularies():
    own = align.aligner(A, B)
    assert len(own.pairs) <= sum(map(len, own.a_bytes)) * 2 + sum(map(len, own.b_bytes)) * 2
    n = len(own.b_bytes)
    for pair in own.pairs[:: len(own.pairs) // 500].tolist():
        x, y = own.a_bytes[pair // n], own.b_bytes[pair % n]
        assert x.endswith(y) or y.endswith(x)


RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found: Counter = Counter()
    for i, t in rows:
        for w in RUN.findall((t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words.get(form[w]), root)
    return out


def as_dict(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.fixture(scope="module")
def spelled():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdeéßÿ×") for _ in range(rnd.randrange(7, 12))) for _ in range(30)] + ["aaaaaaa", "aaaaaaaa", "Straße" * 2, "l" * 70, "l" * 69 + "m", "l" * 71]
    rows = []
    for i in range(400):
        words = []
        for _ in range(60):
            w = rnd.choice(base[:12] if rnd.random() < 0.7 else base)
            if rnd.random() < 0.2:
                k = rnd.randrange(len(w))
                w = rnd.choice([w[:k] + w[k + 1 :], w[:k] + rnd.choice("abéz") + w[k + 1 :], w[:k] + "x" + w[k:]])
            words.append(w.upper() if rnd.random() < 0.1 and w.isascii() else w)
        rows.append((i, rnd.choice([" ", ", ", "1", "\n"]).join(words)))
    return [*rows, (900, None), (901, ""), (None, "aaaaaaab aaaaaaab"), (902, "\x80Ā 漢字"), (3, "aaaaaaa"), (3, "aaaaaaa")]


def test_spellings_equal_brute_force(spark, spelled):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in spelled], "doc_id long, text string, n int, form string").repartition(4)
    words = counted(spelled)
    assert {r.word: r.n for r in variants.vocabulary(df).collect()} == words and len(words) > 300
    want = brute(words)
    assert sum(x[2] is not None for x in want.values()) > 50 and any(x[4] != x[2] for x in want.values() if x[2])
    assert as_dict(variants.group_spellings(df)) == want


def test_small_filters_take_rounds_and_lose_nothing(spark, spelled):
    words = counted(spelled)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    few = variants.plan_rounds({7: 5000, 8: 10, 9: 100_000}, 4096)
    assert all(sum(b for *_, b in r) * 8 <= 4096 for r in few) and {(s, p) for r in few for s, p, *_ in r} >= {(7, 0), (8, 0), (9, 0)}
    assert as_dict(variants.variants(df, filter_bytes=1024)) == brute(words)


def test_roots_of_a_long_chain_ties_and_nothing(spark):
    chain = {"a" * 7 + "b" * k: 10**k for k in range(1, 12)}
    tie = {"zzzzzzza": 5, "zzzzzzzb": 50, "zzzzzzzc": 50}
    words = chain | tie
    df = spark.createDataFrame([*words.items(), (None, 4)], "word string, n long")
    got = as_dict(variants.variants(df))
    assert got == brute(words)
    assert got["a" * 7 + "b"][4] == "a" * 7 + "b" * 11 and got["zzzzzzza"][2] == "zzzzzzzb"
    assert variants.variants(df.limit(0)).count() == 0
    assert variants.group_spellings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_filter_holds_all_its_keys():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 3000).astype(np.uint64)
    blocks = np.zeros(800, np.uint64)
    np.bitwise_or.at(blocks, variants.Filter.place(keys, 800), variants.Filter.bits(keys))
    assert len(variants.Filter(blocks).holds(keys)) == 3000
    parts = [variants.Filter(blocks, k, 3) for k in range(3)]
    assert sorted(np.concatenate([x.holds(keys) for x in parts]).tolist()) == list(range(3000))


def test_very_long_run(spark):
    long = "ab" * 40_000
    rows = [(1, f"{long} {long}"), (2, f"{long}c {long}c")]
    got = as_dict(variants.group_spellings(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(counted(rows))
