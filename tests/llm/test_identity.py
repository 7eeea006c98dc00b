"""Two words whose polynomial hashes modulo 2**64 agree for every odd base; and what each operator makes of them."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from eventloom.llm import bpe, kernels as K, lines, near, packing, recompress, repetition, store
from eventloom.llm.tables import Scratch

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


def word(n: int = 2048) -> str:
    w = "a"
    while len(w) < n:
        w += w.translate(str.maketrans("ab", "ba"))
    return w


X = word()
Y = X.translate(str.maketrans("ab", "ba"))


def spans(*parts: str):
    data = [p.encode() for p in parts]
    ends = np.cumsum([len(p) for p in data])
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], ends[:-1]]), ends


def test_the_words_do_collide():
    h = K.span_hashes(*spans(X, Y))
    assert h[0] == h[1] and X != Y
    at, which = K.classes(*spans(X, Y, X, "", Y, "c", ""))
    assert [at.tolist()[k] for k in which] == [0, 1, 0, 3, 1, 5, 3]


@pytest.fixture(scope="module")
def two(spark):
    """Eight documents, four of each word, on eight sites."""
    return spark.createDataFrame([(i, X if i % 2 else Y, f"s{i}") for i in range(8)], "doc_id long, text string, source string").repartition(1)


def test_token_ids(two, spark):
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    for r in bpe.decode(bpe.encode(two, RANKS, P.PATTERN), RANKS, P.PATTERN).collect():
        assert bytes(r.bytes).decode() == r.text and np.frombuffer(bytes(r.ids), "<u4").tolist() == plain.encode_ordinary(r.text)
    tokenizer, path = Tokenizer.from_file(JSON), Scratch(spark).path()
    crc = lambda t, end: zlib.crc32(np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4").tobytes())
    store.write_store(two, path, JSON, end=2)
    assert {r.doc_id: r.ids_crc32 for r in store.read_digests(spark, path).collect()} == {i: crc(X if i % 2 else Y, 2) for i in range(8)}
    assert {r.doc_id: zlib.crc32(r.ids) for r in packing.token_pieces(two, JSON, capacity=4096).collect()} == {i: crc(X if i % 2 else Y, 1) for i in range(8)}


def test_lines_and_sites(two, spark):
    part = next(K.blocks(pa.array([f"{X}\n{Y}", f"{X}\n{X}"])))
    assert repetition.measure(part, repetition.Rules())["n_dup_lines"].tolist() == [0, 1]
    assert lines.spread_lines(two, min_sites=5).where("n_removed > 0").count() == 0
    assert lines.spread_lines(two, min_sites=4).where("n_removed > 0").count() == 6


def test_links(two, spark):
    got = {r.doc_id: r.component_id for r in near.jaccard_components(two).collect()}
    assert got == {i: i % 2 for i in range(8)}
    rest = " ".join(f"w{k}" for k in range(12))
    rows = [(0, f"{X} {rest}"), (1, f"{Y} {rest}"), (2, f"{X} {rest} z"), (3, f"{X} {rest} {Y} {rest} {X} {rest}")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), near.Jaccard(2, 85)).collect()}
    assert got == {0: (12, 0), 1: (12, 1), 2: (13, 0), 3: (15, 3)}


def test_windows(spark):
    a, b = " ".join(f"w{k}" for k in range(30)), " ".join(f"v{k}" for k in range(30))
    rows = [(1, f"{a} {X} {b}"), (2, f"{a} {Y} {b}"), (3, f"{a} {X} {b}")]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in recompress.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (0, sha(rows[0][1])), 2: (0, sha(rows[1][1])), 3: (61, sha(""))}


def test_texts_that_share_half_of_their_digest(spark):
    """Digests whose first halves are all alike, then whose second halves are: texts are told apart by the other."""
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words[:39])), (4, " ".join(words[::-1])), (5, "w1 w2"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, r.n_shingles, r.component_id) for r in near.jaccard_components(df, near.Jaccard(2, 85)).collect()}
    assert {x[2] for x in want} == {1, 4, 5, 6}
    from eventloom.llm.kernels import digests

    for half in (0, 1):
        def alike(*spans, half=half):
            out = digests(*spans).copy()
            out[:, half] = 7
            return out

        got = near.jaccard_components(df, near.Jaccard(2, 85), digests=alike)
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()} == want
