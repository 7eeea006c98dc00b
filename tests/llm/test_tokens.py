from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import bpe, packing, store, tokens
from eventloom.llm.tables import Scratch

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def test_encode_equals_tiktoken_and_decodes(spark, docs, corpus, reference):
    coded = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    got = {r.doc_id: (list(memoryview(bytes(r.ids)).cast("I")), bytes(r.bytes)) for r in coded.collect()}
    for i, t in corpus:
        assert got[i] == (reference.encode_ordinary(t or ""), (t or "").encode()), i
    assert bpe.encode(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_long_pre_tokens_and_random_texts(reference):
    coder, rnd = bpe.Bpe(bpe.load_ranks(RANKS), P.PATTERN), random.Random(2)
    for token in ("a" * 2500, "abcab" * 600, "".join(rnd.choice("etaoinshrdlu") for _ in range(3000))):
        assert coder.merge(token.encode()) == reference.encode_ordinary(token)
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([1, 9, 60]))) for a in ("ab \n", "é ñ'st1 2", "<|endoftext|> \x1c\x85\xa0　", "«  ° ") for _ in range(300)]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(pa.array(texts))] == [reference.encode_ordinary(t) for t in texts]


def ids_of(corpus, end):
    t = Tokenizer.from_file(JSON)
    return {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4") for i, x in corpus}


def test_white_space_texts_equal_the_library():
    """Units that end in white space, as texts do, stand among units that begin with it."""
    plain, rnd = Tokenizer.from_file(JSON), random.Random(6)
    for alphabet in ("\n a", " \t\n", "\n\r b\xa0", " \x85\u3000\n\u2003c", "\x1c \nd"):
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 12))) for _ in range(2000)] + ["foo\n", "x\n\nfoo", "foo", "x\n"]
        got = [np.frombuffer(ids, "<u4").tolist() for _, ids in tokens.encoded(pa.array(texts), JSON, 1)]
        assert got == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts], repr(alphabet)


def test_special_strings_equal_the_library():
    plain, rnd = Tokenizer.from_file(JSON), random.Random(9)
    texts = ["".join(rnd.choice(["<|endoftext|>", "<|endof", "|>", " ", "\n", "é", "ab"]) for _ in range(rnd.randrange(1, 12))) for _ in range(2000)] + ["<|endoftext|>"]
    got = [np.frombuffer(ids, "<u4").tolist() for _, ids in tokens.encoded(pa.array(texts), JSON, 1)]
    assert got == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts] and got[-1] == [50256, 1]


def test_packing_is_complete_and_tight(spark, docs, corpus):
    pieces = Scratch(spark).written(packing.token_pieces(docs, JSON, end=1, capacity=256))
    rows = packing.pack(pieces, capacity=256).toPandas()
    wanted = ids_of(corpus, 1)
    for key, own in rows.groupby("doc_id"):
        joined = b"".join(own.sort_values("start")["ids"].map(bytes))
        assert joined == wanted[key].tobytes() and (own["doc_tokens"] == len(wanted[key])).all()
    assert set(rows["doc_id"]) == set(wanted)
    total = 0
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1]]
        assert own["length"].sum() <= 256
        total += 1
    assert total <= 1.05 * -(-rows["length"].sum() // 256)
    assert packing.pack(pieces.limit(0), capacity=256).count() == 0
    odd = spark.createDataFrame([(1, 0, 5, 9), (1, 0, 5, 9), (2, 0, 0, 9), (3, 0, None, 9), (4, 0, 300, 9), (None, None, 256, 9)], "doc_id long, start long, length int, _class int")
    out = packing.pack(odd.withColumn("sequence_id", F.lit("x")).withColumn("offset", F.lit(1)), capacity=256)
    assert sorted(r.doc_id or 0 for r in out.where("sequence_id is null").collect()) == [2, 3, 4] and out.count() == 6


def test_patterns_meet_the_demand():
    rng = np.random.default_rng(0)
    for units, top in ((16, 50), (64, 1000), (64, 1)):
        demand = rng.integers(0, top + 1, units)
        found = packing.patterns(demand, units)
        assert (sum((p * n for p, n in found), np.zeros(units, int)) == demand).all()
        assert all((p * np.arange(1, units + 1)).sum() <= units for p, _ in found)


def test_store_round_trip(spark, docs, corpus):
    path = Scratch(spark).path()
    twice = docs.unionByName(docs.where("doc_id = 0"))
    store.write_store(twice, path, JSON, end=2)
    wanted, start = ids_of(corpus, 2), 0
    digests = {(r.doc_id, r.start): r for r in store.read_digests(spark, path).collect()}
    texts = {(r.doc_id, r.start): bytes(r.ids) for r in store.read_documents(spark, path).collect()}
    for i in sorted([*wanted, 0]):
        ids = wanted[i]
        r = digests[i, start]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes())) and texts[i, start] == ids.tobytes()
        start += len(ids)
    chunks = spark.read.parquet(f"{path}/parts/kind=chunk")
    assert chunks.count() == chunks.select("hash").distinct().count()
    assert spark.read.parquet(f"{path}/manifest").selectExpr("sum(tokens) as n", "sum(documents) as d").first() == (start, len(wanted) + 1)


def test_store_damage_is_found(spark, docs):
    path = Scratch(spark).path()
    store.write_store(docs, path, JSON, end=2)
    parts = spark.read.parquet(f"{path}/parts")
    worst = parts.where("kind = 'chunk'").select("hash").first().hash
    parts.where((parts.kind == "recipe") | (parts.hash != worst)).write.partitionBy("kind").parquet(f"{path}-2/parts")
    spark.read.parquet(f"{path}/recipes").write.parquet(f"{path}-2/recipes")
    with pytest.raises(Exception, match="can't be rebuilt"):
        store.read_digests(spark, f"{path}-2").collect()


def test_manifest_finds_lost_and_swapped_recipes(spark, docs):
    path = Scratch(spark).path()
    store.write_store(docs, path, JSON, end=2)
    parts, recipes, manifest = (spark.read.parquet(f"{path}/{x}") for x in ("parts", "recipes", "manifest"))
    lost = recipes.where("doc_id <> 3")
    swapped = recipes.withColumn("doc_id", F.expr("CASE doc_id WHEN 0 THEN 3 WHEN 3 THEN 0 ELSE doc_id END"))
    worst = parts.where("kind = 'chunk'").select("hash").first().hash
    for k, (own, left, error) in enumerate([(lost, parts, "differ from the manifest"), (swapped, parts, "differ from the manifest"), (recipes, parts.where((parts.kind == "recipe") | (parts.hash != worst)), "document .* can't be rebuilt")]):
        left.write.partitionBy("kind").parquet(f"{path}-{k}/parts")
        own.write.parquet(f"{path}-{k}/recipes")
        manifest.write.parquet(f"{path}-{k}/manifest")
        with pytest.raises(Exception, match=error):
            store.read_digests(spark, f"{path}-{k}").collect()
        if k < 2:
            with pytest.raises(ValueError, match=error):
                store.read_documents(spark, f"{path}-{k}")


def test_empty_store(spark, docs):
    path = Scratch(spark).path()
    store.write_store(docs.limit(0), path, JSON)
    assert store.read_digests(spark, path).count() == 0


def test_crc_and_merkle():
    rnd = random.Random(4)
    for _ in range(50):
        parts = [rnd.randbytes(rnd.randrange(0, 40)) for _ in range(rnd.randrange(1, 6))]
        assert store.crc_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))
    leaf = lambda x: hashlib.sha256(b"\0" + x).digest()
    assert store.merkle([b"a", b"b"]) == hashlib.sha256(b"\1" + leaf(b"a") + leaf(b"b")).digest()
    ids = np.random.default_rng(1).integers(0, 50000, 20000).astype("<u4")
    ends = store.borders(ids)
    moved = store.borders(np.concatenate([ids[:100], ids[103:]]))
    assert ends[-1] == 20000 and len({20000 - e for e in ends} & {19997 - e for e in moved}) > 0.7 * len(ends)


def test_forged_identity_raises(spark, docs):
    """Another doc_id, in the same order, or another start under the manifest's roots."""
    base = Scratch(spark).path()
    store.write_store(docs, base, JSON, end=2)
    recipes = spark.read.parquet(f"{base}/recipes")
    for k, forged in enumerate((F.when(F.col("doc_id") == 30, 31).otherwise(F.col("doc_id")), F.col("doc_id"))):
        path = f"{base}-{k}"
        for part in ("parts", "manifest"):
            rows = spark.read.parquet(f"{base}/{part}")
            (rows.write.partitionBy("kind") if part == "parts" else rows.write).parquet(f"{path}/{part}")
        recipes.withColumn("doc_id", forged).write.parquet(f"{path}/recipes")
        if k == 0:
            with pytest.raises(ValueError, match="differ from the manifest"):
                store.read_digests(spark, path)
        else:
            assert store.read_digests(spark, path).count() == docs.count()


def test_chain_of_leaves_holds_one_hash_a_power_of_two():
    chains = []
    for n in range(70):
        chain = store.Chain()
        for i in range(n):
            chain.add(hashlib.sha256(bytes([i])).digest())
        assert len(chain.peaks) == n.bit_count()
        chains.append(chain.root())
    assert len(set(chains)) == 70


def test_words_are_encoded_once_whatever_stop_follows():
    coder, library = tokens.coder(JSON), Tokenizer.from_file(JSON)
    rnd, bits = random.Random(5), [*"aZé漢3 .,;:!?'|<>-\n\t\xa0", "'s", "'ll", "<|endoftext|>", "word", "3.14", "...", "!?", "it's.", "x,y", "\x85", " "]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(60))) for _ in range(2000)] + ["", None, ".", "a.", ".a", " a .b"]
    got = [np.frombuffer(raw, "<u4").tolist() for _, raw in coder.column(pa.array(texts, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    list(coder.column(pa.array(["x zyxwvutty, x zyxwvutty. x zyxwvutty! x zyxwvutty"])))
    assert [u for u in coder.known if b"zyxwvutty" in u] == [b" zyxwvutty"]
