"""Content-addressed store of token ids: chunks kept once, document recipes, Merkle manifests.

Layout under a path, all Parquet:
  parts/kind=chunk/   hash (first 16 bytes of the SHA-256 of the ids as little-endian unsigned 32-bit integers), n (ids), data (the ids'
                      bytes by planes, first bytes first, 2 of 4 where the vocabulary allows; Zstandard)
  parts/kind=recipe/  doc_id, n_tokens, chunks, root, as they were encoded
  recipes/            bucket, doc_id, start, n_tokens, chunks (hashes in order), root; files and rows in ascending doc_id
  manifest/           bucket, documents, tokens, root (Merkle root over the bucket's documents)
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from eventloom.llm import kernels as K
from eventloom.llm.tables import partitions
from eventloom.llm.tokens import encoded

#: Chunks that a task remembers to have sent.
SEEN = 200_000
#: A chunk ends where the rolling hash of the last SPAN ids has MASK's bits set: after 1024 ids on average,
#: LEAST at least, MOST at most.
SPAN, MASK, LEAST, MOST = 16, 1023, 256, 8192


def borders(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one document.  They follow the ids, so an edit moves only those near it."""
    n = len(ids)
    ends, last = [], 0
    if n > LEAST:
        cum = np.zeros(n + 1, np.uint64)
        np.cumsum((ids + np.uint64(1)) * K._power(0, n), out=cum[1:])
        roll = ((cum[SPAN:] - cum[:-SPAN]) * K._power(0, n - SPAN + 1, True)) >> np.uint64(40)
        for at in (np.flatnonzero((roll & np.uint64(MASK)) == MASK) + SPAN).tolist():
            while at - last > MOST:
                last += MOST
                ends.append(last)
            if at - last >= LEAST:
                ends.append(at)
                last = at
        while n - last > MOST:
            last += MOST
            ends.append(last)
    return ends if last == n else [*ends, n]


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """Ids (unsigned 32-bit) as `width` planes of bytes, compressed."""
    if width < 4 and len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"an id needs more than {width} bytes: write the store with wide=True")
    planes = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, :width].T)
    return _compressor().compress(planes.tobytes())


def unpack_ids(data: bytes, width: int) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    planes = np.frombuffer(_decompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, :width] = planes.T
    return out.tobytes()


@functools.cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1, write_checksum=False)


@functools.cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def merkle(hashes: list[bytes]) -> bytes:
    """Root of the binary hash tree; leaves and inner nodes hash apart, an odd node moves up."""
    level = [hashlib.sha256(b"\0" + h).digest() for h in hashes] or [hashlib.sha256(b"\0").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + ([level[-1]] if len(level) % 2 else [])
    return level[0]


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's, bits reflected."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = b >> 1 ^ _POLYNOMIAL if b & 1 else b >> 1
        bit >>= 1
    return out


@functools.lru_cache(100_000)
def _shift(n_bytes: int) -> int:
    """x to the power 8 * n_bytes."""
    out, square, n = 1 << 31, 1 << 30, 8 * n_bytes
    while n:
        if n & 1:
            out = _times(out, square)
        square = _times(square, square)
        n >>= 1
    return out


def crc_of_parts(parts: list[tuple[int, int]]) -> int:
    """The CRC-32 of a concatenation from (crc, bytes) of its parts."""
    out = 0
    for crc, n in parts:
        out = _times(_shift(n), out) ^ crc
    return out


def write_store(docs: DataFrame, path: str, vocabulary: str, end: int = 2, wide: bool = False) -> None:
    """Encodes `docs` (doc_id, text), with `end` after each, and writes the store.

    wide: 4 bytes an id in chunks (vocabularies over 65,536 ids).  One pass encodes and cuts.  Chunks go
    once over the network, by hash, and each partition, sorted, writes every hash once; a task sends a
    chunk it has just met (of its last SEEN ones) no second time, so copies don't pile up.  Recipes
    travel with them.  `start` is a running sum over ascending doc_id: within ranges in parallel, over
    the ranges' sums at the end.
    Null and empty texts have the end id alone; a null doc_id comes first; rows that share a doc_id are
    documents of their own, in the order of their roots; an empty table makes an empty store.
    """
    width = 4 if wide else 2
    names = ["kind", "hash", "n", "data", "doc_id", "n_tokens", "chunks", "root"]
    kinds = [pa.string(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary()]
    schema = "kind string, hash binary, n int, data binary, doc_id long, n_tokens long, chunks array<binary>, root binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                keys, rows = part.column(0).to_pylist(), []
                for i, raw in encoded(part.column(1), vocabulary, end):
                    ids = np.frombuffer(raw, "<u4")
                    own, last = [], 0
                    for e in borders(ids):
                        digest = hashlib.sha256(raw[4 * last : 4 * e]).digest()[:16]
                        own.append(digest)
                        if digest not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(digest)
                            rows.append(("chunk", digest, e - last, pack_ids(ids[last:e], width), None, None, None, None))
                        last = e
                    root = merkle(own)
                    place = hashlib.sha256(root + repr(keys[i]).encode()).digest()[:16]  # equal documents spread
                    rows.append(("recipe", place, None, None, keys[i], len(ids), own, root))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            hashes, is_chunk = batch.column(1).to_pylist(), [k == "chunk" for k in batch.column(0).to_pylist()]
            keep = []
            for h, chunk in zip(hashes, is_chunk, strict=True):
                keep.append(not chunk or h != last)
                if chunk:
                    last = h
            yield batch.filter(pa.array(keep))

    n = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)
    rows = rows.repartition(n, "hash").sortWithinPartitions("kind", "hash").mapInArrow(once, schema)
    rows.write.partitionBy("kind").option("compression", "uncompressed").parquet(f"{path}/parts")
    spark = docs.sparkSession
    coded = spark.read.schema(schema).parquet(f"{path}/parts").where("kind = 'recipe'").select("doc_id", "n_tokens", "chunks", "root")

    cuts = coded.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(-(2**63)).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, keys, "right").astype(np.int32)), *batch.columns], ["bucket", *batch.schema.names])

    recipes = coded.mapInArrow(bucket, "bucket int, doc_id long, n_tokens long, chunks array<binary>, root binary")
    sums = recipes.groupBy("bucket").agg(F.sum("n_tokens").alias("_n"))
    sums = sums.select(F.col("bucket").alias("_bucket"), F.coalesce(F.sum("_n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("bucket").orderBy("doc_id", "root").rowsBetween(Window.unboundedPreceding, -1)
    placed = recipes.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(sums, F.col("bucket") == F.col("_bucket"))
    placed = placed.select("bucket", "doc_id", (F.col("_before") + F.col("_in")).alias("start"), "n_tokens", "chunks", "root")
    placed.repartitionByRange(n, "bucket").sortWithinPartitions("bucket", "start").write.parquet(f"{path}/recipes")

    _buckets(spark, path).drop("start").write.parquet(f"{path}/manifest")


class Chain:
    """The Merkle root of leaves that come one by one: one hash for each power of two of leaves seen, whatever their number."""

    def __init__(self) -> None:
        self.peaks: list[tuple[int, bytes]] = []

    def add(self, leaf: bytes) -> None:
        height = 0
        while self.peaks and self.peaks[-1][0] == height:
            leaf, height = hashlib.sha256(b"\1" + self.peaks.pop()[1] + leaf).digest(), height + 1
        self.peaks.append((height, leaf))

    def root(self) -> bytes:
        out = b""
        for _, peak in reversed(self.peaks):
            out = hashlib.sha256(b"\1" + peak + out).digest() if out else peak
        return out


def leaf(doc_id: int | None, start: int, n_tokens: int, root: bytes) -> bytes:
    """What a bucket's root covers of a document: who it is, where it begins, how long it is, and its chunks."""
    return hashlib.sha256(b"\2" + f"{doc_id},{start},{n_tokens},".encode() + root).digest()


def _buckets(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, documents, tokens, root, start) as recipes/ give them; start, the first document's, is null
    where the others' don't follow from it."""
    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, list] = {}
        for batch in batches:
            for b, tokens, root, start, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = state.setdefault(b, [0, 0, Chain(), start])
                if x[3] is not None and start != x[3] + x[1]:
                    x[3] = None
                x[0] += 1
                x[1] += tokens
                x[2].add(leaf(doc_id, start, tokens, root))
        columns = [[*state], *([x[i] for x in state.values()] for i in (0, 1)), [x[2].root() for x in state.values()], [x[3] for x in state.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], ["bucket", "documents", "tokens", "root", "start"])

    stored = spark.read.parquet(f"{path}/recipes").select("bucket", "n_tokens", "root", "start", "doc_id")
    stored = stored.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "doc_id", "root", "start")
    return stored.mapInArrow(roots, "bucket int, documents long, tokens long, root binary, start long")


def verify(spark: SparkSession, path: str) -> None:
    """Raises where recipes/ don't give the counts, tokens and roots of manifest/, or other starts."""
    try:
        kept = spark.read.parquet(f"{path}/manifest")
    except AnalysisException as e:
        raise ValueError(f"{path} can't be rebuilt: it has no manifest") from e
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.select(F.col("bucket").alias("_bucket"), F.struct("documents", "tokens", "root", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")).alias("_kept"))
    found = _buckets(spark, path).select("bucket", F.struct("documents", "tokens", "root", "start").alias("_found"))
    wrong = found.join(kept, F.col("bucket") == F.col("_bucket"), "full").where(~F.col("_found").eqNullSafe(F.col("_kept"))).select(F.coalesce("bucket", "_bucket")).first()
    if wrong:
        raise ValueError(f"bucket {wrong[0]} can't be rebuilt: its recipes differ from the manifest")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("kind string, hash binary, n int, data binary").parquet(f"{path}/parts").where("kind = 'chunk'").select("hash", "n", "data")


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/recipes").select("doc_id", "start", "n_tokens", "root", F.posexplode("chunks").alias("_k", "hash"))


def read_digests(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    Each stored chunk is read, checked against its hash and reduced to count and CRC; documents' CRCs
    follow from their chunks' by arithmetic, so no ids are shuffled.  A missing or damaged chunk, a
    recipe that doesn't give its root or its count raises; recipes that differ from the manifest do at once.
    """
    verify(spark, path)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, data = (c.to_pylist() for c in batch.columns)
            crcs, sizes = [], []
            for h, x in zip(hashes, data, strict=True):
                ids = unpack_ids(x, 4 if wide else 2)
                if hashlib.sha256(ids).digest()[:16] != h:
                    raise ValueError(f"damaged chunk {h.hex()}")
                crcs.append(zlib.crc32(ids))
                sizes.append(len(ids) // 4)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crcs, pa.int64()), pa.array(sizes, pa.int32())], ["hash", "crc", "size"])

    chunk = _chunks(spark, path).select("hash", "data").mapInArrow(reduce, "hash binary, crc long, size int")
    parts = _pointers(spark, path).join(chunk, "hash", "left").groupBy("doc_id", "start", "n_tokens", "root").agg(F.array_sort(F.collect_list(F.struct("_k", "hash", "crc", "size"))).alias("parts"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, n, root, parts in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if any(p["crc"] is None for p in parts) or merkle([p["hash"] for p in parts]) != root or sum(p["size"] for p in parts) != n:
                    raise ValueError(f"document {key} can't be rebuilt")
                out.append(crc_of_parts([(p["crc"], 4 * p["size"]) for p in parts]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return parts.mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the ids themselves, little-endian unsigned 32-bit, put together again.

    Chunks go to every document that has them; memory follows the longest document.  Recipes that differ
    from the manifest raise at once."""
    verify(spark, path)
    chunk = _chunks(spark, path).select("hash", "data")
    parts = _pointers(spark, path).join(chunk, "hash").groupBy("doc_id", "start", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("_k", "data"))).alias("parts"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(unpack_ids(p["data"], 4 if wide else 2) for p in x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return parts.mapInArrow(join, "doc_id long, start long, n_tokens long, ids binary")
