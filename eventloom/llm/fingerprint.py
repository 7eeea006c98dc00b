"""Document fingerprints by context-triggered piecewise hashing, and their likeness."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.tables import partitions

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)
#: Bytes that the rolling hash sees; most chunks of a signature; least block size (a power of two).
WINDOW, MOST, LEAST = 7, 64, 2
#: Signatures without a common run of this many letters have nothing in common.
COMMON = 7


def fingerprint(data: bytes) -> str:
    """`exponent:signature:signature at twice the block size`.

    A chunk ends where the rolling hash of the last WINDOW bytes has its low `exponent` bits set, so
    borders follow content; each chunk gives one letter.  The exponent is the least with no more than
    MOST chunks, whatever the text's length.
    """
    n = len(data)
    if not n:
        return f"{LEAST}::"
    buf = np.frombuffer(data, np.uint8)
    cum = np.zeros(n + 1, np.uint64)
    np.cumsum(K._VALUES[0][buf] * K._power(0, n), out=cum[1:])
    inverse = K._power(0, n + 1, True)
    if n >= WINDOW:
        roll = (cum[WINDOW:] - cum[:-WINDOW]) * inverse[: n - WINDOW + 1]
        roll ^= roll >> np.uint64(32)
        at = np.flatnonzero((roll & np.uint64(2**LEAST - 1)) == 2**LEAST - 1)
        roll = roll[at]
        at = at + WINDOW
    else:
        at = roll = np.zeros(0, np.uint64)
    exponent = LEAST

    def cut(e: int) -> np.ndarray:
        low = np.uint64(2**e - 1)
        ends = at[(roll & low) == low].astype(np.int64)
        return ends if len(ends) and ends[-1] == n else np.append(ends, n)

    while len(ends := cut(exponent)) > MOST and exponent < 63:
        exponent += 1

    def letters(ends: np.ndarray) -> str:
        starts = np.concatenate([[0], ends[:-1]])
        h = K.mix((cum[ends] - cum[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        return _LETTERS[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    return f"{exponent}:{letters(ends)}:{letters(cut(exponent + 1))}"


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over `a`."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for c in b:
        u = v & places.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _score(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(COMMON, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * common_letters(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) as a share of both lengths; 1 for equal
    fingerprints, 0 for block sizes more than one doubling apart or without a common run."""
    if a == b:
        return 1.0
    (p, a1, a2), (q, b1, b2) = a.split(":"), b.split(":")
    p, q = int(p), int(q)
    if p == q:
        return max(_score(a1, b1), _score(a2, b2) if a2 and b2 and min(len(a2), len(b2)) > 1 else 0.0)
    if p == q + 1:
        return _score(a1, b2)
    if q == p + 1:
        return _score(a2, b1)
    return 0.0


def fingerprints(df: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each whole text; null counts as empty.  No shuffle."""
    df = df.drop(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t or "").encode()) for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, to])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)
    return df.mapInArrow(run, f"{fields}, `{to}` string")


EDIT_COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint against its edited text's and its successor's, in the order of `key`.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next row
    (after the last row: the first).  Rows go once over the network, to ranges of `key` that begin at
    keys of the table; a copy of each range's first row ends the range before, so no row waits for
    another task.  Rows of equal key are ordered by text, null keys come first, a null text is empty,
    a table's only row is its own successor; an empty table gives none.  Memory: two texts a task.
    """
    schema = f"`{key}` long, {EDIT_COLUMNS}"
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("_key"), F.col(key).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    n = 2 * partitions(spark)
    bounds = rows.agg(F.min("_key").alias("least"), F.percentile_approx("_key", [k / n for k in range(1, n)], 10 * n).alias("cuts")).first()
    if bounds.least is None:
        return spark.createDataFrame([], schema)
    bounds = np.unique([bounds.least, *bounds.cuts])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(bounds, keys, "right") - 1
            first = np.flatnonzero(bounds[bucket] == keys)
            for rows, at, tail in ((batch, bucket, False), (batch.take(pa.array(first)), (bucket[first] - 1) % len(bounds), True)):
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(at.astype(np.int32)), pa.array(np.full(len(at), tail))], ["_key", "_id", "_text", "_bucket", "_tail"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0].strip("`") for c in schema.split(", ")]
        last = None
        for batch in batches:
            out = []
            for _, key, text, bucket, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tail and last is None:
                    continue  # further rows that share the next range's first key
                mark = fingerprint(text.encode())
                if last is not None and last[0] == bucket:
                    _, own, before, before_mark = last
                    half = len(before) // 2
                    edited = (before[: len(before) - half] + text[:half]).encode()
                    edited_mark = fingerprint(edited)
                    out.append((own, len(before), hashlib.sha256(edited).hexdigest(), before_mark, edited_mark, likeness(before_mark, edited_mark), likeness(before_mark, mark)))
                last = None if tail else (bucket, key, text, mark)
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    dealt = rows.mapInArrow(deal, "_key long, _id long, _text string, _bucket int, _tail boolean")
    ordered = dealt.repartition(partitions(spark), "_bucket").sortWithinPartitions("_bucket", "_tail", "_key", "_text")
    return ordered.mapInArrow(judge, schema)
