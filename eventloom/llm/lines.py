"""Line dedup by distinct-site spread: HyperLogLog sketches, exact counts near the threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.tables import Scratch, fields, join_frequent, with_lists

#: log2 of a sketch's registers, and how many standard errors around the threshold are counted exactly.
LOG_REGISTERS, ERRORS = 12, 6


def line_table(texts: K.Texts, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    r"""Starts, ends and rows of the \n-split lines of `min_words` words or more, and the digests of what
    they hold between the white space at their ends."""
    starts, ends, _ = texts.words()
    a, b, first = texts.lines()
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    lo, hi = np.searchsorted(starts, a), np.searchsorted(starts, b)
    long = hi - lo >= max(1, min_words)
    a, b, row, lo, hi = a[long], b[long], row[long], lo[long], hi[long]
    return a, b, row, K.digests(texts.buf, starts[lo], ends[hi - 1])


def spread_lines(df: DataFrame, site: str = "source", key: str = "doc_id", text: str = "text", min_sites: int = 5, min_words: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """Removes boilerplate: lines found on `min_sites` distinct sites or more, except in the document of the
    smallest key that holds them.  Adds n_lines (those of `min_words` words or more) and n_removed.

    Lines are told apart by 128-bit digests of their bytes.  One sketch per line, merged by aggregation,
    estimates its distinct sites.  Estimates within ERRORS standard errors (and one site at least) of the
    threshold are replaced by exact distinct counts of those lines only.  Lines of very many documents
    are broadcast, so that no task joins all their rows.  The first holder keeps its lines, so copies of a
    whole text do not lose it everywhere.  A null site counts as one site; null and empty texts stay as
    they are; rows of null key keep all lines; rows that share a key count as one document; an empty table
    gives no rows.  A text that loses no line is not changed.  Other columns pass through, whatever their
    names, except that n_lines and n_removed are replaced.
    """
    scratch = scratch or Scratch(df.sparkSession)
    df = df.drop("n_lines", "n_removed")
    names = ["_doc", "_site", "_a", "_b"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sites = batch.column(0), batch.column(1)
            for part in K.blocks(batch.column(2)):
                _, _, row, line = line_table(part, min_words)
                order = np.lexsort((line[:, 1], line[:, 0], row))
                row, line = row[order], line[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1]).any(axis=1)
                at = pa.array(row[new] + part.first)
                yield pa.RecordBatch.from_arrays([keys.take(at), sites.take(at), *(pa.array(line[new, k].view(np.int64)) for k in (0, 1))], names)

    named = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_doc"), F.when(F.col(site).isNull(), "").otherwise(F.concat(F.lit("="), F.col(site).cast("string"))).alias("_site"), F.col(text))
    lines = scratch.written(named.mapInArrow(cut, "_doc long, _site string, _a long, _b long"))
    margin = max(1.0, ERRORS * 1.04 / 2 ** (LOG_REGISTERS / 2) * min_sites)
    spread = lines.groupBy("_a", "_b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LOG_REGISTERS))).alias("_sites"), F.min("_doc").alias("_first"), F.count("*").alias("_n"))
    spread = scratch.written(spread.where(F.col("_sites") >= min_sites - margin))
    near = scratch.written(spread.where(F.col("_sites") <= min_sites + margin).select("_a", "_b", "_n"))
    exact = join_frequent(lines, near, ["_a", "_b"], "_n").groupBy("_a", "_b").agg(F.count_distinct("_site").alias("_exact"))
    boilerplate = spread.join(exact, ["_a", "_b"], "left").where(F.coalesce("_exact", "_sites") >= min_sites).select("_a", "_b", "_first", "_n")
    boilerplate = scratch.written(boilerplate)
    gone = join_frequent(lines, boilerplate, ["_a", "_b"], "_n").where(F.col("_doc") != F.col("_first")).groupBy("_doc").agg(F.collect_set(F.struct("_a", "_b")).alias("_gone"))
    gone = scratch.written(gone)
    scratch.drop(lines, spread, near, boilerplate)

    kept = df.columns

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = batch.column(0), batch.column(1)
            columns, at = rows.flatten(), rows.type.get_field_index(text)
            texts, counts, removed = columns[at].to_pylist(), np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for part in K.blocks(columns[at]):
                a, b, row, line = line_table(part, min_words)
                counts[part.first : part.first + len(part)] = np.bincount(row, minlength=len(part))
                begin = np.searchsorted(row, np.arange(len(part) + 1))
                for i in range(len(part)):
                    if not lists[part.first + i].is_valid:
                        continue
                    own = slice(begin[i], begin[i + 1])
                    out = lists[part.first + i].values
                    out = set(zip(*(out.field(k).to_pylist() for k in (0, 1)), strict=True))
                    drop = np.array([x in out for x in map(tuple, line[own].view(np.int64).tolist())], bool)
                    raw, last, left = part.buf[part.offsets[i] : part.offsets[i + 1]].tobytes(), 0, []
                    for x, y in zip(a[own][drop] - part.offsets[i], b[own][drop] - part.offsets[i], strict=True):
                        left.append(raw[last:x])
                        last = y + 1
                    left.append(raw[last:])
                    removed[part.first + i] = int(drop.sum())
                    texts[part.first + i] = b"".join(left).decode()
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts), pa.array(removed)], [*kept, "n_lines", "n_removed"])

    return with_lists(df, {"_doc": F.col(key).cast("long")}, gone).mapInArrow(strip, f"{fields(df)}, n_lines long, n_removed long")
