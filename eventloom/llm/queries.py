"""The queries opN_<name>: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.llm import align, bpe, extract, fingerprint, lines, near, packing, quality, recompress, repetition, shards, store, variants
from eventloom.llm.tables import Scratch, read, short_batches

Query = Callable[[SparkSession, str], DataFrame]


def text_bytes(text: str = "text") -> Column:
    return F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)  # texts are long, and the result is lazy: it stays set
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN).drop("text"), vocabulary, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, quality.fit(docs, read(spark, sf_dir, "labels"))).drop("text")


def op4_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = text_bytes()
    rows = read(spark, sf_dir, "documents").select("doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.md5(data).alias("text_md5"))
    out = shards.shard(rows, "size", ["text_md5", "size"], ["doc_id"], n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.jaccard_components(read(spark, sf_dir, "documents"), near.Jaccard(words=4, percent=85))


def op6_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=1, capacity=2048)
    with short_batches(spark):
        pieces = scratch.written(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
    return packing.pack(pieces, capacity=2048, scratch=scratch)


def op7_content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path()
    with short_batches(spark):
        store.write_store(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return store.read_digests(spark, path)


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.drop_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), window=50).drop("text")


def op9_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(read(spark, sf_dir, "documents"))


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 5 words or more, as OP10_SQL has it, on 5 of the 20 sites or more go, but for their first document."""
    out = lines.spread_lines(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), min_words=5)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(text_bytes(), 256).alias("kept_sha256"))


def op11_boosted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages, extract.fit(pages), keep_html=False)


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_spellings(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_repetition, op3_weak_labels, op4_best_fit_shards, op5_grouped_prefix_join, op6_cutting_stock, op7_content_store, op8_recompression, op9_piecewise_hash, op10_line_spread, op11_boosted_blocks, op12_lockstep_alignment, op13_spelling_variants)}


WORDS = r"[^\x20\x09-\x0D]+"

OP5_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS sh FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 3)) AS i FROM w) UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, t) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.t = e.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(t) AS component_id FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY 1"""

OP8_SQL = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w)), f AS (SELECT k, min(doc_id) AS first FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN f USING (k) WHERE first < doc_id),
t AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.p) AS kept FROM t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p WHERE g.p IS NULL GROUP BY 1), c AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id LEFT JOIN c ON w.doc_id = c.doc_id"""

OP10_SQL = f"""WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS site, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), u AS (SELECT doc_id, site, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
l AS (SELECT *, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS k, len(regexp_extract_all(line, '{WORDS}')) >= 5 AS long FROM u), b AS (SELECT k, min(doc_id) AS first FROM l WHERE long GROUP BY 1 HAVING count(DISTINCT site) >= 5),
m AS (SELECT l.*, long AND b.k IS NOT NULL AND b.first <> doc_id AS gone FROM l LEFT JOIN b ON l.k = b.k)
SELECT doc_id, count(*) FILTER (long) AS n_lines, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(line || CASE WHEN p = n THEN '' ELSE chr(10) END, '' ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    """The others' methods (merges, suffix arrays, trained scorers, packings, stores, fingerprints) are beyond
    SQL; tests hold them against brute force."""
    return {"op5_grouped_prefix_join": OP5_SQL, "op8_recompression": OP8_SQL, "op10_line_spread": OP10_SQL}
