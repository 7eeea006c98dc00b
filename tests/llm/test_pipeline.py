from __future__ import annotations

import corpus_pipeline

from eventloom.llm import lines, near
from eventloom.llm.tables import Scratch, read

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_promises(spark):
    docs, kept = read(spark, SF, "documents"), Scratch(spark)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "n-gram Jaccard join", "substring dedup", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept.written(stage(spark, docs, SF))
        assert docs.columns == columns and docs.schema == read(spark, SF, "documents").schema, name
        assert 0 < docs.count() <= before
        before = docs.count()
        if name == "n-gram Jaccard join":
            left = near.jaccard_components(docs, near.Jaccard(5, 80))
            assert left.where("component_id <> doc_id").count() == 0
    packed = stages["packing"](spark, docs, SF).toPandas()
    assert set(packed["doc_id"]) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_empty_input(spark):
    docs, kept = read(spark, SF, "documents").limit(0), Scratch(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = kept.written(stage(spark, docs, SF))
    assert docs.count() == 0


def test_line_dedup_keeps_own_text(spark):
    """Where shared lines outweigh a document's own text, that text stays; a document of shared lines alone goes."""
    line = "a long line of boilerplate that every page of each of the sites carries"
    texts = {i: f"{line}\nown{i}" for i in range(12)} | {100: line, 101: None, 102: "", 103: " \n", 104: f" {line} \n\n \t\n{line}"}
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 6}", len(t or "")) for i, t in texts.items()], read(spark, SF, "documents").schema)
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    want = {i: f"own{i}" if 0 < i < 100 else t for i, t in texts.items() if i not in (100, 104)}
    assert got == {i: (t, len(t or "")) for i, t in want.items()}


def test_line_dedup_counts_short_lines(spark):
    """Lines of one to four words go like longer ones; those on fewer sites than the threshold stay."""
    texts = {i: f"All rights reserved.\nown text of {i}\n -\nHome" if i < 4 else f"All rights reserved.\nown text of {i}\n - " for i in range(12)}
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 6}", len(t)) for i, t in texts.items()], read(spark, SF, "documents").schema)
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {0: texts[0]} | {i: f"own text of {i}\nHome" if i < 4 else f"own text of {i}\n" for i in range(1, 12)}


def test_results_outlive_a_pipeline_run(spark):
    """A lazy result of an operator reads scratch tables of its own; a run deletes only what it made."""
    docs = read(spark, SF, "documents")
    held, n = lines.spread_lines(docs), docs.count()
    packed = corpus_pipeline.run(spark, SF)
    assert held.count() == n and packed.count() > 0


def test_stages_on_odd_rows(spark):
    """Nulls in every column, empty texts, a very long one, repeated rows and rows that share a doc_id."""
    schema = read(spark, SF, "documents").schema
    long = " ".join(f"w{k % 5000}" for k in range(60_000))
    rows = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", "en", "s", 0), (3, "a few words here", "en", "s", 16), (3, "a few words here", "en", "s", 16), (3, "other words", None, "t", 11), (4, long, "en", "u", len(long))]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(rows, schema), SF).toPandas()
        assert len(out) <= (len(rows) if name != "packing" else 300), name
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048


def test_stages_chained_without_writing(spark):
    """Lazy results of stages feed the next stages: none deletes what another reads."""
    docs = read(spark, SF, "documents").limit(60)
    stages = dict(corpus_pipeline.STAGES)
    held = stages["line dedup"](spark, docs, SF)
    for name in ("n-gram Jaccard join", "substring dedup", "packing"):
        held = stages[name](spark, held, SF)
    assert held.count() > 0


def test_two_runs_over_one_folder(spark):
    """Each run deletes only its own tables."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        one, two = pool.map(lambda _: corpus_pipeline.run(spark, SF).count(), range(2))
    assert one == two > 0


def test_release_frees_plans_held_by_cycles(spark):
    """Closures of an operator hold its tables in cycles, and with them plans in the driver's JVM."""
    import weakref

    from eventloom.scratch import release

    df = spark.range(3)
    held = weakref.ref(df)
    cycle = [df]
    cycle.append(cycle)
    del df, cycle
    release(spark)
    assert held() is None
