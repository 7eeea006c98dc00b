"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.llm.tables import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id in `links` (a, b): the smallest id that links reach.

    Each round every id takes the least label among its neighbours' and its own, then its label's
    label, so long chains halve; rounds end when no label changes.  All steps are joins and
    aggregations; each round's labels are a written table that goes with the next round's.
    """
    written = scratch.written
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    last = labels
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy(F.col("a").alias("_a")).agg(F.min("component").alias("_near"))
        stepped = labels.join(near, F.col("id") == F.col("_a")).select("id", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        jump = stepped.select(F.col("id").alias("_to"), F.col("_new").alias("_root"))
        new = written(stepped.join(jump, F.col("_new") == F.col("_to"), "left").select("id", "_old", F.least("_new", F.coalesce("_root", "_new")).alias("component")))
        scratch.drop(last)
        labels, last = new.select("id", "component"), new
        if new.where("_old <> component").isEmpty():
            scratch.drop(both)
            return labels
