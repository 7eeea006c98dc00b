"""Incremental ingestion: logs, upserts, usage, gates, stream joins, counts."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventloom.functions.clean import table_fingerprint
from eventloom.operators import manifest

#: How often a batch is tried while other writers commit between its reading and its commit.
ATTEMPTS = 5


def new_files(spark: SparkSession, path: str, schema: str, form: str = "parquet", files_per_batch: int = 100, latest_first: bool = False, max_age: str | None = None) -> DataFrame:
    """Rows of files that arrive below a path, a bounded number of files a batch."""
    reader = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_batch).option("latestFirst", latest_first)
    return (reader.option("maxFileAge", max_age) if max_age else reader).load(path)


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Handles what there is, then stops; a later run goes on from the checkpoint."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark has given the query of a checkpoint: another checkpoint is another stream."""
    return json.loads(manifest.read_text(spark, f"{checkpoint}/metadata"))["id"]


def upsert_stream(updates: DataFrame, root: str, seq: str, path: str, fields: Sequence[str], checkpoint: str, provenance: Sequence[str] = ()) -> StreamingQuery:
    """Takes what there is of a stream of updates into the manifest under root (`manifest.create` made it), then stops.

    Each batch is one commit on the newest version, whoever wrote it, of the buckets that have updates.  The commit
    names the stream and the batch, so a batch that runs again changes nothing, and a batch that meets another
    writer's commit is tried again on that one's version.
    """
    def apply(batch: DataFrame, number: int) -> None:
        rows = batch.persist()  # read for its buckets, then for its rows
        try:
            stream = _stream_id(batch.sparkSession, checkpoint)
            for attempt in range(ATTEMPTS):
                try:
                    manifest.upsert(root, rows, seq, path, fields, stream, number, provenance)
                    return
                except manifest.CommitConflict:
                    if attempt == ATTEMPTS - 1:
                        raise
        finally:
            rows.unpersist()

    return run_available(updates.writeStream.foreachBatch(apply), checkpoint)


class ManifestMismatch(RuntimeError):
    """The manifest isn't the one that the checkpoint was made with."""


def run_guarded(writer, checkpoint: str, rows: DataFrame, key: str) -> StreamingQuery:
    """As `run_available`, if the manifest `rows` is the one that the checkpoint knows.

    Beside the checkpoint stand the least and greatest key and the content fingerprint of the manifest of the last
    start.  Rows up to that greatest key must be the same now; else ManifestMismatch is raised before any batch.
    Rows of greater keys are new, and the run goes on with them.  A manifest without rows or keys is like any other.
    """
    spark, path = rows.sparkSession, f"{checkpoint.rstrip('/')}-manifest.json"
    fs, at = manifest.file_system(spark, path)

    def identity(df: DataFrame) -> dict[str, str | None]:
        ends = df.agg(F.min(key).cast("string").alias("least"), F.max(key).cast("string").alias("greatest")).first()
        found = table_fingerprint(df.select(*sorted(df.columns))).first()
        return ends.asDict() | {k: None if v is None else str(v) for k, v in found.asDict().items()}

    if fs.exists(at):
        known = json.loads(manifest.read_text(spark, path))
        limit = F.lit(known["greatest"]).cast(rows.schema[key].dataType)
        same = identity(rows.where(F.col(key).isNull() | (F.col(key) <= limit)))
        wrong = [k for k in known if known[k] != same[k]]
        if wrong:
            raise ManifestMismatch(f"{checkpoint} was made with another manifest: {', '.join(f'{k} was {known[k]} and is {same[k]}' for k in wrong)}")
    out = fs.create(at, True)
    out.write(json.dumps(identity(rows)).encode())
    out.close()
    return run_available(writer, checkpoint)


def usage_once(rows: DataFrame, time: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """The first row of each key within the delay."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def _packed(df: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(df, schema=_WAITING, preserve_index=False)
    with pa.ipc.new_stream(sink, _WAITING, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


#: A slice's state in `t0_gate_stream`: a row for each waiting row, and one for each event whose t0 is known (0 or 1).
_WAITING = pa.schema([("event", pa.string()), ("timepoint", pa.string()), ("waits", pa.bool_()), ("t0", pa.int8()), ("due", pa.int64())])


def t0_gate_stream(rows: DataFrame, event: str, time: str, delay: str, wait_ms: int, slices: int = 256) -> DataFrame:
    """Rows of other timepoints wait for their event's t0: then `proceed` or `skip_t0_failed`; after
    wait_ms of event time without one, `skip_t0_failed`.  A t0 is known for as long.

    rows: event, timepoint, ok, time.  Events are dealt to `slices` by hash, and a batch handles all events of a slice
    at once: Python is called once for a slice, not once for an event.  State: the waiting rows and known t0s of a
    slice's events, packed; it is written again when rows of the slice come or its first wait ends.  A slice should
    have some ten thousands of waiting events at most.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        old = pa.ipc.open_stream(bytes(state.get[0])).read_all().to_pandas() if state.exists else _WAITING.empty_table().to_pandas()
        new = [] if state.hasTimedOut else [f for f in frames if len(f)]
        new = pd.concat(new) if new else pd.DataFrame(columns=["event", "timepoint", "ok", "_ms"])
        codes, events = pd.factorize(np.concatenate([old["event"].to_numpy(object), new["event"].to_numpy(object)]))
        n = len(events)
        codes = np.where(codes < 0, n, codes)  # rows of no event: no t0 is theirs
        before, now = codes[: len(old)], codes[len(old) :]
        t0, due, latest, seen = np.full(n + 1, -1), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n + 1, bool)
        t0[before], due[before], seen[now] = old["t0"], old["due"], True
        is_t0, ok = (new["timepoint"] == "t0").to_numpy(bool), new["ok"].eq(True).fillna(False).to_numpy(bool)
        t0[now[is_t0]] = ok[is_t0]  # of several, the last
        t0[n] = -1
        # Every wait ends: it counts from the watermark, or from the rows' times before there is one.
        np.maximum.at(latest, now, new["_ms"].fillna(0).to_numpy(np.int64))
        due[seen] = np.maximum(mark, latest[seen]) + wait_ms
        over = ~seen & (due < mark)
        waits = old["waits"].to_numpy(bool)
        at = np.concatenate([before[waits], now[~is_t0]])
        names = np.concatenate([old["timepoint"].to_numpy(object)[waits], new["timepoint"].to_numpy(object)[~is_t0]])
        named = np.append(events.astype(object), None)
        told = (t0[at] >= 0) | over[at]
        out = pd.DataFrame({"event": named[np.concatenate([now[is_t0], at[told]])], "timepoint": np.concatenate([new["timepoint"].to_numpy(object)[is_t0], names[told]])})
        out["gate"] = np.concatenate([np.where(ok[is_t0], "t0_ok", "t0_failed"), np.where(t0[at[told]] == 1, "proceed", "skip_t0_failed")])
        known = np.flatnonzero((t0 >= 0) & ~over)
        left, place = at[~told], np.concatenate([at[~told], known])
        if len(place):
            kept = pd.DataFrame({"event": named[place], "timepoint": np.concatenate([names[~told], np.full(len(known), None)]), "waits": np.arange(len(place)) < len(left), "t0": t0[place].astype(np.int8), "due": due[place]})
            state.update((_packed(kept),))
            state.setTimeoutTimestamp(int(due[place].min()))
        elif state.exists:
            state.remove()
        if len(out):
            yield out

    keyed = rows.withWatermark(time, delay).select(F.col(event).cast("string").alias("event"), "timepoint", "ok", time, F.unix_millis(F.col(time)).alias("_ms"))
    keyed = keyed.withColumn("_slice", F.pmod(F.xxhash64("event"), F.lit(slices)))
    return keyed.groupBy("_slice").applyInPandasWithState(step, "event string, timepoint string, gate string", "waiting binary", "append", GroupStateTimeout.EventTimeTimeout)


def match_streams(events: DataFrame, products: DataFrame, key: str, event_time: str, product_time: str, window: str, delay: str) -> DataFrame:
    """Inner join of two streams on key, the product within the window of the event on either side."""
    e = events.withWatermark(event_time, delay).alias("e")
    p = products.withWatermark(product_time, delay).withColumnRenamed(key, f"_{key}").alias("p")
    on = (F.col(key) == F.col(f"_{key}")) & F.expr(f"{product_time} between {event_time} - interval {window} and {event_time} + interval {window}")
    return e.join(p, on).drop(f"_{key}")


def status_counts(rows: DataFrame, time: str, status: str, delay: str = "10 minutes", window: str = "10 minutes") -> DataFrame:
    """Rows of each status in windows of time."""
    return rows.withWatermark(time, delay).groupBy(F.window(time, window), status).agg(F.count("*").alias("n"))


def updates_to_files(df: DataFrame, path: str, mode: str = "update") -> DataFrame:
    """Runs a stream over what there is and gives its rows back from files below `path`, a folder for each batch: a
    batch that runs again overwrites its own.  In update mode a key has a row for each batch that changed it."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_available(df.writeStream.outputMode(mode).foreachBatch(write), f"{path}-checkpoint")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch=*")

