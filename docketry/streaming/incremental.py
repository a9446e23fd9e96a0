"""Incremental jobs: file streams drained to the end, with writes that may be repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.merge import MergeSpec, merge, replace_children
from ..operators.rank import last_wins
from ..sources.landing import written
from ..sources.snapshots import Catalog


def drain(spark: SparkSession, path: str, schema, sink: Callable[[DataFrame, int], None], checkpoint: str, files_a_batch: int | None = None, fmt: str = "parquet") -> None:
    """Give all files that haven't been processed to sink, batch by batch, then stop. A batch that fails comes again on the next call."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    query = reader.load(path).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def drain_once(spark: SparkSession, path: str, schema, sink: Callable[[DataFrame, int], None], checkpoint: str, key: str, at: str | None = None, horizon: str = "7 days", files_a_batch: int | None = None, fmt: str = "parquet") -> None:
    """As drain, but rows that were delivered before, by their key, are left out: once and again in a batch, a later one, or a later call.

    The keys of the last `horizon` are kept as state, by the column `at` or, without one, by when their file arrived; so state is bounded by what arrives in that time. A row that comes again after
    it is delivered again, and with arrival times no row is ever too late and lost."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    rows = reader.load(path)
    given = rows.columns
    timed = rows.withColumn("__at", F.col(at) if at else F.col("_metadata.file_modification_time"))
    once = timed.withWatermark("__at", horizon).dropDuplicatesWithinWatermark([key]).select(*given)
    once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def deliver(catalog: Catalog, send: Callable[[DataFrame], None], table: str = "events") -> int:
    """Send the events that were committed after those sent last, and write down how far it got. A run that is lost in between sends them again with the same ids; drain_once on the
    other side tells them. Only the new versions are read. Returns the version that is sent."""
    done, now = catalog.read(f"{table}_sent"), catalog.version()
    last = 0 if done is None else done.first()["version"]
    new = catalog.added_since(table, last, now)
    if new is not None:
        send(new)
        catalog.commit({f"{table}_sent": catalog.spark.createDataFrame([(now,)], "version long")})
    return now


def until_complete(chunks: DataFrame, key: str, index: str = "chunk_index", expected: str = "expected", failed: str = "failed", at: str = "at", horizon: str = "7 days") -> DataFrame:
    """A stream of the chunks of whole documents, from a stream of chunks that come in any order and may come again.

    chunks have the number of chunks that their document has (expected) and why theirs could not be made (failed; null if it could). A document's chunks are held back as state until all are there;
    then they are given out, with outcome Complete. The first that failed drops what is held of its document and gives one row with outcome Failed and the reason. What comes after either is
    left out, as a mark stays until the horizon has passed, by the column `at` (when a chunk came); so does what is held of a document that is never whole. State is one document at most a key.
    Python is called once for each document of a batch, at some milliseconds each; for very many documents see complete_sink."""
    names, schema = chunks.columns, chunks.schema
    timed = chunks.withColumn("__ms", F.unix_millis(at)).withWatermark(at, horizon)

    def step(document, parts, state):
        import pickle

        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        held: dict | None = pickle.loads(state.get[0]) if state.exists else {}
        out, last = [], state.getCurrentWatermarkMs()
        for part in parts:
            last = max(last, int(part.pop("__ms").max()))
            for row in part.to_dict("records"):
                if held is None:
                    continue
                if isinstance(row[failed], str):
                    held = None
                    out.append({key: document[0], failed: row[failed], "outcome": "Failed"})
                elif row[index] not in held:
                    held[row[index]] = row
                    if len(held) == row[expected]:
                        out += [{**held[k], "outcome": "Complete"} for k in sorted(held)]
                        held = None
        state.update((pickle.dumps(held),))
        state.setTimeoutTimestamp(last + 1)  # the watermark is there when the horizon has passed
        if out:
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in out], dtype=object) for n in (*names, "outcome")})

    kind = T.StructType([*schema.fields, T.StructField("outcome", T.StringType())])
    for f in kind.fields:
        f.nullable = True
    return timed.groupBy(key).applyInPandasWithState(step, kind, "held binary", "append", "EventTimeTimeout")


def complete_sink(catalog: Catalog, table: str, key: str, index: str = "chunk_index", expected: str = "expected", failed: str = "failed", at: str = "at", horizon: str = "7 days") -> Callable[[DataFrame, int], None]:
    """A sink that appends the chunks of whole documents, with outcome, to a table of the catalog, as until_complete gives them, but with joins and windows over all documents of a batch.

    What is held back and which documents are over stands in {table}_held, dealt by key, of which a batch reads and writes the parts that it touches; the latest `at` and the batch in {table}_batch. All become
    current in one version, so that a batch that comes again changes nothing. Within a batch a failure counts before completeness. Chunks without a key belong to no document and are left out."""
    held, done = f"{table}_held", f"{table}_batch"

    def sink(batch: DataFrame, number: int) -> None:
        base, before = catalog.version(), catalog.read(done)
        past = before.first() if before is not None else None
        if past is not None and past["batch"] >= number:
            return
        line = F.lit(past["latest"] if past is not None else None).cast("timestamp") - F.expr(f"interval {horizon}")
        rows = batch.where(F.col(key).isNotNull() & F.coalesce(F.col(at) >= line, F.lit(True)))
        came = rows.withColumns({"__over": F.lit(False), "__new": F.lit(True)})
        stored = catalog.touched(held, rows, [key], base)
        if stored is not None:
            came = stored.join(rows.select(key).distinct(), key, "left_semi").drop("__last").withColumn("__new", F.lit(False)).unionByName(came)
        bad = F.col(failed).isNotNull()
        part = F.when(F.col("__over"), "over").when(bad, "bad").otherwise("good")
        one = Window.partitionBy(key, "__part", index).orderBy("__new", at)  # of the same chunk the one that is held
        document = Window.partitionBy(key)
        judged = came.withColumn("__part", part).withColumn("__k", F.row_number().over(one)).where("__k = 1")
        judged = judged.select(
            *batch.columns, "__part", F.max(F.col("__part") == "over").over(document).alias("__over"), F.min(failed).over(document).alias("__why"), F.count(F.when(F.col("__part") == "good", 1)).over(document).alias("__n"),
            F.max(expected).over(document).alias("__of"), F.max(at).over(document).alias("__last"), F.row_number().over(document.orderBy("__part", index)).alias("__row"),
        )
        end = F.when(F.col("__over"), "Over").when(F.col("__why").isNotNull(), "Failed").when(F.col("__n") >= F.col("__of"), "Complete").otherwise("Held")
        judged = written(judged.withColumn("outcome", end))
        whole = judged.where("outcome = 'Complete'").select(*batch.columns, "outcome")
        only = {key: F.col(key), failed: F.col("__why")}
        lost = judged.where("outcome = 'Failed' AND __row = 1").select(*[only.get(c, F.lit(None).cast(batch.schema[c].dataType)).alias(c) for c in batch.columns], "outcome")
        marks = judged.where("outcome <> 'Held' AND __row = 1").select(*[(F.col(key) if c == key else F.col("__last") if c == at else F.lit(None).cast(batch.schema[c].dataType)).alias(c) for c in batch.columns], F.lit(True).alias("__over"), "__last")
        state = judged.where("outcome = 'Held'").select(*batch.columns, F.lit(False).alias("__over"), "__last").unionByName(marks)
        latest = batch.agg(F.max(at)).first()[0]
        latest = max((x for x in (latest, past["latest"] if past is not None else None) if x is not None), default=None)
        gone = F.coalesce(F.col("__last") < F.lit(latest).cast("timestamp") - F.expr(f"interval {horizon}"), F.lit(False))
        keep = lambda s, n: (n if s is None else replace_children(s, n, [key])).where(~gone)
        progress = catalog.spark.createDataFrame([(number, latest)], "batch long, latest timestamp")
        catalog.commit({done: progress}, {table: whole.unionByName(lost)}, {held: (state, [key], keep)}, base)

    return sink


def upsert_sink(catalog: Catalog, table: str, spec: MergeSpec, order: str) -> Callable[[DataFrame, int], None]:
    """Merge each batch into the parts of a table of the catalog that it touches: of a key's rows in a batch the last counts, and a row older than the stored one by `order` changes
    nothing. So batches may come twice or late."""
    guarded = MergeSpec(spec.keys, spec.update, spec.keep_if_null, lambda s, i: s(order).isNull() | (i(order) >= s(order)), spec.on_update)

    def sink(batch: DataFrame, _: int) -> None:
        rows = last_wins(batch, list(spec.keys), order)
        catalog.commit({}, upserts={table: (rows, list(spec.keys), lambda stored, new: new if stored is None else merge(stored, new, guarded))})

    return sink


def since(spark: SparkSession, last_end, now, buffer_seconds: int, initial_seconds: int) -> "F.Column":
    """Where an incremental load begins: the last successful end less a buffer, or, without one, the initial look-back."""
    start = F.lit(last_end).cast("timestamp") - F.expr(f"make_dt_interval(0, 0, 0, {buffer_seconds})")
    return F.coalesce(start, F.lit(now).cast("timestamp") - F.expr(f"make_dt_interval(0, 0, 0, {initial_seconds})"))


def complete_documents(chunks: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys of which as many chunks are stored as are expected."""
    n = chunks.groupBy(key).agg(F.count("*").alias("_n"))
    return expected.join(n, key, "left").where(F.coalesce("_n", F.lit(0)) == F.col("expected")).select(key)


def without_failed(rows: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Rows of documents none of whose batches failed."""
    return rows.join(failed.select(key).distinct(), key, "left_anti")


def outbox(rows: DataFrame, event_type: str, source: str, run: str, payload: list[str]) -> DataFrame:
    """Events as (event_id, type, source, correlation_id, payload): ids follow from the content, so that a repeated run writes the same ones."""
    body = F.to_json(F.struct(*payload))
    return rows.select(F.sha2(F.concat_ws("|", F.lit(event_type), F.lit(run), body), 256).alias("event_id"), F.lit(event_type).alias("type"), F.lit(source).alias("source"), F.lit(run).alias("correlation_id"), body.alias("payload"))
