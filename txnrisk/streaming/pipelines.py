"""Ingest, publish and score streams. The transformations are those of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from threading import Event

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from txnrisk.operators.incremental import not_processed
from txnrisk.operators.messages import CORRUPT, decode, encode
from txnrisk.sources.tables import PathTable

AVAILABLE_NOW = {"availableNow": True}
RECENT = "spark.sql.streaming.numRecentProgressUpdates"
SETTLE_SECONDS = 30  # wait for the last progress of a query that has ended


def _start(writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, object] | None) -> StreamingQuery:
    tally(SparkSession.active())
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def ingest(
    source: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
    stamp: str | None = None,
) -> StreamingQuery:
    """Decode messages and append them to files, exactly once. ``stamp``: a column with the time of ingest.

    One pass writes both good and malformed messages, apart in the partitions
    ``rejected=false`` and ``rejected=true``. Without a trigger it runs continuously.
    """
    rows = decode(source).withColumn("rejected", F.col(CORRUPT).isNotNull())
    if stamp:
        rows = rows.withColumn(stamp, F.current_timestamp())
    writer = rows.writeStream.format(fmt).option("path", path).option("header", True)
    return _start(writer.partitionBy("rejected").outputMode("append"), checkpoint, trigger)


def _part(spark: SparkSession, path: str, rejected: bool) -> DataFrame:
    """One partition of an ingest folder: partition values are read back as text."""
    return spark.read.parquet(path).where(F.col("rejected") == str(rejected).lower())


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """Good rows of a Parquet ingest folder."""
    return _part(spark, path, False).drop("rejected", CORRUPT)


def ingest_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Malformed messages of a Parquet ingest folder."""
    return _part(spark, path, True).select(F.col(CORRUPT).alias("value"), F.lit("malformed message").alias("reason"))


def publish(
    source: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Turn a stream of table rows into ``key``, ``value`` messages."""
    writer = encode(source).writeStream.format(fmt).options(**(options or {}))
    return _start(writer.outputMode("append"), checkpoint, trigger)


def score_stream(
    source: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    key: str = "transaction_id",
    ts: str = "timestamp",
) -> StreamingQuery:
    """Score each micro-batch and store it under ``run=<id>/batch_id=<n>/event_date=<d>``.

    A batch that is run again replaces its own folder only: the run is the id Spark keeps
    in the checkpoint, so a new checkpoint, which counts batches from 0 again, writes
    elsewhere. Messages that were delivered twice are dropped: copies inside a batch by
    value, copies of earlier batches by an anti join on the id that reads only the event
    dates the batch touches.
    """
    target = PathTable(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if run_id is None:
            raise RuntimeError("the stream's id is not known: earlier batches cannot be told from this one")
        batch.persist()
        try:
            rows = batch.dropDuplicates().withColumn("event_date", F.to_date(ts))
            if target.exists(spark):
                own = (F.col("run") == run_id) & (F.col("batch_id") == batch_id)
                # Only the event dates of the batch are read: Spark prunes by the dates at run time.
                dates = rows.select(F.col("event_date").alias("touched")).distinct()
                same_date = F.col("event_date").eqNullSafe(F.col("touched"))
                earlier = target.read(spark).where(~own).join(dates, same_date, "left_semi")
                rows = not_processed(rows, earlier, [key])
            # Few files per date, and a hot date in several.
            scored = score(rows).hint("rebalance", "event_date")
            folder = f"{path}/run={run_id}/batch_id={batch_id}"
            scored.write.mode("overwrite").partitionBy("event_date").parquet(folder)
        finally:
            batch.unpersist()

    return _start(source.writeStream.foreachBatch(write), checkpoint, trigger)


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start_stateful(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query whose state lies in RocksDB, beyond the heap; its checkpoint keeps the choice."""
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def score_once(
    source: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    delay: str,
    trigger: Mapping[str, object] | None = None,
    key: str = "transaction_id",
    ts: str = "timestamp",
) -> StreamingQuery:
    """Score each id once, however often it is delivered, and append to ``event_date=<d>`` folders, exactly once.

    The ids of the last ``delay`` (of event time) are kept in the state store, and forgotten as the watermark
    passes them: the state stays as large as that stretch of the stream, and no earlier output is read. A copy
    that comes later than ``delay`` after the newest time is dropped with all other late rows; the report
    counts them as ``late``. ``score`` may be a saved model: it must only work row by row.

    Rows without a key or a time have no place in the state and are left out; ``unplaced`` has them.
    """
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    once = source.where(known).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    dated = score(once).withColumn("event_date", F.to_date(ts))
    writer = dated.writeStream.format("parquet").option("path", path).partitionBy("event_date").outputMode("append")
    return _start_stateful(source.sparkSession, lambda: _start(writer, checkpoint, trigger))


def unplaced(source: DataFrame, key: str = "transaction_id", ts: str = "timestamp") -> DataFrame:
    """What ``score_once`` leaves out: rows without a key or a time, with the reason."""
    tests = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in (key, ts)]
    return source.withColumn("reason", F.concat_ws("; ", *tests)).where("reason <> ''")


def tally_stream(
    scored: DataFrame,
    name: str,
    checkpoint: str,
    columns: Sequence[str] = ("score", "prediction", "label"),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep the number of scored rows for each combination of ``columns`` as the table ``name``, up to date.

    The counts are the state: scores are rounded before, so it is bounded by their steps, not by the rows. The
    table is in the driver's memory and complete after each batch; ``metrics.report_of`` reads it.
    """
    counts = scored.groupBy(*columns).agg(F.count("*").alias("n_rows"))
    writer = counts.writeStream.format("memory").queryName(name).outputMode("complete")
    return _start_stateful(scored.sparkSession, lambda: _start(writer, checkpoint, trigger))


@dataclass(frozen=True)
class RunReport:
    """What a run did. ``late``: rows that came after the watermark; ``state_rows``: the most that its state held."""

    batches: int
    rows: int
    error: str | None
    late: int = 0
    state_rows: int = 0


class Tally(StreamingQueryListener):
    """Counts of each run of a query, however many batches it has, until they are reported."""

    def __init__(self) -> None:
        self.counts: dict[str, list[int]] = {}
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended[str(event.runId)] = Event()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        counts = self.counts.setdefault(str(event.progress.runId), [0, 0, 0, 0])
        counts[0] += 1
        counts[1] += event.progress.numInputRows
        for state in event.progress.stateOperators:
            counts[2] += state.numRowsDroppedByWatermark
            counts[3] = max(counts[3], state.numRowsTotal)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if ended := self.ended.get(str(event.runId)):
            ended.set()

    def report(self, query: StreamingQuery, error: str | None) -> RunReport:
        """The counts, once the query's last event is in; they are given once."""
        run = str(query.runId)
        ended = self.ended.get(run)
        if ended is None:  # it began before the tally
            progress = query.recentProgress
            if len(progress) >= int(SparkSession.active().conf.get(RECENT)):
                raise RuntimeError("the query began before the tally, and Spark keeps its last batches only")
            return RunReport(len(progress), sum(p["numInputRows"] for p in progress), error)
        if not ended.wait(SETTLE_SECONDS):
            raise RuntimeError("the last batches of the query are not reported yet")
        self.ended.pop(run)
        batches, rows, late, state_rows = self.counts.pop(run, (0, 0, 0, 0))
        return RunReport(batches, rows, error, late, state_rows)


_TALLIES: dict[str, Tally] = {}


def tally(spark: SparkSession) -> Tally:
    """The session's tally. Ask for it before a query starts, as the functions here do."""
    application = spark.sparkContext.applicationId
    if application not in _TALLIES:
        _TALLIES[application] = Tally()
        spark.streams.addListener(_TALLIES[application])
    return _TALLIES[application]


def run(query: StreamingQuery, timeout: int | None = None, raise_on_error: bool = True) -> RunReport:
    """Wait for a query and report what it did. Without ``raise_on_error`` a failure is in the report."""
    error = None
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.stop()
    except StreamingQueryException as failure:
        if raise_on_error:
            raise
        error = str(failure)
    return tally(SparkSession.active()).report(query, error)
